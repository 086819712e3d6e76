"""Fitted pipelines as SQL expressions."""

import duckdb
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from pricewright.operators.model_sql import feature_statements, prediction_sql
from pricewright.operators.models import least_squares
from pricewright.plans.pipelines import LABEL, comparison_columns, fit_comparison_features, for_scoring
from pricewright.plans.training import fit_linear


@pytest.fixture(scope="module")
def unique_market(small_market):
    """One row per key, so that results can be joined on it."""
    rows = small_market.dropDuplicates(["row_key"]).persist()
    yield rows
    rows.unpersist()


def _prepared(spark, model, rows):
    for statement in feature_statements(model):
        rows = spark.sql(statement.replace("__THIS__", "{rows}"), rows=rows)
    return rows


def _close(df):
    off = F.abs(F.col("prediction") - F.col("again")) > 1e-6 * (1 + F.abs("prediction"))
    return df.agg(F.count_if(off | (F.col("prediction").isNull() != F.col("again").isNull())).alias("n")).first()["n"] == 0


def test_linear_pipeline(spark, unique_market):
    model = fit_linear(unique_market, keep=["row_key"])
    again = _prepared(spark, model, unique_market).select(
        "row_key", F.expr(prediction_sql(model)).alias("again"))
    both = model.transform(unique_market).select("row_key", "prediction").join(again, "row_key")
    assert both.count() == unique_market.count() and _close(both)


def test_dummies_and_population_scaler(spark, unique_market):
    rows = comparison_columns(unique_market)
    features = fit_comparison_features(rows)
    regressor = least_squares(label=LABEL).fit(features.transform(rows))
    model = PipelineModel(stages=[features, regressor])
    again = _prepared(spark, model, rows).select("row_key", F.expr(prediction_sql(model)).alias("again"))
    assert _close(model.transform(rows).select("row_key", "prediction").join(again, "row_key"))


def test_unseen_type_and_quotes(spark, unique_market):
    named = unique_market.withColumn("type", F.when(F.col("type") == "organic", "farmer's").otherwise(F.col("type")))
    model = for_scoring(fit_linear(named, keep=["row_key"]), "keep")
    odd = named.limit(20).withColumn("type", F.lit("new"))
    rows = named.limit(20).unionByName(odd.withColumn("row_key", F.concat("row_key", F.lit("x")))).persist()
    again = _prepared(spark, model, rows).select("row_key", F.expr(prediction_sql(model)).alias("again"))
    assert _close(model.transform(rows).select("row_key", "prediction").join(again, "row_key"))
    rows.unpersist()


def test_another_engine_runs_the_expression(spark, unique_market):
    model = fit_linear(unique_market, keep=["row_key"])
    rows = _prepared(spark, model, unique_market).toPandas()
    text = prediction_sql(model, quote='"')
    got = dict(duckdb.sql(f"SELECT row_key, {text} FROM rows").fetchall())
    assert len(rows) == len(got)
    for r in model.transform(unique_market).select("row_key", "prediction").collect():
        assert got[r["row_key"]] == pytest.approx(r["prediction"], rel=1e-9)


def test_unknown_stage_is_an_error(unique_market):
    stage = Bucketizer(splits=[0.0, 1.0, 2.0], inputCol="AveragePrice", outputCol="b")
    with pytest.raises(TypeError, match="Bucketizer"):
        prediction_sql(Pipeline(stages=[stage]).fit(unique_market))
