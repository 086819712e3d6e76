import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from pricewright.functions import log_plus_one, micros_per_row, month_name, parse_date, type_code
from pricewright.operators.encoders import (
    DummyEncoder,
    DummyEncoderModel,
    ExtraColumns,
    PopulationScaler,
)
from pricewright.operators.split import split
from pricewright.plans.pipelines import (
    fit_comparison_features,
    check_input,
    comparison_features,
    feature_sql,
    for_scoring,
    linear_features,
    linear_pipeline,
    usable_rows,
)
from pricewright.session import new_path


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr.alias("y")).first()["y"]


@pytest.mark.parametrize("value, want", [
    (-1.0, None), (-2.0, None), (0.0, 0.0), (1e-18, 0.0), (None, None), (math.e - 1, 1.0),
])
def test_log_domain(spark, value, want):
    assert one(spark, value, "double", log_plus_one("x")) == want


@pytest.mark.parametrize("text, want", [
    ("27-12-2015", "2015-12-27"), ("04-01-2015", "2015-01-04"), ("2015-12-27", None),
    ("31-02-2015", None), ("", None), (None, None),
])
def test_dates_never_fail(spark, text, want):
    got = one(spark, text, "string", parse_date("x", "dd-MM-yyyy"))
    assert (got and str(got)) == want


@pytest.mark.parametrize("text, want", [
    ("conventional", 0), ("organic", 1), ("wild", None), (None, None),
])
def test_type_codes(spark, text, want):
    assert one(spark, text, "string", type_code("x")) == want


@pytest.mark.parametrize("month, want", [(1, "JAN"), (9, "SEPT"), (12, "DEC"), (13, None), (0, None)])
def test_month_names(spark, month, want):
    assert one(spark, month, "int", month_name("x")) == want


def test_time_per_row_of_nothing_is_null(spark):
    assert one(spark, 0, "int", micros_per_row(F.lit(2.0), "x")) is None
    assert one(spark, 4, "int", micros_per_row(F.lit(2.0), "x")) == 500_000


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 3)), min_size=1, max_size=20))
def test_population_scaler_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = [r["x"] for r in PopulationScaler(inputCols=["x"]).fit(df).transform(df).collect()]
    std = np.std(values)
    if std > 1e-6:
        np.testing.assert_allclose(sorted(got), sorted((values - np.mean(values)) / std), atol=1e-6)


def test_constant_column_is_centred(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    rows = PopulationScaler(inputCols=["x"]).fit(df).transform(df).collect()
    assert {r["x"] for r in rows} == {0.0}


def test_dummies_drop_the_first_level_and_zero_the_unseen(spark):
    fit = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "region string")
    model = DummyEncoder(inputCols=["region"]).fit(fit)
    assert model.output_columns() == ["region_b", "region_c"]
    new = spark.createDataFrame([("a",), ("c",), ("z",), (None,)], "region string")
    rows = {r["region"]: (r["region_b"], r["region_c"]) for r in model.transform(new).collect()}
    assert rows == {"a": (0, 0), "c": (0, 1), "z": (0, 0), None: (0, 0)}
    with pytest.raises(PySparkException, match="unseen level in region: z"):
        model.setHandleInvalid("error").transform(new.where("region = 'z'")).collect()


def test_numbered_dummies_take_any_level(spark, small_market):
    levels = ["", "St. Louis", "b", "B", "a`b", "a b"]
    fit = spark.createDataFrame([(v,) for v in levels], "region string")
    model = DummyEncoder(inputCols=["region"], numbered=True).fit(fit)
    assert model.output_columns() == [f"region_{i}" for i in range(1, 6)]
    rows = {r["region"]: list(r)[1:] for r in model.transform(fit).collect()}
    for i, level in enumerate(sorted(levels)):
        assert rows[level] == [int(i == j) for j in range(1, 6)]
    level = F.element_at(F.array(*[F.lit(v) for v in levels]), F.pmod(F.hash("row_key"), F.lit(6)) + 1)
    odd = small_market.withColumn("region", level)
    vectors = fit_comparison_features(odd).transform(odd)
    assert vectors.first()["features"].size == 8 + 3 + 5


def test_dummy_levels_survive_saving(spark):
    fit = spark.createDataFrame([("b b",), ("a'",), ("ü",)], "region string")
    path = new_path(spark, "model")
    model = DummyEncoder(inputCols=["region"]).fit(fit)
    model.save(path)
    again = DummyEncoderModel.load(path)
    assert again.vocabulary() == model.vocabulary()
    assert again.transform(fit).collect() == model.transform(fit).collect()


def test_index_ties_go_by_name(spark):
    df = spark.createDataFrame([(v,) for v in "bbaac"], "x string")
    assert StringIndexer(inputCol="x", outputCol="i").fit(df).labels == ["a", "b", "c"]


def test_python_stages_work_inside_saved_pipelines(spark, small_market):
    train, test = split(small_market)
    model = comparison_features().fit(train)
    path = new_path(spark, "model")
    model.save(path)
    again = PipelineModel.load(path)
    columns = ["row_key", "`Total Volume`", "type_code", "sold_year"]
    a = model.transform(test).select(*columns).orderBy("row_key").collect()
    assert a == again.transform(test).select(*columns).orderBy("row_key").collect()


def test_extra_columns_in_a_pipeline(spark):
    df = spark.createDataFrame([(2.0,)], "x double")
    out = Pipeline(stages=[ExtraColumns(expressions=["x * 2 AS y"])]).fit(df).transform(df)
    assert out.first()["y"] == 4.0


def test_constant_month_scales_to_one_half(spark, small_market):
    rows = small_market.limit(50).withColumn("Date", F.lit("05-03-2015"))
    fitted = linear_features().fit(rows)
    row = fitted.transform(rows).first()
    assert row["month_scaled"][0] == 0.5
    assert row["features_scaled"][0] == 0.0


def test_bad_rows_are_counted_and_kept_apart(spark, small_market):
    bad = small_market.limit(3).withColumn("Date", F.lit("2015-12-27"))
    negative = small_market.limit(2).withColumn("4225", F.lit(-1.0))
    rows = small_market.unionByName(bad).unionByName(negative)
    counts = check_input(rows).first()
    assert counts["bad_dates"] == 3 and counts["bad 4225"] == 2
    good, rest = usable_rows(rows)
    assert (good.count(), rest.count()) == (small_market.count(), 5)


def test_training_fails_on_unseen_types_and_scoring_does_not(spark, small_market):
    train, test = split(small_market)
    model = linear_pipeline().fit(train)
    odd = test.limit(5).withColumn("type", F.lit("wild"))
    with pytest.raises(Exception, match="Unseen label"):
        model.transform(odd).select("prediction").collect()
    scored = for_scoring(model, keep=["row_key"]).transform(odd)
    assert scored.select("row_key", "prediction").count() == 5
    skipped = for_scoring(model, "skip").transform(odd)
    assert skipped.count() == 0


def test_feature_sql_quotes_names():
    sql = feature_sql(keep=["row_key"])
    assert "`LOG 4225`" in sql and "`row_key`" in sql and "try_to_timestamp" in sql
