"""Feature pipelines, declared once and saved together with their model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    MinMaxScaler,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import DAY_FIRST, parse_date
from ..functions.scalars import TYPE_CODES
from ..operators.encoders import DummyEncoder, ExtraColumns, PopulationScaler

LABEL = "AveragePrice"

# Columns that enter the linear model as logarithms.
LOG_COLUMNS = ("4225", "4770", "Small Bags", "Large Bags", "XLarge Bags")

# Columns standardised for the model comparison.
VOLUME_COLUMNS = (
    "Total Volume", "4046", "4225", "4770",
    "Total Bags", "Small Bags", "Large Bags", "XLarge Bags",
)

# Settings of the linear price model and of its search grid.
LINEAR_DEFAULTS = {"maxIter": 500, "regParam": 0.3, "elasticNetParam": 0.8}
REG_PARAMS = (0.05, 0.1, 0.2, 0.5)
ELASTIC_NET_PARAMS = (0.01, 0.5, 1.0)
FOLDS = 10

LINEAR_FEATURES = ("year", "month_scaled", *[f"LOG {c}" for c in LOG_COLUMNS], "type_index")


def feature_sql(keep: Sequence[str] = (), fmt: str = DAY_FIRST) -> str:
    """Projection of a market table: label, type, logarithms, year, month.

    ``keep`` passes columns through that the model does not use (row key,
    fold). A date that does not fit the format gives a null year and month.
    """
    items = [f"`{c}`" for c in (*keep, LABEL, "type")]
    items += [f"ln(`{c}` + 1) AS `LOG {c}`" for c in LOG_COLUMNS]
    day = f"cast(try_to_timestamp(`Date`, '{fmt}') AS date)"
    items += [f"year({day}) AS year", f"month({day}) AS month"]
    return f"SELECT {', '.join(items)} FROM __THIS__"


def linear_features(
    keep: Sequence[str] = (), fmt: str = DAY_FIRST, handle_invalid: str = "error"
) -> Pipeline:
    """The eight-wide standardised feature vector of the linear price model."""
    numeric = [c for c in LINEAR_FEATURES if c != "type_index"]
    return Pipeline(stages=[
        SQLTransformer(statement=feature_sql(keep, fmt)),
        StringIndexer(inputCol="type", outputCol="type_index", handleInvalid=handle_invalid),
        VectorAssembler(inputCols=["month"], outputCol="month_vec", handleInvalid=handle_invalid),
        MinMaxScaler(inputCol="month_vec", outputCol="month_scaled"),
        VectorAssembler(inputCols=numeric, outputCol="features_num", handleInvalid=handle_invalid),
        VectorAssembler(
            inputCols=["type_index"], outputCol="features_cat", handleInvalid=handle_invalid
        ),
        StandardScaler(
            inputCol="features_num", outputCol="features_scaled", withMean=True, withStd=True
        ),
        VectorAssembler(inputCols=["features_scaled", "features_cat"], outputCol="features"),
    ])


def linear_regression(**params) -> LinearRegression:
    settings = {**LINEAR_DEFAULTS, **params}
    return LinearRegression(
        featuresCol="features", labelCol=LABEL, predictionCol="prediction", **settings
    )


def linear_pipeline(keep: Sequence[str] = (), **params) -> Pipeline:
    """Features and regressor as one nested pipeline."""
    return Pipeline(stages=[linear_features(keep), linear_regression(**params)])


def comparison_expressions(fmt: str = DAY_FIRST) -> list[str]:
    day = f"cast(try_to_timestamp(`Date`, '{fmt}') AS date)"
    codes = " ".join(f"WHEN '{k}' THEN {v}" for k, v in TYPE_CODES.items())
    return [
        f"year({day}) AS sold_year",
        f"month({day}) AS sold_month",
        f"CASE `type` {codes} END AS type_code",
    ]


def comparison_features(fmt: str = DAY_FIRST) -> Pipeline:
    """Features of the model comparison.

    Calendar numbers, type code, region dummies and the eight standardised
    volume columns. The scaler is a stage, so a saved model scales new data
    the way its training data was scaled.
    """
    return Pipeline(stages=[
        ExtraColumns(expressions=comparison_expressions(fmt)),
        DummyEncoder(inputCols=["region"], numbered=True),
        PopulationScaler(inputCols=list(VOLUME_COLUMNS)),
    ])


def comparison_columns(df: DataFrame) -> DataFrame:
    """The columns the comparison reads: what is worth caching for its fits."""
    names = ["row_key", LABEL, "Date", "type", "region", *VOLUME_COLUMNS]
    return df.select(*[F.col(f"`{c}`") for c in names])


def comparison_assembler(features: PipelineModel) -> VectorAssembler:
    """The vector over the columns a fitted ``comparison_features`` writes."""
    dummies = features.stages[1].output_columns()
    columns = [*VOLUME_COLUMNS, "type_code", "sold_year", "sold_month", *dummies]
    return VectorAssembler(inputCols=columns, outputCol="features")


def fit_comparison_features(train: DataFrame, fmt: str = DAY_FIRST) -> PipelineModel:
    fitted = comparison_features(fmt).fit(train)
    return PipelineModel(stages=[*fitted.stages, comparison_assembler(fitted)])


def for_scoring(
    model: PipelineModel, handle_invalid: str = "keep", keep: Sequence[str] = ()
) -> PipelineModel:
    """A copy of a fitted pipeline that does not fail on null or unseen values.

    'keep' gives unseen types their own index and nulls NaN features; 'skip'
    drops such rows; 'error' is what training uses. ``keep`` names columns of
    the scored data that the feature SQL shall pass through.
    """
    passed = "".join(f"`{c}`, " for c in keep)

    def relax(stage):
        if isinstance(stage, PipelineModel):
            return PipelineModel(stages=[relax(s) for s in stage.stages])
        stage = stage.copy()
        if isinstance(stage, SQLTransformer):
            stage.setStatement(stage.getStatement().replace("SELECT ", f"SELECT {passed}", 1))
        if stage.hasParam("handleInvalid"):
            stage.set(stage.getParam("handleInvalid"), handle_invalid)
        return stage

    return relax(model)


def check_input(df: DataFrame, fmt: str = DAY_FIRST) -> DataFrame:
    """One row: total rows, bad dates, and negative or missing log columns."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(parse_date("Date", fmt).isNull()).alias("bad_dates"),
        *[
            F.count_if(F.col(f"`{c}`").isNull() | (F.col(f"`{c}`") < 0)).alias(f"bad {c}")
            for c in LOG_COLUMNS
        ],
    )


def usable_rows(df: DataFrame, fmt: str = DAY_FIRST) -> tuple[DataFrame, DataFrame]:
    """(rows training can use, rows it cannot): no row is lost in between."""
    good = parse_date("Date", fmt).isNotNull()
    for c in LOG_COLUMNS:
        good = good & F.coalesce(F.col(f"`{c}`") >= 0, F.lit(False))
    return df.where(good), df.where(~good)
