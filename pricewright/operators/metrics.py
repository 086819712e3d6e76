"""Regression metrics as plain aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

METRICS = ("mae", "mse", "rmse", "r2")


def metric_columns(label: Column | str = "label", prediction: Column | str = "prediction") -> list[Column]:
    """rows, MAE, MSE, RMSE and R2 of a group of predictions.

    Rows lacking a label or a prediction (null or NaN) do not count. R2 is null when the
    label is constant. The deviation of the label is taken as a variance, not
    as a difference of large sums.
    """
    y = F.col(label) if isinstance(label, str) else label
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    error = y - F.nanvl(p.cast("double"), F.lit(None).cast("double"))
    scored = F.when(error.isNotNull(), y)
    spread = F.var_pop(scored)
    mse = F.avg(error * error)
    return [
        F.count(error).alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        (1 - mse / F.nullif(spread, F.lit(0.0))).alias("r2"),
    ]


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", *by: str) -> DataFrame:
    """All metrics in one pass, per group if ``by`` is given."""
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(*metric_columns(F.col(f"`{label}`"), F.col(f"`{prediction}`")))


def long_predictions(
    df: DataFrame, keys: str | Sequence[str], label: str, models: dict[str, str]
) -> DataFrame:
    """(keys, model, label, prediction) rows from one prediction column per model."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(name).alias("model"), F.col(f"`{c}`").cast("double").alias("prediction"))
            for name, c in models.items()
        ])
    )
    return df.select(*keys, F.col(f"`{label}`").alias("label"), pairs.alias("p")).select(
        *keys, "p.model", "label", "p.prediction"
    )


def leaderboard(predictions: DataFrame) -> DataFrame:
    """One row per model with its metrics and its rank by R2.

    The window sees one row per model.
    """
    scores = evaluate(predictions, "label", "prediction", "model")
    order = Window.orderBy(F.desc("r2"))
    return scores.withColumn("rank", F.rank().over(order)).orderBy(F.desc("r2"), "model")
