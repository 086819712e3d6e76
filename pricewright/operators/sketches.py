"""Profiles from mergeable quantile sketches: every group and column in one pass.

The exact forms in ``profile`` narrow values down in several passes. Here each
task keeps one sketch per group and column, of a size that does not depend on
the rows, and Spark merges them; a hot group is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Items a sketch keeps near its top level; the error falls almost as 1 / SKETCH_SIZE.
SKETCH_SIZE = 2048

# Fixed values of the published error curve of the sketch (99 % of all draws).
_ERROR_SCALE, _ERROR_POWER = 2.296, 0.9723

#: Whiskers reach to the last value within this many quartile distances.
WHISKER = 1.5


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far the share of rows below an answer is from the one asked for, in 99 % of cases."""
    return _ERROR_SCALE / size**_ERROR_POWER


def _value(name: str) -> Column:
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """One row per group and column: ``by``, column, sketch, count, mean, std, min, max.

    Null and NaN values are left out. A group without a value in a column has
    count 0 and nulls; an empty frame without ``by`` has one such row a column.
    """
    def summary(name: str) -> Column:
        x = _value(name)
        return F.struct(
            F.lit(name).alias("column"), F.kll_sketch_agg_double(x, F.lit(size)).alias("sketch"),
            F.count(x).alias("count"), F.mean(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"))

    groups = [F.col(f"`{b}`").alias(b) for b in by]
    rows = df.groupBy(*groups).agg(F.array(*[summary(c) for c in columns]).alias("s"))
    return rows.select(*[f"`{b}`" for b in by], F.inline("s"))


def _at(p: float | Column) -> Column:
    rank = F.lit(float(p)) if isinstance(p, (int, float)) else p
    return F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("sketch", rank))


def sketched_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], by: Sequence[str] = (),
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """``by``, column, probability, value: each value's rank is within ``rank_error`` of its probability."""
    rows = sketches(df, columns, by, size)
    answers = F.array(*[F.struct(F.lit(float(p)).alias("probability"), _at(p).alias("value")) for p in probabilities])
    return rows.select(*[f"`{b}`" for b in by], "column", F.inline(answers))


def sketched_describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """``by``, column, count, mean, std, min, q25, q50, q75, max; quartiles by sketch, the rest exact."""
    quartiles = [_at(p).alias(name) for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))]
    return sketches(df, columns, by, size).select(
        *[f"`{b}`" for b in by], "column", "count", "mean", "std", "min", *quartiles, "max")


def sketched_box(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """``by``, column, q1, median, q3, low, high, outside: quartiles, the values at
    the fences, and the estimated rows beyond them, from the same single pass."""
    rows = sketches(df, columns, by, size).withColumns(
        {"q1": _at(0.25), "median": _at(0.5), "q3": _at(0.75)})
    # the sketch answers fixed ranks only: an even grid of them, finer than its error
    grid = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(i / size) for i in range(size + 1)]))
    rows = rows.withColumn("grid", F.when(F.col("count") > 0, grid))
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.filter("grid", lambda v: (v >= F.col("q1") - reach) & (v <= F.col("q3") + reach))
    share = 1 - F.size(inside) / F.size("grid")
    return rows.withColumn("inside", inside).select(
        *[f"`{b}`" for b in by], "column", "q1", "median", "q3",
        F.array_min("inside").alias("low"), F.array_max("inside").alias("high"),
        F.when(F.col("count") > 0, F.round(share * F.col("count"))).cast("long").alias("outside"))


def sketched_letter_values(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), depth: int = 5, size: int = SKETCH_SIZE
) -> DataFrame:
    """``by``, column, depth, low, high: the pairs at 1/2, 1/4, ... of the rows."""
    levels = F.array(*[
        F.struct(F.lit(k).alias("depth"), _at(0.5**k).alias("low"), _at(1 - 0.5**k).alias("high"))
        for k in range(1, depth + 1)])
    return sketches(df, columns, by, size).select(*[f"`{b}`" for b in by], "column", F.inline(levels))


def rank_check(df: DataFrame, answers: DataFrame, columns: Sequence[str], error: float) -> DataFrame:
    """column, probability, within: whether each value's true rank in ``df`` is within ``error``.

    ``answers`` has a few rows (column, probability, value) for the whole frame;
    they come to the driver and are counted in one aggregate.
    """
    asked = answers.collect()
    share = []
    for r in asked:
        x = _value(r["column"])
        share.append(F.struct(
            F.lit(r["column"]).alias("column"), F.lit(r["probability"]).alias("probability"),
            F.avg((x < r["value"]).cast("double")).alias("below"), F.avg((x <= r["value"]).cast("double")).alias("upto")))
    rows = df.agg(F.array(*share).alias("s")).select(F.inline("s"))
    p = F.col("probability")
    return rows.select("column", "probability", (
        (F.col("below") - error <= p) & (p <= F.col("upto") + error)).alias("within"))
