"""Profiling: summaries, counts, box and letter values, histogram, density."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import DAY_FIRST, month_name, parse_date
from ..session import small_side
from .quantiles import BINS, exact_quantiles

NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")
DENSITY_POINTS = 200
#: Linear bins of the pre-binned density.
DENSITY_BINS = 4096
DENSITY_CUT = 3.0


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def preview(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """First n rows in key order, so that the preview is repeatable."""
    return df.orderBy(_c(key)).limit(n)


def column_info(df: DataFrame) -> DataFrame:
    """Per column: position, type, non-null count; and the shape of the frame."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count(_c(c)).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    per_column = F.explode(
        F.array(*[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column"),
                F.lit(t).alias("dtype"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, (c, t) in enumerate(df.dtypes)
        ])
    )
    return counts.select("rows", per_column.alias("p")).select(
        "p.*", "rows", F.lit(len(df.columns)).alias("columns")
    )


def describe(
    df: DataFrame, columns: Sequence[str] | None = None, bins: int = BINS
) -> DataFrame:
    """count, mean, sample std, min, quartiles and max, one row per column.

    The moments of all columns come from one aggregate. Quartiles are exact;
    they run over (column, value) pairs so that one set of passes serves all
    columns.
    """
    columns = list(columns or [c for c, t in df.dtypes if t in NUMERIC])
    stats = ("count", "mean", "std", "min", "max")
    agg = [
        fn(_c(c).cast("double")).alias(f"{s}{i}")
        for i, c in enumerate(columns)
        for s, fn in zip(stats, (F.count, F.avg, F.stddev_samp, F.min, F.max))
    ]
    per_column = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{s}{i}").alias(s) for s in stats])
            for i, c in enumerate(columns)
        ])
    )
    moments = df.agg(*agg).select(per_column.alias("p")).select("p.*")
    pairs = df.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("column"), _c(c).cast("double").alias("value"))
                for c in columns
            ])
        ).alias("p")
    ).select("p.*")
    quartiles = exact_quantiles(pairs, "value", (0.25, 0.5, 0.75), ["column"], bins)
    q = F.col("q")
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min",
        q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), "max",
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(_c(column).alias(column)).agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of values."""
    return df.groupBy(*[_c(c).alias(c) for c in columns]).agg(F.count("*").alias("count"))


def counts_by_month(df: DataFrame, date_col: str = "Date", fmt: str = DAY_FIRST) -> DataFrame:
    """Rows per month label."""
    label = month_name(F.month(parse_date(_c(date_col), fmt)))
    return df.groupBy(label.alias("Month")).agg(F.count("*").alias("count"))


def box_stats(
    df: DataFrame, value: str, by: str, whisker: float = 1.5, bins: int = BINS
) -> DataFrame:
    """Quartiles, whisker ends and outlier count of ``value`` per group."""
    quartiles = exact_quantiles(df, value, (0.25, 0.5, 0.75), [by], bins)
    q = F.col("q")
    reach = whisker * (q[2] - q[0])
    fences = quartiles.select(
        by, "n", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - reach).alias("low_fence"), (q[2] + reach).alias("high_fence"),
    )
    joined = df.select(_c(by).alias(by), _c(value).alias("x")).join(small_side(fences), by)
    x = F.col("x")
    inside = x.between(F.col("low_fence"), F.col("high_fence"))
    return joined.groupBy(by, "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    )


def letter_probs(depth: int) -> list[float]:
    """.5, .25, .75, .125, .875, ... down to 1 / 2**depth."""
    probs = [0.5]
    for level in range(2, depth + 1):
        tail = 0.5 ** level
        probs += [tail, 1 - tail]
    return probs


def letter_values(
    df: DataFrame, value: str, by: str, depth: int = 4, bins: int = BINS
) -> DataFrame:
    """Letter values of ``value`` per group, one row per (group, probability)."""
    probs = letter_probs(depth)
    out = exact_quantiles(df, value, probs, [by], bins)
    pairs = F.explode(
        F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("q").alias("value"))
    )
    return out.select(by, "n", pairs.alias("p")).select(by, "n", "p.prob", "p.value")


def histogram(
    df: DataFrame, value: str, cap: int | None = None, bins: int = BINS
) -> DataFrame:
    """Density histogram with the Freedman-Diaconis bin count, at most ``cap`` if given.

    All bins are listed, empty ones too; the last one includes its right edge.
    """
    rows = df.select(_c(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    quartiles = exact_quantiles(rows, "x", (0.25, 0.75), (), bins).first()
    n, q = quartiles["n"], quartiles["q"]
    if not n:
        return df.sparkSession.createDataFrame(
            [], "bin int, low double, high double, count bigint, density double"
        )
    low, high = rows.agg(F.min("x"), F.max("x")).first()
    width = 2 * (q[1] - q[0]) / n ** (1 / 3)
    bins = int(np.ceil((high - low) / width)) if width > 0 else int(n ** 0.5)
    bins = bins if cap is None else min(bins, cap)
    if high == low:
        low, high = low - 0.5, high + 0.5
    bins = max(bins, 1)
    step = (high - low) / bins
    slot = F.least(F.floor((F.col("x") - low) / step), F.lit(bins - 1)).cast("int")
    counts = rows.groupBy(slot.alias("bin")).agg(F.count("*").alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = every.join(counts, "bin", "left")
    count = F.coalesce("count", F.lit(0))
    return filled.select(
        "bin",
        (low + F.col("bin") * step).alias("low"),
        (low + (F.col("bin") + 1) * step).alias("high"),
        count.alias("count"),
        (count / (n * step)).alias("density"),
    )


def density(
    df: DataFrame, value: str, points: int = DENSITY_POINTS, cut: float = DENSITY_CUT
) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid.

    Every task adds the kernels of its own rows into one array of ``points``
    sums, so ``points`` rows per task are shuffled whatever the row count.
    """
    rows = df.select(_c(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    n, std, low, high = rows.agg(
        F.count("*"), F.stddev_samp("x"), F.min("x"), F.max("x")
    ).first()
    schema = "point int, x double, density double"
    if not n or not std:
        return df.sparkSession.createDataFrame([], schema)
    band = std * n ** (-1 / 5)
    start, stop = low - cut * band, high + cut * band
    step = (stop - start) / (points - 1)
    grid = start + step * np.arange(points)

    def kernel_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(points)
        for batch in batches:
            x = batch["x"].to_numpy()
            for at in range(0, len(x), 4096):
                u = (x[at:at + 4096, None] - grid[None, :]) / band
                total += np.exp(-0.5 * u * u).sum(axis=0)
        yield pd.DataFrame({"point": np.arange(points, dtype="int32"), "s": total})

    scale = n * band * float(np.sqrt(2 * np.pi))
    return (
        rows.mapInPandas(kernel_sums, "point int, s double")
        .groupBy("point").agg(F.sum("s").alias("s"))
        .select(
            "point",
            (start + F.col("point") * step).alias("x"),
            (F.col("s") / scale).alias("density"),
        )
    )


def binned_density(
    df: DataFrame, value: str, points: int = DENSITY_POINTS, cut: float = DENSITY_CUT,
    bins: int = DENSITY_BINS,
) -> DataFrame:
    """``density`` from ``bins`` linear bins: point, x, density, error_bound.

    A row is shared between the two bin edges around it, so rows are read for
    one count and one sum per bin, and kernels are computed per edge and point.
    Between two edges the kernel is replaced by its chord, hence the bound on
    the difference to ``density``. Nulls are left out; without two different
    values the result is empty.
    """
    rows = df.select(_c(value).cast("double").alias("x")).where(F.col("x").isNotNull())
    n, std, low, high = rows.agg(
        F.count("*"), F.stddev_samp("x"), F.min("x"), F.max("x")
    ).first()
    if not n or not std:
        return df.sparkSession.createDataFrame(
            [], "point int, x double, density double, error_bound double")
    band = std * n ** (-1 / 5)
    start, stop = low - cut * band, high + cut * band
    step = (stop - start) / (points - 1)
    width = (high - low) / bins
    place = (F.col("x") - low) / width
    at = F.least(F.floor(place), F.lit(bins - 1))
    mass = rows.groupBy(at.alias("bin")).agg(
        F.count("*").alias("c"), F.sum(place - at).alias("right"))
    at_point = start + F.col("point") * step

    def kernel(edge: Column) -> Column:
        u = (at_point - (low + edge * width)) / band
        return F.exp(-0.5 * u * u)

    share = (F.col("c") - F.col("right")) * kernel(F.col("bin")) + F.col("right") * kernel(F.col("bin") + 1)
    spread = mass.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    root = float(np.sqrt(2 * np.pi))
    # a chord is off by at most an eighth of the squared width times the steepest bend
    bound = width**2 / 8 / (root * band**3)
    return spread.groupBy("point").agg(F.sum(share).alias("s")).select(
        "point", at_point.alias("x"), (F.col("s") / (n * band * root)).alias("density"),
        F.lit(bound).alias("error_bound"))
