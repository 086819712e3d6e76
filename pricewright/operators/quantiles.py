"""Exact linear-interpolated quantiles that do not hold a group in memory.

The interval that holds a wanted rank is narrowed: each pass counts rows per
bin of the interval (a map-side combined aggregate) and keeps only the bin with
the rank, until what is left is one value or few enough rows to count by value.
The first pass bins by sign and power of two, so that later intervals span less
than a factor of two and split evenly; whatever the values, a handful of passes
is enough. No pass shuffles or sorts the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, small_side

BINS = 4096             # bins per narrowing pass
INFINITE = 4000         # above the bin of every finite power of two


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    bins: int = BINS,
) -> DataFrame:
    """One row per group: the ``by`` columns, ``n`` and an array ``q``.

    ``q`` follows the order of ``probs``; nulls in ``value`` are ignored. A
    group with a NaN has NaN quantiles. Infinite values are values like any
    other; halfway between the two infinities is NaN.
    """
    keys = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(by)]
    names = [f"__k{i}" for i in range(len(by))]
    rows = df.select(
        *keys, F.col(f"`{value}`").cast("double").alias("x")
    ).where(F.col("x").isNotNull()).persist()
    try:
        # NaN is above all other values, so the largest value tells of one
        groups = cut_lineage(rows.groupBy(*names).agg(
            F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")
        ))
        nothing = F.array(*[F.lit(float("nan")) for _ in probs])
        unordered = groups.where(F.isnan("hi")).select(*names, "n", nothing.alias("q"))
        ordered = groups.where((F.col("n") > 0) & ~F.isnan("hi"))
        empty = groups.where("n = 0").select(*names, "n", F.lit(None).cast("array<double>").alias("q"))
        out = _narrowed(rows, ordered, list(probs), names, bins)
    finally:
        rows.unpersist()
    out = out.unionByName(unordered).unionByName(empty)
    return out.select(*[F.col(k).alias(c) for k, c in zip(names, by)], "n", "q")


def _narrowed(
    rows: DataFrame, groups: DataFrame, probs: list[float], names: list[str], bins: int
) -> DataFrame:
    """Quantiles of groups from the values at the two ranks around each."""
    position = F.explode(
        F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)
        ])
    )
    spots = groups.select("*", position.alias("s")).select(
        *names, "n", "lo", "hi", F.col("s.i").alias("i"),
        (F.col("s.p") * (F.col("n") - 1)).alias("at"),
    )
    targets = spots.select(
        *names, F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank"),
        "lo", "hi", F.lit(0).cast("long").alias("below"), "n",
    ).distinct()
    found = _values_at_ranks(rows, targets, names, bins)

    low = found.select(*names, F.col("rank").alias("r0"), F.col("x").alias("x0"))
    high = found.select(*names, F.col("rank").alias("r1"), F.col("x").alias("x1"))
    both = (
        spots.withColumn("r0", F.floor("at")).withColumn("r1", F.ceil("at"))
        .join(low, [*names, "r0"]).join(high, [*names, "r1"])
    )
    part, gap = F.col("at") - F.col("r0"), F.col("x1") - F.col("x0")
    # from the nearer end; a gap beyond the largest double is weighed from both
    near = F.when(part < 0.5, F.col("x0") + part * gap).otherwise(F.col("x1") - (1 - part) * gap)
    value = F.when(F.col("x0") == F.col("x1"), F.col("x0")).when(
        gap < float("inf"), near
    ).otherwise(F.col("x0") * (1 - part) + F.col("x1") * part)
    ordered = F.sort_array(F.collect_list(F.struct("i", value.alias("v"))))
    return both.groupBy(*names, "n").agg(ordered.getField("v").alias("q"))


def _power(x: Column) -> Column:
    """Bin of a number by sign and power of two; larger numbers never get a smaller bin."""
    size = F.when(F.abs(x) == float("inf"), INFINITE).otherwise(F.floor(F.log2(F.abs(x))) + 1100)
    return F.when(x == 0, 0).when(x > 0, size).otherwise(-size)


def _values_at_ranks(
    rows: DataFrame, targets: DataFrame, names: list[str], bins: int
) -> DataFrame:
    """The value at each zero-based rank of each group.

    ``targets`` holds the closed interval [lo, hi] around the rank, the number
    of rows ``below`` it and the number ``n`` inside it. Both ends of an
    interval fall into different bins, so every pass narrows it.
    """
    done = []
    pending = cut_lineage(targets)
    first = True
    while True:
        done.append(
            pending.where(F.col("lo") == F.col("hi")).select(*names, "rank", F.col("lo").alias("x"))
        )
        pending = pending.where(F.col("lo") < F.col("hi"))
        n_pending, widest = pending.agg(F.count("*"), F.max("n")).first()
        if not n_pending:
            return reduce(DataFrame.unionByName, done)
        spans = pending.select(*names, "lo", "hi").distinct()
        inside = _inside(rows, spans, n_pending, names)
        span = [*names, "lo", "hi"]
        if widest <= bins:
            step = F.col("x")
        elif first:
            step = _power(F.col("x"))
        else:
            scaled = (F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins
            step = F.least(F.floor(scaled), F.lit(bins - 1))
        first = False
        counts = inside.groupBy(*span, step.alias("bin")).agg(
            F.count("*").alias("n"), F.min("x").alias("x_lo"), F.max("x").alias("x_hi")
        )
        # a bounded number of bins per interval reaches this window
        running = Window.partitionBy(*span).orderBy("x_lo").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        counts = counts.select(
            *span, "x_lo", "x_hi", F.col("n").alias("inside"),
            (F.sum("n").over(running) - F.col("n")).alias("before"),
        )
        wanted = F.col("rank") - F.col("below")
        pending = cut_lineage(
            counts.join(small_side(pending, n_pending), span)
            .where((wanted >= F.col("before")) & (wanted < F.col("before") + F.col("inside")))
            .select(
                *names, "rank",
                F.col("x_lo").alias("lo"), F.col("x_hi").alias("hi"),
                (F.col("below") + F.col("before")).alias("below"),
                F.col("inside").alias("n"),
            )
        )


def _inside(rows: DataFrame, spans: DataFrame, n_spans: int, names: list[str]) -> DataFrame:
    """Rows that lie in an interval of their group.

    Intervals of a group do not overlap, so a row matches at most one and the
    join never grows the data.
    """
    x = F.col("x")
    if names:
        renamed = spans.select(*[F.col(k).alias(f"{k}_of") for k in names], "lo", "hi")
        fits = [F.col(k) == F.col(f"{k}_of") for k in names] + [x.between(F.col("lo"), F.col("hi"))]
        return rows.join(small_side(renamed, n_spans), fits).select(*names, "x", "lo", "hi")
    # without groups there are at most two intervals per wanted quantile
    low = high = F.lit(None).cast("double")
    for span in spans.collect():
        fits = x.between(span["lo"], span["hi"])
        low = F.when(fits, span["lo"]).otherwise(low)
        high = F.when(fits, span["hi"]).otherwise(high)
    return rows.select("x", low.alias("lo"), high.alias("hi")).where(F.col("lo").isNotNull())
