"""Elastic-net models of many groups at once, fitted inside Spark from moments.

One grouped aggregate gives each group's second moments; coordinate descent
then runs in a projection over the (group, parameters) rows. Nothing is
collected, so there may be as many groups as a table has rows to offer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def grouped_moments(df: DataFrame, features: Sequence[str], label: str, by: Sequence[str]) -> DataFrame:
    """``by`` and ``moments``: sums of the products of (1, features, label), row by row.

    Rows with a null in any feature or in the label count nowhere.
    """
    names = [*features, label]
    complete = df.dropna(subset=[f"`{c}`" for c in names])
    terms = [F.lit(1.0), *[F.col(f"`{c}`").cast("double") for c in names]]
    size = len(terms)
    sums = {(i, j): f"_s{i}_{j}" for i in range(size) for j in range(i, size)}
    out = complete.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        *[F.sum(terms[i] * terms[j]).alias(name) for (i, j), name in sums.items()])
    flat = F.array(*[F.col(sums[min(i, j), max(i, j)]) for i in range(size) for j in range(size)])
    return out.select(*[F.col(f"`{c}`") for c in by], flat.alias("moments"))


def without_each(moments: DataFrame, fold: str) -> DataFrame:
    """Moments of all other folds for each fold; a single fold is left with none of its own."""
    long = moments.select(fold, F.posexplode("moments").alias("at", "own"))
    total = long.groupBy("at").agg(F.sum("own").alias("all"))
    rest = long.join(total, "at").select(fold, F.struct("at", (F.col("all") - F.col("own")).alias("rest")).alias("m"))
    return rest.groupBy(fold).agg(
        F.transform(F.array_sort(F.collect_list("m")), lambda x: x["rest"]).alias("moments"))


def _at(values: Column, i: Column | int) -> Column:
    return F.get(values, F.lit(i) if isinstance(i, int) else i)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def elastic_net_fits(
    moments: DataFrame, grid: Sequence[tuple[float, float]], width: int, max_iter: int = 500, tol: float = 1e-10
) -> DataFrame:
    """One row per row of ``moments`` and (penalty, mix) of ``grid``, with the model that
    minimises Spark's elastic-net objective.

    Adds reg_param, elastic_net_param, intercept, coefficients, sweeps and
    converged (whether the last sweep moved no coefficient by more than ``tol``
    within ``max_iter`` sweeps). ``width`` is the number of features. Features
    and label are standardised and the penalty is divided by the label's
    deviation; a constant feature gets coefficient 0, a constant label its mean.
    """
    size = width + 2
    keys = [c for c in moments.columns if c != "moments"]
    points = F.explode(F.array(*[
        F.struct(F.lit(float(r)).alias("reg_param"), F.lit(float(m)).alias("elastic_net_param")) for r, m in grid]))
    index = F.sequence(F.lit(0), F.lit(width - 1))
    m = F.col("moments")
    rows = moments.withColumn("_mean", F.transform(F.slice(m, 1, size), lambda v: v / _at(m, 0)))
    cov = lambda i, j: _at(m, i * size + j) / _at(m, 0) - _at(F.col("_mean"), i) * _at(F.col("_mean"), j)
    spread = F.transform(index, lambda i: F.sqrt(F.greatest(cov(i + 1, i + 1), F.lit(0.0))))
    rows = rows.withColumn("_spread", spread).withColumn(
        "_sy", F.sqrt(F.greatest(cov(F.lit(size - 1), F.lit(size - 1)), F.lit(0.0))))
    # a feature whose spread is lost in rounding is constant
    rows = rows.withColumn("_live", F.transform("_spread", lambda s, i: s > 1e-9 * F.abs(_at(F.col("_mean"), i + 1))))
    rows = rows.withColumn("_scale", F.zip_with("_spread", "_live", lambda s, on: F.when(on, s).otherwise(1.0)))
    rows = rows.withColumn("_a", F.transform(index, lambda i: F.transform(
        index, lambda j: cov(i + 1, j + 1) / (_at(F.col("_scale"), i) * _at(F.col("_scale"), j)))))
    rows = rows.withColumn("_r", F.transform(index, lambda i: F.when(
        F.col("_sy") > 0, cov(i + 1, F.lit(size - 1)) / (_at(F.col("_scale"), i) * F.col("_sy"))).otherwise(0.0)))
    rows = rows.withColumn("_p", points).select("*", "_p.*")
    unit = F.when(F.col("_sy") > 0, F.col("reg_param") / F.col("_sy")).otherwise(0.0)
    rows = rows.withColumn("_l1", unit * F.col("elastic_net_param")).withColumn(
        "_l2", unit * (1 - F.col("elastic_net_param")))

    def moved(beta: Column, j: Column) -> Column:
        row = _at(F.col("_a"), j)
        own = _at(row, j)
        rest = _at(F.col("_r"), j) - _dot(row, beta) + own * _at(beta, j)
        shrunk = F.signum(rest) * F.greatest(F.abs(rest) - F.col("_l1"), F.lit(0.0)) / (own + F.col("_l2"))
        return F.when(_at(F.col("_live"), j), shrunk).otherwise(0.0)

    def one_sweep(beta: Column) -> Column:
        return F.aggregate(index, beta, lambda b, j: F.transform(
            b, lambda v, i: F.when(i == j, moved(b, j)).otherwise(v)))

    def step(acc: Column, _: Column) -> Column:
        after = F.struct(one_sweep(acc["beta"]).alias("beta"), acc["beta"].alias("before"), (acc["sweeps"] + 1).alias("sweeps"))
        far = F.exists(F.zip_with(acc["beta"], acc["before"], lambda x, y: F.abs(x - y)), lambda d: d > tol)
        return F.when((acc["sweeps"] > 0) & ~far, acc).otherwise(after)

    zero = F.transform(index, lambda i: F.lit(0.0))
    start = F.struct(zero.alias("beta"), zero.alias("before"), F.lit(0).alias("sweeps"))
    rows = rows.withColumn("_fit", F.aggregate(F.sequence(F.lit(1), F.lit(max_iter)), start, step))
    beta = F.transform("_fit.beta", lambda b, i: b * F.col("_sy") / _at(F.col("_scale"), i))
    rows = rows.withColumn("coefficients", beta)
    intercept = _at(F.col("_mean"), size - 1) - _dot(F.slice("_mean", 2, width), F.col("coefficients"))
    settled = ~F.exists(F.zip_with("_fit.beta", "_fit.before", lambda x, y: F.abs(x - y)), lambda d: d > tol)
    return rows.select(
        *keys, "reg_param", "elastic_net_param", intercept.alias("intercept"), "coefficients",
        F.col("_fit.sweeps").alias("sweeps"), settled.alias("converged"))
