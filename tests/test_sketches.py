import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from pricewright.operators import profile, sketches
from pricewright.plans.pipelines import LABEL
from pricewright.sources import market

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(5)
    n = 40000
    return pd.DataFrame({
        # a third of all rows share one value; group a holds most rows
        "x y": np.where(rng.random(n) < 1 / 3, 7.25, np.exp(rng.normal(0, 4, n))),
        "z": rng.normal(size=n), "g": rng.choice(["a", "a", "a", "b"], n)})


def _within(data, p, value, error):
    return (data < value).mean() - error <= p <= (data <= value).mean() + error


@pytest.mark.parametrize("size", [200, 2048])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks_are_within_the_stated_error(spark, values, size, by):
    rows = spark.createDataFrame(values).repartition(16)
    out = sketches.sketched_quantiles(rows, ["x y", "z"], PROBS, by, size).collect()
    assert len(out) == (2 if by else 1) * 2 * len(PROBS)
    for r in out:
        mine = values[values.g == r.g] if by else values
        assert _within(mine[r.column], r.probability, r.value, 2 * sketches.rank_error(size))


def test_one_pass_and_one_shuffle(spark, values):
    out = sketches.sketched_describe(spark.createDataFrame(values), ["x y", "z"], ["g"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan") == 1


def test_describe_box_and_letter_values(spark, values):
    rows = spark.createDataFrame(values)
    error = 2 * sketches.rank_error()
    for r in sketches.sketched_describe(rows, ["x y", "z"], ["g"]).collect():
        mine = values[values.g == r.g][r.column]
        assert (r["count"], r.min, r.max) == (len(mine), mine.min(), mine.max())
        assert np.isclose(r.mean, mine.mean()) and np.isclose(r.std, mine.std())
        assert _within(mine, 0.25, r.q25, error) and _within(mine, 0.5, r.q50, error) and _within(mine, 0.75, r.q75, error)
    for r in sketches.sketched_box(rows, ["x y", "z"], ["g"]).collect():
        mine = values[values.g == r.g][r.column]
        low, high = r.q1 - 1.5 * (r.q3 - r.q1), r.q3 + 1.5 * (r.q3 - r.q1)
        assert abs(((mine < low) | (mine > high)).sum() - r.outside) <= 2 * error * len(mine)
        assert _within(mine, (mine < low).mean(), r.low, error) and _within(mine, (mine <= high).mean(), r.high, error)
    pairs = sketches.sketched_letter_values(rows, ["z"], depth=4).collect()
    assert [r.depth for r in pairs] == [1, 2, 3, 4]
    assert all(_within(values.z, 0.5**r.depth, r.low, error) and _within(values.z, 1 - 0.5**r.depth, r.high, error) for r in pairs)


def test_nulls_and_empty_groups(spark):
    rows = spark.createDataFrame(
        [("a", None), ("a", float("nan")), ("b", 1.0), ("b", None), (None, 2.0)], "g string, x double")
    out = {r.g: r for r in sketches.sketched_describe(rows, ["x"], ["g"]).collect()}
    assert (out["a"]["count"], out["a"].min, out["a"].q50) == (0, None, None)
    assert (out["b"]["count"], out["b"].q25, out[None].q75) == (1, 1.0, 2.0)
    box = {r.g: r for r in sketches.sketched_box(rows, ["x"], ["g"]).collect()}
    assert (box["a"].q1, box["a"].outside, box["b"].low, box["b"].high, box["b"].outside) == (None, None, 1.0, 1.0, 0)
    none = sketches.sketched_quantiles(rows.limit(0), ["x"], [0.5]).collect()
    assert [(r.column, r.value) for r in none] == [("x", None)]
    assert sketches.sketched_quantiles(rows.limit(0), ["x"], [0.5], ["g"]).count() == 0


def test_binned_density_is_within_its_bound(spark):
    rows = market(spark, SMALL)
    exact = {r.point: r for r in profile.density(rows, LABEL).collect()}
    for bins in (64, 4096):
        out = profile.binned_density(rows, LABEL, bins=bins).collect()
        assert len(out) == len(exact)
        assert all(abs(r.density - exact[r.point].density) <= r.error_bound + 1e-12 for r in out)
    assert out[0].error_bound < 1e-3 * max(r.density for r in exact.values())
    assert profile.binned_density(rows.limit(1), LABEL).count() == 0
    assert profile.binned_density(rows.where(F.lit(False)), LABEL).count() == 0
