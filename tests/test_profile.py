import numpy as np
import pandas as pd
import pytest

from pricewright.operators import profile
from pricewright.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.25, 0.5, 0.75, 0.9375, 1.0)


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(3)
    tail = np.exp(rng.normal(0, 4, 4000))
    return pd.DataFrame({
        # a third of all rows share one value, the rest spans many magnitudes
        "x": np.concatenate([np.full(3000, 7.25), tail, -tail[:500]]),
        "g": rng.choice(["a", "a", "a", "b", "c"], 7500),
        "n": rng.integers(0, 4, 7500).astype(float),
    })


@pytest.mark.parametrize("limit", [1 << 18, 50])
@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("column", ["x", "n"])
def test_quantiles_match_numpy_with_any_number_of_bins(spark, skewed, limit, by, column):
    out = exact_quantiles(spark.createDataFrame(skewed), column, PROBS, by, bins=limit)
    rows = out.collect()
    groups = skewed.groupby("g") if by else [(None, skewed)]
    assert len(rows) == (3 if by else 1)
    expected = {k: np.quantile(g[column], PROBS) for k, g in groups}
    for row in rows:
        np.testing.assert_allclose(row["q"], expected[row["g"] if by else None], rtol=1e-12)


def test_quantiles_large_and_small_groups_together(spark, skewed):
    out = exact_quantiles(spark.createDataFrame(skewed), "x", (0.5,), ["g"], bins=2000)
    got = {r["g"]: (r["n"], r["q"][0]) for r in out.collect()}
    for g, part in skewed.groupby("g"):
        assert got[g][0] == len(part)
        assert got[g][1] == pytest.approx(np.median(part["x"]), rel=1e-12)


@pytest.mark.parametrize("bins", [8, 4096])
def test_quantiles_of_extreme_values(spark, bins):
    """Infinities, NaN, a span beyond the largest double, hundreds of decades, denormals."""
    inf, rng = float("inf"), np.random.default_rng(5)
    groups = {
        "one infinity": np.append(rng.normal(size=5000), inf),
        "both": np.concatenate([rng.normal(size=99), [-inf, -inf, inf]]),
        "wide": np.concatenate([rng.normal(size=50), [-1.7e308, 1.7e308]]),
        "decades": 10.0 ** rng.uniform(-300, 300, 5000),
        "denormal": np.array([5e-324, 0.0, -5e-324, 1e-310, 2e-310, -0.0]),
        "nan": np.append(rng.normal(size=50), np.nan),
        "same": np.full(9000, 3.5),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    probs = (0.1, 0.5, 0.77)
    got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(
        spark.createDataFrame(rows, "g string, x double"), "x", probs, ["g"], bins=bins).collect()}
    assert got.keys() == groups.keys()
    for g, xs in groups.items():
        assert got[g][0] == len(xs)
        np.testing.assert_allclose(got[g][1], np.quantile(xs, probs), rtol=1e-12, err_msg=g)


def test_quantiles_of_nothing(spark):
    row = exact_quantiles(spark.createDataFrame([], "x double"), "x", (0.5,)).first()
    assert row["n"] == 0 and row["q"] is None


def test_quantiles_ignore_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert exact_quantiles(df, "x", (0.5,)).first()["q"] == [2.0]


def test_describe_with_any_number_of_bins(spark, small_market):
    whole = profile.describe(small_market, ["AveragePrice", "4225"]).collect()
    narrowed = profile.describe(small_market, ["AveragePrice", "4225"], bins=100).collect()
    pdf = small_market.select("AveragePrice", "`4225`").toPandas().describe().T
    for rows in (whole, narrowed):
        for r in rows:
            want = pdf.loc[r["column"]]
            np.testing.assert_allclose(
                [r["count"], r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]],
                want.to_numpy(), rtol=1e-9,
            )


def test_histogram_covers_all_rows_and_has_unit_area(spark, small_market):
    rows = profile.histogram(small_market, "AveragePrice").collect()
    assert sum(r["count"] for r in rows) == small_market.count()
    assert sum(r["density"] * (r["high"] - r["low"]) for r in rows) == pytest.approx(1)


def test_histogram_of_a_constant_and_of_nothing(spark):
    same = spark.createDataFrame([(5.0,)] * 10, "x double")
    assert sum(r["count"] for r in profile.histogram(same, "x").collect()) == 10
    assert profile.histogram(same.limit(0), "x").count() == 0


def test_density_has_unit_area(spark, small_market):
    pdf = profile.density(small_market, "AveragePrice").orderBy("x").toPandas()
    assert np.trapezoid(pdf["density"], pdf["x"]) == pytest.approx(1, abs=0.01)


def test_letter_probabilities():
    assert profile.letter_probs(3) == [0.5, 0.25, 0.75, 0.125, 0.875]
