"""Elastic nets fitted inside Spark against the plain solver."""

import numpy as np
import pytest
from pyspark.sql import Row

from pricewright.operators.elastic import elastic_net_fits, grouped_moments, without_each
from pricewright.operators.tuning import elastic_net

GRID = [(0.0, 0.0), (0.05, 0.01), (0.5, 0.5), (2.0, 1.0), (1e6, 1.0)]
NAMES = ["a", "b.c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = []
    for group in range(40):
        x = rng.normal(size=(30, 3)) @ rng.normal(size=(3, 3)) + rng.normal(size=3) * 5
        if group % 5 == 0:
            x[:, 1] = 7.0                               # a constant feature
        y = x @ rng.normal(size=3) + rng.normal(size=30) if group % 7 else np.full(30, 2.5)
        out += [(group, *map(float, v), float(t)) for v, t in zip(x, y)]
    out += [(3, None, 1.0, 1.0, 1.0), (3, 1.0, 1.0, 1.0, None), (None, 1.0, 2.0, 3.0, 4.0)]
    return spark.createDataFrame(out, "g int, a double, `b.c` double, d double, y double")


def _matrix(row: Row) -> np.ndarray:
    return np.array(row.moments).reshape(5, 5)


def test_fits_of_many_groups(rows):
    moments = grouped_moments(rows, NAMES, "y", ["g"])
    by_group = {r.g: _matrix(r) for r in moments.collect()}
    assert by_group[3][0, 0] == 30 and by_group[None][0, 0] == 1
    fits = elastic_net_fits(moments, GRID, 3).collect()
    assert len(fits) == 41 * len(GRID)
    for f in fits:
        want = elastic_net(by_group[f.g], f.reg_param, f.elastic_net_param)
        assert np.allclose([f.intercept, *f.coefficients], want, atol=1e-6), f


def test_moments_without_each_fold(rows):
    moments = grouped_moments(rows.where("g IS NOT NULL"), NAMES, "y", ["g"])
    by_group = {r.g: _matrix(r) for r in moments.collect()}
    total = sum(by_group.values())
    for r in without_each(moments, "g").collect():
        assert np.allclose(_matrix(r), total - by_group[r.g])


def test_unfinished_descent_is_told(rows):
    moments = grouped_moments(rows, NAMES, "y", ["g"])
    fits = elastic_net_fits(moments, [(0.0, 0.0)], 3, max_iter=2).collect()
    assert not all(f.converged for f in fits) and max(f.sweeps for f in fits) == 2
    assert elastic_net_fits(moments.limit(0), GRID, 3).count() == 0
