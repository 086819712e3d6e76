"""Dummies as one sparse vector."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from pricewright.operators import sparse
from pricewright.operators.encoders import DummyEncoder
from pricewright.operators.sparse import fit_levels, vector_parts


def test_same_places_as_dummy_columns(spark, small_market):
    rows = small_market.select("row_key", "Total Volume", "region", "type")
    wide = DummyEncoder(inputCols=["region", "type"]).fit(rows)
    names = wide.output_columns()
    want = {
        r["row_key"]: [r["Total Volume"], *[float(r[n]) for n in names]] for r in wide.transform(rows).collect()}
    got = fit_levels(rows, ["region", "type"]).encode(rows, ["Total Volume"])
    vector = vector_to_array("features").alias("v")
    assert {r["row_key"]: r["v"] for r in got.select("row_key", vector).collect()} == want


@pytest.mark.parametrize("limit", [0, 8 << 20])
def test_null_unseen_and_repeated_rows(spark, monkeypatch, limit):
    """Without a broadcast too: the join is then a shuffled one."""
    monkeypatch.setattr(sparse, "LEVEL_BYTES", limit)
    schema = "id int, `a.b` string, level string, position double"
    train = spark.createDataFrame([(1, "x", "p", 1.0), (2, "y`z", "q", 2.0), (3, None, "P", 0.1)], schema)
    levels = fit_levels(train, ["a.b", "level"])
    assert levels.counts == {"a.b": 2, "level": 3}
    rows = spark.createDataFrame(
        [(1, "x", "P", 1.5), (1, "x", "P", 1.5), (2, "y`z", "q", math.nan), (3, "new", None, 0.1),
         (4, None, "p", math.inf), (5, "x", "p", None)], schema)
    out = levels.encode(rows, ["position"])
    assert out.columns == [*rows.columns, "features"]
    got = sorted(((r["id"], r["features"]) for r in out.collect()), key=lambda r: r[0])
    assert [g[0] for g in got] == [1, 1, 2, 3, 4, 5]
    assert got[0] == got[1] == (1, Vectors.sparse(4, [0], [1.5]))
    nan = got[2][1]
    assert list(nan.indices) == [0, 1, 3] and math.isnan(nan.values[0]) and list(nan.values[1:]) == [1.0, 1.0]
    assert got[3][1] == Vectors.sparse(4, [0], [0.1])
    assert got[4][1] == Vectors.sparse(4, [0, 2], [math.inf, 1.0])
    assert got[5][1] is None


def test_unseen_level_can_fail(spark):
    train = spark.createDataFrame([("x",), ("y",)], "c string")
    rows = spark.createDataFrame([("z",)], "c string")
    with pytest.raises(Exception, match="unseen level in c: z"):
        fit_levels(train, ["c"]).encode(rows, handle_invalid="error").collect()


def test_output_name_must_be_free(spark):
    rows = spark.createDataFrame([("x", 1)], "c string, Features int")
    with pytest.raises(ValueError):
        fit_levels(rows, ["c"]).encode(rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "c string, n double")
    levels = fit_levels(none, ["c"])
    assert levels.counts == {"c": 0} and levels.encode(none, ["n"]).count() == 0
    one = spark.createDataFrame([("x", 2.0)], "c string, n double")
    assert levels.encode(one, ["n"]).first()["features"] == Vectors.sparse(1, [0], [2.0])


def test_a_million_levels_and_a_hot_one(spark):
    n = 1_000_000
    rows = spark.range(n * 3 // 2).select(
        F.format_string("%07d", F.when(F.col("id") < n, F.col("id")).otherwise(7)).alias("c"))
    levels = fit_levels(rows, ["c"])
    assert levels.size() == n - 1
    out = levels.encode(rows)
    parts = out.select(F.col("c").cast("int").alias("c"), vector_parts("features").alias("p"))
    wrong = F.col("p.indices") != F.when(F.col("c") == 0, F.array().cast("array<int>")).otherwise(F.array(F.col("c") - 1))
    row = parts.agg(F.count("*").alias("rows"), F.count_if(wrong).alias("wrong"), F.max("p.size").alias("size")).first()
    assert row.asDict() == {"rows": n * 3 // 2, "wrong": 0, "size": n - 1}


def test_models_read_the_vector(spark, small_market):
    rows = small_market.select("AveragePrice", "region")
    levels = fit_levels(rows, ["region"])
    model = LinearRegression(labelCol="AveragePrice").fit(levels.encode(rows).select("AveragePrice", "features"))
    want = {r["region"]: r["m"] for r in rows.groupBy("region").agg(F.avg("AveragePrice").alias("m")).collect()}
    for r in model.transform(levels.encode(rows.select("region").distinct())).collect():
        assert r["prediction"] == pytest.approx(want[r["region"]], rel=1e-6)
