"""Every query: SQL equivalent where there is one, plan shape for all."""

import duckdb
import pytest
from conftest import MEDIUM, SMALL
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()
CHEAP_WITHOUT_SQL = (
    "q_params", "q_dt", "q_runs", "q_knn_lsh", "q_tree_unlimited", "q_boosted_second_order", "q_forest_grown_together",
    "q_knn_nearest", "q_kernel_certificate",
)


@pytest.fixture(scope="module")
def con():
    return connect(MEDIUM)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, MEDIUM), con, SQL[name]) == []


@pytest.mark.parametrize("name", CHEAP_WITHOUT_SQL)
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    out = entry_points.entry(spark)
    assert out.columns == ["row_key", "features", "label", "prediction"]
    assert out.where("prediction IS NULL").count() == 0


def test_comparison_notices_one_changed_row(spark, con):
    """Negative control: the check fails when a single value is off."""
    good = QUERIES["q_count_year_type"](spark, MEDIUM)
    off = good.withColumn(
        "count",
        F.when((F.col("year") == 1998) & (F.col("type") == "organic"), F.col("count") + 1)
        .otherwise(F.col("count")),
    )
    assert compare(good, con, SQL["q_count_year_type"]) == []
    assert compare(off, con, SQL["q_count_year_type"]) != []
    assert compare(good.limit(3), con, SQL["q_count_year_type"]) != []


SIMPLE = [
    "q_preview", "q_feature_sql", "q_calendar", "q_describe", "q_box_stats", "q_letter_values",
    "q_histogram", "q_kde", "q_standardize_pop", "q_metrics", "q_leaderboard_fixed", "q_split",
    "q_param_grid", "q_dummies",
]


@pytest.mark.parametrize("name", SIMPLE)
def test_no_cross_product_in_plan(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["q_count_year_type"](spark, SMALL)._jdf.queryExecution().toString()
    read = [line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line]
    assert read
    for unused in ("l_discount", "l_tax", "l_quantity", "l_extendedprice", "l_returnflag"):
        assert all(unused not in line for line in read)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_same_result_at_any_partition_count(spark, con, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for name in ("q_box_stats", "q_kde", "q_metrics", "q_folds"):
            assert compare(QUERIES[name](spark, MEDIUM), con, SQL[name]) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_duckdb_is_only_used_by_tests():
    assert duckdb.__name__ == "duckdb"
    import pathlib
    for path in pathlib.Path(entry_points.__file__).parent.glob("pricewright/**/*.py"):
        assert "import duckdb" not in path.read_text()
