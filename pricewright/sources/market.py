"""The market table derived from the order-line tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.split import with_bucket
from ..session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _volume(*kinds: str) -> Column:
    return F.when(F.col("p_type").isin(*kinds), F.col("l_quantity")).otherwise(0.0)


def _bags(low: int, high: int | None) -> Column:
    size = F.col("p_size")
    fits = size >= low if high is None else size.between(low, high)
    return F.when(fits, size.cast("double")).otherwise(0.0)


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: price, volumes, bags, type, year, region.

    The joins carry no hint: Catalyst broadcasts a dimension only while its
    size is under the threshold, and AQE splits skewed shuffle partitions
    when a part or supplier holds a large share of the lines.
    """
    line = spread(table(spark, sf_dir, "lineitem"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, line.l_suppkey == supplier.s_suppkey)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
    )
    keyed = with_bucket(joined, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return keyed.select(
        "row_key",
        "bucket",
        F.date_format(F.col("l_shipdate").cast("date"), "dd-MM-yyyy").alias("Date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("AveragePrice"),
        F.col("l_quantity").alias("Total Volume"),
        _volume("ECONOMY", "SMALL").alias("4046"),
        _volume("MEDIUM", "STANDARD").alias("4225"),
        _volume("LARGE", "PROMO").alias("4770"),
        F.col("p_size").cast("double").alias("Total Bags"),
        _bags(0, 20).alias("Small Bags"),
        _bags(21, 40).alias("Large Bags"),
        _bags(41, None).alias("XLarge Bags"),
        F.when(F.col("l_linestatus") == "F", "conventional")
        .when(F.col("l_linestatus") == "O", "organic")
        .alias("type"),
        F.year("l_shipdate").alias("year"),
        F.col("n_name").alias("region"),
    )
