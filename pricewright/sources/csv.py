"""Market tables as CSV: batch scan, stream scan, listing, writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The columns of a market file, in file order.
MARKET_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("AveragePrice", T.DoubleType()),
    T.StructField("Total Volume", T.DoubleType()),
    T.StructField("4046", T.DoubleType()),
    T.StructField("4225", T.DoubleType()),
    T.StructField("4770", T.DoubleType()),
    T.StructField("Total Bags", T.DoubleType()),
    T.StructField("Small Bags", T.DoubleType()),
    T.StructField("Large Bags", T.DoubleType()),
    T.StructField("XLarge Bags", T.DoubleType()),
    T.StructField("type", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("region", T.StringType()),
])


def read_market_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = MARKET_SCHEMA,
    infer: bool = False,
) -> DataFrame:
    """Headed CSV with a declared schema; ``infer=True`` costs an extra pass."""
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def stream_market_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType = MARKET_SCHEMA,
    max_files: int | None = None,
) -> DataFrame:
    """CSV files arriving under ``path`` with the file each row came from."""
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path).select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    )


def input_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every file below ``path``; file contents stay unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows that a file scan brings from each of its files."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def write_market_csv(
    df: DataFrame, path: str, by: str | None = None, schema: T.StructType = MARKET_SCHEMA
) -> None:
    """Write the market columns, one folder per value of ``by`` if given.

    Rows are not regrouped before writing: a value that holds a third of all
    rows would otherwise end up in one task.
    """
    columns = [F.col(f"`{f.name}`") for f in schema]
    if by is None:
        df.select(*columns).write.mode("overwrite").option("header", True).csv(path)
        return
    (
        df.select(*columns, F.col(f"`{by}`").alias("client"))
        .write.mode("overwrite")
        .partitionBy("client")
        .option("header", True)
        .csv(path)
    )
