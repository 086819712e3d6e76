"""Scoring of arriving files with per-file telemetry."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from ..functions.scalars import micros_per_row
from ..operators.metrics import metric_columns
from ..plans.pipelines import for_scoring
from ..session import cut_lineage
from ..sources.csv import MARKET_SCHEMA, input_files, read_market_csv, stream_market_csv

# Upper edges of the request-size histogram, in bytes.
SIZE_EDGES = (0, 100, 1000, 5000, 10000)

TELEMETRY = (
    "file", "batch_id", "rows", "bytes", "seconds", "micros_per_row", "mae", "mse", "rmse", "r2",
)


@dataclass
class Scored:
    """Folders a scoring stream writes to."""

    predictions: str
    telemetry: str
    checkpoint: str

    @classmethod
    def under(cls, path: str) -> "Scored":
        return cls(f"{path}/predictions", f"{path}/telemetry", f"{path}/checkpoint")


def _write_predictions(scored: DataFrame, label: str, path: str) -> int:
    """Write the predictions and return their number, counted by the writing job itself."""
    seen = Observation()
    scored.select("file", "bytes", F.col(f"`{label}`"), "prediction").observe(
        seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def _telemetry(
    predictions: DataFrame, label: str, seconds: float, batch_id: int, total: int
) -> DataFrame:
    """One row per file; the time is that of the batch of ``total`` rows the file was part of."""
    rows, *quality = metric_columns(F.col(f"`{label}`"), F.col("prediction"))
    per_file = predictions.groupBy("file").agg(
        F.count("*").alias("rows"), F.max("bytes").alias("bytes"), *quality
    )
    return per_file.select(
        "file", F.lit(batch_id).cast("long").alias("batch_id"), "rows", "bytes",
        F.lit(seconds).alias("seconds"),
        micros_per_row(F.lit(seconds), F.lit(total)).alias("micros_per_row"),
        "mae", "mse", "rmse", "r2",
    )


def score_stream(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    target: str,
    label: str = "AveragePrice",
    schema: T.StructType = MARKET_SCHEMA,
    max_files: int | None = None,
    handle_invalid: str = "keep",
) -> Scored:
    """Score every file below ``source`` that was not scored yet, then return.

    The model is loaded or fitted beforehand, never in the stream. A batch
    writes into a folder of its own number and replaces it when the batch is
    repeated after a failure, so no file is counted twice. A file without rows
    gets a telemetry row of 0 rows, under batch -1.
    """
    out = Scored.under(target.rstrip("/"))
    # what is there now is what the stream takes; later arrivals are for the next call
    listed = cut_lineage(_listed(spark, source))
    scorer = for_scoring(model, handle_invalid, keep=("file", "bytes"))

    def write(batch: DataFrame, batch_id: int) -> None:
        begun = time.monotonic()
        part = f"{out.predictions}/batch_id={batch_id}"
        total = _write_predictions(scorer.transform(batch), label, part)
        seconds = time.monotonic() - begun
        done = batch.sparkSession.read.parquet(part)
        _telemetry(done, label, seconds, batch_id, total).drop("batch_id").write.mode(
            "overwrite"
        ).parquet(f"{out.telemetry}/batch_id={batch_id}")

    query = (
        stream_market_csv(spark, source, schema, max_files)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", out.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if listed.isEmpty():
        return out
    known = read_telemetry(spark, out).select(_plain("file").alias("file"))
    missing = listed.join(known, "file", "left_anti")
    none = [F.lit(None).cast("double").alias(c) for c in TELEMETRY[5:]]
    missing.select(
        "file", F.lit(0).cast("long").alias("rows"), "bytes", F.lit(0.0).alias("seconds"), *none
    ).write.mode("append").parquet(f"{out.telemetry}/batch_id=-1")
    return out


def _plain(file: str) -> Column:
    """One spelling of a local file's address."""
    return F.regexp_replace(file, "^file:/+", "file:/")


def _listed(spark: SparkSession, source: str) -> DataFrame:
    """Files a scan of ``source`` reads; names that begin with _ or . are not data."""
    return input_files(spark, source).where(~F.col("path").rlike("/[_.][^/]*$")).select(
        _plain("path").alias("file"), F.col("length").alias("bytes")
    )


def read_telemetry(spark: SparkSession, out: Scored) -> DataFrame:
    rows = spark.read.parquet(out.telemetry)
    return rows.select(*[F.col(c) for c in TELEMETRY])


def score_files(
    spark: SparkSession,
    model: PipelineModel,
    source: str,
    target: str,
    label: str = "AveragePrice",
    schema: T.StructType = MARKET_SCHEMA,
    handle_invalid: str = "keep",
) -> DataFrame:
    """Batch form: telemetry of all files below ``source``, empty files included."""
    begun = time.monotonic()
    rows = read_market_csv(spark, source, schema).select(
        "*", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    )
    scorer = for_scoring(model, handle_invalid, keep=("file", "bytes"))
    total = _write_predictions(scorer.transform(rows), label, target)
    seconds = time.monotonic() - begun
    done = _telemetry(spark.read.parquet(target), label, seconds, 0, total)
    listed = _listed(spark, source).select(F.col("file").alias("id"), F.col("bytes").alias("size"))
    joined = listed.join(done.withColumn("id", _plain("file")), "id", "left")
    return joined.select(
        F.col("id").alias("file"),
        F.coalesce("batch_id", F.lit(0)).alias("batch_id"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.col("size").alias("bytes"),
        F.lit(seconds).alias("seconds"),
        "micros_per_row", "mae", "mse", "rmse", "r2",
    )


def _edge(size: Column) -> Column:
    """Smallest edge that is not below the size, null past the last one."""
    expr = F.when(size <= SIZE_EDGES[0], SIZE_EDGES[0])
    for edge in SIZE_EDGES[1:]:
        expr = expr.when(size <= edge, edge)
    return expr.cast("long")


def size_histogram(df: DataFrame, size: str) -> DataFrame:
    """Requests per size bucket, with the cumulative count up to each edge.

    The last bucket has no upper edge (null). The window sees six rows.
    """
    counts = df.groupBy(_edge(F.col(size)).alias("up_to")).agg(F.count("*").alias("count"))
    order = Window.orderBy(F.asc_nulls_last("up_to")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return counts.withColumn("cumulative", F.sum("count").over(order))


def requests_by_client(df: DataFrame, client: str) -> DataFrame:
    """Requests per client or dialer label."""
    return df.groupBy(client).agg(F.count("*").alias("requests"))
