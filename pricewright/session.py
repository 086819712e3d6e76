"""Session for local work, and the shared folder jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 100_000
#: Cached training rows that one task of a fit reads.
PART_ROWS = 250_000

_local_dirs: dict[str, str] = {}


def local_session(cores: str | int = "*", app: str = "pricewright", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark. On a cluster, use its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a scratch
    folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return os.path.dirname(current.rstrip("/"))
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="pricewright-")
    return _local_dirs[sc.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute once into reliable shared storage and read it from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A join side that is broadcast only while its counted rows stay small.

    Past the limit it is joined as it is: Spark shuffles both sides and AQE
    splits skewed partitions.
    """
    if rows is None:
        df = cut_lineage(df)
        rows = df.count()
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def even_parts(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Cached, in parts of about ``rows`` rows at most, so that no task's share grows with the table.

    A frame whose parts are small enough keeps its layout. The caller unpersists.
    """
    needed = -(-df.count() // (rows or PART_ROWS))
    return (df.repartition(needed) if needed > df.rdd.getNumPartitions() else df).persist()


def spread(df: DataFrame) -> DataFrame:
    """Give every core rows to work on when the input came in few splits.

    Tables of many files already have more partitions than cores and are left
    as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
