"""Shared helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import new_path

#: ASCII white space, the word separator of all contracts.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shielded(*private: str) -> Callable:
    """For functions that keep all columns of their first frame: the caller's columns
    that bear a name the function uses inside carry another one meanwhile."""
    used = {p.lower() for p in private}

    def wrap(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(fn)
        def run(docs: DataFrame, *args, **options) -> DataFrame:
            taken, renamed = used | {c.lower() for c in docs.columns}, {}
            for c in docs.columns:
                if c.lower() in used:
                    name = f"kept_{c}"
                    while name.lower() in taken:
                        name = f"kept_{name}"
                    taken.add(name.lower())
                    renamed[c] = name
            out = fn(docs.withColumnsRenamed(renamed), *args, **options)
            return out.withColumnsRenamed({v: k for k, v in renamed.items()})

        return run

    return wrap


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once into the shared folder and read from there: cuts the lineage,
    and every later reader sees the same rows even if an executor is lost."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file.rsplit("/", 1)[0])
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def hot_limit(total: int) -> int:
    """From how many rows on a key counts as hot.

    A thousandth of all rows: below it a key is less than a task's share of a
    large job, and at most 1,000 keys are above it, however large the corpus.
    """
    return max(16, total // 1000)


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of rows with one row per key, whatever share of rows a key has.

    At most 1,000 keys have many rows (see ``hot_limit``), so they are broadcast
    and their rows stay where they are; the others are shuffled. ``rows`` is read
    twice and should be stored.
    """
    limit = hot_limit(total)
    hot = groups.where(F.col(count) > limit)
    cold = groups.where(F.col(count) <= limit)
    return rows.join(F.broadcast(hot), keys).unionByName(
        rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    )


def components(edges: DataFrame, store: Callable[[DataFrame, str], DataFrame] = stored) -> DataFrame:
    """Connected components of (a, b) long pairs: rows (id, component), the smallest id reachable.

    Every node, and the node its label names, hooks onto the smallest label
    around it, then labels are shortened by one pointer jump; the rounds grow
    with the logarithm of the longest chain. Labels go to the shared folder
    after each round. Nodes with many edges and labels of many nodes are joined
    with ``attach``, so neither is one task's work.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = store(both.where("a <> b").distinct(), "edges")
    labels = store(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"), F.count("*").alias("n_edges"))
        .select("id", F.least("id", "m").alias("component"), "n_edges"), "labels")
    n_nodes, n_edges = labels.agg(F.count("*"), F.sum("n_edges")).first()
    while True:
        near = attach(both, labels.withColumnRenamed("id", "b"), ["b"], "n_edges", n_edges or 0)
        best = near.groupBy(F.col("a").alias("id")).agg(F.min("component").alias("best"))
        # the best label next to a node is offered to the node and to its present root
        offers = labels.join(best, "id").where("best < component")
        offers = offers.select(F.explode(F.array("id", "component")).alias("id"), "best")
        offers = offers.groupBy("id").agg(F.min("best").alias("offer"))
        hooked = store(labels.join(offers, "id", "left").select(
            "id", F.least("component", F.coalesce("offer", "component")).alias("component"),
            F.col("component").alias("before"), "n_edges"), "hooked")
        next_of = hooked.select(F.col("id").alias("component"), F.col("component").alias("next"))
        named = hooked.groupBy("component").agg(F.count("*").alias("n_named")).join(next_of, "component")
        jumped = store(attach(hooked, named, ["component"], "n_named", n_nodes).select(
            "id", F.least("component", "next").alias("component"), "before", "n_edges"), "labels")
        changed = jumped.where("component <> before").limit(1).count()
        discard(labels)
        discard(hooked)
        labels = jumped.drop("before")
        if not changed:
            discard(both)
            return labels.drop("n_edges")
