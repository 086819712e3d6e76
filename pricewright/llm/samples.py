"""Bounded, repeatable samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label, text) of at most ``per_class`` labelled ids of either class.

    The ids with the smallest hashes are taken. Labels other than 0 and 1, null
    ids and ids without a document teach nothing; a repeated label counts once
    and ids with both labels are left out. At most 2 * per_class ids are
    broadcast.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(label).cast("int").alias("label"), F.max(label).alias("_max"))
    usable = usable.where("label = _max").select("doc_id", "label")
    order = F.xxhash64(F.col("doc_id"), F.lit("sample"))
    some = usable.where("label = 0").orderBy(order, "doc_id").limit(per_class).unionByName(
        usable.where("label = 1").orderBy(order, "doc_id").limit(per_class))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return text.where("text IS NOT NULL").join(F.broadcast(some), "doc_id")
