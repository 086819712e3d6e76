"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of code points. Equal blocks get
equal integer names by sorting; then adjacent names of a document are paired
and the pairs are named in the same way, level by level, until one name is
left. Names come from comparing the keys themselves, never from a digest alone,
so two documents share an identity exactly if their texts are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import attach, discard, hot_limit, stored, text_or_empty

BLOCK_CHARS = 4096
_BUCKETS = 1 << 31


def _bucket() -> Column:
    return F.pmod(F.col("_h"), F.lit(_BUCKETS))


def name_rows(rows: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Add the long ``name``: equal for rows with equal keys, different otherwise.

    Rows are dealt by a hash of the keys, sorted by the keys themselves within
    each of 2^31 buckets, and numbered there: bucket * 2^32 + rank. Keys with
    many rows (few, see ``hot_limit``) are numbered once, from their distinct
    values, and the number is broadcast; their rows travel without the keys,
    dealt by ``spread``. ``rows`` is read up to three times. The key columns
    are dropped.
    """
    rows = rows.withColumn("_h", F.xxhash64(*keys))
    counts = stored(rows.groupBy("_h").agg(F.count("*").alias("n")), "block-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > hot_limit(total)).select("_h")
    in_bucket = Window.partitionBy("_bucket").orderBy("_h", *keys)
    distinct = rows.join(F.broadcast(hot), "_h", "left_semi").select("_h", *keys).distinct()
    named = (
        distinct.withColumn("_bucket", _bucket())
        .withColumn("hot_name", -F.shiftleft("_bucket", 32) - F.dense_rank().over(in_bucket))
        .withColumn("alone", F.count("*").over(Window.partitionBy("_h")) == 1)
    )
    # a hash with one key needs no comparison, so the key is not sent
    named = named.select(
        F.col("_h").alias("hot_h"), "hot_name", "alone",
        *[F.when(~F.col("alone"), F.col(k)).alias(f"hot_{k}") for k in keys])
    same = F.col("_h") == F.col("hot_h")
    equal = F.lit(True)
    for k in keys:
        equal = equal & F.col(k).eqNullSafe(F.col(f"hot_{k}"))
    rows = rows.join(F.broadcast(named), same & (F.col("alone") | equal), "left")
    is_hot = F.col("hot_name").isNotNull()
    rows = rows.withColumn(
        "_bucket", F.when(is_hot, -1 - F.pmod(F.xxhash64(*spread), F.lit(_BUCKETS))).otherwise(_bucket()))
    rows = rows.withColumns({k: F.when(~is_hot, F.col(k)) for k in keys})
    rank = F.dense_rank().over(in_bucket)
    name = F.coalesce("hot_name", F.shiftleft("_bucket", 32) + rank)
    return rows.withColumn("name", name).drop(
        "_h", "_bucket", "hot_h", "hot_name", "alone", *keys, *[f"hot_{k}" for k in keys])


def blocks_of(text: Column, size: int = BLOCK_CHARS) -> Column:
    """The blocks of a text in order; an empty text is one empty block."""
    found = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(found)


def text_identities(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, text_sha256, level, name.

    (level, name) is equal exactly for equal texts; null counts as empty. rid
    tells rows apart, as doc_id may be null or repeat.
    """
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().alias("text"))
    base = base.select(
        "rid", "doc_id", F.sha2("text", 256).alias("text_sha256"),
        blocks_of(F.col("text"), block_chars).alias("blocks"))
    rows = base.select(
        "rid", "doc_id", "text_sha256", F.size("blocks").alias("width"),
        F.posexplode("blocks").alias("idx", "block"))
    # the sha is kept with the first block only
    rows = rows.withColumn("text_sha256", F.when(F.col("idx") == 0, F.col("text_sha256")))
    first = stored(name_rows(rows, ["block"], ["rid", "idx"]), "block-names")
    single = first.where("width = 1").select(
        "rid", "doc_id", "text_sha256", F.lit(0).alias("level"), "name")
    width = first.agg(F.max("width")).first()[0] or 1
    level, current, ends = 0, first.where("width > 1").select("rid", "idx", "width", "name"), []
    while width > 1:
        level, width = level + 1, (width + 1) // 2
        odd = F.col("idx") % 2 == 1
        pairs = current.groupBy(
            "rid", F.floor(F.col("idx") / 2).cast("int").alias("idx"),
            F.floor((F.col("width") + 1) / 2).cast("int").alias("width"),
        ).agg(F.max(F.when(~odd, F.col("name"))).alias("left"), F.max(F.when(odd, F.col("name"))).alias("right"))
        named = stored(name_rows(pairs, ["left", "right"], ["rid", "idx"]), "pair-names")
        ends.append(named.where("width = 1").select("rid", F.lit(level).alias("level"), "name"))
        current = named.where("width > 1")
    if not ends:
        return single
    end = ends[0]
    for more in ends[1:]:
        end = end.unionByName(more)
    heads = first.where("width > 1 AND idx = 0").select("rid", "doc_id", "text_sha256")
    return single.unionByName(heads.join(end, "rid"))


def exact_duplicates(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id is kept. Null texts count as
    empty, null ids as smaller than any id; of repeated rows with one doc_id
    exactly one is kept. Other columns of ``docs`` are ignored; an empty table
    gives an empty result.
    """
    rows = stored(text_identities(docs, block_chars), "identities")
    total = rows.count()
    groups = rows.groupBy("level", "name").agg(
        F.max(F.struct("doc_id", "rid")).alias("keep"), F.count("*").alias("group_size"))
    groups = stored(groups, "text-groups")
    return attach(rows, groups, ["level", "name"], "group_size", total).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("keep.rid") == F.col("rid")).alias("kept"), "text_sha256")
