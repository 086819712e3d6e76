"""Filter interaction audit: what each filter removes in every order of five filters.

Documents become narrow rows of their filters' verdicts. Inside a task, rows
are sorted by part and id and cut into id ranges; a range keeps one sorted
posting list of failing ids per filter, and galloping merges of these lists
give the size of the union of every set of filters. Sizes of disjoint ranges
add up, so only 32 numbers per range and part leave a task. Every count of an
order follows from the unions: a filter removes, after a set of others, what
its union with them has more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import attach, stored, text_or_empty

FILTERS = "ABCDE"
#: Ids in a range; a range is one task's work of a moment, whatever the table's size.
RANGE_ROWS = 20_000
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SUBSETS = ["".join(c) for n in range(len(FILTERS) + 1) for c in combinations(FILTERS, n)]


def _own_failures(text: Column) -> list[Column]:
    """Verdicts of the filters that look at one text: A, B, C, D."""
    words = F.filter(
        F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ", -1), lambda w: w != F.lit(""))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return [
        n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * F.length(text),
        text.rlike(r"[#$%&*|]")]


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, id, A to E, n, good, toxic): which filters the documents of an id fail.

    ``n`` rows of ``docs`` with one part, id and set of failing filters are one
    row, so a repeated or missing id is never many. Null texts count as empty, a
    null lang is the part ''. A text fails E where a row with a smaller id holds
    it; rows without an id have no smaller one and are none to others. A
    document is good or toxic if any of its rows of ``labels`` says so.
    """
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text"))
    a, b, c, d = _own_failures(F.col("text"))
    rows = stored(rows.select(
        "part", "id", a.alias("A"), b.alias("B"), c.alias("C"), d.alias("D"),
        F.unhex(F.sha2("text", 256)).alias("digest")), "audit-rows")
    groups = stored(rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n_same")), "audit-texts")
    total = groups.agg(F.sum("n_same")).first()[0] or 0
    marked = attach(rows, groups, ["digest"], "n_same", total).withColumn(
        "E", F.coalesce(F.col("id") > F.col("first"), F.lit(False)))
    marked = marked.groupBy("part", "id", *FILTERS).agg(F.count("*").alias("n"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    known = known.where("good OR toxic")
    return marked.join(known, "id", "left").select(
        "part", "id", *FILTERS, "n", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))


def _reach(values: np.ndarray, begin: int, limit: int) -> int:
    """The first place from ``begin`` on whose value is not below ``limit``, found in
    doubling steps and a binary search of the last one."""
    step = 1
    while begin + step < len(values) and values[begin + step] < limit:
        step *= 2
    low = begin + step // 2
    return low + int(np.searchsorted(values[low : begin + step + 1], limit))


def gallop_union(lists: list[np.ndarray]) -> np.ndarray:
    """Sorted distinct ids of sorted lists of distinct ids.

    The list with the smallest head gives everything below the next head at once.
    """
    heads, out = {k: 0 for k, x in enumerate(lists) if len(x)}, []
    while len(heads) > 1:
        front = sorted((int(lists[k][at]), k) for k, at in heads.items())
        (value, k), (other, _) = front[0], front[1]
        if value == other:
            # the head stands in another list too, which gives it
            end = heads[k] + 1
        else:
            end = _reach(lists[k], heads[k], other)
            out.append(lists[k][heads[k] : end])
        if end == len(lists[k]):
            del heads[k]
        else:
            heads[k] = end
    out.extend(lists[k][at:] for k, at in heads.items())
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def gallop_difference(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids of the sorted list ``left`` that the sorted list ``right`` has not."""
    i, j, out = 0, 0, []
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            i, j = i + 1, j + 1
        elif left[i] < right[j]:
            end = _reach(left, i, right[j])
            out.append(left[i:end])
            i = end
        else:
            j = _reach(right, j, left[i])
    out.append(left[i:])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def _sizes(rows: pd.DataFrame) -> list[tuple]:
    """(subset, documents, union, good and toxic in the union, only) of one id range.

    ``only``: for single filters, documents that fail no other one.
    """
    weight = rows["n"].to_numpy(dtype=np.int64)
    # places in the sorted range stand for its ids: an id may be there with several verdicts
    lists = {f: np.flatnonzero(rows[f].to_numpy(dtype=bool)) for f in FILTERS}
    marks = [np.flatnonzero(rows[c].to_numpy(dtype=bool)) for c in ("good", "toxic")]
    unions = {"": np.zeros(0, dtype=np.int64)}
    for subset in _SUBSETS[1:]:
        unions[subset] = lists[subset] if len(subset) == 1 else gallop_union([unions[subset[:-1]], lists[subset[-1]]])
    out = []
    for subset, union in unions.items():
        only = 0
        if len(subset) == 1:
            rest = gallop_union([lists[f] for f in FILTERS if f != subset])
            only = weight[gallop_difference(lists[subset], rest)].sum()
        lost = [weight[x].sum() - weight[gallop_difference(x, union)].sum() for x in marks]
        out.append((subset, weight.sum(), weight[union].sum(), *lost, only))
    return out


def union_sizes(marked: DataFrame) -> DataFrame:
    """(part, subset, n, failing, good, toxic, only): sizes of the union of each set of filters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin in range(0, len(batch), RANGE_ROWS):
                piece = batch.iloc[begin : begin + RANGE_ROWS]
                for part, rows in piece.groupby("part", sort=False):
                    out = pd.DataFrame(_sizes(rows), columns=["subset", "n", "failing", "good", "toxic", "only"])
                    out.insert(0, "part", part)
                    yield out

    schema = "part string, subset string, n long, failing long, good long, toxic long, only long"
    sizes = marked.sortWithinPartitions("part", "id").mapInPandas(run, schema)
    return sizes.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "failing", "good", "toxic", "only")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) for each part, each of the 120 orders and each step.

    No rows for an empty table. Only doc_id, text and lang of ``docs`` and
    doc_id, quality and toxic of ``labels`` are read.
    """
    spark = docs.sparkSession
    sizes = stored(union_sizes(failures(docs, labels)), "audit-sizes")
    steps = [
        ("".join(order), k + 1, order[k], "".join(sorted(order[:k])), "".join(sorted(order[: k + 1])))
        for order in permutations(FILTERS) for k in range(len(FILTERS))]
    # fixed: 120 orders of five steps
    plan = spark.createDataFrame(
        steps, "filter_order string, step int, filter string, before string, after string")
    was = sizes.select(
        "part", F.col("subset").alias("before"), F.col("failing").alias("failing_before"),
        F.col("good").alias("good_before"), F.col("toxic").alias("toxic_before"))
    now = sizes.select("part", F.col("subset").alias("after"), "n", "failing", "good", "toxic")
    single = sizes.select("part", F.col("subset").alias("filter"), F.col("failing").alias("alone"), "only")
    removed = F.col("failing") - F.col("failing_before")
    out = (
        now.join(F.broadcast(plan), "after").join(was, ["part", "before"]).join(single, ["part", "filter"])
        .select(
            "part", "filter_order", "step", "filter", (F.col("n") - F.col("failing")).alias("kept"),
            removed.alias("removed"), (F.col("alone") - removed).alias("redundant"),
            F.col("only").alias("unique_fails"), (F.col("good") - F.col("good_before")).alias("good_lost"),
            (F.col("toxic") - F.col("toxic_before")).alias("toxic_lost")))
    shapley = out.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return out.join(shapley, ["part", "filter"]).drop("filter")
