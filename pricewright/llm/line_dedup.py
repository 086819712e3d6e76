"""Line deduplication by pairwise alignment.

A line is rare enough to link documents if it has ``MIN_BLOCK_WORDS`` words;
shorter lines link by the shortest stretch of lines that reaches them. Each
such stretch is linked to the first document that holds it, so links are at
most two a line however often one repeats. A pair of linked documents is
aligned with patience diff over the shared stretches: their longest chain that
rises in both documents, then chains of what lies outside it (moved or
repeated passages) until every link is in one. Neighbouring links of a chain
at equal distance in both documents are one block; the aligned blocks, and
nothing else, go from the later document.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import attach, discard, shielded, stored
from .textbatch import TextBatch, chunks, mix

#: An aligned block of fewer words stays.
MIN_BLOCK_WORDS = 20

_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LINE = np.ones(256, dtype=bool)
_LINE[10] = False


def _powers(base: np.uint64, n: np.ndarray) -> np.ndarray:
    """base ** n modulo 2^64 for an array of exponents."""
    out, square, left = np.ones(len(n), dtype=np.uint64), base, n.astype(np.uint64)
    while left.any():
        with np.errstate(over="ignore"):
            square_next = square * square
        out = np.where(left & np.uint64(1), out * square, out)
        square, left = square_next, left >> np.uint64(1)
    return out


def run_table(docs: DataFrame, min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """(doc_id, h, run, first, last): the shortest stretch of ``min_words`` words
    that begins at each line that is not empty, and the one that ends there.

    Two a line at most. The runs inside a stretch of enough words cover all its
    lines, so what two documents share is covered by runs they share.
    """
    def run(batches: Iterator[pd.DataFrame]):
        for part in chunks(batches):
            texts = [t.encode() for t in part["text"]]
            lines = TextBatch(texts, _LINE)
            n = len(lines.begin)
            if not n:
                continue
            words = TextBatch(texts)
            n_words = np.searchsorted(words.begin, lines.end) - np.searchsorted(words.begin, lines.begin)
            first = lines.first[lines.doc]
            last = lines.first[lines.doc + 1] - 1
            pos = np.arange(n) - first
            with np.errstate(over="ignore"):
                term = mix(lines.word_hashes()) * _powers(_BASE, pos)
                total = np.concatenate([[np.uint64(0)], np.cumsum(term, dtype=np.uint64)])
            upto = np.concatenate([[0], np.cumsum(n_words)])
            at = np.arange(n)
            ends = np.searchsorted(upto, upto[:-1] + min_words) - 1
            begins = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
            ahead, back = ends <= last, begins >= first
            spans = np.unique(np.concatenate([at[ahead] * n + ends[ahead], begins[back] * n + at[back]]))
            s, e = spans // n, spans % n
            with np.errstate(over="ignore"):
                key = (total[e + 1] - total[s]) * _powers(_INVERSE, pos[s]) + (e - s + 1).astype(np.uint64)
            yield pd.DataFrame({
                "doc_id": part["doc_id"].to_numpy()[lines.doc[s]], "h": part["h"].to_numpy()[lines.doc[s]],
                "run": mix(key).view(np.int64), "first": pos[s], "last": pos[e]})

    return docs.select("doc_id", "h", "text").mapInPandas(
        run, "doc_id long, h long, run long, first long, last long")


def links(runs: DataFrame) -> DataFrame:
    """(doc_id, h, partner, h_a, first, last, at): the stretches a document shares
    with the first document that holds them, which has them from line ``at`` on.

    ``runs`` is a stored ``run_table``; a document is earlier if its (doc_id, h)
    is smaller. Repeated rows of a document give their links once.
    """
    firsts = runs.groupBy("run").agg(
        F.min(F.struct("doc_id", "h", "first")).alias("a"), F.count("*").alias("holders")).where("holders > 1")
    firsts = stored(firsts, "first-runs")
    found = attach(runs, firsts, ["run"], "holders", runs.count()).where(
        (F.col("a.doc_id") != F.col("doc_id")) | (F.col("a.h") != F.col("h")))
    return found.select(
        "doc_id", "h", F.col("a.doc_id").alias("partner"), F.col("a.h").alias("h_a"), "first", "last",
        F.col("a.first").alias("at")).distinct()


def _longest_chain(places: np.ndarray) -> np.ndarray:
    """Indices of a longest strictly increasing subsequence."""
    if len(places) < 2 or (np.diff(places) > 0).all():
        return np.arange(len(places))
    tails, tail_at, before = [], [], []
    for i, p in enumerate(places.tolist()):
        k = bisect_left(tails, p)
        before.append(tail_at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(p)
            tail_at.append(i)
        else:
            tails[k], tail_at[k] = p, i
    out, i = [], tail_at[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.array(out[::-1])


def _rising_chains(places: np.ndarray) -> list[np.ndarray]:
    """All indices, dealt to as few strictly increasing subsequences as possible:
    each goes to the chain with the greatest end below it."""
    ends, chains = [], []       # -end, rising
    for i, p in enumerate(places.tolist()):
        k = bisect_right(ends, -p)
        if k == len(ends):
            ends.append(-p)
            chains.append([i])
        else:
            ends[k] = -p
            chains[k].append(i)
    return [np.array(c) for c in chains]


def aligned_blocks(first: np.ndarray, last: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) line in the later document of each block aligned with the earlier one.

    Links of one pair: lines ``first`` to ``last`` of the later document are
    those from ``at`` on of the earlier.
    """
    order = np.lexsort((-last, -at, first))     # falling places at one line: a chain takes one of them
    first, last, at = first[order], last[order], at[order]
    once = np.ones(len(first), dtype=bool)
    once[1:] = (first[1:] != first[:-1]) | (at[1:] != at[:-1])
    first, last, at = first[once], last[once], at[once]
    longest = _longest_chain(at)
    chains = [longest]
    if len(longest) < len(at):
        outside = np.setdiff1d(np.arange(len(at)), longest, assume_unique=True)
        chains += [outside[c] for c in _rising_chains(at[outside])]
    out = []
    for chain in chains:
        b, e = first[chain], last[chain]
        reach = np.maximum.accumulate(e)
        apart = (np.diff(b) != np.diff(at[chain])) | (b[1:] > reach[:-1] + 1)
        starts = np.concatenate([[0], np.flatnonzero(apart) + 1])
        ends = np.maximum.reduceat(e, starts)
        out += zip(b[starts].tolist(), ends.tolist())
    return out


def find_blocks(runs: DataFrame) -> DataFrame:
    """(doc_id, h, blocks, partners): per document with something to delete, the
    lines of its aligned blocks (first, last, first, last, ...; no overlaps) and
    the earlier documents they are aligned with.

    ``runs`` is a stored ``run_table``.
    """
    key = ["doc_id", "h"]
    # a stated number of partitions: few bytes here are much work
    parts = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = links(runs).repartition(parts, *key).sortWithinPartitions(*key, "partner", "h_a")

    def cuts(cols: list[np.ndarray]) -> list[int]:
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in cols])
        return [0, *(np.flatnonzero(new) + 1).tolist(), len(cols[0])]

    def blocks(part: pd.DataFrame) -> pd.DataFrame:
        c = {name: part[name].to_numpy() for name in part.columns}
        pairs = cuts([c["doc_id"], c["h"], c["partner"], c["h_a"]])
        spans: dict[tuple, list] = {}
        partners: dict[tuple, list] = {}
        for i, j in zip(pairs, pairs[1:]):
            doc = (int(c["doc_id"][i]), int(c["h"][i]))
            spans.setdefault(doc, []).extend(aligned_blocks(c["first"][i:j], c["last"][i:j], c["at"][i:j]))
            partners.setdefault(doc, []).append(int(c["partner"][i]))
        rows = [(*doc, [x for span in _union(sorted(found)) for x in span], sorted(set(partners[doc])))
                for doc, found in spans.items()]
        return pd.DataFrame(rows, columns=["doc_id", "h", "blocks", "partners"])

    def run(batches: Iterator[pd.DataFrame]):
        held: list[pd.DataFrame] = []       # rows of a document that may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            last = cuts([batch["doc_id"].to_numpy(), batch["h"].to_numpy()])[-2]
            begins = not held or tuple(held[-1][key].iloc[-1]) != tuple(batch[key].iloc[0])
            if last or begins:
                done = held + ([batch.iloc[:last]] if last else [])
                if done:
                    yield blocks(pd.concat(done, ignore_index=True))
                held = []
            held.append(batch.iloc[last:])
        if held:
            yield blocks(pd.concat(held, ignore_index=True))

    return pairs.mapInPandas(run, "doc_id long, h long, blocks array<long>, partners array<long>")


@shielded("_id", "_h", "_copy", "_blocks")
def remove_shared_blocks(docs: DataFrame, min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """All columns of ``docs`` with ``text`` less its blocks shared with an
    earlier document, plus n_lines, n_removed, removed_words and partners.

    Earlier means a smaller doc_id (null first), then a smaller text hash. Of
    repeated rows (one id, one text) all but one lose their whole text if it
    has ``min_words`` words. A null text stays null; lines are what line breaks
    separate, empty ones stay. Columns of the added names are replaced.
    """
    added = T.StructType.fromDDL("n_lines long, n_removed long, removed_words long, partners array<long>")
    names = [c for c in docs.columns if c not in added.names]
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    text = F.col("text").cast("string")
    keyed = docs.select(*names).withColumns({"_id": key, "_h": F.xxhash64(text)})
    filled = keyed.where(F.length(text) > 0).select(
        F.col("_id").alias("doc_id"), F.col("_h").alias("h"), text.alias("text"))
    runs = stored(run_table(filled, min_words), "runs")
    found = find_blocks(runs).withColumnsRenamed({"doc_id": "_id", "h": "_h", "blocks": "_blocks"})
    found = stored(found, "line-blocks")
    discard(runs)
    same = Window.partitionBy("_id", "_h").orderBy("_id")
    rows = keyed.withColumn("_copy", F.row_number().over(same) > 1).join(found, ["_id", "_h"], "left")
    rows = rows.select(*names, "_copy", "_blocks", "partners")
    schema = T.StructType(docs.select(*names).schema.fields + added.fields)

    def rewrite(text, copy, blocks):
        lines = text.split("\n")
        kept, k, gone, words = [], -1, 0, 0
        spans = list(zip(blocks[::2].tolist(), blocks[1::2].tolist())) if blocks is not None else []
        if copy and len(text.encode().split()) >= min_words:
            spans = [(0, len(lines))]
        at = 0
        for line in lines:
            if line:
                k += 1
                while at < len(spans) and spans[at][1] < k:
                    at += 1
                if at < len(spans) and spans[at][0] <= k:
                    gone += 1
                    words += len(line.encode().split())
                    continue
            kept.append(line)
        return "\n".join(kept) if gone else text, k + 1, gone, words

    def run(batches: Iterator[pd.DataFrame]):
        for batch in batches:
            made = [
                (None, 0, 0, 0) if t is None else rewrite(t, c, b)
                for t, c, b in zip(batch["text"], batch["_copy"], batch["_blocks"])]
            out = batch.drop(columns=["_copy", "_blocks"])
            out["text"], out["n_lines"], out["n_removed"], out["removed_words"] = (
                zip(*made) if made else ([], [], [], []))
            out["partners"] = [[] if p is None else sorted(p) for p in batch["partners"]]
            yield out[schema.names]

    return rows.mapInPandas(run, schema)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for first, last in spans:
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def line_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (cleaned), n_lines, n_removed, removed_words, partners, kept."""
    out = remove_shared_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    return out.withColumn("kept", (F.col("n_removed") == 0) | (F.col("text") != ""))
