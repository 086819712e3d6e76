"""Periodic runs of words: stretches that repeat with a fixed distance.

The root of a run, taken at the right place, is the longest Lyndon word that
begins there under one of two opposite orders of the words. Both Lyndon arrays
come from the first phase of Baier's suffix sorting, which groups suffixes by
their longest Lyndon prefix; no suffix array is built. Each root is extended to
both sides as far as words one period apart agree, with longest common
extensions from names of power-of-two blocks.

Runs of interest repeat about four times, so a cheap test in front (words, or
runs of four words, that come again soon) leaves only stretches that can hold
one; it never leaves out a run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import text_or_empty
from .textbatch import TextBatch, chunks, window_hashes

MIN_LENGTH = 6
MIN_REPEATS = 4
#: Below this period words are compared alone, from it on in runs of four.
LONG_PERIOD = 5
GRAM = 4


def lyndon_array(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that begins at each place.

    Groups of suffixes with one known Lyndon prefix are taken from the highest
    down. For each member the nearest earlier suffix of a lower group is
    followed by one more copy of the group's prefix; such suffixes leave their
    group for a higher one, ordered by the number of copies.
    """
    n = len(ranks)
    out = [1] * n
    group_of = ranks.tolist()
    members: list[list[int]] = [[] for _ in range(max(group_of, default=-1) + 1)]
    for i, g in enumerate(group_of):
        members[g].append(i)
    size = [1] * len(members)                       # length of each group's prefix
    lower = list(range(-1, len(members) - 1))       # the next lower group
    upper = list(range(1, len(members) + 1))        # the next higher group; past the end: none
    before = list(range(-1, n - 1))                 # nearest earlier place that may still be in a lower group
    done = bytearray(n)
    top = len(members) - 1
    while top >= 0:
        g, top = top, lower[top]
        mine = [i for i in members[g] if group_of[i] == g]
        members[g] = []
        length = size[g]
        for i in mine:
            done[i] = 1
            out[i] = length
        copies: dict[int, int] = {}
        for i in mine:
            j = before[i]
            while j >= 0 and done[j]:
                k = before[j]
                if k >= 0 and done[k]:
                    before[j] = before[k]           # halve the path
                j = k
            before[i] = j
            if j >= 0:
                copies[j] = copies.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in copies.items():
            moved.setdefault((group_of[j], times), []).append(j)
        for old, times in sorted(moved, reverse=True):
            # directly above the old group; fewer copies are put in later, so below more copies
            new = len(members)
            places = moved[old, times]
            members.append(places)
            size.append(size[old] + times * length)
            above = upper[old]
            lower.append(old)
            upper.append(above)
            upper[old] = new
            if old == top:
                top = new
            else:
                lower[above] = new
            for j in places:
                group_of[j] = new
    return np.array(out, dtype=np.int64)


class Extensions:
    """Longest common extensions of pairs of places, to the right and to the left."""

    def __init__(self, ranks: np.ndarray):
        self.n = len(ranks)
        self.names = [ranks.astype(np.int32)]
        step = 1
        while 2 * step <= self.n:
            a = self.names[-1]
            pairs = a[: len(a) - step].astype(np.int64) * (int(a.max()) + 1) + a[step:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
            step *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from i and from j on, for i < j."""
        out = np.zeros(len(i), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            name = self.names[k]
            fits = np.flatnonzero(j + out < len(name))
            a, b = i[fits] + out[fits], j[fits] + out[fits]
            out[fits[name[a] == name[b]]] += 1 << k
        return out

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree before i and before j, for i < j."""
        out = np.zeros(len(i), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            name = self.names[k]
            a = i - out - (1 << k)
            fits = np.flatnonzero(a >= 0)
            same = name[a[fits]] == name[j[fits] - out[fits] - (1 << k)]
            out[fits[same]] += 1 << k
        return out


def find_runs(ranks: np.ndarray, least: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``repeats`` periods, by start and period."""
    n = len(ranks)
    if n < least:
        return []
    reach = Extensions(ranks)
    found = []
    for order in (ranks, ranks.max() - ranks):
        period = lyndon_array(order)
        i = np.arange(n)
        near = repeats * period <= n
        i, period = i[near], period[near]
        j = np.minimum(i + period, n)
        right, left = reach.right(i, j), reach.left(i, j)
        length = left + period + right
        good = (length >= least) & (length >= repeats * period)
        found.append(np.stack([i - left, length, period], axis=1)[good])
    rows = np.unique(np.concatenate(found), axis=0)
    return [tuple(r) for r in rows[np.lexsort((rows[:, 2], rows[:, 0]))].tolist()]


def _next_same(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Distance to the next place of a document with the same key; very far if there is none."""
    out = np.full(len(keys), np.iinfo(np.int64).max, dtype=np.int64)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        a, b = order[:-1], order[1:]
        same = (keys[a] == keys[b]) & (doc[a] == doc[b])
        out[a[same]] = b[same] - a[same]
    return out


def _stretches(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = end - begin >= least
    return begin[long], end[long]


def candidate_stretches(words: np.ndarray, doc: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges of words that cover every run.

    In a run of period q and length n >= 4q the first n - q - (g - 1) runs of g
    words come again within q words. Equal hashes of different words only add
    candidates.
    """
    n = len(words)
    found = []
    alone = _next_same(words, doc)
    for period in range(1, LONG_PERIOD):
        least = max(MIN_LENGTH, MIN_REPEATS * period) - period
        begin, end = _stretches(alone <= period, least)
        found.append((begin, end + period))
    grams = window_hashes(words, GRAM)
    inside = doc[: len(grams)] == doc[GRAM - 1 :] if len(grams) else np.zeros(0, dtype=bool)
    again = _next_same(grams, doc[: len(grams)])
    again[~inside] = np.iinfo(np.int64).max
    longest = int(np.max(np.diff(first), initial=0)) // MIN_REPEATS
    low = LONG_PERIOD
    while low <= longest:       # periods from low up to 2 * low - 1
        high = 2 * low - 1
        begin, end = _stretches(again <= high, (MIN_REPEATS - 1) * low - GRAM + 1)
        found.append((begin, end + high + GRAM))
        low *= 2
    begin = np.concatenate([b for b, _ in found])
    end = np.concatenate([e for _, e in found])
    # marks never pass from one document to the next: the last words of a document do not come again
    stop = first[doc[begin] + 1] if len(begin) else begin
    order = np.argsort(begin, kind="stable")
    out: list[list[int]] = []
    for b, e in zip(begin[order].tolist(), np.minimum(end, stop)[order].tolist()):
        if out and b < out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([b, e])
    return [(b, min(e, n)) for b, e in out]


def planted(words: list[bytes], checksum: int | None) -> list[bytes]:
    """The words with the tail that the contract makes periodic for every tenth id."""
    if checksum is None or checksum % 10 or not words:
        return words
    g, n = checksum // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a : a + p]
    return words[:a] + (root * ((n - a) // p + 1))[: n - a]


def _document(words: list[bytes], ranges: list[tuple[int, int]]) -> tuple:
    """n_runs, best run's start, length, period, exponent_milli, digest of the runs, digest of the kept words."""
    runs = []
    for begin, end in ranges:
        names: dict[bytes, int] = {}
        ranks = np.array([names.setdefault(w, len(names)) for w in words[begin:end]], dtype=np.int64)
        runs += [(begin + s, length, period) for s, length, period in find_runs(ranks)]
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    if runs:
        drop = np.zeros(len(words) + 1, dtype=np.int64)
        for s, n, q in runs:
            drop[s + q] += 1
            drop[s + n] -= 1
        gone = np.cumsum(drop)[:-1] > 0
        words = [w for w, x in zip(words, gone.tolist()) if not x]
    kept = hashlib.sha256(b" ".join(words)).hexdigest()
    if not runs:
        return 0, None, None, None, None, listed, kept
    s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return len(runs), s, n, q, 1000 * n // q, listed, kept


def _batch(texts: list[str], checksums: list) -> Iterator[tuple]:
    split = [planted(t.encode().split(), None if h is None else int(h)) for t, h in zip(texts, checksums)]
    block = TextBatch([b" ".join(words) for words in split])
    ranges: dict[int, list[tuple[int, int]]] = {}
    if len(block.begin):
        for begin, end in candidate_stretches(block.word_hashes(), block.doc, block.first):
            i = int(block.doc[begin])
            ranges.setdefault(i, []).append((begin - int(block.first[i]), end - int(block.first[i])))
    for i, words in enumerate(split):
        yield _document(words, ranges.get(i, []))


_RESULT = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs, the run of the greatest exponent
    (start, length, period, exponent_milli; nulls without a run), runs_sha256 and
    collapsed_sha256.

    Null texts have no words. Rows without an id keep their words as they are.
    Repeated rows are rows of their own. Only doc_id and text are read.
    """
    names = [c.split()[0] for c in _RESULT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in chunks(batches):
            made = list(_batch(part["text"].tolist(), [None if pd.isna(h) else h for h in part["h"]]))
            out = pd.DataFrame(made, columns=names)
            for c in names[:5]:
                out[c] = out[c].astype("Int64")
            out.insert(0, "rid", part["rid"].to_numpy())
            yield out

    rid = F.col("doc_id").cast("long").cast("string")
    rows = docs.select(rid.alias("rid"), F.crc32(rid.cast("binary")).alias("h"), text_or_empty().alias("text"))
    made = rows.mapInPandas(run, "rid string, " + _RESULT)
    return made.select(F.col("rid").cast("long").alias("doc_id"), *names)
