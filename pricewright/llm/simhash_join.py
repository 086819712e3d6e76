"""SimHash near-dedup: 64-bit fingerprints, joined by walking a binary trie against itself.

Two fingerprints with at most two differing bits agree in one third of their
bits, so three tries, each with another third in front, are entered at the
nodes below that third, where no bit differs yet. Below, pairs of nodes are
walked together, bit by bit: a pair has the pairs of its children as children,
differing bits add up, and a pair is dropped as soon as they exceed the budget.
A node pair with many fingerprints is cut into the pairs some levels below it,
with Spark, until every pair fits a task; a task walks all its pairs at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import attach, components, stored, text_or_empty
from .textbatch import chunks

SHINGLE_WORDS = 3
SEED = 42
BUDGET = 2
#: (rotation to the left, bits of the third then in front)
TRIES = ((0, 21), (21, 21), (42, 22))
#: Larger node pairs are cut by so many levels at a time.
NODE_ROWS = 50_000
CUT_BITS = 6
#: Hashes whose bits are counted at once, node pairs that are walked at once.
SLICE = 100_000
FRONTIER = 300_000
_NODE = ["rotation", "depth", "a", "b", "used"]


def shingle_hashes(text: str) -> list[int]:
    """XXH64 of each run of three words, lower-cased in A-Z; fewer words are one run."""
    words = text.encode().lower().split()       # of bytes: ASCII letters and white space only
    if len(words) < SHINGLE_WORDS:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    begin = np.cumsum(size + 1) - size - 1
    end = (begin + size)[SHINGLE_WORDS - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[i:j], SEED) for i, j in zip(begin.tolist(), end)]


def fingerprints(texts: list[str]) -> np.ndarray:
    """Unsigned 64-bit fingerprints: a bit is set if it is in over half the hashes."""
    ones = np.zeros((len(texts), 64), dtype=np.int64)
    count = np.zeros(len(texts), dtype=np.int64)
    owners, held, n = [], [], 0

    def add() -> None:
        hashes = np.array(held, dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.cumsum([0, *(k for _, k in owners[:-1])])
        sums = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        np.add.at(ones, [i for i, _ in owners], sums)

    for i, text in enumerate(texts):
        hashes = shingle_hashes(text)
        count[i] = len(hashes)
        for begin in range(0, len(hashes), SLICE):
            piece = hashes[begin : begin + SLICE]
            owners.append((i, len(piece)))
            held.extend(piece)
            if len(held) >= SLICE:
                add()
                owners, held = [], []
    if held:
        add()
    bits = 2 * ones > count[:, None]
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def with_fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as a signed long) for each row; null texts count as empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in chunks(batches):
            made = fingerprints(part["text"].tolist()).view(np.int64)
            yield pd.DataFrame({"rid": part["rid"].to_numpy(), "fingerprint": made})

    rows = docs.select(F.col("doc_id").cast("string").alias("rid"), text_or_empty().alias("text"))
    made = rows.mapInPandas(run, "rid string, fingerprint long")
    return made.select(F.col("rid").cast("long").alias("doc_id"), "fingerprint")


def _rotated(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)) if bits else x


def _top_pairs(points: DataFrame) -> DataFrame:
    """Each fingerprint at its node of every trie, paired with itself."""
    each = [
        F.struct(
            F.lit(bits).alias("rotation"), F.lit(depth).alias("depth"), _rotated(F.col("fingerprint"), bits).alias("x"))
        for bits, depth in TRIES]
    rows = points.select(F.explode(F.array(*each)).alias("t")).select("t.*")
    top = F.expr("shiftrightunsigned(x, 64 - depth)")
    return rows.select("rotation", "depth", top.alias("a"), top.alias("b"), F.lit(0).alias("used"), F.lit(0).alias("side"), "x")


def _cut(pairs: DataFrame, bits: int) -> DataFrame:
    """The fingerprints of node pairs at the pairs ``bits`` levels below that are within the budget."""
    masks = [m for m in range(1 << bits) if m.bit_count() <= BUDGET]
    step = F.expr(f"least({bits}, 64 - depth)")
    rows = pairs.withColumn("_step", step)
    own = F.expr("shiftrightunsigned(shiftleft(x, depth), 64 - _step)")
    rows = rows.withColumn("_own", own).withColumn("_mask", F.explode(F.array(*map(F.lit, masks))))
    rows = rows.where(
        (F.col("_mask") < F.expr("shiftleft(1, _step)")) & (F.col("used") + F.bit_count("_mask") <= BUDGET))
    other = F.col("_own").bitwiseXOR(F.col("_mask").cast("long"))
    same = F.col("a") == F.col("b")
    # below a node paired with itself, the smaller child comes first
    side = F.when(same, (F.col("_own") > other).cast("int")).otherwise(F.col("side"))
    rows = rows.withColumn("_other", other).withColumn("_side", side)
    first = F.when(F.col("_side") == 0, F.col("_own")).otherwise(F.col("_other"))
    second = F.when(F.col("_side") == 0, F.col("_other")).otherwise(F.col("_own"))
    down = lambda c: F.expr(f"shiftleft({c}, _step)")
    return rows.select(
        "rotation", (F.col("depth") + F.col("_step")).alias("depth"), down("a").bitwiseOR(first).alias("a"),
        down("b").bitwiseOR(second).alias("b"), (F.col("used") + F.bit_count("_mask")).alias("used"),
        F.col("_side").alias("side"), "x")


def _fitting_pairs(points: DataFrame, node_rows: int) -> DataFrame:
    """Node pairs of at most ``node_rows`` fingerprints that together hold every link."""
    open_, done = stored(_top_pairs(points), "trie-pairs"), None
    while True:
        sizes = open_.groupBy(*_NODE).agg(F.count("*").alias("n"), F.min("side").alias("_low"), F.max("side").alias("_high"))
        # nothing to compare in one fingerprint, nor in a pair of two nodes with one side empty
        useful = "n > 1 AND (a = b OR _low <> _high)"
        sizes = stored(sizes.where(useful).drop("_low", "_high"), "trie-sizes")
        total = sizes.agg(F.sum("n")).first()[0] or 0
        rows = stored(attach(open_, sizes, _NODE, "n", total), "trie-open") if total else open_.limit(0).withColumn("n", F.lit(0))
        fit = rows.where((F.col("n") <= node_rows) | (F.col("depth") == 64)).drop("n")
        done = fit if done is None else done.unionByName(fit)
        large = rows.where((F.col("n") > node_rows) & (F.col("depth") < 64)).drop("n")
        if not sizes.where((F.col("n") > node_rows) & (F.col("depth") < 64)).limit(1).count():
            return done
        open_ = stored(_cut(large, CUT_BITS), "trie-pairs")


def walk(x: np.ndarray, pairs: list[np.ndarray], depth: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) in x of the links below node pairs.

    ``x``: unsigned, ascending within each node. ``pairs``: five arrays, the
    ranges [l0, l1) and [r0, r1) of the two nodes (equal for a node with
    itself) and the bits that differ so far; ``depth``: bits above each pair.
    """
    set_before: dict[int, np.ndarray] = {}
    work = []
    for level in np.unique(depth).tolist():
        work.append((level, [p[depth == level] for p in pairs]))
    while work:
        level, state = work.pop()
        if len(state[0]) > FRONTIER:
            half = len(state[0]) // 2
            work += [(level, [s[:half] for s in state]), (level, [s[half:] for s in state])]
            continue
        l0, l1, r0, r1, used = state
        lone = (l1 - l0 == 1) & (r1 - r0 == 1)
        i, j = l0[lone], r0[lone]
        near = (i != j) & (np.bitwise_count(x[i] ^ x[j]) <= BUDGET)
        if near.any():
            yield i[near], j[near]
        keep = ~lone
        l0, l1, r0, r1, used = (s[keep] for s in (l0, l1, r0, r1, used))
        if not len(l0) or level == 64:
            continue
        if level not in set_before:
            bit = (x >> np.uint64(63 - level)) & np.uint64(1)
            set_before[level] = np.concatenate([[0], np.cumsum(bit.astype(np.int64))])
        ones = set_before[level]
        lm, rm = l1 - (ones[l1] - ones[l0]), r1 - (ones[r1] - ones[r0])
        same = l0 == r0
        children = [
            (l0, lm, r0, rm, used, None), (lm, l1, rm, r1, used, None),
            (l0, lm, rm, r1, used + 1, None), (lm, l1, r0, rm, used + 1, ~same)]
        made = []
        for a0, a1, b0, b1, u, only in children:
            good = (a1 > a0) & (b1 > b0) & (u <= BUDGET)
            if only is not None:
                good &= only
            good &= (a0 != b0) | (a1 - a0 > 1)
            made.append([c[good] for c in (a0, a1, b0, b1, u)])
        work.append((level + 1, [np.concatenate(c) for c in zip(*made)]))


class _Forest:
    """Which places are linked already; keeps one link per merge."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def add(self, i: int, j: int) -> bool:
        parent = self.parent
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        while parent[j] != j:
            parent[j] = j = parent[parent[j]]
        if i == j:
            return False
        parent[max(i, j)] = min(i, j)
        return True


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that span the links of whole node pairs."""
    key = rows[_NODE].to_numpy(dtype=np.int64)
    node = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
    x = rows["x"].to_numpy(dtype=np.int64).view(np.uint64)
    side = rows["side"].to_numpy(dtype=np.int64)
    order = np.lexsort((x, side, node))
    x, side, key = x[order], side[order], key[order]
    begin = np.flatnonzero(np.diff(node, prepend=-1))
    end = np.append(begin[1:], len(x))
    middle = end - np.add.reduceat(side, begin)
    equal = key[begin, 2] == key[begin, 3]
    pairs = [begin, np.where(equal, end, middle), np.where(equal, begin, middle), end, key[begin, 4]]
    full = (pairs[1] > pairs[0]) & (pairs[3] > pairs[2])
    forest, kept = _Forest(len(x)), []
    for i, j in walk(x, [p[full] for p in pairs], key[begin, 1][full]):
        kept.extend((a, b) for a, b in zip(i.tolist(), j.tolist()) if forest.add(a, b))
    at = np.array(kept, dtype=np.int64).reshape(-1, 2)
    left, right = key[at[:, 0], 0].astype(np.uint64), np.uint64(64) - key[at[:, 0], 0].astype(np.uint64)

    def back(v: np.ndarray) -> np.ndarray:
        turned = (v >> left) | np.where(left > 0, v << (right % np.uint64(64)), np.uint64(0))
        return turned.view(np.int64)

    return pd.DataFrame({"a": back(x[at[:, 0]]), "b": back(x[at[:, 1]])})


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole node pairs at a time; a pair's rows follow each other."""
    held: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        key = rows[_NODE].to_numpy(dtype=np.int64)
        cut = np.flatnonzero((key != key[-1]).any(axis=1))
        last = cut[-1] + 1 if len(cut) else 0
        if last:
            yield _block_links(rows.iloc[:last])
        held = rows.iloc[last:]
    if held is not None:
        yield _block_links(held)


def fingerprint_links(points: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) with the same connected groups as all pairs of distinct
    ``fingerprint`` values at two or fewer differing bits."""
    pairs = _fitting_pairs(points, node_rows)
    rows = pairs.repartition(*_NODE).sortWithinPartitions(*_NODE)
    return rows.mapInPandas(_links, "a long, b long")


def simhash_groups(docs: DataFrame, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Null texts count as empty; texts without words have the fingerprint zero.
    Rows without an id belong to their group but name none: a group of such rows
    alone has a null component_id. Only doc_id and text are read.
    """
    rows = stored(with_fingerprint(docs), "fingerprints")
    points = stored(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "fingerprint-points")
    labels = components(stored(fingerprint_links(points.select("fingerprint"), node_rows), "fingerprint-links"))
    named = stored(
        points.join(labels.withColumnRenamed("id", "fingerprint"), "fingerprint", "left")
        .withColumn("component", F.coalesce("component", "fingerprint")), "fingerprint-groups")
    groups = named.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("n_points"))
    sizes = named.agg(F.count("*"), F.sum("n")).first()
    told = stored(attach(named, stored(groups, "fingerprint-names"), ["component"], "n_points", sizes[0]), "fingerprint-told")
    out = attach(rows, told.select("fingerprint", "component_id", "n"), ["fingerprint"], "n", sizes[1] or 0)
    return out.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
