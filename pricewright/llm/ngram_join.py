"""Jaccard join on word n-grams with several global token orders.

Two sets of a similarity of 0.8 or more share a token among the first fifth of
their tokens under any order of all tokens. Several orders are used, all with
rare tokens first and ties broken differently. Under each, documents that are
connected by shared prefix tokens form a cluster; a link can only lie inside a
cluster of every order, so documents are compared only where all cluster labels
agree. Comparisons are exact: a large cluster is first measured against one
pivot, the triangle inequality leaves only neighbouring rings, and those are
compared block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import attach, components, discard, shielded, stored, text_or_empty
from .textbatch import TextBatch, chunks, mix, window_hashes

SHINGLE = 5
THRESHOLD = 80      # percent
ORDERS = 3
#: Text of one map chunk, and of one bucket of tokens.
CHUNK_CHARS = 1_000_000
CHUNK_DOCS = 50_000
BUCKET_CHARS = 4_000_000
#: A token in so many documents of a chunk travels once for all of them.
LOCALLY_COMMON = 32
BLOCK = 128
_LOW = np.uint64((1 << 48) - 1)
_NONE = 0xFFFF


def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text (A-Z lower-cased).

    A text of fewer words is one shingle of all its words; without words the set is empty.
    """
    batch = TextBatch([t.lower() for t in texts])      # bytes: only A-Z change
    words = batch.word_hashes()
    windows = window_hashes(words, n)
    out = []
    for i, j in zip(batch.first.tolist(), batch.first[1:].tolist()):
        if j - i >= n:
            out.append(np.unique(windows[i : j - n + 1]))
        elif j > i:
            out.append(window_hashes(words[i:j], j - i) ^ np.uint64(j - i))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def least_overlap(n: np.ndarray) -> np.ndarray:
    return (THRESHOLD * n + 99) // 100


def _pack(tokens: np.ndarray) -> bytes:
    low = tokens & _LOW
    return (low & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (low >> np.uint64(32)).astype("<u2").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    n = len(data) // 6
    low = np.frombuffer(data, "<u4", n).astype(np.uint64)
    return low | (np.frombuffer(data, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32))


def token_table(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: rid, doc_id, h (hash of the text), n, sig1, sig2, and, where the
    document can have a partner at all, shared (its tokens that another
    document has) and prefixes (one array per order).

    Tokens are counted by bucket, each chunk of documents sends them once and
    gets back the counts above one. A document with a full prefix of tokens
    that no other has needs no further look.
    """
    text = text_or_empty()
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    n_buckets = min(1 << 24, max(256, -(-chars // BUCKET_CHARS)))
    columns = "bucket int, chunk long, kind int, tokens binary, docs binary, counts binary, ids binary, hashes binary, sizes binary, sigs binary"

    def send(batches: Iterator[pd.DataFrame]):
        part, seq = TaskContext.get().partitionId(), 0
        for whole in chunks(batches, "text", CHUNK_CHARS):
            for k in range(0, len(whole), CHUNK_DOCS):
                some = whole.iloc[k : k + CHUNK_DOCS]
                chunk = (part << 24) | seq
                seq += 1
                sets = shingle_sets([t.encode() for t in some["text"]])
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                sigs = b"".join(hashlib.sha256(s.tobytes()).digest()[:16] for s in sets)
                rows = [(int(chunk % n_buckets), chunk, 0, b"", b"", b"", some["doc_id"].to_numpy(dtype="<i8").tobytes(), some["h"].to_numpy(dtype="<i8").tobytes(), sizes.astype("<i8").tobytes(), sigs)]
                tokens = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
                doc = np.repeat(np.arange(len(sets)), sizes).astype(np.uint16)
                order = np.argsort(tokens, kind="stable")
                tokens, doc = tokens[order], doc[order]
                begin = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, dtype=np.int64)
                count = np.diff(np.append(begin, len(tokens)))
                common = np.repeat(count >= LOCALLY_COMMON, count)
                bucket = ((tokens >> np.uint64(40)) * np.uint64(n_buckets)) >> np.uint64(24)
                if common.any():    # the documents of locally common tokens stay with the chunk
                    full = (bucket[common] << np.uint64(48)) ^ (tokens[common] & _LOW)
                    rows.append((int((chunk + 1) % n_buckets), chunk, 1, full.tobytes(), doc[common].tobytes(), *[b""] * 5))
                first = np.zeros(len(tokens), dtype=bool)
                first[begin] = True
                sent = ~common | first
                doc = np.where(common, np.uint16(_NONE), doc)
                times = np.where(common, np.repeat(count, count), 1).astype("<u2")
                tokens, doc, times, bucket = tokens[sent], doc[sent], times[sent], bucket[sent]
                cut = np.searchsorted(bucket, np.arange(n_buckets + 1, dtype=np.uint64)) if n_buckets <= 4096 else None
                spans = zip(range(n_buckets), cut, cut[1:]) if cut is not None else _bucket_runs(bucket)
                for b, i, j in spans:
                    if j > i:
                        rows.append((int(b), chunk, 2, _pack(tokens[i:j]), doc[i:j].tobytes(), times[i:j].tobytes(), *[b""] * 4))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in columns.split(", ")])

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        plain = rows[rows["kind"] < 2]
        rows = rows[rows["kind"] == 2]
        if not len(rows):
            return plain.drop(columns="bucket")
        tokens = [_unpack(t) for t in rows["tokens"]]
        sizes = np.array([len(t) for t in tokens])
        flat = np.concatenate(tokens)
        times = np.concatenate([np.frombuffer(c, "<u2") for c in rows["counts"]]).astype(np.int64)
        _, inverse = np.unique(flat, return_inverse=True)
        df = np.bincount(inverse, weights=times)[inverse].astype(np.int64)
        df = np.minimum(df, 0xFFFFFFFF)
        base = np.uint64(int(rows["bucket"].iloc[0])) << np.uint64(48)
        docs_ = np.concatenate([np.frombuffer(d, "<u2") for d in rows["docs"]])
        cut = np.concatenate([[0], np.cumsum(sizes)])
        made = []
        for chunk, i, j in zip(rows["chunk"], cut, cut[1:]):
            keep = df[i:j] > 1
            if keep.any():
                made.append((chunk, 2, ((flat[i:j][keep]) ^ base).tobytes(), docs_[i:j][keep].tobytes(), df[i:j][keep].astype("<u4").tobytes(), *[b""] * 4))
        made = pd.DataFrame(made, columns=[c for c in rows.columns if c != "bucket"])
        return pd.concat([plain.drop(columns="bucket"), made], ignore_index=True)

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        meta = rows[rows["kind"] == 0].iloc[0]
        ids, sizes = np.frombuffer(meta["ids"], "<i8"), np.frombuffer(meta["sizes"], "<i8")
        sigs = np.frombuffer(meta["sigs"], "<i8").reshape(-1, 2)
        back = rows[rows["kind"] == 2]
        join = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in back[c]]) if len(back) else np.zeros(0, t)
        tokens, doc, df = join("tokens", "<u8"), join("docs", "<u2"), join("counts", "<u4").astype(np.int64)
        local = rows[rows["kind"] == 1]
        if len(local):
            named = doc == _NONE
            known, known_df = tokens[named], df[named]
            order = np.argsort(known)
            t = np.concatenate([np.frombuffer(x, "<u8") for x in local["tokens"]])
            d = np.concatenate([np.frombuffer(x, "<u2") for x in local["docs"]])
            at = order[np.searchsorted(known, t, sorter=order)]
            tokens, doc, df = (np.concatenate([tokens[~named], t]), np.concatenate([doc[~named], d]), np.concatenate([df[~named], known_df[at]]))
        doc = doc.astype(np.int64)
        n_shared = np.bincount(doc, minlength=len(ids))
        prefix = sizes - least_overlap(sizes) + 1 - (sizes - n_shared)
        open_ = (prefix > 0) & (sizes > 0)
        mine = open_[doc]
        tokens, doc, df = tokens[mine], doc[mine], df[mine]
        order = np.lexsort((tokens, doc))
        shared = np.split(tokens[order], np.cumsum(np.bincount(doc, minlength=len(ids)))[:-1])
        prefixes: list[list] = [[] for _ in ids]
        for k in range(ORDERS):
            rank = df if k == 0 else np.floor(np.log2(np.maximum(df, 1))).astype(np.int64)
            tie = mix(tokens + np.uint64(0x5851F42D4C957F2D * (k + 1) & 0xFFFFFFFFFFFFFFFF))
            order = np.lexsort((tie, rank, doc))
            cut = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(ids)))])
            for i in np.flatnonzero(open_):
                prefixes[i].append(tokens[order[cut[i] : cut[i] + prefix[i]]].view(np.int64))
        rid = (int(meta["chunk"]) << 20) + np.arange(len(ids))
        return pd.DataFrame({
            "rid": rid, "doc_id": ids, "h": np.frombuffer(meta["hashes"], "<i8"), "n": sizes, "sig1": sigs[:, 0], "sig2": sigs[:, 1],
            "shared": [s.tobytes() if o else None for s, o in zip(shared, open_)],
            "prefixes": [p if o else None for p, o in zip(prefixes, open_)]})

    empty = F.lit(-(1 << 63))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), empty).alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
    sent = rows.mapInPandas(send, columns)
    counted = sent.groupBy("bucket").applyInPandas(count, columns.removeprefix("bucket int, "))
    out = counted.groupBy("chunk").applyInPandas(
        settle, "rid long, doc_id long, h long, n long, sig1 long, sig2 long, shared binary, prefixes array<array<long>>")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != empty, F.col("doc_id")))


def _bucket_runs(bucket: np.ndarray):
    cut = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    return [(int(bucket[i]), i, j) for i, j in zip(cut, cut[1:]) if j > i]


def overlaps(sets_a: list[np.ndarray], sets_b: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of all intersections of two lists of sorted sets, by slices of the vocabulary."""
    flat = np.concatenate([*sets_a, *sets_b])
    owner = np.repeat(np.arange(len(sets_a) + len(sets_b)), [len(s) for s in (*sets_a, *sets_b)])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[column] > 1
    column, owner = column[keep], owner[keep]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets_a), len(sets_b)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [start, start + width])
        table = np.zeros((len(sets_a) + len(sets_b), width), dtype=np.float32)
        table[owner[i:j], column[i:j] - start] = 1.0
        out += table[: len(sets_a)] @ table[len(sets_a) :].T
    return out


def _linked(sizes_a, sizes_b, shared) -> np.ndarray:
    return 100 * shared >= THRESHOLD * (sizes_a[:, None] + sizes_b[None, :] - shared)


def _forest(links: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """A few links that connect all that the link matrix connects."""
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = np.nonzero(links)
    i, j = place[i], place[len(a) + j]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(ids))
    return pd.DataFrame({"a": ids[moved], "b": ids[label[moved]]})


def _sets(rows: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(s, "<u8") for s in rows["shared"]]


def cluster_links(members: DataFrame) -> DataFrame:
    """(a, b): pairs that connect all linked documents of each cluster.

    ``members`` (stored) has cluster, size (of the cluster), pivot (smallest
    rid), rid, n, shared. Clusters of one block are compared whole. In larger
    ones every member is compared with the pivot, in salted groups; members
    linked to it are done with each other, and the distance to the pivot (1 -
    similarity, a metric) is cut into rings of 0.2: only equal or neighbouring
    rings can hold a link.
    """
    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) < 2:
            return pd.DataFrame({"a": [], "b": []})
        sets, sizes, rid = _sets(rows), rows["n"].to_numpy(), rows["rid"].to_numpy()
        return _forest(_linked(sizes, sizes, overlaps(sets, sets)), rid, rid)

    small = members.where(F.col("size") <= BLOCK).groupBy("cluster").applyInPandas(whole, "a long, b long")

    large = members.where(F.col("size") > BLOCK)
    salts = F.ceil(F.col("size") / BLOCK).cast("int")
    is_pivot = F.col("rid") == F.col("pivot")
    dealt = large.withColumn("salt", F.explode(F.when(is_pivot, F.sequence(F.lit(0), salts - 1)).otherwise(
        F.array(F.pmod(F.hash("rid"), salts)))))

    def measure(rows: pd.DataFrame) -> pd.DataFrame:
        at = rows["rid"].to_numpy() == rows["pivot"].to_numpy()
        pivot, others = rows[at].iloc[:1], rows[~at]
        if not len(others):
            return pd.DataFrame({"cluster": [], "rid": [], "ring": []})
        shared = overlaps(_sets(others), _sets(pivot))[:, 0].astype(np.int64)
        union = others["n"].to_numpy() + int(pivot["n"].iloc[0]) - shared
        linked = 100 * shared >= THRESHOLD * union
        ring = np.where(linked, 0, np.maximum(1, np.ceil((union - shared) / union * 5 - 1e-9).astype(int) - 1))
        return pd.DataFrame({"cluster": others["cluster"], "rid": others["rid"], "ring": ring})

    rings = dealt.groupBy("cluster", "salt").applyInPandas(measure, "cluster long, rid long, ring int")
    rings = stored(rings, "rings")
    near = large.join(rings, ["cluster", "rid"])
    star = near.where("ring = 0").select(F.col("rid").alias("a"), F.col("pivot").alias("b"))
    counts = rings.groupBy("cluster").agg(*[
        F.sum((F.col("ring") == r).cast("long")).alias(f"c{r}") for r in range(5)], F.count("*").alias("all"))
    counts = stored(counts, "ring-counts")
    rows = stored(near.select("cluster", "rid", "ring", "n", "shared"), "ring-members")
    rows = attach(rows, counts, ["cluster"], "all", rows.count())
    blocks = [F.ceil(F.col(f"c{r}") / BLOCK).cast("int") for r in range(5)]
    n_blocks = lambda r: F.element_at(F.array(*blocks), r + 1)
    own = F.pmod(F.hash("rid"), n_blocks(F.col("ring")))
    rows = rows.withColumn("own", own).withColumn("mine", n_blocks(F.col("ring")))
    key = lambda low, high, i, j: F.struct(low.alias("low"), high.alias("high"), i.alias("i"), j.alias("j"))
    ring = F.col("ring")
    inside = F.when(ring > 0, F.transform(F.sequence(F.lit(0), F.col("mine") - 1), lambda j: key(
        ring, ring, F.least("own", j), F.greatest("own", j))))
    up = F.when((ring < 4) & (n_blocks(F.least(ring + 1, F.lit(4))) > 0), F.transform(
        F.sequence(F.lit(0), F.greatest(n_blocks(F.least(ring + 1, F.lit(4))) - 1, F.lit(0))), lambda j: key(ring, ring + 1, F.col("own"), j)))
    down = F.when((ring > 0) & (n_blocks(F.greatest(ring - 1, F.lit(0))) > 0), F.transform(
        F.sequence(F.lit(0), F.greatest(n_blocks(F.greatest(ring - 1, F.lit(0))) - 1, F.lit(0))), lambda j: key(ring - 1, ring, j, F.col("own"))))
    none = F.array().cast("array<struct<low:int,high:int,i:int,j:int>>")
    rows = rows.withColumn("k", F.explode(F.concat(*[F.coalesce(x, none) for x in (inside, up, down)])))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        if first["low"] == first["high"]:
            if first["i"] == first["j"]:
                return whole(rows)
            side = rows["own"] == first["i"]
        else:
            side = rows["ring"] == first["low"]
        a, b = rows[side], rows[~side]
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": []})
        links = _linked(a["n"].to_numpy(), b["n"].to_numpy(), overlaps(_sets(a), _sets(b)))
        return _forest(links, a["rid"].to_numpy(), b["rid"].to_numpy())

    blockwise = rows.select("cluster", "k.*", "own", "ring", "rid", "n", "shared").groupBy(
        "cluster", "low", "high", "i", "j").applyInPandas(compare, "a long, b long")
    return small.unionByName(star).unionByName(blockwise)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, h, rid, is_first.

    component_id is the smallest doc_id reachable by links (null ids count
    only if there is no other); a document without words is linked with
    nothing. rid tells rows apart; is_first marks one row of each component,
    that of the smallest doc_id.
    """
    table = stored(token_table(docs), "token-sets")
    open_ = table.where("shared IS NOT NULL")
    rows = open_.select("rid", "doc_id", "n", "sig1", "sig2")
    classes = rows.groupBy("n", "sig1", "sig2").agg(F.min("rid").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes, "set-classes")
    member = stored(attach(rows, classes, ["n", "sig1", "sig2"], "copies", rows.count()).select("rid", "doc_id", "rep"), "class-members")

    reps = open_.join(member.where("rid = rep").select("rid"), "rid", "left_semi")
    reps = stored(reps.select("rid", "n", "shared", "prefixes"), "class-sets")
    posts = reps.select("rid", F.posexplode("prefixes").alias("ord", "tokens")).select(
        "rid", "ord", F.explode("tokens").alias("token"))
    posts = stored(posts, "postings")
    lists = posts.groupBy("ord", "token").agg(F.min("rid").alias("head"), F.count("*").alias("length")).where("length > 1")
    edges = attach(posts, stored(lists, "posting-lists"), ["ord", "token"], "length", posts.count())
    tagged = lambda c: F.col(c) * ORDERS + F.col("ord")
    graph = stored(edges.where("rid <> head").select(tagged("rid").alias("a"), tagged("head").alias("b")).distinct(), "prefix-edges")
    discard(posts)
    label = components(graph)
    label = label.select(
        F.floor(F.col("id") / ORDERS).alias("rid"), (F.col("id") % ORDERS).alias("ord"), "component")
    label = label.groupBy("rid").agg(
        F.count("*").alias("found"), *[F.max(F.when(F.col("ord") == k, F.col("component"))).alias(f"o{k}") for k in range(ORDERS)])
    # a document has to have company under every order, and the same company
    label = label.where(F.col("found") == ORDERS).withColumn("cluster", F.xxhash64(*[f"o{k}" for k in range(ORDERS)]))
    label = stored(label.select("rid", "cluster"), "clusters")
    sizes = stored(label.groupBy("cluster").agg(F.count("*").alias("size"), F.min("rid").alias("pivot")).where("size > 1"), "cluster-sizes")
    inside = attach(label, sizes, ["cluster"], "size", label.count())
    members = stored(inside.join(reps.select("rid", "n", "shared"), "rid"), "cluster-members")
    links = stored(cluster_links(members).where("a <> b"), "links")

    root = components(links).select(F.col("id").alias("rep"), F.col("component").alias("root"))
    roots = stored(_with_root(member, root), "roots")
    groups = stored(roots.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("least"), F.count("*").alias("members")), "components")
    linked = attach(roots, groups, ["root"], "members", roots.count()).select(
        "rid", F.col("least.doc_id").alias("component_id"), (F.col("least.rid") == F.col("rid")).alias("is_first"))
    out = table.select("rid", "doc_id", "h", "n").join(linked, "rid", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
        "h", "rid", F.coalesce("is_first", F.lit(True)).alias("is_first"))


def _with_root(member: DataFrame, root: DataFrame) -> DataFrame:
    """Members with the root of their class; classes without links are their own."""
    sizes = member.groupBy("rep").agg(F.count("*").alias("held"))
    named = stored(sizes.join(root, "rep", "left").withColumn("root", F.coalesce("root", "rep")), "class-roots")
    return attach(member, named, ["rep"], "held", member.count()).select("rid", "doc_id", "root")


@shielded("_id", "_h", "_nth")
def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that come first in their component; of repeated
    rows (one id, one text) one stays. Columns as they are."""
    names = docs.columns
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    first = near_duplicates(docs).where("is_first").select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_id"), F.col("h").alias("_h"))
    rows = docs.withColumns({"_id": key, "_h": F.xxhash64(text_or_empty())})
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "_h").orderBy("_id"))).where("_nth = 1")
    return rows.join(first, ["_id", "_h"], "left_semi").select(*names)


def ngram_join(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")
