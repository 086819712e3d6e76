"""Byte-pair encoding and decoding with a public vocabulary file.

Each task gathers the distinct words of many documents and merges all of them
together: an index maps every pair to all its positions, the active ranks are
taken in ascending order, all positions of a rank are merged at once, and only
the lists of the neighbouring pairs change. Results equal those of the
``tokenizers`` library for files of this kind (byte-level symbols, a suffix at
the end of a word, added tokens matched in the raw text).
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import text_or_empty

#: Code points of text that are merged together, and distinct parts of words remembered, per task.
CHUNK_CHARS = 3_000_000
KEPT_PARTS = 300_000
#: Tokens in a frame that goes back to Spark.
FRAME_TOKENS = 200_000

# Fixed values of the file format: how bytes are written as characters, and the
# pattern that splits normalised text.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+


#: Texts below this character, whose lower case lies below it too, are split by plain character classes.
_LATIN_END = 0x180


def _latin_split() -> re.Pattern:
    """The same pattern over the Latin letters, with its classes written out."""
    latin = [chr(i) for i in range(_LATIN_END)]
    kinds = [unicodedata.category(c) for c in latin]
    letters = "".join(re.escape(c) for c, k in zip(latin, kinds) if k[0] == "L")
    numbers = "".join(re.escape(c) for c, k in zip(latin, kinds) if k[0] == "N")
    space = "\\x09-\\x0d\\x20\\x85\\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")


def _byte_chars() -> list[str]:
    rest = [b for b in range(256) if b not in set(_PRINTABLE)]
    chars = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [chars[b] for b in range(256)]


class Vocabulary:
    """Ids, merges and added tokens of a tokenizer file; a few MB, sent to tasks once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.frame = json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}})
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (ids | self.added).items()}
        chars = _byte_chars()
        self.inner = np.array([ids[c] for c in chars], dtype=np.int64)
        self.last = np.array([ids[c + suffix] for c in chars], dtype=np.int64)
        self.width = max(self.tokens) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([ids[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        keys = self.left * self.width + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for pairs that never merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)


def merge_words(words: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """Token ids of non-empty byte strings, merged together through a pair index."""
    if not words:
        return []
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    sym = vocab.inner[data].astype(np.int32)
    sym[ends - 1] = vocab.last[data[ends - 1]]
    after = np.arange(1, len(sym) + 1, dtype=np.int32)
    after[ends - 1] = -1
    before = np.arange(-1, len(sym) - 1, dtype=np.int32)
    before[0] = -1
    before[ends[:-1]] = -1

    here = np.flatnonzero(after >= 0)
    rank = vocab.ranks(sym[here], sym[here + 1])
    here, rank = here[rank >= 0], rank[rank >= 0]
    order = np.argsort(rank, kind="stable")
    active, begin = np.unique(rank[order], return_index=True)
    index = dict(zip(active.tolist(), map(np.ndarray.tolist, np.split(here[order], begin[1:])))) if len(active) else {}
    heap = list(index)
    heapify(heap)
    while heap:
        r = heappop(heap)
        a, b = vocab.left[r], vocab.right[r]
        at = np.unique(np.array(index.pop(r), dtype=np.int64))
        at = at[sym[at] == a]
        to = after[at]
        at, to = at[to >= 0], to[to >= 0]
        fits = sym[to] == b
        at, to = at[fits], to[fits]
        if a == b and len(at) > 1:      # in a run of one symbol the leftmost pairs go first
            keep, used = [], -1
            for i, (p, q) in enumerate(zip(at.tolist(), to.tolist())):
                if p != used:
                    keep.append(i)
                    used = q
            at, to = at[keep], to[keep]
        if not len(at):
            continue
        sym[at], sym[to] = vocab.made[r], -1
        follow = after[to]
        after[at] = follow
        inside = follow >= 0
        before[follow[inside]] = at[inside]
        previous = before[at]
        changed = np.concatenate([previous[previous >= 0], at[inside]])
        new = vocab.ranks(sym[changed], sym[after[changed]])
        for rank_, p in zip(new.tolist(), changed.tolist()):
            if rank_ < 0:
                continue
            if rank_ in index:
                index[rank_].append(p)
            else:
                index[rank_] = [p]
                heappush(heap, rank_)
    alive = sym >= 0
    cut = np.cumsum(alive)[ends - 1]
    ids = sym[alive].tolist()
    return [ids[i:j] for i, j in zip([0, *cut[:-1].tolist()], cut.tolist())]


class Encoder:
    """Encodes documents chunk by chunk and remembers a bounded number of word parts."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.known: dict[str, tuple[int, str, str]] = {}
        self.split = _latin_split()
        self.library = Tokenizer.from_str(vocab.frame)     # no vocabulary: splits words only
        self.byte_of = {c: b for b, c in enumerate(_byte_chars())}
        added = "|".join(map(re.escape, sorted(vocab.added, key=len, reverse=True)))
        self.added = re.compile(f"({added})") if added else None

    def _parts(self, text: str) -> list[str]:
        """Normalised parts of a plain text.

        Beyond the Latin letters, where versions of Unicode differ in what is a
        letter or has a lower case, the library's own normaliser splits the words.
        """
        if text.isascii():
            return self.split.findall(text.lower())
        if max(text) < chr(_LATIN_END):
            return self.split.findall("".join(map(str.lower, unicodedata.normalize("NFC", text))))
        found = []
        for word in re.split(r"[\x20\x09-\x0D]+", text):
            if not word:
                continue
            if max(word) < chr(_LATIN_END):
                found.extend(self._parts(word))
            else:
                parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(word))
                found.extend(bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in parts)
        return found

    def split_text(self, text: str) -> list[list[str] | str]:
        """Lists of parts, and added tokens as they are, in turn."""
        if self.added is None or "<|" not in text:
            return [self._parts(text)]
        return [piece if i % 2 else self._parts(piece) for i, piece in enumerate(self.added.split(text))]

    def learn(self, texts: list[str]) -> None:
        self.learn_split([self.split_text(t) for t in texts])

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, ids joined by spaces, decoded text, of a learned text."""
        return self.encode_split(self.split_text(text))

    def learn_split(self, texts: list[list[list[str] | str]]) -> None:
        """Encode the parts of these split texts that are not known yet."""
        seen: set[str] = set()
        for pieces in texts:
            for parts in pieces[::2]:
                seen.update(parts)
        if len(self.known) + len(seen) > KEPT_PARTS:
            self.known = {p: self.known[p] for p in seen if p in self.known}
        fresh = [p for p in seen if p not in self.known]
        del seen
        name = self.vocab.tokens
        for begin in range(0, len(fresh), KEPT_PARTS):
            some = fresh[begin : begin + KEPT_PARTS]
            for p, i in zip(some, merge_words([p.encode() for p in some], self.vocab)):
                self.known[p] = (len(i), " ".join(map(str, i)), " ".join([name[x] for x in i]))

    def encode_split(self, pieces: list[list[str] | str]) -> tuple[int, str, str]:
        known, found = self.known, []
        for i, piece in enumerate(pieces):
            if i % 2:
                found.append((1, str(self.vocab.added[piece]), piece))
            else:
                found.extend([known[p] for p in piece])
        return (
            sum([n for n, _, _ in found]), " ".join([i for _, i, _ in found]),
            " ".join([t for _, _, t in found]))


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, chars = [], [], 0
    for batch in batches:
        for i, text in zip(batch["rid"], batch["text"]):
            ids.append(i)
            texts.append(text)
            chars += len(text)
            if chars >= CHUNK_CHARS:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


def _frame(ids: list, made: list[tuple[int, str, str]], keep_ids: bool) -> pd.DataFrame:
    out = {
        "rid": ids,
        "n_tokens": [n for n, _, _ in made],
        "ids_sha256": [hashlib.sha256(i.encode()).hexdigest() for _, i, _ in made],
        "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for _, _, t in made],
    }
    if keep_ids:
        out["token_ids"] = [np.array(i.split(), dtype=np.int32) for _, i, _ in made]
    return pd.DataFrame(out)


def bpe_round_trip(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    With ``keep_ids`` also token_ids (array<int>). Null texts count
    as empty: no tokens, digests of the empty string. Null and repeated ids are
    carried as they are; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(Vocabulary(path)))    # plain data: workers need no package
    extra = ", token_ids array<int>" if keep_ids else ""

    def run(batches):
        vocab = Vocabulary.__new__(Vocabulary)
        vars(vocab).update(sent.value)
        encoder = Encoder(vocab)
        for ids, texts in _chunks(batches):
            pieces = [encoder.split_text(t) for t in texts]
            encoder.learn_split(pieces)
            begin, n, made = 0, 0, []
            for k, document in enumerate(pieces):
                pieces[k] = None
                made.append(encoder.encode_split(document))
                n += made[-1][0]
                if n >= FRAME_TOKENS or len(made) == 1000 or k + 1 == len(pieces):
                    yield _frame(ids[begin : k + 1], made, keep_ids)
                    begin, n, made = k + 1, 0, []

    rows = docs.select(F.col("doc_id").cast("string").alias("rid"), text_or_empty().alias("text"))
    out = rows.mapInPandas(
        run, f"rid string, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}")
    return out.withColumn("doc_id", F.col("rid").cast("long")).select("doc_id", *[c for c in out.columns if c != "rid"])
