"""Vectorised words, word hashes and character n-grams of a batch of texts.

Used inside Arrow-batched tasks. Hashes depend on the word alone, so they are
equal in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

#: Code points handled at once in a task; a longer text is handled alone.
CHUNK_CHARS = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Letters, digits and all bytes of characters beyond ASCII.
WORDLIKE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
#: Bytes that begin a character.
LEADING = np.array([(c & 0xC0) != 0x80 for c in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class TextBatch:
    """Texts joined by line breaks, with the place of each word.

    ``begin``/``end`` are byte offsets of words, ``doc`` the number of the text
    of each word, ``first`` the index of each text's first word (one more at
    the end).
    """

    def __init__(self, texts: list[bytes], letters: np.ndarray | None = None):
        self.n = len(texts)
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=self.n)
        self.ends = np.cumsum(lengths + 1)          # behind the separator
        self.starts = self.ends - lengths - 1
        inside = letters[self.data] if letters is not None else ~SPACE[self.data]
        step = np.diff(inside.view(np.int8), prepend=np.int8(0))
        self.begin = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.doc = np.searchsorted(self.ends, self.begin, side="right")
        self.first = np.searchsorted(self.doc, np.arange(self.n + 1))

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum of a value per byte for each text."""
        total = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
        return total[self.ends - 1] - total[self.starts]

    def word_hashes(self, prefixes: tuple[int, ...] = ()) -> np.ndarray:
        """64-bit hashes of the words, from one running sum over all bytes.

        With ``prefixes``, one row of hashes for the words and one for their
        first so many bytes each.
        """
        n = len(self.data)
        powers = np.full(n, _BASE, dtype=np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        total = np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)
        inverse = np.full(n, _INVERSE, dtype=np.uint64)
        inverse[0] = 1
        np.cumprod(inverse, out=inverse)
        before = np.where(self.begin > 0, total[self.begin - 1], np.uint64(0))
        inverse = inverse[self.begin]
        out = []
        for longest in (n, *prefixes):
            end = np.minimum(self.end, self.begin + longest)
            out.append(mix((total[end - 1] - before) * inverse + (end - self.begin).astype(np.uint64)))
        return np.vstack(out) if prefixes else out[0]


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; run i begins at word i."""
    out = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for k in range(n):
        out = mix(out + words[k : k + len(out)] * np.uint64(2 * k + 3))
    return out


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive values for each text, given the first index of each."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def char_grams(texts: list[str], n: int, buckets: int, letters: np.ndarray | None = None):
    """(bucket of each n-gram, index of the first n-gram of each text).

    A text is padded at its end, so it has as many n-grams as code points.
    With ``letters`` (a table over the first 65,536 code points) all other
    characters count as blanks.
    """
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    pad = "\n" * (n - 1)
    points = np.frombuffer((pad.join(texts) + pad).encode("utf-32-le"), dtype=np.uint32)
    if letters is not None:
        keep = letters[np.minimum(points, 65535)] & (points < 65535)
        points = np.where(keep, points, np.uint32(32))
    grams = np.zeros(len(points) - n + 1, dtype=np.uint64)
    for k in range(n):
        grams = grams * np.uint64(0x100000001B3) + points[k : k + len(grams)]
    shift = np.uint64(64 - (buckets - 1).bit_length())
    found = ((grams * np.uint64(_BASE)) >> shift).astype(np.int64)
    begins = np.cumsum(lengths + n - 1) - (lengths + n - 1)
    owner = np.zeros(len(points) + 1, dtype=np.int8)
    np.add.at(owner, begins, 1)
    np.add.at(owner, begins + lengths, -1)
    inside = np.cumsum(owner[: len(found)]) > 0
    return found[inside], np.concatenate([[0], np.cumsum(lengths)])


def chunks(batches: Iterator[pd.DataFrame], text: str = "text", chars: int = CHUNK_CHARS) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into frames of bounded text."""
    for batch in batches:
        if not len(batch):
            continue
        total = np.cumsum(batch[text].str.len().to_numpy())
        part = total // chars
        for begin, end in _runs(part):
            yield batch.iloc[begin:end]


def _runs(part: np.ndarray) -> list[tuple[int, int]]:
    cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return list(zip(cut, cut[1:]))
