"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction
from itertools import permutations

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def shingles(text: str | None) -> frozenset:
    words = WORD.findall(lower(text or ""))
    if len(words) >= 5:
        return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def link_components(texts: dict[int, str | None]) -> dict[int, int]:
    """Smallest id reachable by similarities of 0.8 or more."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def base_counts(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places: dict[tuple, list[int]] = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {k for at in places.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered))


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    text = text or ""
    return sorted(
        [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
        + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
        + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16])


def targets(sizes: dict, share=1.5, most=2.0, weights=(5, 2, 1)) -> dict:
    """Weighted shares, cut at twice the size, the excess shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        rest = total - sum(out.values())
        level = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
    return out


def lines_gone(before: str, after: str) -> Counter:
    return Counter(before.split("\n")) - Counter(after.split("\n"))


def _normal_two_sided(z: float) -> float:
    return max(math.erfc(abs(z) / math.sqrt(2)), 1e-15)


def randomness(token: str, alphabet: str) -> float:
    """Combined p-value of the chi-squared, runs and serial tests."""
    v = [alphabet.index(c) + 1 for c in token]
    n, k = len(v), len(alphabet)
    chi = sum((v.count(s) - n / k) ** 2 / (n / k) for s in range(1, k + 1))
    p1 = _normal_two_sided((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    high = [x > k / 2 for x in v]
    n1, runs = sum(high), 1 + sum(a != b for a, b in zip(high, high[1:]))
    expected = 2 * n1 * (n - n1) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p2 = _normal_two_sided((runs - expected) / math.sqrt(variance) if variance > 0 else 9)
    mean = sum(v) / n
    power = sum((x - mean) ** 2 for x in v)
    lag = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:]))
    p3 = _normal_two_sided((lag / power + 1 / n) * math.sqrt(n) if power > 0 else 9)
    equal = sum(c * (c - 1) // 2 for c in Counter(zip(v, v[1:])).values())
    likely = (n - 1) * (n - 2) / 2 / k**2
    if equal > likely:
        chance = math.exp(equal - likely + equal * math.log(likely / equal))
        p3 = max(chance, 1e-15) if chance < 0.001 else p3
    x = -2 * (math.log(p1) + math.log(p2) + math.log(p3))
    return math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_audit(docs: list[tuple], labels: list[tuple]) -> set[tuple]:
    """All rows of the audit, by running every order over (doc_id, text, lang) rows."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    first: dict[str, int] = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts: dict[str, list] = {}
    for i, t, lang in docs:
        t = t or ""
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and first[t] < i}
        parts.setdefault(lang or "", []).append((i, {f for f, v in fails.items() if v}))
    out = []
    for part, rows in parts.items():
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out.append([
                    part, "".join(order), step, len(left), len(gone),
                    sum(f in r[1] for r in rows) - len(gone), sum(r[1] == {f} for r in rows),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)])
    total = Counter()
    for r in out:
        total[r[0], r[1][r[2] - 1]] += r[4]
    return {(*r, total[r[0], r[1][r[2] - 1]]) for r in out}


def fingerprint(text: str | None) -> int:
    words = WORD.findall(lower(text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def near_components(prints: dict[int, int], budget: int = 2) -> dict[int, int]:
    """Smallest id reachable by fingerprints with few differing bits."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= budget:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


def periodic_words(doc_id: int | None, text: str | None) -> list[str]:
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def runs(words: list, least: int = 6, repeats: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) by trying every period."""
    found: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, repeats * q):
                found.setdefault((start, length), q)       # the smallest period of a stretch is met first
    return sorted((s, length, q) for (s, length), q in found.items())


def run_row(words: list[str]) -> tuple:
    found = runs(words)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())
