"""Periodic runs, the filter audit and the fingerprint join against brute force and SQL."""

import random
import sys
from itertools import permutations
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402
from conftest import MEDIUM, SMALL  # noqa: E402
from oracle import compare, connect  # noqa: E402
from test_operators import EDGE, docs, edge, edge_labels, empty, texts  # noqa: E402, F401

from pricewright.llm import filter_audit, periodic_runs, simhash_join  # noqa: E402
from pricewright.llm.registry import QUERIES, SQL  # noqa: E402


def test_filter_audit_equals_sql(spark):
    assert compare(QUERIES["op12_filter_audit"](spark, MEDIUM), connect(MEDIUM), SQL["op12_filter_audit"]) == []


def test_gallop_merges():
    rng = random.Random(12)
    for _ in range(300):
        lists = [np.array(sorted(rng.sample(range(200), rng.choice((0, 1, 3, 40, 150))))) for _ in range(rng.randrange(5))]
        lists = [x.astype(np.int64) for x in lists]
        want = sorted(set().union(*map(set, lists)))
        assert filter_audit.gallop_union(lists).tolist() == want
        if len(lists) > 1:
            assert filter_audit.gallop_difference(lists[0], lists[1]).tolist() == sorted(set(lists[0]) - set(lists[1]))


def test_filter_audit_edges(spark, edge, empty, edge_labels):
    out = filter_audit.filter_audit(edge, edge_labels).collect()
    want = brute.filter_audit([tuple(r) for r in edge.select("doc_id", "text", "lang").collect()],
                              [tuple(r) for r in edge_labels.collect()])
    assert {tuple(r[c] for c in brute.AUDIT) for r in out} == want and len(out) == len(want)
    assert filter_audit.filter_audit(empty, edge_labels).count() == 0
    assert filter_audit.filter_audit(edge, edge_labels.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_filter_audit_random(spark):
    """Repeated ids and texts, ids missing, many ranges."""
    rng = random.Random(2)
    rows = [(rng.choice((None, *range(60))), " ".join(rng.choice(("A", "bb", "c#", "DD")) for _ in range(rng.choice((0, 1, 4, 120)))),
             rng.choice(("x", "y", None))) for _ in range(150)]
    labels = [(rng.randrange(60), rng.choice((0, 1, None)), rng.choice((0, 1, None))) for _ in range(50)]
    out = filter_audit.filter_audit(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert {tuple(r[c] for c in brute.AUDIT) for r in out} == brute.filter_audit(rows, labels)


def test_simhash_equals_brute_force(docs, texts):
    got = {r.doc_id: r for r in QUERIES["op13_simhash"](docs.sparkSession, MEDIUM).collect()}
    prints = {i: brute.fingerprint(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{v:016x}" for i, v in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == brute.near_components(prints)


@pytest.mark.parametrize("node_rows", [2, 40, 50_000])
def test_trie_join_equals_brute_force(spark, node_rows):
    """Crowded subcubes, chains over all bits and the highest bit; nodes cut down to pairs."""
    rng = random.Random(node_rows)
    some = [rng.getrandbits(64) for _ in range(120)]
    some += [some[0] ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 3, 4)))) for _ in range(60)]
    some += [some[1] ^ rng.getrandbits(7) << 30 for _ in range(60)]
    for k in range(20):
        some.append(some[-1] ^ (1 << rng.randrange(64)) ^ (1 << 63))
    prints = dict(enumerate(some))
    points = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in set(some)], "fingerprint long")
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash_join.fingerprint_links(points, node_rows).collect()]
    assert all(a != b and (a ^ b).bit_count() <= 2 for a, b in links)
    parent = {v: v for v in some}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        parent[find(a)] = find(b)
    want = brute.near_components(prints)
    assert len({find(v) for v in some}) == len(set(want.values()))
    assert all((find(some[i]) == find(some[j])) == (want[i] == want[j]) for i in prints for j in prints)


def test_simhash_edges(spark, edge, empty):
    out = simhash_join.simhash_groups(edge).collect()
    rows = edge.select("doc_id", "text").collect()
    assert sorted((r.doc_id or -1, int(r.fingerprint, 16)) for r in out) == sorted(
        (r.doc_id or -1, brute.fingerprint(r.text)) for r in rows)
    assert {r.component_id for r in out if int(r.fingerprint, 16) == 0} == {1}
    assert {r.component_id for r in out if r.doc_id in (4, 5)} == {4}
    lone = spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string")
    assert [r.component_id for r in simhash_join.simhash_groups(lone).collect()] == [None, None]
    assert simhash_join.simhash_groups(empty).count() == 0


RUN_COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_periodic_runs_equal_brute_force(spark, docs, texts):
    short = docs.where("length(text) < 6000")
    got = {r.doc_id: tuple(r[c] for c in RUN_COLUMNS) for r in periodic_runs.periodic_runs(short).collect()}
    for i, row in got.items():
        assert row == brute.run_row(brute.periodic_words(i, texts[i])), i
    assert sum(row[0] > 0 for row in got.values()) > 0.05 * len(got)
    assert QUERIES["op11_periodic_runs"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def _lyndon(v):
    """By the definition: the longest prefix of each suffix that is smaller than all its own suffixes."""
    n = len(v)
    return [max(k for k in range(1, n - i + 1) if all(v[i : i + k] < v[j : i + k] for j in range(i + 1, i + k))) for i in range(n)]


def test_lyndon_array():
    rng = random.Random(9)
    for _ in range(1500):
        v = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randrange(1, 28))]
        ranks = np.unique(v, return_inverse=True)[1]
        assert periodic_runs.lyndon_array(ranks).tolist() == _lyndon(v)
        high = ranks.max() - ranks
        assert periodic_runs.lyndon_array(high).tolist() == _lyndon(high.tolist())


def test_runs_of_random_words():
    """All runs of two periods and more, of random, periodic and Fibonacci words."""
    rng = random.Random(10)
    words = [[rng.randrange(rng.choice((1, 2, 2, 3))) for _ in range(rng.randrange(1, 90))] for _ in range(600)]
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    words += [b, [0] * 50, [0, 0, 1] * 30 + [0] * 9, ([0, 1] * 5 + [2]) * 7]
    for v in words:
        ranks = np.unique(v, return_inverse=True)[1]
        assert periodic_runs.find_runs(ranks, 2, 2) == brute.runs(v, 2, 2)
        assert periodic_runs.find_runs(ranks) == brute.runs(v)


def test_candidates_cover_all_runs(spark):
    """Runs of every period between ordinary words, many to a document, at its ends, next to each other."""
    rng = random.Random(20)
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(1, 6)):
            words += [f"w{rng.randrange(400)}" for _ in range(rng.choice((0, 3, 40)))]
            root = [rng.choice("abcd") for _ in range(rng.choice((1, 2, 3, 4, 5, 6, 9, 10, 11, 40)))]
            words += (root * 9)[: rng.randrange(3 * len(root), 8 * len(root))]
        rows.append((i, rng.choice((" ", "\n", " \t ")).join(words)))
    out = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    texts = dict(rows)
    assert len(out) == len(rows)
    for r in out:
        assert tuple(r[c] for c in RUN_COLUMNS) == brute.run_row(brute.periodic_words(r.doc_id, texts[r.doc_id]))


def test_periodic_runs_edges(edge, empty):
    out = periodic_runs.periodic_runs(edge).collect()
    rows = edge.select("doc_id", "text").collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    want = [(r.doc_id, *brute.run_row(brute.periodic_words(r.doc_id, r.text))) for r in rows if r.doc_id != 7]
    assert sorted((tuple(r) for r in out if r.doc_id != 7), key=key) == sorted(want, key=key)
    assert [(r.n_runs, r.start, r.period) for r in out if r.doc_id == 7] == [(1, 0, 10)]
    assert periodic_runs.periodic_runs(empty).count() == 0
