"""The corpus pipeline, stage by stage."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402
from conftest import MEDIUM  # noqa: E402

import corpus_pipeline as cp  # noqa: E402
from pricewright.llm.common import stored  # noqa: E402


@pytest.fixture(scope="module")
def frames(spark):
    docs, out = spark.read.parquet(f"{MEDIUM}/documents.parquet"), []
    out.append(docs)
    for _, stage in cp.STAGES:
        out.append(stored(stage(spark, out[-1], MEDIUM), "test-stage"))
    return out


def test_columns(frames):
    for frame in frames[1:-1]:
        assert frame.columns == frames[0].columns and frame.schema == frames[0].schema


def test_languages(frames):
    assert frames[1].count() >= 0.98 * frames[0].where("text RLIKE '\\\\p{L}'").count()


def test_lines(frames):
    before = {r.doc_id: r.text for r in frames[1].collect()}
    seen = set()
    after = {r.doc_id: r for r in frames[2].collect()}
    for i in sorted(before):
        if i in after:
            assert after[i].n_chars == len(after[i].text)
            assert all(line in seen or not line for line in brute.lines_gone(before[i], after[i].text))
        seen.update(before[i].split("\n"))


def test_near_duplicates(frames):
    texts = {r.doc_id: r.text for r in frames[2].collect()}
    want = {i for i, c in brute.link_components(texts).items() if i == c}
    assert {r.doc_id for r in frames[3].collect()} == want


def test_mixing(frames):
    count = lambda df: {r.source: r.n for r in df.groupBy("source").agg(
        F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    want = brute.targets(count(frames[3]))
    for source, n in count(frames[4]).items():
        assert abs(n - want[source]) <= 1


def test_encoding(frames):
    library = Tokenizer.from_file(cp.VOCABULARY)
    texts = sorted((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in frames[4].collect())
    assert sorted((r.doc_id, tuple(r.token_ids)) for r in frames[5].collect()) == texts


def test_empty_and_null(spark, frames):
    docs = frames[0]
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "some words of text", None, "s", 18),
         (2, "some words of text", None, "s", 18)], docs.schema)
    for rows in (docs.limit(0), odd):
        for _, stage in cp.STAGES:
            rows = stored(stage(spark, rows, MEDIUM), "odd-stage")
        assert rows.count() >= 0
