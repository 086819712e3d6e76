"""Quality rules: exact base counts, and a calibrated n-gram classifier.

Hashed word and character n-grams feed a logistic regression that learns from
labelled quality rows; a part of those rows calibrates its margin to a
probability. Whole texts are scored in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from .common import shielded
from .samples import labelled_sample
from .textbatch import LEADING, SPACE, TextBatch, char_grams, chunks, per_text, window_hashes

#: Labelled rows per class that the classifier learns from.
SAMPLE_PER_CLASS = 1500
BUCKETS = 2048
KINDS = ("word", "pair", "gram")
KEEP_FROM = 0.5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def _features(texts: list[str], batch: TextBatch):
    """For each kind of n-gram: (bucket of each, first index of each text)."""
    words = batch.word_hashes()
    shift = np.uint64(64 - 11)
    yield (words >> shift).astype(np.int64), batch.first
    pairs = window_hashes(words, 2)
    inside = batch.doc[:-1] == batch.doc[1:] if len(words) > 1 else np.zeros(0, dtype=bool)
    first = np.concatenate([[0], np.cumsum(np.maximum(np.diff(batch.first) - 1, 0))])
    yield (pairs[inside] >> shift).astype(np.int64), first
    yield char_grams(texts, 4, BUCKETS)


def _repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    seen: dict[tuple, int] = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered, until = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + 5 - max(i, until)
            until = i + 5
    return covered


def _duplicate_lines(text: bytes) -> int:
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip():
            if line in seen:
                n += 1
            else:
                seen.add(line)
    return n


def base_counts(texts: list[bytes], batch: TextBatch) -> pd.DataFrame:
    """The exact counts of the rules; a 64-bit hash only finds the texts whose
    windows have to be compared word by word."""
    n_words = np.diff(batch.first)
    visible = LEADING & ~SPACE
    windows = window_hashes(batch.word_hashes(), 5)
    doc = batch.doc[: len(windows)]
    inside = doc == batch.doc[4:] if len(windows) else np.zeros(0, dtype=bool)
    windows, doc = windows[inside], doc[inside]
    order = np.lexsort((windows, doc))
    same = (windows[order][1:] == windows[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    repeats = np.zeros(len(texts), dtype=np.int64)
    for i in np.unique(doc[order][1:][same]):
        repeats[i] = _repeated_words(texts[i].split())
    return pd.DataFrame({
        "n_words": n_words,
        "word_chars": batch.sums(visible[batch.data]),
        "n_symbols": batch.sums(_SYMBOLS[batch.data]),
        "n_dup_lines": [_duplicate_lines(t) if b"\n" in t else 0 for t in texts],
        "n_repeat_words": repeats,
    })


class QualityModel:
    """Weights per bucket, intercept, and the two numbers of the calibration."""

    def __init__(self, weights: np.ndarray, intercept: float, slope: float, shift: float):
        self.weights, self.intercept, self.slope, self.shift = weights, intercept, slope, shift

    def margin(self, texts: list[str], batch: TextBatch) -> np.ndarray:
        out = np.full(len(texts), self.intercept)
        for k, (found, first) in enumerate(_features(texts, batch)):
            weights = self.weights[k * BUCKETS : (k + 1) * BUCKETS]
            out += per_text(weights[found], first) / np.maximum(np.diff(first), 1)
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def _vectors(sample: DataFrame) -> DataFrame:
    """(doc_id, label, features): relative frequencies of all buckets."""
    def run(batches):
        for part in chunks(batches):
            texts = part["text"].tolist()
            batch = TextBatch([t.encode() for t in texts])
            tables = []
            for found, first in _features(texts, batch):
                doc = np.repeat(np.arange(len(texts)), np.diff(first))
                got = np.bincount(doc * BUCKETS + found, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
                tables.append(got / np.maximum(np.diff(first), 1)[:, None])
            table = np.hstack(tables)
            at = [np.flatnonzero(row) for row in table]
            yield pd.DataFrame({
                "doc_id": part["doc_id"].to_numpy(), "label": part["label"].to_numpy(),
                "at": at, "value": [row[i] for row, i in zip(table, at)]})

    rows = sample.mapInPandas(run, "doc_id long, label int, at array<int>, value array<double>")
    to_vector = F.udf(lambda at, value: Vectors.sparse(len(KINDS) * BUCKETS, at, value), VectorUDT())
    return rows.select("doc_id", F.col("label").cast("double").alias("label"), to_vector("at", "value").alias("features"))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> QualityModel:
    """Three quarters of the sample fit the regression, the last calibrates it.

    Calibration rows are weighted to the class shares of all labels; where the
    first part lacks a class, all rows fit and none calibrate. Without
    rows of both classes the probability is the share of good labels (1 without
    labels).
    """
    rows = _vectors(labelled_sample(docs, labels, "quality", per_class)).persist()
    shares = {r["quality"]: r["count"] for r in labels.where("quality IN (0, 1)").groupBy("quality").count().collect()}
    seen = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    size = len(KINDS) * BUCKETS
    if len(seen) < 2:
        good = shares.get(1, 0) / max(1, sum(shares.values())) if shares else 1.0
        rows.unpersist()
        return QualityModel(np.zeros(size), 0.0, 0.0, float(np.log((good + 1e-9) / (1 - good + 1e-9))))
    calibrates = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(4)) == 0
    if rows.where(~calibrates).select("label").distinct().count() < 2:
        calibrates = F.lit(False)       # too few rows to spare any
    fit = LogisticRegression(maxIter=40, regParam=0.02, elasticNetParam=0.0).fit(rows.where(~calibrates))
    margin = F.udf(lambda v: float(v[1]), "double")
    held = fit.transform(rows.where(calibrates)).select(
        "label", margin("rawPrediction").alias("margin"),
        F.when(F.col("label") == 1, shares[1] / seen[1]).otherwise(shares[0] / seen[0]).alias("weight"))
    held = VectorAssembler(inputCols=["margin"], outputCol="features").transform(held)
    slope, shift = 1.0, 0.0
    if held.select("label").distinct().count() == 2:
        platt = LogisticRegression(maxIter=50, regParam=1e-3, weightCol="weight").fit(held)
        slope, shift = float(platt.coefficients[0]), float(platt.intercept)
    rows.unpersist()
    return QualityModel(fit.coefficients.toArray(), float(fit.intercept), slope, shift)


@shielded("_whole")
def with_quality(docs: DataFrame, model: QualityModel, keep_from: float = KEEP_FROM) -> DataFrame:
    """All columns of ``docs`` plus the base counts, base_failed, quality and kept.

    A null text has no words and fails. kept is base_failed = false and a
    quality of at least ``keep_from``. Columns of these names are replaced.
    """
    made = T.StructType.fromDDL(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, quality double, kept boolean")
    names = [c for c in docs.columns if c not in made.names]
    schema = T.StructType(docs.select(*names).schema.fields + made.fields)
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))     # plain arrays: workers need no package

    def run(batches):
        model = QualityModel(**sent.value)
        for batch in batches:
            for part in chunks([batch.assign(_whole=batch["text"].fillna(""))], "_whole"):
                texts = part["_whole"].tolist()
                data = [t.encode() for t in texts]
                words = TextBatch(data)
                out = base_counts(data, words)
                out["base_failed"] = (out["n_words"] < MIN_WORDS) | (
                    100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * out["n_words"])
                out["quality"] = model.probability(model.margin(texts, words))
                out["kept"] = ~out["base_failed"] & (out["quality"] >= keep_from)
                out.index = part.index
                yield pd.concat([part.drop(columns="_whole"), out], axis=1)

    return docs.select(*names).mapInPandas(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, base counts, base_failed, quality, kept."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_quality(rows, fit_quality(docs, labels)).drop("text")
