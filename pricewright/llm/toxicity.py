"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from hashed
words; the document's is their noisy-or. Weights are trained from document
labels alone, and the sentence probabilities then tell where the offence is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import shielded
from .samples import labelled_sample
from .textbatch import LEADING, WORDLIKE, TextBatch, chunks

#: Labelled rows per class that the classifier learns from.
SAMPLE_PER_CLASS = 1500
BITS = 18
#: Words also count by their first so many bytes.
PREFIXES = (5, 7)
#: Only features this many standard errors apart between the labels are trained.
LEAST_Z = 4.5
ROUNDS = 150
FLAG_FROM = 0.7
SENTENCE_FROM = 0.5

_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True


class Sentences:
    """Word buckets of texts and the sentence of each; ``doc`` is the text of each sentence."""

    def __init__(self, texts: list[str]):
        self.batch = TextBatch([t.lower().encode() for t in texts], WORDLIKE)
        stops = np.concatenate([[0], np.cumsum(_STOPS[self.batch.data])])
        place, self.word_sentence = np.unique(stops[self.batch.begin], return_inverse=True)
        kinds = self.batch.word_hashes(PREFIXES) if len(place) else np.zeros((1 + len(PREFIXES), 0), dtype=np.uint64)
        kinds = kinds + np.arange(len(kinds), dtype=np.uint64)[:, None] * np.uint64(1 << 60)
        #: One row per kind of feature, one column per word.
        self.bucket = (kinds >> np.uint64(64 - BITS)).astype(np.int64)
        self.n = len(place)
        self.first_word = np.searchsorted(self.word_sentence, np.arange(self.n))
        self.doc = self.batch.doc[self.first_word]


def sentence_logits(s: Sentences, weights: np.ndarray, intercept: float) -> np.ndarray:
    return intercept + np.bincount(s.word_sentence, weights=weights[s.bucket].sum(axis=0), minlength=s.n)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def noisy_or(doc: np.ndarray, logits: np.ndarray, n_docs: int) -> np.ndarray:
    """1 - prod(1 - p) over the sentences of each document; 0 without sentences."""
    return -np.expm1(-np.bincount(doc, weights=_softplus(logits), minlength=n_docs))


def telling(bucket, doc, label) -> np.ndarray:
    """Which buckets are found in clearly unequal shares of the two labels' documents."""
    pairs = np.unique(bucket * len(label) + doc)
    bucket, toxic = pairs // len(label), label[pairs % len(label)] == 1
    with_toxic = np.bincount(bucket[toxic], minlength=1 << BITS)
    with_clean = np.bincount(bucket[~toxic], minlength=1 << BITS)
    n_toxic, n_clean = max(1, (label == 1).sum()), max(1, (label == 0).sum())
    share = (with_toxic + with_clean) / len(label)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n_toxic + 1 / n_clean))
    return np.abs(with_toxic / n_toxic - with_clean / n_clean) >= LEAST_Z * error


def train_noisy_or(bucket, sentence, doc, label, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch Adam on the cross-entropy of the noisy-or.

    ``bucket`` and ``sentence`` have one entry per feature of a word, ``doc``
    one per sentence, ``label`` one per document.
    """
    chosen = telling(bucket, doc[sentence], label)[bucket]
    bucket, sentence = bucket[chosen], sentence[chosen]
    seen, column = np.unique(bucket, return_inverse=True)
    w = np.zeros(len(seen) + 1)
    w[-1] = -4.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    n_sentences, n_docs = len(doc), len(label)
    for t in range(1, rounds + 1):
        z = w[-1] + np.bincount(sentence, weights=w[column], minlength=n_sentences)
        risk = np.bincount(doc, weights=_softplus(z), minlength=n_docs)
        # d loss / d risk: 1 for clean documents, -1 / (e^risk - 1) for toxic ones
        slope = np.where(label == 1, -1.0 / np.expm1(np.clip(risk, 1e-6, 50)), 1.0) / n_docs
        dz = slope[doc] / (1 + np.exp(-np.clip(z, -50, 50)))
        grad = np.empty_like(w)
        grad[:-1] = np.bincount(column, weights=dz[sentence], minlength=len(seen)) + 2e-5 * w[:-1]
        grad[-1] = dz.sum()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(1 << BITS)
    weights[seen] = w[:-1]
    return weights, float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple[np.ndarray, float]:
    """Train on at most ``per_class`` rows of either label.

    Words become numbers where the rows are; the bounded sample of numbers is
    trained in one task. Without rows of both labels every text scores 0.
    """
    def words(batches):
        for part in chunks(batches):
            s = Sentences(part["text"].tolist())
            ends = np.searchsorted(s.batch.doc, np.arange(len(part) + 1))
            yield pd.DataFrame({
                "label": part["label"].to_numpy(),
                "bucket": [s.bucket[:, a:b].ravel() for a, b in zip(ends, ends[1:])],
                "sentence": [
                    np.tile(s.word_sentence[a:b] - (s.word_sentence[a] if b > a else 0), len(s.bucket))
                    for a, b in zip(ends, ends[1:])]})

    def train(bags):
        bags = bags[bags["bucket"].str.len() > 0]
        counts = [int(s[-1]) + 1 for s in bags["sentence"]]
        if bags["label"].nunique() < 2:
            return pd.DataFrame({"weights": [np.zeros(1 << BITS)], "intercept": [-50.0]})
        shift = np.cumsum([0, *counts[:-1]])
        weights, intercept = train_noisy_or(
            np.concatenate(bags["bucket"].tolist()),
            np.concatenate([s + k for s, k in zip(bags["sentence"], shift)]),
            np.repeat(np.arange(len(bags)), counts), bags["label"].to_numpy())
        return pd.DataFrame({"weights": [weights], "intercept": [intercept]})

    bags = labelled_sample(docs, labels, "toxic", per_class).mapInPandas(
        words, "label int, bucket array<int>, sentence array<int>").withColumn("sample", F.lit(1))
    got = bags.groupBy("sample").applyInPandas(train, "weights array<double>, intercept double").first()
    if got is None:
        return np.zeros(1 << BITS), -50.0
    return np.array(got["weights"]), got["intercept"]


@shielded("_whole")
def with_toxicity(docs: DataFrame, model: tuple[np.ndarray, float], flag_from: float = FLAG_FROM) -> DataFrame:
    """All columns of ``docs`` plus score, predicted and offending.

    offending lists the sentences of a probability of at least a half: start
    and end (code points, from the first to the last word) and probability. A
    null or wordless text scores 0. Columns of these names are replaced.
    """
    made = T.StructType.fromDDL(
        "score double, predicted int, offending array<struct<start:long,end:long,probability:double>>")
    names = [c for c in docs.columns if c not in made.names]
    schema = T.StructType(docs.select(*names).schema.fields + made.fields)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, intercept = sent.value
        for batch in batches:
            for part in chunks([batch.assign(_whole=batch["text"].fillna(""))], "_whole"):
                texts = part["_whole"].tolist()
                s = Sentences(texts)
                z = sentence_logits(s, weights, intercept)
                score = np.clip(noisy_or(s.doc, z, len(texts)), 0.0, 1.0)
                spans: list[list] = [[] for _ in texts]
                found = np.flatnonzero(z >= np.log(SENTENCE_FROM / (1 - SENTENCE_FROM)))
                if len(found):
                    points = np.concatenate([[0], np.cumsum(LEADING[s.batch.data])])
                    last = np.append(s.first_word[1:], s.bucket.shape[1]) - 1
                    for k in found:
                        base = points[s.batch.starts[s.doc[k]]]
                        spans[s.doc[k]].append({
                            "start": int(points[s.batch.begin[s.first_word[k]]] - base),
                            "end": int(points[s.batch.end[last[k]]] - base),
                            "probability": float(1 / (1 + np.exp(-z[k])))})
                yield part.drop(columns="_whole").assign(
                    score=score, predicted=(score >= flag_from).astype("int32"), offending=spans)

    return docs.select(*names).mapInPandas(run, schema)


def in_test_fold(doc_id="doc_id"):
    """Rows that never teach: crc32 of the id as text, mod 3, is 1 (a null id counts as empty)."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 3 == 1


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, offending."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit_toxicity(docs, labels.where(~in_test_fold()))
    return with_toxicity(rows.withColumn("held_out", in_test_fold()), model).drop("text")
