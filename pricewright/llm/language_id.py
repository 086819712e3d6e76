"""Language identification by multilingual mixture inference.

Each language is a distribution over hashed character trigrams, counted over
all labelled training rows. A document is a mixture of languages: expectation
maximisation estimates its proportions, and the set of languages is the one of
the largest likelihood less a penalty per language. The main language of that
set is the prediction.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from .common import shielded
from .textbatch import char_grams, chunks

BUCKETS = 4096
GRAM = 3
ROUNDS = 12
#: Trigrams overlap, so their likelihood counts as a third.
OVERLAP = 3.0
#: A further language has to explain this many log-units per parameter, beyond log(n) / 2.
PENALTY = 10.0
DOCS_AT_ONCE = 256


def letter_table() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(65536)])


def _counts(texts: list[str], letters: np.ndarray) -> np.ndarray:
    """Trigram counts, one row per text; runs of blanks do not count."""
    found, first = char_grams([t.lower() for t in texts], GRAM, BUCKETS, letters)
    blank = int(char_grams([" "], GRAM, BUCKETS, letters)[0][0])
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    out = np.bincount(doc * BUCKETS + found, minlength=len(texts) * BUCKETS)
    out = out.reshape(len(texts), BUCKETS).astype(np.float32)
    out[:, blank] = 0
    return out


def in_test_fold(doc_id="doc_id"):
    """Rows that never teach: crc32 of the id as text, mod 4, is 2 (a null id counts as empty)."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 4 == 2


def fit_languages(train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log-probabilities of trigrams, log-share of each) from columns text, lang.

    Counts over all rows, summed per task and then per language: the driver
    gets one row per language and bucket.
    """
    def count(batches):
        letters, sums, docs = letter_table(), {}, {}
        for part in chunks(batches):
            for lang, texts in part.groupby("lang")["text"]:
                texts = texts.tolist()
                for i in range(0, len(texts), DOCS_AT_ONCE):
                    got = _counts(texts[i : i + DOCS_AT_ONCE], letters).sum(axis=0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + got
                docs[lang] = docs.get(lang, 0) + len(texts)
        for lang, got in sums.items():
            at = np.flatnonzero(got)
            yield pd.DataFrame({"lang": lang, "bucket": np.r_[at, -1], "n": np.r_[got[at], docs[lang]].astype(np.int64)})

    rows = train.select("lang", "text").mapInPandas(count, "lang string, bucket int, n long")
    got = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    table, docs = np.full((len(langs), BUCKETS), 0.5), np.ones(len(langs))
    for k, lang in enumerate(langs):
        mine = got[got["lang"] == lang]
        grams = mine[mine["bucket"] >= 0]
        table[k, grams["bucket"]] += grams["n"]
        docs[k] = mine.loc[mine["bucket"] < 0, "n"].sum()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)) if langs else table, np.log(docs / docs.sum()) if langs else docs


def infer_mixture(counts: np.ndarray, logp: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, confidence) for rows of trigram counts.

    Proportions are zero outside the chosen set of languages. Confidence is the
    posterior of the language where one is chosen, else its proportion.
    """
    n_docs, n_langs = len(counts), len(logp)
    p = np.exp(logp).astype(np.float32)
    total = np.maximum(counts.sum(axis=1), 1.0)
    alone = (counts @ logp.T.astype(np.float32)).astype(np.float64)
    best = np.argmax(alone / OVERLAP + prior, axis=1)
    rows = np.arange(n_docs)

    def improve(theta, rounds):
        for _ in range(rounds):
            theta = theta * ((counts / (theta @ p)) @ p.T) / total[:, None]
            theta = np.maximum(theta, 1e-9).astype(np.float32)
            theta /= theta.sum(axis=1, keepdims=True)
        return theta

    free = improve(np.full((n_docs, n_langs), 1.0 / n_langs, dtype=np.float32), ROUNDS)
    order = np.argsort(-free, axis=1)
    theta = np.zeros((n_docs, n_langs))
    theta[rows, best] = 1.0
    score = (alone[rows, best]) / OVERLAP
    step = np.log(total + 1) / 2 + PENALTY
    for k in range(2, n_langs + 1):
        allowed = np.zeros((n_docs, n_langs), dtype=np.float32)
        allowed[rows[:, None], order[:, :k]] = 1.0
        some = free * allowed
        some /= some.sum(axis=1, keepdims=True)
        some = improve(some, 2) if k < n_langs else free
        fit = np.einsum("ij,ij->i", counts, np.log(some @ p), dtype=np.float64) / OVERLAP
        value = fit - step * (k - 1)
        better = value > score
        theta[better], score[better] = some[better], value[better]
    odds = alone / OVERLAP + prior
    odds = np.exp(odds - odds.max(axis=1, keepdims=True))
    odds /= odds.sum(axis=1, keepdims=True)
    main = np.argmax(theta, axis=1)
    single = (theta > 0.001).sum(axis=1) == 1
    return theta, np.where(single, odds[rows, main], theta[rows, main])


@shielded("_whole")
def with_language(docs: DataFrame, train: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus lang_pred, score and languages (a map of proportions).

    ``train`` has text and lang; rows without either teach nothing. A text that
    is null or has no letter is ``und`` with score 0, and so is every text when
    there is nothing to learn from. Columns of these names are replaced.
    """
    usable = train.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    langs, logp, prior = fit_languages(usable)
    model = docs.sparkSession.sparkContext.broadcast((langs, logp, prior))
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "languages")]
    schema = docs.select(*names).schema.add("lang_pred", T.StringType()).add(
        "score", T.DoubleType()).add("languages", T.MapType(T.StringType(), T.DoubleType()))

    def run(batches):
        langs, logp, prior = model.value
        letters = letter_table()
        for batch in batches:
            batch = batch.assign(_whole=batch["text"].fillna("") if "text" in batch else "")
            for part in chunks([batch], "_whole"):
                for i in range(0, len(part), DOCS_AT_ONCE):
                    some = part.iloc[i : i + DOCS_AT_ONCE]
                    texts = some["_whole"].tolist()
                    counts = _counts(texts, letters)
                    pred, score, shares = ["und"] * len(texts), [0.0] * len(texts), [{} for _ in texts]
                    if langs:
                        theta, sure = infer_mixture(counts, logp, prior)
                        for j, text in enumerate(texts):
                            if counts[j].any() or any(map(str.isalpha, text)):
                                pred[j], score[j] = langs[int(np.argmax(theta[j]))], float(min(1.0, sure[j]))
                                shares[j] = {langs[k]: float(theta[j, k]) for k in np.flatnonzero(theta[j] > 0.001)}
                    yield some.drop(columns="_whole").assign(lang_pred=pred, score=score, languages=shares)

    return docs.select(*names).mapInPandas(run, schema)


def predict_language(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, languages."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    train = docs.where(~in_test_fold()).select("text", "lang")
    ids = rows.withColumn("held_out", in_test_fold())
    return with_language(ids, train).drop("text")
