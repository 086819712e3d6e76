"""The corpus operators as queries over the given tables, with their SQL."""

from __future__ import annotations

import public_tokenizers

from .bpe import bpe_round_trip
from .common import documents
from .exact_dedup import exact_duplicates
from .filter_audit import filter_audit
from .language_id import predict_language
from .licenses import document_paths, scan_licences
from .line_dedup import line_dedup
from .mixing import mix_counts
from .ngram_join import ngram_join
from .periodic_runs import periodic_runs
from .quality import quality_rules
from .secrets import find_secrets
from .simhash_join import simhash_groups
from .toxicity import score_toxicity

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_exact_dedup(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir))


SQL["op1_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""


@query
def op2_bpe(spark, sf_dir):
    return bpe_round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_language_id(spark, sf_dir):
    return predict_language(documents(spark, sf_dir))


@query
def op4_quality_rules(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op10_toxicity(spark, sf_dir):
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op7_secret_scans(spark, sf_dir):
    return find_secrets(documents(spark, sf_dir))


@query
def op6_line_dedup(spark, sf_dir):
    return line_dedup(documents(spark, sf_dir))


@query
def op3_mixing(spark, sf_dir):
    return mix_counts(documents(spark, sf_dir))


@query
def op9_license_scans(spark, sf_dir):
    return scan_licences(document_paths(documents(spark, sf_dir)))


@query
def op8_ngram_join(spark, sf_dir):
    return ngram_join(documents(spark, sf_dir))


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


SQL["op12_filter_audit"] = r"""
WITH words AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
verdicts AS (
  SELECT part, doc_id,
         len(w) < 100 AS a,
         100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM words),
known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
  SELECT part, a::int + 2 * b::int + 4 * c::int + 8 * d::int + 16 * e::int AS mask, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM verdicts LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT f1.name || f2.name || f3.name || f4.name || f5.name AS filter_order,
         [f1.bit, f2.bit, f3.bit, f4.bit, f5.bit] AS bits
  FROM f f1, f f2, f f3, f f4, f f5
  WHERE f1.bit + f2.bit + f3.bit + f4.bit + f5.bit = 31
    AND f2.bit <> f1.bit AND f3.bit NOT IN (f1.bit, f2.bit)
    AND f4.bit NOT IN (f1.bit, f2.bit, f3.bit) AND f5.bit NOT IN (f1.bit, f2.bit, f3.bit, f4.bit)),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::int AS earlier
  FROM orders, range(1, 6) r(step)),
counts AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (earlier + bit)::int = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::int AS step, kept::bigint AS kept, removed::bigint AS removed,
       redundant::bigint AS redundant, unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost,
       toxic_lost::bigint AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::bigint AS shapley
FROM counts
"""


@query
def op13_simhash(spark, sf_dir):
    return simhash_groups(documents(spark, sf_dir))


@query
def op11_periodic_runs(spark, sf_dir):
    return periodic_runs(documents(spark, sf_dir))
