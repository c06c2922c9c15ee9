"""Registered queries of this subpackage: each runs its operator over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (brown, decontaminate, exactdedup, minhash, periodicruns, pieces, quality, rollups, rules, suffixdedup,
                        toxicity, wavelet, whitening)
from quarry.session import checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.corpus_scores(_table(spark, sf_dir, "documents"))


def _shared(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def op3_wavelet_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_ids(_table(spark, sf_dir, "documents"), wavelet.tokenizer_path(), _shared(spark, "token-shards"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_report(_table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(_table(spark, sf_dir, "documents"), pieces.Pieces.load(pieces.model_path()))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.repeated_bytes(_table(spark, sf_dir, "documents"))


def op9_token_count_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.document_rollup(_table(spark, sf_dir, "documents"), wavelet.tokenizer_path(), _shared(spark, "token-ledger"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodicruns.periodic_runs(_table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_brown_class_lm, op3_wavelet_token_ids, op4_toxicity, op5_circulant_minhash, op6_quality_rules, op7_sentencepiece, op8_suffix_dedup, op9_token_count_rollups,
                                  op10_benchmark_decontamination, op11_embedding_whitening, op12_periodic_runs, op13_exact_dedup)}

_WORD = r"[^\x20\x09-\x0D]+"

_OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, range(0, 5) AS r(o) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n, count(*) AS lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d)
          WHERE regexp_matches(l, '{_WORD}') GROUP BY doc_id),
s AS (SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, coalesce(lines.lines, 0) AS n_lines,
             CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 15 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) > length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))) AS kept
FROM b"""

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD}, '{_ITEM_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD}, '{_ITEM_WORD}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i+9], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i+n-1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, k)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.l, '')) AS items_sha256,
       coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP13 = rf"""
WITH d AS (SELECT doc_id, {_FOLD} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)"""

#: The oracles take doc_id as a key, which it is in the given tables.
ORACLES: dict[str, str] = {"op6_quality_rules": _OP6, "op10_benchmark_decontamination": _OP10, "op13_exact_dedup": _OP13}
