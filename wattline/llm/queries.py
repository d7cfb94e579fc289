"""Registered queries of this package and, where SQL can express one, the DuckDB SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    alignment,
    bpe,
    exact,
    licenses,
    neighbours,
    packing,
    pieces,
    prefix_trie,
    quality,
    simhash,
    substrings,
    token_counts,
    toxicity,
)
from wattline.llm.common import table


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("evidence")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packing.pack(counted, F.col("n_tokens"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.aligned(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))[0]


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM d)),
lo AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, k FROM (
         SELECT win.doc_id, unnest(range(i, i + 50)) AS k FROM win JOIN lo ON win.s = lo.s WHERE win.doc_id > lo.m)),
place AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS k FROM d),
kept AS (SELECT p.doc_id, string_agg(p.x, ' ' ORDER BY p.k) AS t, count(*) AS n FROM place p
         LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.k = p.k WHERE g.k IS NULL GROUP BY p.doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
OP9_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_near_dedup": op1_simhash_near_dedup,
        "op2_license_scan": op2_license_scan,
        "op3_token_counts": op3_token_counts,
        "op4_quality": op4_quality,
        "op5_toxicity": op5_toxicity,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_packing": op7_packing,
        "op8_bpe_round_trip": op8_bpe_round_trip,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_nearest_neighbours": op10_nearest_neighbours,
        "op11_alignment": op11_alignment,
        "op12_sentencepiece": op12_sentencepiece,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_substring_dedup": OP6_SQL, "op9_exact_dedup": OP9_SQL}
