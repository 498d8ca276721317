"""The corpus operators as queries: each runs on the whole of its table and returns its full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import op01_pii, op02_substring_dedup, op03_licenses, op04_ann, op05_packing, op06_sentencepiece, op07_simhash_dedup, op08_fingerprints, op09_language_id, op10_quality
from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_pii.personal_data(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_licenses.find_licenses(table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_ann.nearest_vectors(table(spark, sf_dir, "embeddings"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return op05_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return op06_sentencepiece.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_language_id.identify_documents(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_licenses": op3_licenses,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_packing": op5_packing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_fingerprints": op8_fingerprints,
    "op9_language_id": op9_language_id,
    "op10_quality_classifier": op10_quality_classifier,
}

# The other operators tokenise, hash with XXH64, learn or search approximately, which SQL can't express.
ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT doc_id, k, sha256(array_to_string(words[k:k + 34], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS k FROM w WHERE len(words) >= 35)),
repeated AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY h) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, k + i AS p FROM repeated, range(35) AS t(i)),
placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT l.doc_id, string_agg(l.word, ' ' ORDER BY l.p) AS text, count(*) AS n FROM placed l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.p = l.p GROUP BY 1)
SELECT w.doc_id, len(w.words) AS n_words, len(w.words) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256 FROM w LEFT JOIN kept k ON k.doc_id = w.doc_id
""",
}
