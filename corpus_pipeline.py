"""The corpus pipeline: five stages over documents, each on all that its predecessor kept.

1. language ID: rows without a letter (or text) go, and those that no learned language compresses
   below 8 bits a byte; a missing lang is filled in.
2. SimHash near-dedup: of each group one row stays, that with the smallest (doc_id, text hash).
3. substring dedup: words under repeated 35-word windows go; untouched texts stay as they are.
4. PII: each span found, secrets included, becomes its kind in brackets.
5. packing: the texts that are left become token sequences.

Stages 1 to 4 return the columns of documents; extra columns are dropped. Every stage is written as
Parquet and read back, so a lost executor costs a stage at most; what a stage wrote for itself is removed
when its result is there.

Defined results. Null or empty text: goes in stage 1 (where nothing is labelled, stage 1 keeps all: then it is a
document without words or spans, whose one token is the end mark). Null doc_id: kept like any; in stage 2 it
loses to any id. Very long texts: whole in every stage. Ties and repeated rows: equal rows are one group in
stage 2, of which one stays. Empty table: no rows. Text that a stage empties stays as an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemark.llm import op01_pii, op02_substring_dedup, op05_packing, op07_simhash_dedup, op09_language_id
from telemark.llm.common import drop_table, keep_table, keyed, prepare, scratch_scope, stage_table, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bits a byte that a text costs when no language explains it.
UNEXPLAINED = 8.0


def _changed(docs: DataFrame, text: str) -> DataFrame:
    """documents with the text of another column, and its length where that differs."""
    length = F.when(F.col(text).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return docs.withColumn("n_chars", length).withColumn("text", F.col(text)).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without any labelled text nothing can be judged, and all rows stay."""
    docs = docs.select(*COLUMNS)
    trees = op09_language_id.learn(docs)
    if trees is None:
        return docs
    found = op09_language_id.language_id(docs, trees, COLUMNS)
    kept = found.filter((F.col("lang_pred") != op09_language_id.UNKNOWN) & (F.col("bits_per_byte") < UNEXPLAINED))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies; rows equal in doc_id and text are one row. Null texts are a group (fingerprint zero)."""
    docs = keyed(docs.select(*COLUMNS))
    prints = stage_table(op07_simhash_dedup.fingerprint(docs, ("doc_id", "k1", "k2")), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "k1", "k2")
    winners = prints.join(op07_simhash_dedup.groups(prints), "fp").groupBy("root").agg(F.min(order).alias("x")).select("x.k1", "x.k2")
    return docs.join(winners, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select(*COLUMNS)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; a text that loses words keeps the others joined by one space. Null texts stay null."""
    found = op02_substring_dedup.remove_repeats(docs.select(*COLUMNS), COLUMNS, with_text=True)
    return _changed(found.withColumn("new", F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))), "new")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with spans redacted. Null texts stay null."""
    docs = docs.select(*COLUMNS)
    spans = op01_pii.find(docs).filter(F.size("spans") > 0).groupBy("k1", "k2").agg(F.first("spans").alias("spans"))
    marked = keyed(docs).join(spans, ["k1", "k2"], "left")
    return _changed(op01_pii.redact(marked, COLUMNS), "redacted")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document. Null texts count as empty."""
    import public_tokenizers

    return op05_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language),
    ("simhash_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("pii", personal_data),
    ("packing", pack),
]

#: The stages learn, hash and tokenise, which SQL can't express; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from all of documents."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch_scope(spark):
            last, docs = docs, keep_table(stage_table(stage(spark, docs, sf_dir), f"stage-{name}"))
        drop_table(last)
    return STAGES[-1][1](spark, docs, sf_dir)
