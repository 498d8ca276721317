"""Operator 8: weighted SimHash fingerprints of whole texts, and search within a Hamming radius.

Terms are words (weight 1) and pairs of neighbouring words (weight 2); a text of under 64 words adds
its runs of four bytes, so that short texts still compare, with a weight that falls evenly from 1 for no
word to 0 for 64 words: a few words more or less change little at any length. Each term hash votes with its
weight on 128 signed bits; a fingerprint bit is 1 where the sum is positive. Hashing and voting are
vectorised over blocks of text.

The query's neighbour of a row is the next one by (doc_id, text hash), after the last the first. Rows
are range-partitioned and sorted once, which is the only time texts are shuffled; the first and last
row of each partition meet the partition before by a join on partition numbers, and only those numbers
(one per partition) reach the driver.

``within`` cuts fingerprints into radius + 1 blocks; two within the radius agree on one block at least,
so a table per block, keyed by that block first, finds every pair, and bit counts verify it. It works on
distinct fingerprints: the pairs it gives are between fingerprints, and ``members`` tells whose they are, so copies
are never expanded. A pair comes out of the first block that it agrees on only, which needs no removal of doubles.

Defined results. Null or empty text: fingerprint zero. Equal texts: equal fingerprints. A single row is
its own next. Very long texts: read whole, a text at a time. Null doc_id: comes first. Ties: by the text's hash.
Repeated rows follow each other. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TextBlock, mix, partitions_for, prepare, stage_table, text_blocks, word_hashes, word_spans
from .op07_simhash_dedup import bit_counts

BITS, FADED_WORDS, RUN = 128, 64, 4
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344))


def _votes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    n = np.diff(bounds)[:, None]
    return np.concatenate([2 * bit_counts(mix(hashes ^ salt), bounds) - n for salt in _SALTS], axis=1)


def block_fingerprints(block: TextBlock) -> np.ndarray:
    """Two 64-bit words for each row of the block."""
    starts, ends, first = word_spans(block)
    words = word_hashes(block, starts, ends)
    sums = _votes(words, first)
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) if len(words) else words
    count = np.maximum(np.diff(first) - 1, 0)
    inside = np.ones(len(pairs), dtype=bool)
    edge = first[1:-1] - 1  # the pair that begins at a row's last word
    inside[edge[(edge >= 0) & (edge < len(pairs))]] = False
    sums += 2 * _votes(pairs[inside], np.concatenate([[0], np.cumsum(count)]))
    sums *= FADED_WORDS
    weight = np.maximum(FADED_WORDS - np.diff(first), 0)
    size = np.where(weight > 0, np.maximum(np.diff(block.offsets) - RUN + 1, 0), 0)
    if size.any():
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(block.offsets[:-1] - bounds[:-1], size) + np.arange(bounds[-1])
        runs = np.zeros(len(at), dtype=np.uint64)
        for j in range(RUN):
            runs |= block.data[at + j].astype(np.uint64) << np.uint64(8 * j)
        sums += weight[:, None] * _votes(mix(runs + np.uint64(1)), bounds)
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64)


def fingerprints(column: pa.Array) -> np.ndarray:
    out = np.zeros((len(column), 2), dtype=np.uint64)
    for block in text_blocks(column):
        out[block.first : block.first + block.rows] = block_fingerprints(block)
    return out


def digits(prints: np.ndarray) -> list[str]:
    return [f"{a:016x}{b:016x}" for a, b in prints.tolist()]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SHAPE = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _results(ids: pa.Array, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> list:
    changed = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    column = pa.array(changed, pa.string())
    prints = fingerprints(column)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in changed]
    return [ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(sha), pa.array(digits(own)), pa.array(digits(prints)), pa.array(likeness(own, prints)), pa.array(likeness(own, after))]


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (doc_id, text) rows to results; a partition's last row goes out open and its first row as a head, for joining."""
    part = TaskContext.get().partitionId()
    shape = [*(pa.array([], t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))]
    names = [*_NAMES, "part", "role", "text"]

    def edge(doc_id: pa.Array, role: str, text: str) -> pa.RecordBatch:
        blank = [pa.nulls(1, a.type) for a in shape]
        return pa.RecordBatch.from_arrays([doc_id, *blank, pa.array([part], pa.int32()), pa.array([role]), pa.array([text])], names=names)

    held: tuple[pa.Array, str, np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ids, column = batch.column(0), batch.column(1).fill_null("")
        texts, prints = column.to_pylist(), fingerprints(column)
        if held is None:
            yield edge(ids.slice(0, 1), "head", texts[0])
        else:
            ids, texts, prints = pa.concat_arrays([held[0], ids]), [held[1], *texts], np.concatenate([held[2], prints])
        n = len(texts) - 1
        if n:
            out = _results(ids.slice(0, n), texts[:-1], texts[1:], prints[:-1], prints[1:])
            yield pa.RecordBatch.from_arrays([*out, pa.nulls(n, pa.int32()), pa.array(["done"] * n), pa.nulls(n, pa.string())], names=names)
        held = ids.slice(n, 1), texts[n], prints[n:]
    if held is not None:
        yield edge(held[0], "open", held[1])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, following) rows to results."""
    for batch in batches:
        texts, following = batch.column(1), batch.column(2)
        yield pa.RecordBatch.from_arrays(_results(batch.column(0), texts.to_pylist(), following.to_pylist(), fingerprints(texts), fingerprints(following)), names=_NAMES)


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row."""
    spark = docs.sparkSession
    prepare(spark)
    tie = F.xxhash64("text")
    source = docs.select("doc_id", "text")
    dealt = source.repartitionByRange(partitions_for(source), F.col("doc_id"), tie).sortWithinPartitions("doc_id", tie)
    found = stage_table(dealt.mapInArrow(_with_next, f"{_SHAPE}, part int, role string, text string"), "fingerprints")
    done = found.filter("role = 'done'").select(*_NAMES)
    parts = sorted(r["part"] for r in found.filter("role = 'head'").select("part").collect())
    if not parts:
        return done
    links = spark.createDataFrame(list(zip(parts, [*parts[1:], parts[0]], strict=True)), "part int, next int")
    heads = found.filter("role = 'head'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    last = found.filter("role = 'open'").select("doc_id", "text", "part").join(links, "part").join(heads, "next").select("doc_id", "text", "following")
    return done.union(last.mapInArrow(_close, _SHAPE))


def members(prints: DataFrame) -> DataFrame:
    """(id, hi, lo) rows to the representative of each: the smallest id with the same fingerprint."""
    first = prints.groupBy("hi", "lo").agg(F.min("id").alias("representative"))
    return prints.join(first, ["hi", "lo"]).select("id", "representative")


def within(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(id, hi, lo) rows and such queries to (query_id, id, distance) for every two representatives, of queries and of prints, at most ``radius`` bits apart."""
    width = BITS // (radius + 1)
    cut = [(k * width, BITS if k == radius else (k + 1) * width) for k in range(radius + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in cut]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    block = lambda hi, lo, m: (F.col(hi).bitwiseAND(F.lit(signed(m >> 64))), F.col(lo).bitwiseAND(F.lit(signed(m & ((1 << 64) - 1)))))

    def tables(df: DataFrame, name: str) -> DataFrame:
        distinct = df.groupBy(F.col("hi").alias(f"{name}_hi"), F.col("lo").alias(f"{name}_lo")).agg(F.min("id").alias(name))
        keys = [F.struct(F.lit(t).alias("t"), *(c.alias(n) for c, n in zip(block(f"{name}_hi", f"{name}_lo", m), "ab", strict=True))) for t, m in enumerate(masks)]
        return distinct.select("*", F.explode(F.array(*keys)).alias("x")).select(name, f"{name}_hi", f"{name}_lo", "x.*")

    both = tables(prints, "id").join(tables(queries, "query_id"), ["t", "a", "b"])
    differ = both.select("query_id", "id", "t", F.col("id_hi").bitwiseXOR(F.col("query_id_hi")).alias("hi"), F.col("id_lo").bitwiseXOR(F.col("query_id_lo")).alias("lo"))
    first = F.lit(len(masks))
    for t in reversed(range(len(masks))):
        a, b = block("hi", "lo", masks[t])
        first = F.when((a == 0) & (b == 0), t).otherwise(first)
    distance = F.bit_count("hi") + F.bit_count("lo")
    return differ.filter((distance <= radius) & (first == F.col("t"))).select("query_id", "id", distance.alias("distance"))
