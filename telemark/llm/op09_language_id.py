"""Operator 9: language identification by prediction by partial matching.

One variable-order byte context tree per language holds frozen counts of the byte that follows each
context of up to three bytes. A byte costs -log2 of its probability in the longest context that knows
it, plus the escapes (method C: distinct / (total + distinct)) from each longer context that is known
but lacks it; order -1 gives every byte 8 bits. The language with the shortest code wins.

As statistics are frozen, the trees of all languages flatten into one table of exact code lengths: a
row for each context that any language knows, a column for each byte seen in training (one more for
all others) and language. Scoring is two look-ups a byte and works on Arrow buffers. Where that table
would be larger than ``max_table_mb``, as with tens of languages and scripts, each language keeps only
what it has seen, and the distinct contexts of a window of text are looked up there: code lengths and
orders are the same, scoring is slower.

Learning uses a sample of bounded size a language, from every language: the ``per_language`` documents that
come first by a hash of doc_id, from each at most ``max_bytes`` characters at a place fixed by its hash. Equal
rows count once, and no more than those documents reach the driver, whatever ids are repeated. Rows without
text, language or doc_id, and those of the held-out fold, teach nothing.

Defined results. Null or letterless text: ``und``, score 0. No learned language: ``und``, score 0.
Ties: the smaller name. Very long texts: read whole, a window at a time. Null doc_id: predicted like any. Equal rows: equal results. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_fold, prepare, text_blocks, worker_cache

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
_SPACE = 0x20


def contexts(data: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """The ``order`` bytes before each byte as a number, nearest byte lowest; texts begin after spaces."""
    code = np.zeros(len(data), dtype=np.uint32)
    for back in range(1, order + 1):
        before = np.full(len(data), _SPACE, dtype=np.uint32)
        before[back:] = data[:-back]
        for k in range(back):
            at = starts + k
            before[at[at < len(data)]] = _SPACE
        code |= before << np.uint32(8 * (back - 1))
    return code


class Trees:
    """Counts by order and language, and from them the table of code lengths."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = 3, max_table_mb: int = 160):
        self.key = uuid.uuid4().hex
        self.languages = sorted(samples)
        self.counts: list[list[tuple[np.ndarray, np.ndarray]]] = []
        self.sparse = False
        seen = np.zeros(256, dtype=bool)
        for k in range(order + 1):
            level = []
            for name in self.languages:
                texts = [t for t in samples[name] if t]
                data = np.frombuffer(b"".join(texts), dtype=np.uint8)
                seen[data] = True
                starts = np.cumsum([0, *(len(t) for t in texts[:-1])]).astype(np.int64)
                keys = contexts(data, starts, k).astype(np.uint64) << np.uint64(8) | data
                level.append(np.unique(keys, return_counts=True))
            width = (int(seen.sum()) + 1) * len(self.languages) * 4
            if k and len(np.unique(np.concatenate([x >> np.uint64(8) for x, _ in level]))) * width > max_table_mb << 20:
                self.sparse = True
            self.counts.append(level)
        self.column = np.full(256, int(seen.sum()), dtype=np.int64)
        self.column[seen] = np.arange(seen.sum())

    def by_language(self) -> list[list[tuple[np.ndarray, ...]]]:
        """For each language and order: known contexts and their escapes, known keys (context, byte) and their code lengths."""
        found = []
        for j in range(len(self.languages)):
            levels = []
            for level in self.counts:
                keys, counts = level[j]
                known, at = np.unique(keys >> np.uint64(8), return_inverse=True)
                total, kinds = np.bincount(at, weights=counts), np.bincount(at)
                levels.append((known, -np.log2(kinds / (total + kinds)).astype(np.float32), keys, -np.log2(counts / (total + kinds)[at]).astype(np.float32)))
            found.append(levels)
        return found

    def flatten(self) -> tuple[np.ndarray, np.ndarray, int]:
        """Row of each context number of the highest order, code lengths [row * columns + column, language], columns."""
        columns, n = int(self.column.max()) + 1, len(self.languages)
        parent_at = np.zeros(1, dtype=np.int64)
        parent = np.full((1, columns, n), 8.0, dtype=np.float32)
        rows, tables, base = np.zeros(1, dtype=np.int32), [], 0
        for k, level in enumerate(self.counts):
            known = np.unique(np.concatenate([keys >> np.uint64(8) for keys, _ in level])).astype(np.int64)
            suffix = known & ((1 << 8 * max(k - 1, 0)) - 1)
            own = parent[np.searchsorted(parent_at, suffix)] if k else np.repeat(parent, len(known), 0)
            for j, (keys, counts) in enumerate(level):
                at = np.searchsorted(known, (keys >> np.uint64(8)).astype(np.int64))
                total = np.bincount(at, weights=counts, minlength=len(known))
                kinds = np.bincount(at, minlength=len(known))
                has = total > 0
                own[has, :, j] += (-np.log2(kinds[has] / (total[has] + kinds[has])))[:, None].astype(np.float32)
                own[at, self.column[(keys & np.uint64(255)).astype(np.int64)], j] = -np.log2(counts / (total + kinds)[at])
            rows = np.tile(rows, 256) if k else rows
            rows[known] = base + np.arange(len(known), dtype=np.int32)
            tables.append(own)
            base += len(known)
            parent_at, parent = known, own
        return rows.astype(np.uint16) if base < 1 << 16 else rows, np.concatenate(tables).reshape(-1, n), columns


def _tables(trees: Broadcast | Trees) -> tuple:
    """The flattened table, or what each language has seen and no rows; built once in each worker."""
    own = trees.value if isinstance(trees, Broadcast) else trees
    return worker_cache(own.key, lambda: (own, None, own.by_language(), 0) if own.sparse else (own, *own.flatten()))


def _place(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are in the sorted ``known``, and where."""
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    has = known[at] == wanted
    return has, at[has]


def _sparse_prices(levels: list[tuple[np.ndarray, ...]], keys: np.ndarray) -> np.ndarray:
    """Code length of each key of the highest order under one language."""
    price = np.full(len(keys), 8.0, dtype=np.float32)
    for k, (known, escapes, seen, lengths) in enumerate(levels):
        short = keys & np.uint64((1 << 8 * (k + 1)) - 1)
        has, at = _place(known, short >> np.uint64(8))
        price[has] += escapes[at]
        has, at = _place(seen, short)
        price[has] = lengths[at]
    return price


def code_lengths(column: pa.Array, trees: Broadcast | Trees, window: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each row under each language, and its bytes."""
    own, rows, cost, columns = _tables(trees)
    order = len(own.counts) - 1
    bits, size = np.zeros((len(column), len(own.languages))), np.zeros(len(column))
    for block in text_blocks(column):
        full = np.flatnonzero(np.diff(block.offsets))
        begins, ends = block.offsets[full], block.offsets[full + 1]
        size[block.first + full] = ends - begins
        for at in range(0, len(block.data), window):
            lead = min(order, at)
            piece = block.data[at - lead : at + window]
            inside = (begins < at + window) & (ends > at)
            code = contexts(piece, begins[(begins >= at - lead) & (begins < at + window)] - at + lead, order)[lead:]
            # A text that began before the lead is continued: its first bytes here have true neighbours.
            cuts = np.maximum(begins[inside] - at, 0)
            if rows is None:
                keys, back = np.unique(code.astype(np.uint64) << np.uint64(8) | piece[lead:], return_inverse=True)
                for j, levels in enumerate(cost):
                    bits[block.first + full[inside], j] += np.add.reduceat(_sparse_prices(levels, keys)[back], cuts, dtype=np.float64)
                continue
            price = cost[rows[code].astype(np.int64) * columns + own.column[piece[lead:]]]
            bits[block.first + full[inside]] += np.add.reduceat(price, cuts, axis=0, dtype=np.float64)
    return bits, size


def _identify(batches: Iterator[pa.RecordBatch], trees: Broadcast, keep: int, at: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``keep`` columns to pass on and, last, whether there is a letter; the text is column ``at``."""
    for batch in batches:
        text, letters = batch.column(at), batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
        bits, size = code_lengths(text, trees)
        names = trees.value.languages
        per_byte = bits / np.maximum(size, 1)[:, None]
        best = per_byte.argmin(axis=1)
        weight = np.exp2(-(per_byte - per_byte.min(axis=1, keepdims=True)) * np.minimum(size, 64)[:, None])
        score = np.where(letters, 1 / weight.sum(axis=1), 0.0)
        shortest = np.where(letters, per_byte.min(axis=1), 0.0)
        said = pa.array([names[i] if ok else UNKNOWN for i, ok in zip(best, letters, strict=True)], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[:keep], said, pa.array(score.round(6)), pa.array(shortest.round(6))], names=[*batch.schema.names[:keep], "lang_pred", "score", "bits_per_byte"])


def learn(docs: DataFrame, per_language: int = 160, max_bytes: int = 8192, at_once: int = 64) -> Trees | None:
    """Trees from a sample of labelled documents of each language, read ``at_once`` languages at a time; None if there is no label."""
    length = F.length("text")
    sf = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (length > 0) & ~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    found = sf.groupBy("lang").count().orderBy("lang").collect()
    place = F.abs(F.xxhash64("doc_id") % (1 << 20)) / (1 << 20)
    begin = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(length - max_bytes + 1, F.lit(1))) + 1
    first = Window.partitionBy("lang").orderBy("place", "doc_id", "h")
    samples: dict[str, list[bytes]] = {r["lang"]: [] for r in found}
    for i in range(0, len(found), at_once):
        # A hash keeps few rows of large languages; the rank bounds what ids in many copies leave.
        share = F.create_map(*(F.lit(x) for r in found[i : i + at_once] for x in (r["lang"], min(1.0, 2.0 * per_language / r["count"]))))
        near = sf.filter(place < share[F.col("lang")]).select("lang", "doc_id", place.alias("place"), F.xxhash64("text").alias("h"), F.col("text").substr(begin.cast("int"), F.lit(max_bytes)).alias("piece"))
        each = near.groupBy("lang", "doc_id", "place", "h").agg(F.min("piece").alias("piece"))
        picked = each.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= per_language).orderBy("lang", "rank").collect()
        for r in picked:
            samples[r["lang"]].append(r["piece"].encode())
    samples = {k: v for k, v in samples.items() if v}
    return Trees(samples) if samples else None


def language_id(docs: DataFrame, trees: Trees | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred, score and bits_per_byte of each whole text."""
    prepare(docs.sparkSession)
    if trees is None:
        return docs.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_byte"))
    source = docs.select(*dict.fromkeys([*keep, "text"]), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[: len(keep)])
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    return source.mapInArrow(partial(_identify, trees=shared, keep=len(keep), at=source.columns.index("text")), f"{fields}, lang_pred string, score double, bits_per_byte double")


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte for each row of documents."""
    out = language_id(docs, learn(docs), ["doc_id"])
    return out.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "lang_pred", "score", "bits_per_byte")
