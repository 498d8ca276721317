"""Operator 2: substring deduplication over a compacted de Bruijn graph of words.

A window is ``WINDOW`` consecutive words of one text. Windows are the edges of a de Bruijn graph whose
nodes are the runs of one word less; a word goes if a window over it occurs anywhere else as well.

Edges are never shuffled one by one. In each window the anchor is the 8-word piece with the smallest
hash, leftmost on ties, so equal windows have equal anchors at equal places. Consecutive windows with
one anchor occurrence form a path (28 edges at most, so no path holds a window twice), and only paths
travel: anchor, digest of all their words, source coordinates. Then, by joins:

1. An anchor that occurs once makes its whole path unique; it is dropped.
2. Where all paths of an anchor are equal nothing branches: the compacted path counts as one unit.
3. Elsewhere paths branch. Each distinct path (copies are counted beforehand, on the map side too) goes
   back to one source coordinate, and the words of each window there are digested and counted under their
   anchor. A path found twice is repeated whole; of the others a bit mask keeps the repeated windows.
4. Paths and masks return to the coordinates of all occurrences, and texts drop the covered words.

Spans are verified by the words themselves: paths and windows compare by keyed BLAKE2b digests of the words at
their source coordinates, joined by spaces, under one anchor. No arithmetic of word hashes decides, so no
repetitive or hostile text can collide; the anchors, which do come from such hashes, only gather spans. Hot anchors are combined before each shuffle,
and the joins back are equi-joins that adaptive execution can split. No list outgrows its own text.

Defined results. Null, empty or blank text: no words, nothing removed, hash of the empty string.
Repeated rows: each counts, so their windows are repeated; their text is opened once and their hits are
one set, however many rows there are. Rows sharing a doc_id are told apart by text. Very long texts are read whole, a text at a time. Ties between anchors: the leftmost. Null doc_id: handled like any id. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TextBlock, drop_worker_cache, joined_words, keyed, mix, prepare, sliding_min, stage_table, text_blocks, word_hashes, word_spans

WINDOW, ANCHOR = 35, 8
#: Words handled at once; positions take 24 bits beside 40 bits of hash.
_CHUNK = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_STEPS = mix(np.arange(1, ANCHOR + 1, dtype=np.uint64)) | np.uint64(1)
_KEY = b"substring dedup"


class BlockWords:
    """The words of a block: hashes for anchors, where each row's words begin, and their text for digests."""

    def __init__(self, block: TextBlock):
        starts, ends, self.first = word_spans(block)
        self.hashes = word_hashes(block, starts, ends)
        self.text, self.begin, self.end = joined_words(block, starts, ends)

    def digests(self, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        """64 bits of the digest of ``count`` words from each word of ``begin`` on."""
        text, digest = self.text, blake2b
        cuts = zip(self.begin[begin].tolist(), self.end[begin + count - 1].tolist(), strict=True)
        return np.frombuffer(b"".join([digest(text[a:b], digest_size=8, key=_KEY).digest() for a, b in cuts]), dtype=np.int64)


def paths(block: BlockWords, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Row, first window in the row, windows, anchor hash and digest of each path."""
    found = []
    words, first = block.hashes, block.first
    ends = np.repeat(first[1:], np.diff(first))
    starts = np.repeat(first[:-1], np.diff(first))
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for at in range(0, max(len(words) - window + 1, 0), _CHUNK):
        part = words[at : at + _CHUNK + window - 1]
        pieces = np.zeros(len(part) - anchor + 1, dtype=np.uint64)
        for j in range(anchor):
            pieces += part[j : j + len(pieces)] * _STEPS[j]
        pieces = mix(pieces)
        least = sliding_min((pieces & ~_PLACE) | np.arange(len(pieces), dtype=np.uint64), window - anchor + 1)
        inside = np.arange(at, at + len(least)) + window <= ends[at : at + len(least)]
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
        begin = np.flatnonzero(new)
        if len(begin) == 0:
            continue
        total = np.concatenate([[0], np.cumsum(inside)])
        n = np.diff(np.append(total[begin], total[-1]))
        found.append((rows[at + begin], at + begin - starts[at + begin], n, pieces[(least[begin] & _PLACE).astype(np.int64)], block.digests(at + begin, n + window - 1)))
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64))


def _find_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, text) rows to (k1, k2, p, n, anchor, path)."""
    drop_worker_cache()
    for batch in batches:
        for block in text_blocks(batch.column(2)):
            row, p, n, anchor, path = paths(BlockWords(block))
            row = pa.array(row + block.first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(p.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(path)],
                names=["k1", "k2", "p", "n", "anchor", "path"],
            )


def _open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, k2, text, list of (p, n, anchor, path)) rows to a row for each window of those paths: (anchor, path, place, window).

    Equal texts of one id come one after another where the rows are sorted by key, and only the first of them is opened.
    """
    last = None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(2)], axis=1)
        if len(keys) == 0:
            continue
        before = np.concatenate([keys[:1] if last is None else last, keys[:-1]])
        new = (keys != before).any(axis=1)
        new[0] |= last is None
        last, batch = keys[-1:], batch.select(["text", "paths"]).filter(pa.array(new))
        size = batch.column(1).value_lengths().to_numpy()
        flat = batch.column(1).flatten()
        p, n, anchor, path = (flat.field(k).to_numpy().astype(np.int64) for k in range(4))
        bounds = np.concatenate([[0], np.cumsum(size)])
        for block in text_blocks(batch.column(0)):
            words = BlockWords(block)
            own = slice(bounds[block.first], bounds[block.first + block.rows])
            row = np.repeat(np.arange(block.rows), size[block.first : block.first + block.rows])
            count = n[own]
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            begin = np.repeat(words.first[row] + p[own], count) + place
            found = words.digests(begin, np.full(len(begin), WINDOW))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(anchor[own], count)), pa.array(np.repeat(path[own], count)), pa.array(place.astype(np.int32)), pa.array(found)],
                names=["anchor", "path", "place", "window"],
            )


def kept_words(words: list[bytes], hits: np.ndarray) -> tuple[list[bytes], int]:
    """Words outside the hit windows, and how many went. A hit: first window << 28 | mask of windows from there."""
    covered = np.zeros(len(words) + 1, dtype=np.int32)
    at, mask = hits >> 28, hits & ((1 << 28) - 1)
    for k in range(28):
        begin = at[(mask >> k & 1).astype(bool)] + k
        np.add.at(covered, begin, 1)
        np.add.at(covered, begin + WINDOW, -1)
    gone = np.cumsum(covered[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~gone).tolist()], int(gone.sum())


def _remove(batches: Iterator[pa.RecordBatch], keep: int, at: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """Rows of ``keep`` columns to pass on and, last, hits to those columns and n_words, n_removed, kept_sha256[, kept]; the text is column ``at``."""
    for batch in batches:
        hits = batch.column(batch.num_columns - 1)
        size = hits.value_lengths().fill_null(0).to_numpy()
        bounds, flat = np.concatenate([[0], np.cumsum(size)]), hits.flatten().to_numpy()
        n, gone, sha, kept = [], [], [], []
        for block in text_blocks(batch.column(at)):
            for i in range(block.rows):
                words, removed = block.text(i).split(), 0
                n.append(len(words))
                own = flat[bounds[block.first + i] : bounds[block.first + i + 1]]
                if len(own):
                    words, removed = kept_words(words, own)
                text = b" ".join(words)
                gone.append(removed)
                sha.append(hashlib.sha256(text).hexdigest())
                kept.append(text if with_text else b"")
        out = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
        names = [*batch.schema.names[:keep], "n_words", "n_removed", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *out, *([pa.array(kept, pa.binary()).cast(pa.string())] * with_text)], names=[*names, *["kept"] * with_text])


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(k1, k2, hits): the repeated windows of each text that has any."""
    source = keyed(docs.select("doc_id", "text")).select("k1", "k2", "text")
    found = stage_table(source.mapInArrow(_find_paths, "k1 long, k2 long, p int, n int, anchor long, path long"), "paths")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("c"), F.min("path").alias("low"), F.max("path").alias("high"))
    # Aggregates are written before they are joined: then both sides of a join are plain exchanges, whose hot partitions adaptive execution splits.
    again = stage_table(anchors.filter("c > 1").select("anchor", (F.col("low") != F.col("high")).alias("branches")), "anchors")
    matched = stage_table(found.join(again, "anchor"), "matched")

    branching = matched.filter("branches")
    forms = stage_table(branching.groupBy("anchor", "path").agg(F.count("*").alias("c"), F.min(F.struct("k1", "k2", "p", "n")).alias("at")), "forms")
    sources = forms.groupBy(F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2")).agg(F.collect_list(F.struct("at.p", "at.n", "anchor", "path")).alias("paths"))
    opened = stage_table(source.join(sources, ["k1", "k2"]).select("k1", "k2", "text", "paths").mapInArrow(_open_windows, "anchor long, path long, place int, window long"), "windows")
    twice = stage_table(opened.groupBy("anchor", "window").count().filter("count > 1").select("anchor", "window"), "repeated")
    bit = F.expr("shiftleft(1L, place)")
    masks = opened.join(twice, ["anchor", "window"]).groupBy("anchor", "path").agg(F.bit_or(bit).alias("mask"))
    whole = F.expr("shiftleft(1L, n) - 1")
    judged = forms.filter("c > 1").select("anchor", "path", F.lit(None).cast("long").alias("mask")).union(masks.join(forms.filter("c = 1").select("anchor", "path"), ["anchor", "path"]))
    judged = stage_table(judged, "judged")
    hits = matched.filter("NOT branches").select("k1", "k2", "p", whole.alias("mask")).union(
        branching.join(judged, ["anchor", "path"]).select("k1", "k2", "p", F.coalesce("mask", whole))
    )
    return hits.groupBy("k1", "k2").agg(F.collect_set(F.shiftleft(F.col("p").cast("long"), 28).bitwiseOR(F.col("mask"))).alias("hits"))


def remove_repeats(docs: DataFrame, keep: list[str], with_text: bool = False) -> DataFrame:
    """Columns ``keep`` with n_words, n_removed, kept_sha256 and, if asked for, the kept text."""
    prepare(docs.sparkSession)
    hits = stage_table(repeated_windows(docs), "hits")
    joined = keyed(docs.select(*dict.fromkeys([*keep, "doc_id", "text"]))).join(hits, ["k1", "k2"], "left").select(*dict.fromkeys([*keep, "text"]), "hits")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in joined.schema.fields[: len(keep)])
    return joined.mapInArrow(partial(_remove, keep=len(keep), at=joined.columns.index("text"), with_text=with_text), fields + "n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text)
