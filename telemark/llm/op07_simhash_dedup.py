"""Operator 7: SimHash near-duplicate groups by bit-sliced comparison.

A text (A-Z lowered) gives the XXH64 (seed 42) of each 3-word shingle, repeats included; a fingerprint
bit is 1 if set in over half of them. Fingerprints link at ``RADIUS`` differing bits or fewer.

Only distinct fingerprints are compared, so copies cost nothing. Two of them within radius 2 agree on
at least two of four 16-bit blocks: six tables, each keyed by two blocks, make the buckets. In a
bucket the fingerprints lie as 64 vertical bit planes; shifting the planes by d rows compares every
row with its d-th neighbour at once, and carry-save counters add the differing bits until all 64 rows
of a word exceed the radius and are abandoned. A bucket of over ``HOT`` fingerprints is dealt again by
six of eight 8-bit blocks (28 tables), where it holds 2**16 distinct fingerprints at most; any two in
one bucket meet there too, so nothing is lost. A bucket sends out a spanning star of each linked group,
never its pairs; components() joins the stars.

Defined results. Null, empty or blank text: fingerprint zero, linked like any other. Under three words:
one shingle of all. component_id is the smallest doc_id reachable (null ids don't count; null if there
is no other). Repeated rows: one result each. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_worker_cache, mix, prepare, stage_table, text_blocks
from .graph import components

RADIUS, SHINGLE, SEED = 2, 3, 42
#: Distinct fingerprints in a bucket from which it is dealt again by finer keys.
HOT = 4096
_TABLE = np.uint64(0x9E3779B97F4A7C15)
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]


def bit_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of hashes[bounds[i]:bounds[i + 1]] have each of 64 bits set; eight bits are summed in one word."""
    size = np.diff(bounds)
    out = np.zeros((len(size), 64), dtype=np.int64)
    full = np.flatnonzero(size)
    if len(full):
        lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
        parts = -(-size[full] // 255)
        first = np.cumsum(parts) - parts
        cuts = np.repeat(bounds[full] - 255 * first, parts) + 255 * np.arange(parts.sum())
        sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(-1, 64)
        out[full] = np.add.reduceat(sums, first, axis=0, dtype=np.int64)
    return out


def shingle_hashes(text: bytes) -> list[int]:
    words = text.lower().split()
    h = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return [h(b" ".join(words), SEED)] if words else []
    return [h(b"%b %b %b" % t, SEED) for t in zip(words, words[1:], words[2:], strict=False)]


def fingerprints(column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column), dtype=np.uint64)
    for block in text_blocks(column):
        each = [shingle_hashes(block.text(i)) for i in range(block.rows)]
        bounds = np.cumsum([0, *map(len, each)])
        bits = 2 * bit_counts(np.array([x for row in each for x in row], dtype=np.uint64), bounds) > np.diff(bounds)[:, None]
        out[block.first : block.first + block.rows] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    drop_worker_cache()
    for batch in batches:
        found = pa.array(fingerprints(batch.column(text)).view(np.int64))
        kept = [i for i in range(batch.num_columns) if i != text]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), found], names=[*(batch.schema.names[i] for i in kept), "fp"])


def fingerprint(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` and fp (the 64 bits as a long) of each row."""
    prepare(docs.sparkSession)
    source = docs.select(*keep, "text")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInArrow(partial(_fingerprint, text=len(keep)), fields + "fp long")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _planes(fps: np.ndarray) -> np.ndarray:
    """64 rows, one per bit; bit i of a row belongs to fingerprint i."""
    words = -(-len(fps) // 64) + 1
    bits = np.zeros((64, words * 64), dtype=np.uint8)
    bits[:, : len(fps)] = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _shifted(planes: np.ndarray, by: int) -> np.ndarray:
    """Row i + by in the place of row i, for by under 64."""
    if not by:
        return planes
    out = planes >> np.uint64(by)
    out[..., :-1] |= planes[..., 1:] << np.uint64(64 - by)
    return out


def _within(a: np.ndarray, b: np.ndarray, valid: np.ndarray, radius: int) -> np.ndarray:
    """Of the rows in ``valid``, those that differ between planes a and b in at most ``radius`` bits."""
    alive = np.flatnonzero(valid)
    out = np.zeros_like(valid)
    counters = [np.zeros(len(alive), dtype=np.uint64) for _ in range(radius.bit_length())]
    over = ~valid[alive]
    for k in range(64):
        carry = a[k, alive] ^ b[k, alive]
        for i, c in enumerate(counters):
            counters[i], carry = c ^ carry, c & carry
        over |= carry
        if k % 8 == 7:
            above, equal = over.copy(), ~over
            for i in reversed(range(len(counters))):
                if radius >> i & 1:
                    equal &= counters[i]
                else:
                    above |= equal & counters[i]
                    equal &= ~counters[i]
            near = ~above
            if not near.all():
                left = np.flatnonzero(near)
                if len(left) == 0:
                    return out
                if len(left) < len(alive):
                    alive, over, near, counters = alive[left], over[left], near[left], [c[left] for c in counters]
    out[alive] = near
    return out


def _merge(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest row linked to each of n rows."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def linked(fps: np.ndarray, ends: np.ndarray, radius: int = RADIUS, most: int = 1 << 21) -> np.ndarray:
    """Label of each row: the first row that links reach from it. ends: where its bucket ends (buckets are consecutive)."""
    n = len(fps)
    label, lefts, rights, held = np.arange(n), [], [], 0
    planes = _planes(fps)
    reach = ends - np.arange(n)
    furthest = int(reach.max(initial=1))
    for low in range(min(64, furthest)):
        near = _shifted(planes, low)
        for d in range(low or 64, furthest, 64):
            jump = d // 64
            bits = np.zeros(planes.shape[1] * 64, dtype=np.uint8)
            bits[:n] = reach > d
            valid = np.packbits(bits, bitorder="little").view(np.uint64)[: planes.shape[1] - jump]
            if not valid.any():
                continue
            hit = _within(planes[:, : planes.shape[1] - jump], near[:, jump:], valid, radius)
            if hit.any():
                at = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little"))
                lefts.append(at)
                rights.append(at + d)
                held += len(at)
                if held > most:
                    rows = np.flatnonzero(label != np.arange(n))
                    label = _merge(n, np.concatenate([*lefts, rows]), np.concatenate([*rights, label[rows]]))
                    lefts, rights, held = [], [], 0
    if lefts:
        rows = np.flatnonzero(label != np.arange(n))
        label = _merge(n, np.concatenate([*lefts, rows]), np.concatenate([*rights, label[rows]]))
    return label


def _stars(fps: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """Spanning stars of the linked groups in whole buckets: rows sorted by key."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(starts, len(keys)))
    a, b = [], []
    small = np.repeat((size > 1) & (size <= 256), size)
    groups = [(fps[small], np.repeat(np.cumsum(s), s)) for s in [size[(size > 1) & (size <= 256)]] if len(s)]
    groups += [(fps[x : x + m], np.full(m, m)) for x, m in zip(starts, size, strict=True) if m > 256]
    for rows, ends in groups:
        label = linked(rows, ends)
        moved = np.flatnonzero(label != np.arange(len(rows)))
        a.append(rows[moved])
        b.append(rows[label[moved]])
    none = np.zeros(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or [none]).view(np.int64)) for x in (a, b)], names=["a", "b"])


def _bucket_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by (t, key); a bucket that a batch cuts is carried over."""
    fps, keys = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for batch in batches:
        more = batch.column(2).to_numpy().view(np.uint64)
        key = mix(batch.column(1).to_numpy().view(np.uint64) + batch.column(0).to_numpy().astype(np.uint64) * _TABLE)
        fps, keys = np.concatenate([fps, more]), np.concatenate([keys, key])
        whole = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if len(keys) and keys[0] != keys[-1] else 0
        if whole >= 1 << 15:
            yield _stars(fps[:whole], keys[:whole])
            fps, keys = fps[whole:], keys[whole:]
    if len(fps):
        yield _stars(fps, keys)


def _dealt(fps: DataFrame, blocks: int, radius: int) -> DataFrame:
    """A row for each fingerprint and table: the bits of all blocks but ``radius`` of them, other bits zero."""
    width = 64 // blocks
    masks = []
    for left_out in combinations(range(blocks), radius):
        bits = sum(((1 << width) - 1) << (width * k) for k in range(blocks) if k not in left_out)
        masks.append(bits - (1 << 64) if bits >> 63 else bits)
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)))
    return fps.select("fp", F.explode(tables).alias("x")).select("x.t", "x.key", "fp")


def near_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fp to spanning links (a, b) of the groups within ``radius`` bits."""
    coarse = _dealt(fps, 4, radius)
    run = lambda dealt: dealt.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(_bucket_stars, "a long, b long")
    hot = stage_table(coarse.groupBy("t", "key").count().filter(F.col("count") > HOT).select("t", "key"), "hot-buckets")
    if hot.isEmpty():
        return run(coarse)
    again = coarse.join(hot, ["t", "key"], "left_semi").select("fp").distinct()
    return run(coarse.join(hot, ["t", "key"], "left_anti")).union(run(_dealt(again, 8, radius)))


def groups(prints: DataFrame) -> DataFrame:
    """doc_id and fp rows to (fp, root, component_id), a row for each distinct fp; root is one fp of the group."""
    own = stage_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    root = components(near_links(own.select("fp")))
    member = root.select(F.col("node").alias("fp"), "root").union(root.select("root", "root").distinct())
    named = member.join(own, "fp")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    found = named.join(least, "root").select("fp", "root", "component_id")
    all_groups = own.join(found, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    # Written before it is joined: then both sides of that join are plain exchanges, whose hot partitions adaptive execution splits.
    return stage_table(all_groups, "groups")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for each row of documents."""
    prints = stage_table(fingerprint(docs), "prints")
    return prints.join(groups(prints), "fp").select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
