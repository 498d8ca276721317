"""Operator 5: best-fit decreasing packing of tokenised documents into sequences.

Lengths are whole numbers of at most ``capacity`` tokens, so pieces of one length are interchangeable
and so are bins with one remaining capacity. Best-fit decreasing over the whole corpus therefore needs
only the count of each length (at most 4096 numbers): a segment tree over remaining capacities finds the tightest open
bins in logarithmic time, and whole ranges of alike bins are filled at once. The plan it makes is a list
of runs (length, first rank) -> (first bin, pieces a bin takes, room before). A range's room at least
halves with each use (r mod l < r / 2) and each length adds two ranges at most, so the plan has under
13 * 3 * 4096 rows however many documents there are; that bound is why it may be broadcast. It is the
packing that handling documents one by one would give, found without a sequential pass over them.

Executors tokenise, number pieces of a length inside their partition, add the counts of partitions
before theirs (a window per length over partition counts, never over documents) and look up the run.

Tokenising keeps a bounded cache of words, which this vocabulary encodes independently of each other
because white space always parts them; the cache changes the speed and never the ids.

Defined results. Null or empty text: the end token alone, one piece of length 1. Repeated rows and null
ids: each row is a document of its own. Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import accumulate, batched, chain, compress, pairwise
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, release_memory, stage_table, text_blocks, worker_cache

CAPACITY, END = 4096, 1
CACHED_WORDS = 800_000
#: Words the library encodes in one call: what it makes of each takes a hundred times the room of its ids.
AT_ONCE = 4096
#: Marks that may follow a word; an apostrophe may start a contraction and isn't among them.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class CapacityTree:
    """Segment tree over capacities 0..n: how many ranges of open bins have each, and the smallest one from a length on."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(n + 1)]

    def _add(self, capacity: int, change: int) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += change
            i >>= 1

    def push(self, capacity: int, bins: tuple[int, int]) -> None:
        if capacity:
            self.ranges[capacity].append(bins)
            self._add(capacity, 1)

    def pop(self, capacity: int) -> tuple[int, int]:
        self._add(capacity, -1)
        return self.ranges[capacity].pop()

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that has an open bin."""
        i = length + self.leaves
        if self.count[i]:
            return length
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit_plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces to a bin, room before), sorted; counts[l]: pieces of length l."""
    tree, plan, bins = CapacityTree(capacity), [], 0
    for length in range(capacity, 0, -1):
        left, rank = int(counts[length]), 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, opened = capacity, -(-left // (capacity // length))
                tree.push(room, (bins, opened))
                bins += opened
            first, n = tree.pop(room)
            each = room // length
            plan.append((length, rank, first, each, room))
            full = min(n, left // each)
            taken = full * each
            if full:
                tree.push(room - each * length, (first, full))
            if left > taken and n > full:
                tree.push(room - (left - taken) * length, (first + full, 1))
                taken, full = left, full + 1
            if n > full:
                tree.push(room, (first + full, n - full))
            left, rank = left - taken, rank + taken
    return np.array(sorted(plan), dtype=np.int64).reshape(-1, 5)


class WordEncoder:
    """Token ids of texts, little-endian 32-bit, by a bounded cache of words."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and each thread would keep memory of its own
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.plain, self.ends = None, None
        rules = json.loads(vocabulary)
        suffix = rules["model"].get("end_of_word_suffix")
        if suffix:  # lower-case Latin letters need no normalising, and ids with the suffix tell words apart
            rules["normalizer"] = None
            rules["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
            self.plain = Tokenizer.from_str(json.dumps(rules))
            ids = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(ids.values()) + 1, dtype=bool)
            self.ends[[i for token, i in ids.items() if token.endswith(suffix)]] = True
        self.words: dict[bytes, bytes] = {}

    def _learn(self, unknown: set[bytes]) -> None:
        """Letters and the marks of punctuation after them are encoded apart; other words as they are."""
        listed = list(unknown)
        texts = b"\n".join(listed).decode().split("\n")
        cores = [t.rstrip(_TAIL) for t in texts]
        simple = [c.isalpha() and (c.isascii() or max(c) <= "\xff") for c in cores]
        lower = "\n".join(compress(cores, simple)).lower().split("\n") if any(simple) else []
        tails = [t[len(c) :] for t, c in zip(compress(texts, simple), compress(cores, simple), strict=True)]
        tail_ids = self._each(set(tails))
        core_ids = self._letters(set(lower))
        self.words.update(zip(compress(listed, simple), map(add, map(core_ids.__getitem__, lower), map(tail_ids.__getitem__, tails)), strict=True))
        others = {t for t, plain in zip(texts, simple, strict=True) if not plain}
        self.words.update((t.encode(), ids) for t, ids in self._each(others).items())

    def _each(self, texts: set[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        for part in batched(texts, AT_ONCE):
            for t, f in zip(part, self.tokenizer.encode_batch_fast(list(part), add_special_tokens=False), strict=True):
                found[t] = np.array(f.ids, dtype="<u4").tobytes()
        return found

    def _letters(self, texts: set[str]) -> dict[str, bytes]:
        """Words of lower-case Latin letters, many in one go: each ends with the only id that has the suffix."""
        if self.plain is None:
            return self._each(texts)
        found: dict[str, bytes] = {}
        for part in batched(texts, AT_ONCE):
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = [0, *(4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()]
            if len(cuts) != len(part) + 1:
                found |= self._each(set(part))
                continue
            raw = ids.tobytes()
            found.update(zip(part, [raw[a:b] for a, b in pairwise(cuts)], strict=True))
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        split = [t.split() for t in texts]
        words = list(chain.from_iterable(split))
        ids = list(map(self.words.get, words))
        gaps = [i for i, found in enumerate(ids) if found is None]
        if gaps:
            unknown = {words[i] for i in gaps}
            if len(self.words) + len(unknown) > CACHED_WORDS:
                self.words.clear()
            self._learn(unknown)
            found = self.words
            for i in gaps:
                ids[i] = found[words[i]]
        ends = list(accumulate(map(len, split), initial=0))
        return [b"".join(ids[a:b]) for a, b in pairwise(ends)]


def encoder(vocabulary: str) -> WordEncoder:
    return worker_cache(f"words {zlib.crc32(vocabulary.encode())}", lambda: WordEncoder(vocabulary))


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: Broadcast, capacity: int, end: int) -> Iterator[pa.RecordBatch]:
    """Pieces of each document; ``idx`` numbers pieces of one length in this partition."""
    words, part, seen = encoder(vocabulary.value), TaskContext.get().partitionId(), [0] * (capacity + 1)
    last = np.uint32(end).astype("<u4").tobytes()
    for batch in batches:
        release_memory()
        row, piece, start, length, crc, idx = [], [], [], [], [], []
        for block in text_blocks(batch.column(1)):
            for i, ids in enumerate(words.encode([block.text(i) for i in range(block.rows)])):
                ids += last
                for k in range(0, len(ids) // 4, capacity):
                    cut = ids[4 * k : 4 * (k + capacity)]
                    n = len(cut) // 4
                    row.append(block.first + i)
                    piece.append(k // capacity)
                    start.append(k)
                    length.append(n)
                    crc.append(zlib.crc32(cut))
                    idx.append(seen[n])
                    seen[n] += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc)), pa.array([part] * len(row), pa.int32()), pa.array(idx, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "idx"],
        )


def _place(batches: Iterator[pa.RecordBatch], plan: Broadcast, capacity: int) -> Iterator[pa.RecordBatch]:
    lengths, ranks, bins, each, room = plan.value.T
    keys = (lengths << 48) + ranks
    for batch in batches:
        length, rank = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "rank"))
        run = np.searchsorted(keys, (length << 48) + rank, "right") - 1
        k = rank - ranks[run]
        found = [bins[run] + k // each[run], capacity - room[run] + k % each[run] * length]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, found)], names=[*batch.schema.names[:5], "sequence_id", "offset"])


def pack(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document."""
    spark = docs.sparkSession
    prepare(spark)
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    shape = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = stage_table(docs.select("doc_id", "text").mapInArrow(partial(_pieces, vocabulary=vocabulary, capacity=capacity, end=end), f"{shape}, part int, idx long"), "pieces")
    counts = stage_table(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    total = np.zeros(capacity + 1, dtype=np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # capacity rows at most
        total[r["length"]] = r["n"]
    plan = spark.sparkContext.broadcast(best_fit_plan(total, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # The counts grow with the partitions, so they are merged and not broadcast.
    ranked = pieces.join(before.hint("merge"), ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("idx")).alias("rank"))
    return ranked.mapInArrow(partial(_place, plan=plan, capacity=capacity), f"{shape}, sequence_id long, offset long")
