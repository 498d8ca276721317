"""Operator 4: nearest neighbours by an inverted file with product-quantised residuals.

Coarse centroids (k-means) make the cells. Where cells would hold more than ``LIST`` vectors on average, each is
divided by the nearest of a set of residual centroids that all cells share, so the number of lists grows with the
table although centroids come from a sample. A vector's residual to its list's centre is coded by one of 256
sub-centroids in each of sixteen groups of dimensions; how far the vector lies from what its code says is kept beside it.
A query visits its nearest lists, ranks their codes by asymmetric distance tables and reranks the best ``RERANK`` of
each block by exact distances. What else the codes can't rule out, as it may lie nearer than the eleventh of those, is
compared too, so within the lists visited nothing is lost, however coarse the codes are for a block.

Learning uses a bounded sample: distinct vectors by hash, ``SAMPLE`` at most and ``SAMPLE_BYTES`` at most. From it come centroids,
codebooks and the number of cells and lists to visit: the fewest that reach ``RECALL`` in the sample, whose
neighbours lie further apart than those of all vectors, both for ``ASKED`` of its own vectors and for as many of the
queries, which may lie elsewhere than most rows. Every vector is indexed. Queries whose lists
hold too few vectors visit all lists in a second search.

Equal vectors are collapsed first and keep their 11 smallest ids, which is all that ten neighbours of
any query can need; equal query vectors are searched once. Lists are dealt into blocks of ``BLOCK``
vectors by ``BLOCK`` queries or so, so one dense list never meets in one task, and a block sends out
11 neighbours per query.

Defined results. Null, zero and differently long vectors and those with null or non-finite components
take no part, nor do rows without id (the length that most vectors have counts). Ties go to the smaller
vec_id. Repeated rows count once. Fewer than ten other vectors: all found. Empty table or no valid
query: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, stage_table

NEAREST, STEP = 10, 100
SAMPLE, SAMPLE_BYTES, PER_CENTROID, GROUPS, CODES = 32_768, 32 << 20, 16, 16, 256
LIST, RERANK, BLOCK, RECALL, ASKED = 1_024, 32, 8_192, 0.98, 200
#: Query and vector pairs whose rough distances are held at once.
_PAIRS = 1 << 20


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centers, 1)[:, 0]
        count = np.bincount(near, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        centers = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], x[rng.integers(0, len(x), k)])
    return centers


def nearest(x: np.ndarray, centers: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k nearest centers of each row, nearest first."""
    out = np.empty((len(x), k), dtype=np.int64)
    norms = (centers**2).sum(1)
    for at in range(0, len(x), 2048):
        d = norms - 2 * (x[at : at + 2048] @ centers.T)
        if k == 1:
            out[at : at + 2048, 0] = d.argmin(1)
        else:
            picked = np.argpartition(d, k - 1, axis=1)[:, :k] if k < d.shape[1] else np.tile(np.arange(k), (len(d), 1))
            out[at : at + 2048] = np.take_along_axis(picked, np.take_along_axis(d, picked, 1).argsort(1, kind="stable"), 1)
    return out


class Index:
    """Centroids, shared residual centroids, codebooks and numbers to visit, learned from a sample of ``total`` vectors and of queries."""

    def __init__(self, sample: np.ndarray, total: int, list_size: int = LIST, asked: np.ndarray | None = None):
        most = max(1, len(sample) // PER_CENTROID)
        self.cells = kmeans(sample, max(1, min(int(total**0.5), most)))
        cell = nearest(sample, self.cells, 1)[:, 0]
        residuals = sample - self.cells[cell]
        parts = min(most, -(-total // (len(self.cells) * list_size)))
        self.subs = kmeans(residuals, parts, 8) if parts > 1 else np.zeros((1, sample.shape[1]))
        sub = nearest(residuals, self.subs, 1)[:, 0]
        residuals = residuals - self.subs[sub]
        self.groups = [p for p in np.array_split(np.arange(sample.shape[1]), min(GROUPS, sample.shape[1])) if len(p)]
        self.books = [kmeans(residuals[:, p], min(CODES, len(sample)), 8) for p in self.groups]
        own = sample[np.linspace(0, len(sample) - 1, min(ASKED, len(sample))).astype(int)]
        reached = [self._calibrate(x, sample, cell, cell * len(self.subs) + sub) for x in (own, asked) if x is not None and len(x)]
        self.visited_cells, self.visited_lists = (max(n) for n in zip(*reached, strict=True))

    def centre(self, number: np.ndarray | int) -> np.ndarray:
        return self.cells[number // len(self.subs)] + self.subs[number % len(self.subs)]

    def _calibrate(self, asked: np.ndarray, sample: np.ndarray, cell: np.ndarray, number: np.ndarray) -> tuple[int, int]:
        """Fewest cells, and lists in them, that hold ``RECALL`` of the true neighbours of some queries."""
        true = nearest(asked, sample, min(NEAREST + 1, len(sample)))
        self.visited_cells, self.visited_lists = len(self.cells), len(self.cells) * len(self.subs)
        order = nearest(asked, self.cells, len(self.cells))
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(len(self.cells))[None, :].repeat(len(asked), 0), 1)
        needed = np.sort(np.take_along_axis(rank, cell[true], 1).ravel())
        reached = lambda x, share: int(x[min(len(x) - 1, int(share * len(x)))]) + 1
        if len(self.subs) == 1:
            return (reached(needed, RECALL),) * 2
        self.visited_cells = reached(needed, (1 + RECALL) / 2)
        needed = []
        for q, own in zip(asked, number[true], strict=True):
            listed = self.lists(q[None, :])[0]
            place = {v: i for i, v in enumerate(listed.tolist())}
            needed += [place.get(v, len(listed) - 1) for v in own.tolist()]
        return self.visited_cells, reached(np.sort(needed), RECALL)

    def lists(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the lists that each row visits, nearest first."""
        cells = nearest(x, self.cells, self.visited_cells)
        n = len(self.subs)
        if n == 1:
            return cells
        out = np.empty((len(x), min(self.visited_lists, cells.shape[1] * n)), dtype=np.int64)
        norms = (self.subs**2).sum(1)
        for i, own in enumerate(cells):
            away = x[i] - self.cells[own]
            d = ((away**2).sum(1)[:, None] - 2 * away @ self.subs.T + norms).ravel()
            k = out.shape[1]
            picked = np.argpartition(d, k - 1)[:k] if k < len(d) else np.arange(len(d))
            picked = picked[d[picked].argsort(kind="stable")]
            out[i] = own[picked // n] * n + picked % n
        return out

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and code of each row."""
        cell = nearest(x, self.cells, 1)[:, 0]
        residuals = x - self.cells[cell]
        sub = nearest(residuals, self.subs, 1)[:, 0]
        residuals -= self.subs[sub]
        return cell * len(self.subs) + sub, np.stack([nearest(residuals[:, p], b, 1)[:, 0] for p, b in zip(self.groups, self.books, strict=True)], axis=1).astype(np.uint8)

    def error(self, x: np.ndarray, number: np.ndarray, code: np.ndarray) -> np.ndarray:
        """How far each row lies from what its list and code say of it."""
        told = self.centre(number)
        for j, (p, b) in enumerate(zip(self.groups, self.books, strict=True)):
            told[:, p] += b[code[:, j]]
        return np.sqrt(((x - told) ** 2).sum(1))

    def rough(self, queries: np.ndarray, number: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric squared distances [query, code] under one list: a table look-up for each group of dimensions."""
        away = queries - self.centre(number)
        out = np.zeros((len(queries), len(codes)), dtype=np.float32)
        for j, (p, b) in enumerate(zip(self.groups, self.books, strict=True)):
            table = ((away[:, p] ** 2).sum(1)[:, None] - 2 * away[:, p] @ b.T + (b**2).sum(1)).astype(np.float32)
            out += table[:, codes[:, j]]
        return out


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _encode(batches, index: Broadcast):
    """(embedding, ids, least) rows with list, code and the code's error."""
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0))
            number, code = index.value.encode(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(index.value.error(x, number, code))], names=[*batch.schema.names, "list", "code", "error"])


def _probe(batches, index: Broadcast, everywhere: bool):
    """(h1, h2, embedding) rows, one for each list to visit."""
    own = index.value
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            if everywhere:
                numbers = np.tile(np.arange(len(own.cells) * len(own.subs)), (part.num_rows, 1))
            else:
                numbers = own.lists(matrix(part.column(2)))
            row = pa.array(np.repeat(np.arange(part.num_rows), numbers.shape[1]))
            yield pa.RecordBatch.from_arrays([*(c.take(row) for c in part.columns), pa.array(numbers.ravel())], names=[*part.schema.names, "list"])


_FOUND = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("score", pa.float64()), ("least", pa.int64()), ("ids", pa.list_(pa.int64()))])


def _open(own: Index, number: int, q: np.ndarray, codes: np.ndarray, error: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs among which the 11 nearest of a block are, ordered by both.

    The best by their codes are measured; a vector is out if even its code less the code's error lies beyond the
    eleventh of those, or if its distance does by a matrix product, each with room for rounding.
    """
    rough = own.rough(q, number, codes)
    best = np.argpartition(rough, RERANK - 1, axis=1)[:, :RERANK]
    reach = np.sort(((vectors[best] - q[:, None, :]) ** 2).sum(2), axis=1)[:, NEAREST]
    centre = own.centre(number)
    x, away = vectors - centre, q - centre
    norms = (away**2).sum(1)
    least = np.sqrt(np.maximum(rough, 0)) * (1 - 1e-5) - error - 1e-6 * np.sqrt(norms)[:, None]
    near = (least <= np.sqrt(reach)[:, None]) | ~np.isfinite(rough)
    some = near.any(0).nonzero()[0]
    room = (x[some] ** 2).sum(1) + norms[:, None]
    squared = room - 2 * away @ x[some].T
    row, at = (near[:, some] & (squared <= reach[:, None] + 1e-12 * q.shape[1] * (room + reach[:, None]))).nonzero()
    pairs = np.concatenate([row * len(x) + some[at], (np.arange(len(q))[:, None] * len(x) + best).ravel()])
    return np.divmod(np.unique(pairs), len(x))


def _search(queries: pa.Table, block: pa.Table, index: Broadcast) -> pa.Table:
    """The 11 nearest vectors in this block for each query: codes rank, original vectors decide."""
    if queries.num_rows == 0 or block.num_rows == 0:
        return _FOUND.empty_table()
    own, number, size = index.value, block["list"][0].as_py(), block.num_rows
    codes = np.frombuffer(b"".join(block["code"].to_pylist()), np.uint8).reshape(size, -1)
    vectors, asked, least, error = matrix(block["embedding"]), matrix(queries["embedding"]), block["least"].to_numpy(), block["error"].to_numpy()
    order = least.argsort(kind="stable")  # so that a stable sort by distance breaks ties by id
    codes, vectors, error = codes[order], vectors[order], error[order]
    rows, picks, scores = [], [], []
    step = max(1, _PAIRS // max(size, RERANK * vectors.shape[1]))
    for at in range(0, len(asked), step):
        q = asked[at : at + step]
        row, picked = _open(own, number, q, codes, error, vectors) if size > RERANK else np.divmod(np.arange(len(q) * size), size)
        piece = max(1, _PAIRS // vectors.shape[1])
        exact = np.concatenate([np.sqrt(((vectors[picked[i : i + piece]] - q[row[i : i + piece]]) ** 2).sum(1)) for i in range(0, len(row), piece)])
        best = np.lexsort((picked, exact, row))
        ordered = row[best]
        best = best[np.arange(len(best)) - np.searchsorted(ordered, ordered) <= NEAREST]
        rows.append(at + row[best])
        picks.append(order[picked[best]])
        scores.append(exact[best])
    rows, picks = pa.array(np.concatenate(rows)), pa.array(np.concatenate(picks))
    return pa.Table.from_arrays([queries["h1"].take(rows), queries["h2"].take(rows), pa.array(np.concatenate(scores)), block["least"].take(picks), block["ids"].take(picks)], schema=_FOUND)


def valid_vectors(df: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) rows that take part."""
    ok = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(embedding, x -> x <> 0)")
    rows = df.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(ok).distinct()
    size = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("embedding") == (size["d"] if size else -1))


def search(asked: DataFrame, coded: DataFrame, index: Broadcast, everywhere: bool = False) -> DataFrame:
    """(h1, h2, embedding) queries against coded vectors: (h1, h2, score, least, ids) of the 11 nearest vectors found."""
    kind = dict(asked.dtypes)["embedding"]
    probes = stage_table(asked.mapInArrow(partial(_probe, index=index, everywhere=everywhere), f"h1 long, h2 long, embedding {kind}, list long"), "probes")
    # Lists that are dealt into several blocks, on either side: no more rows than such blocks, so mostly none.
    dealt = lambda d, name: d.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name)).filter(F.col(name) > 1)
    blocks = stage_table(dealt(coded, "vectors").join(dealt(probes, "queries"), "list", "full"), "blocks")
    vectors, queries = (F.coalesce(c, F.lit(1)) for c in ("vectors", "queries"))
    left = probes.join(blocks, "list", "left").select("h1", "h2", "embedding", "list", F.pmod("h1", queries).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0), vectors - 1)).alias("vb"))
    right = coded.join(blocks, "list", "left").select(*coded.columns, F.pmod(F.xxhash64("embedding"), vectors).cast("int").alias("vb"), F.explode(F.sequence(F.lit(0), queries - 1)).alias("qb"))
    keys = ["list", "vb", "qb"]
    meet = lambda a, b: _search(a, b, index)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "h1 long, h2 long, score double, least long, ids array<long>")
    return found.withColumn("n", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("score", "least"))).filter(F.col("n") <= NEAREST + 1).drop("n")


def nearest_vectors(df: DataFrame, step: int = STEP, list_size: int = LIST) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest vectors of each row whose vec_id is divisible by ``step``."""
    spark = df.sparkSession
    prepare(spark)
    rows = stage_table(valid_vectors(df), "vectors")
    kind = dict(rows.dtypes)["embedding"]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("n") <= NEAREST + 1)
    distinct = stage_table(ranked.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("least", F.col("ids")[0]), "distinct-vectors")
    total = distinct.count()
    if not total:
        return empty
    place = F.abs(F.xxhash64("embedding") % (1 << 20)) / (1 << 20)
    first = distinct.select("embedding").limit(1).toArrow()
    most = max(1_000, min(SAMPLE, SAMPLE_BYTES // (4 * len(first["embedding"][0]))))
    sample = distinct.filter(place < min(1.0, 0.9 * most / total)).select("embedding").limit(most).toArrow()
    sample = matrix((sample if sample.num_rows else first)["embedding"])
    sample = sample[np.lexsort(sample.T)]  # file order must not matter
    hashes = [F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2")]
    wanted = rows.filter(F.col("vec_id") % step == 0)
    asked = wanted.select(*hashes, "embedding").dropDuplicates(["h1", "h2"])
    some = asked.orderBy("h1", "h2").limit(ASKED).select("embedding").toArrow()["embedding"]
    index = spark.sparkContext.broadcast(Index(sample, total, list_size, matrix(some) if len(some) else None))

    shape = f"embedding {kind}, ids array<long>, least long, list long, code binary, error double"
    coded = stage_table(distinct.select("embedding", "ids", "least").mapInArrow(partial(_encode, index=index), shape), "codes")
    found = stage_table(search(asked, coded, index), "nearest")
    enough = found.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= min(NEAREST + 1, total)).select("h1", "h2")
    short = stage_table(asked.join(enough, ["h1", "h2"], "left_anti"), "short")
    if not short.isEmpty():
        found = found.join(enough, ["h1", "h2"], "left_semi").union(search(short, coded, index, everywhere=True))
    each = wanted.select(F.col("vec_id").alias("query_id"), *hashes).join(found, ["h1", "h2"]).select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= NEAREST).select("query_id", "rank", "vec_id", "score")
