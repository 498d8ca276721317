"""Operator 10: quality scores from a byte-level convolutional network in numpy.

Every byte position of a text feeds learned filters over ``WIDTH`` bytes (embedding times kernel, kept
as one table per tap, so inference is look-ups and sums). Filter outputs are max-pooled over
overlapping chunks of 256 positions, 192 apart, that cover the whole text; the mean, maximum and
minimum over chunks and the log length go through one hidden layer to one probability.

Learning: Adam on the driver over a bounded sample: of each class about ``per_class`` labelled documents by a
hash of doc_id, twice as many at most whatever ids are repeated, from each at most ``max_bytes`` characters at a
place fixed by its hash; classes keep their
true weights, and short pieces of half the texts are added. Equal rows count once. Rows without text, doc_id or a 0/1 label, and those of the held-out fold, teach nothing.

Defined results. Null or empty text: the score of a text without chunks. Very long texts: all chunks, a text at a time. No labels at all: 0.5. Repeated
rows: equal scores. A doc_id labelled twice teaches with each label. Empty table: no rows. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_fold, prepare, text_blocks

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
WIDTH, FILTERS, EMBED, HIDDEN = 6, 24, 8, 16
CELL, CHUNK_CELLS, STRIDE_CELLS = 64, 4, 3
CHUNK, STRIDE = CELL * CHUNK_CELLS, CELL * STRIDE_CELLS


class Network:
    """Weights, and the sums that learning needs."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        normal = lambda *s: rng.normal(size=s).astype(np.float32)
        self.w = {
            "embed": normal(256, EMBED) * 0.5,
            "kernel": normal(WIDTH, EMBED, FILTERS) * np.float32((WIDTH * EMBED) ** -0.5),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(3 * FILTERS + 1, HIDDEN) * np.float32((3 * FILTERS) ** -0.5),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN) * np.float32(HIDDEN**-0.5),
            "out_bias": np.zeros(1, np.float32),
        }

    def taps(self) -> np.ndarray:
        """What byte b adds to each filter at tap j: [j, b, filter]."""
        return np.einsum("be,jef->jbf", self.w["embed"], self.w["kernel"])

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.maximum(pooled @ self.w["hidden"] + self.w["hidden_bias"], 0)
        return hidden, hidden @ self.w["out"] + self.w["out_bias"]


def combine(chunks: np.ndarray, bounds: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Mean, maximum and minimum over the chunks of each text, and its log length."""
    out = np.zeros((len(bounds) - 1, 3 * FILTERS + 1), dtype=np.float32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        at = bounds[full]
        out[full, :FILTERS] = np.add.reduceat(chunks, at, axis=0) / np.diff(bounds)[full, None]
        out[full, FILTERS : 2 * FILTERS] = np.maximum.reduceat(chunks, at, axis=0)
        out[full, 2 * FILTERS : -1] = np.minimum.reduceat(chunks, at, axis=0)
    out[:, -1] = np.log1p(size) / 8
    return out


def chunk_counts(size: np.ndarray) -> np.ndarray:
    cells = -(-size // CELL)
    return np.where(size > 0, np.maximum(1, -(-(cells - 1) // STRIDE_CELLS)), 0)


def pooled_chunks(data: np.ndarray, offsets: np.ndarray, taps: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Max-pooled filter outputs of the chunks of each text, and where each text's chunks begin."""
    size = np.diff(offsets)
    begin = offsets[:-1] + np.arange(len(size)) * (WIDTH - 1)
    padded = np.zeros(len(data) + len(size) * (WIDTH - 1) + WIDTH, dtype=np.uint8)
    padded[np.arange(len(data)) + np.repeat(np.arange(len(size)) * (WIDTH - 1), size)] = data
    full = np.flatnonzero(size)
    cells = -(-size[full] // CELL)
    first = np.cumsum(cells) - cells
    starts = np.repeat(begin[full] - CELL * first, cells) + CELL * np.arange(cells.sum())
    ends = np.minimum(starts + CELL, np.repeat(begin[full] + size[full], cells))
    best = np.empty((len(starts), FILTERS), dtype=np.float32)
    for at in range(0, len(starts), 512):
        s, e = starts[at : at + 512], ends[at : at + 512]
        lo, hi = s[0], e[-1]
        sums = taps[0][padded[lo:hi]]
        for j in range(1, WIDTH):
            sums += taps[j][padded[lo + j : hi + j]]
        cuts = np.stack([s, e], axis=1).ravel() - lo
        cuts[-1] = cuts[-2]
        best[at : at + 512] = np.maximum.reduceat(sums, cuts, axis=0)[::2]
        best[at + len(s) - 1] = sums[s[-1] - lo :].max(axis=0)
    count = chunk_counts(size)
    bounds = np.concatenate([[0], np.cumsum(count)])
    own = count[full]
    chunk_first = np.repeat(first, own) + STRIDE_CELLS * (np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own))
    last = np.repeat(first + cells - 1, own)
    chunks = best[chunk_first]
    for k in range(1, CHUNK_CELLS):
        chunks = np.maximum(chunks, best[np.minimum(chunk_first + k, last)])
    return np.maximum(chunks + bias, 0), bounds


def _training_chunks(text: bytes, rng: np.random.Generator, most: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text, dtype=np.uint8)
    count = int(chunk_counts(np.array([len(data)]))[0])
    picked = np.arange(count) if count <= most else np.sort(rng.choice(count, most, replace=False))
    rows = np.zeros((len(picked), CHUNK + WIDTH - 1), dtype=np.uint8)
    for i, c in enumerate(picked):
        piece = data[c * STRIDE : c * STRIDE + CHUNK + WIDTH - 1]
        rows[i, : len(piece)] = piece
    return rows, np.minimum(CHUNK, len(data) - picked * STRIDE)


def with_crops(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, share: float = 0.5) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Adds short pieces of some texts, so that a text isn't judged by being short."""
    rng, texts, labels, weights = np.random.default_rng(11), list(texts), list(labels), list(weights)
    for i in range(len(texts)):
        n = int(rng.integers(4, 250) if rng.random() < 0.7 else rng.integers(3, 25))
        if rng.random() < share and n < len(texts[i]):
            at = int(rng.integers(0, len(texts[i]) - n))
            texts.append(texts[i][at : at + n])
            labels.append(labels[i])
            weights.append(weights[i])
    return texts, np.array(labels, dtype=np.float32), np.array(weights, dtype=np.float32)


def learn_network(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, epochs: int = 20, most_chunks: int = 8, batch: int = 48, rate: float = 0.004) -> Network:
    """Adam over minibatches; the gradient of a max-pooled filter flows to its one best position."""
    net, rng = Network(), np.random.default_rng(7)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    size = np.array([len(t) for t in texts], dtype=np.int64)
    step = 0
    for epoch in range(epochs):
        for picked in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // batch)):
            made = [_training_chunks(texts[i], rng, most_chunks) for i in picked]
            bounds = np.concatenate([[0], np.cumsum([len(m[0]) for m in made])])
            x, valid = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
            taps = net.taps()
            sums = taps[0][x[:, :CHUNK]]
            for j in range(1, WIDTH):
                sums += taps[j][x[:, j : j + CHUNK]]
            sums[np.arange(CHUNK)[None, :] >= valid[:, None]] = -np.inf
            place = sums.argmax(axis=1)
            chunks = np.maximum(np.take_along_axis(sums, place[:, None, :], axis=1)[:, 0] + net.w["bias"], 0)
            pooled = combine(chunks, bounds, size[picked])
            hidden, logit = net.head(pooled)
            error = ((1 / (1 + np.exp(-logit)) - labels[picked]) * weights[picked] / weights[picked].sum()).astype(np.float32)
            d_hidden = error[:, None] * net.w["out"] * (hidden > 0)
            d_pooled = d_hidden @ net.w["hidden"].T
            doc = np.repeat(np.arange(len(picked)), np.diff(bounds))
            d_mean, d_max, d_min = (d_pooled[:, k * FILTERS : (k + 1) * FILTERS] for k in range(3))
            d_chunk = d_mean[doc] / np.diff(bounds)[doc, None]
            d_chunk += d_max[doc] * (chunks == pooled[doc, FILTERS : 2 * FILTERS]) + d_min[doc] * (chunks == pooled[doc, 2 * FILTERS : -1])
            d_chunk *= chunks > 0
            c, f = np.nonzero(d_chunk)
            g = d_chunk[c, f]
            grad = {"out": hidden.T @ error, "out_bias": error.sum(keepdims=True), "hidden": pooled.T @ d_hidden, "hidden_bias": d_hidden.sum(0), "bias": d_chunk.sum(0)}
            grad["embed"], grad["kernel"] = np.zeros_like(net.w["embed"]), np.zeros_like(net.w["kernel"])
            for j in range(WIDTH):
                byte = x[c, place[c, f] + j]
                table = np.bincount(byte.astype(np.int64) * FILTERS + f, weights=g, minlength=256 * FILTERS).reshape(256, FILTERS).astype(np.float32)
                grad["kernel"][j] = net.w["embed"].T @ table
                grad["embed"] += table @ net.w["kernel"][j].T
            step += 1
            now = rate * min(1.0, 2.0 * (1 - epoch / epochs))
            for k, v in grad.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                net.w[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def probabilities(column: pa.Array, net: Network, taps: np.ndarray) -> np.ndarray:
    out = np.zeros(len(column))
    for block in text_blocks(column):
        chunks, bounds = pooled_chunks(block.data, block.offsets, taps, net.w["bias"])
        logit = net.head(combine(chunks, bounds, np.diff(block.offsets)))[1]
        out[block.first : block.first + block.rows] = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))
    return out.round(6)


def _score(batches: Iterator[pa.RecordBatch], net: Broadcast, keep: int) -> Iterator[pa.RecordBatch]:
    taps = net.value.taps()
    for batch in batches:
        found = pa.array(probabilities(batch.column(keep), net.value, taps))
        yield pa.RecordBatch.from_arrays([*batch.columns[:keep], found], names=[*batch.schema.names[:keep], "score"])


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 900, max_bytes: int = 8192) -> Network | None:
    """A network from a bounded sample of labelled documents; None if nothing is labelled."""
    usable = labels.select("doc_id", "quality").filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    if not counts:
        return None
    place = F.abs(F.xxhash64("doc_id") % (1 << 20)) / (1 << 20)
    share = F.create_map(*(F.lit(x) for q, n in counts.items() for x in (q, min(1.0, per_class / n))))
    # The hash keeps about per_class ids of each class; the rank is the proven bound of what is broadcast and of what is collected.
    rank = F.row_number().over(Window.partitionBy("quality").orderBy("place", "doc_id", "h"))
    near = usable.filter(place < share[F.col("quality")]).distinct().withColumn("place", place)
    picked = near.withColumn("h", F.lit(0)).withColumn("rank", rank).filter(F.col("rank") <= 2 * per_class).select("doc_id", "quality", "place")
    length = F.length("text")
    begin = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(length - max_bytes + 1, F.lit(1))) + 1
    pieces = (
        docs.select("doc_id", "text")
        .filter(F.col("text").isNotNull())
        .join(F.broadcast(picked), "doc_id")
        .groupBy("quality", "place", "doc_id", F.xxhash64("text").alias("h"))
        .agg(F.min(F.col("text").substr(begin.cast("int"), F.lit(max_bytes))).alias("piece"))
    )
    rows = pieces.withColumn("rank", rank).filter(F.col("rank") <= 2 * per_class).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["piece"]))
    y = np.array([r["quality"] for r in rows], dtype=np.float32)
    found = {q: max(1, int((y == q).sum())) for q in (0, 1)}
    total = sum(counts.values())
    weights = np.array([counts[q] / total / found[q] * len(rows) for q in y.astype(int)], dtype=np.float32)
    return learn_network(*with_crops([r["piece"].encode() for r in rows], y, weights))


def quality(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with the score and the prediction for each whole text."""
    prepare(docs.sparkSession)
    if net is None:
        scored = docs.select(*keep, F.lit(0.5).alias("score"))
    else:
        source = docs.select(*keep, "text")
        fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[: len(keep)])
        shared = docs.sparkSession.sparkContext.broadcast(net)
        scored = source.mapInArrow(partial(_score, net=shared, keep=len(keep)), fields + "score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of documents."""
    out = quality(docs, learn(docs, labels), ["doc_id"])
    return out.select("doc_id", in_fold(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score", "predicted")
