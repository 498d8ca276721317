"""Learned operators: exact code lengths by a plain loop, and held-out accuracy."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from telemark.llm import op09_language_id, op10_quality, queries
from telemark.llm.common import table


def code_length(samples, text, order):
    """PPM with escapes by method C, a byte at a time."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for s in samples:
        padded = b"   " + s
        for i in range(3, len(padded)):
            for k in range(order + 1):
                counts[k][padded[i - k : i]][padded[i]] += 1
    bits, padded = 0.0, b"   " + text
    for i in range(3, len(padded)):
        for k in range(order, -1, -1):
            seen = counts[k].get(padded[i - k : i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if padded[i] in seen:
                bits -= math.log2(seen[padded[i]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    samples = {"a": [b"the cat sat on the mat", b"that hat"], "b": ["der Hund läuft über".encode(), b"und"], "c": [b"x"]}
    trees = op09_language_id.Trees(samples)
    texts = ["the hat", "der über", "", "zzz \x01 the the cat sat", "x", "läuft the"]
    bits, size = op09_language_id.code_lengths(pa.array(texts), trees, window=5)
    for i, t in enumerate(texts):
        assert size[i] == len(t.encode())
        for j, name in enumerate(trees.languages):
            assert math.isclose(bits[i, j], code_length(samples[name], t.encode(), len(trees.counts) - 1), rel_tol=1e-4, abs_tol=1e-4)


def test_language_accuracy(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").collect()}
    rows = queries.QUERIES["op9_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_nothing(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "123 ...", "en"), (3, "some words here", "en"), (4, "des mots ici", "fr")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in op09_language_id.identify_documents(docs).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[1].score) == ("und", "und", 0.0)
    unlabelled = op09_language_id.identify_documents(docs.selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def naive_chunks(text, net):
    """Max-pooled chunks, a chunk at a time."""
    taps, data = net.taps(), np.frombuffer(text, np.uint8)
    padded = np.concatenate([data, np.zeros(op10_quality.WIDTH, np.uint8)])
    sums = np.array([sum(taps[j][padded[i + j]] for j in range(op10_quality.WIDTH)) for i in range(len(data))])
    count = int(op10_quality.chunk_counts(np.array([len(data)]))[0])
    return [np.maximum(sums[c * op10_quality.STRIDE : c * op10_quality.STRIDE + op10_quality.CHUNK].max(0) + net.w["bias"], 0) for c in range(count)]


def test_chunks_cover_whole_texts():
    net, rng = op10_quality.Network(), np.random.default_rng(0)
    sizes = [0, 1, 63, 64, 65, 255, 256, 257, 448, 449, 1000, 40_000]
    texts = [rng.integers(0, 256, n, dtype=np.uint8) for n in sizes]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    chunks, bounds = op10_quality.pooled_chunks(np.concatenate(texts), offsets, net.taps(), net.w["bias"])
    for i, t in enumerate(texts):
        want = naive_chunks(t.tobytes(), net)
        assert bounds[i + 1] - bounds[i] == len(want)
        assert np.allclose(chunks[bounds[i] : bounds[i + 1]], np.array(want).reshape(-1, op10_quality.FILTERS), atol=1e-5)


def test_quality_is_learned(spark):
    """Held-out documents of the larger table, by the area under the curve."""
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = [r for r in queries.QUERIES["op10_quality_classifier"](spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    good, bad = ([r.score for r in rows if truth[r.doc_id] == q] for q in (1, 0))
    assert np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good]) > 0.85
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    got = op10_quality.score_documents(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 1)] * 2
