"""Values of whole queries by plain loops: predictions, edge rows, and texts longer than any block or window."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_brute_force import base_by_pattern, check_op2, check_packing, simhash, smallest_linked
from test_constructed import check_spans, notices_by_hand
from test_edges import CLASHES, DOCS, prose, rows
from test_learned import naive_chunks

from telemark.llm import op05_packing, op06_sentencepiece, op09_language_id, op10_quality, queries
from telemark.llm.common import table


def levels_of(trees):
    """For each language and order: counts by context and byte, and their sums."""
    found = []
    for j in range(len(trees.languages)):
        found.append([])
        for level in trees.counts:
            seen = defaultdict(dict)
            for key, n in zip(*(x.tolist() for x in level[j]), strict=True):
                seen[key >> 8][key & 255] = n
            found[-1].append((seen, {c: (sum(v.values()), len(v)) for c, v in seen.items()}))
    return found


def predicted(languages, levels, text):
    """Language, score and bits a byte of a text, a byte at a time from the counts alone."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0, 0.0
    raw, bits = b"   " + text.encode(), []
    for own in levels:
        total = 0.0
        for i in range(3, len(raw)):
            for k in range(len(own) - 1, -1, -1):
                seen, sums = own[k]
                context = int.from_bytes(raw[i - k : i], "big")
                if context not in sums:
                    continue
                count, kinds = sums[context]
                n = seen[context].get(raw[i])
                total -= math.log2((n or kinds) / (count + kinds))
                if n:
                    break
            else:
                total += 8
        bits.append(total / (len(raw) - 3))
    least = min(bits)
    weight = [2 ** (-(b - least) * min(len(raw) - 3, 64)) for b in bits]
    return languages[bits.index(least)], 1 / sum(weight), least


def test_op9_predictions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trees = op09_language_id.learn(docs)
    levels = levels_of(trees)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r for r in queries.QUERIES["op9_language_id"](spark, sf_dir).collect()}
    for i in sorted(texts, key=lambda i: len(texts[i]))[:70]:
        name, score, bits = predicted(trees.languages, levels, texts[i])
        assert found[i].lang_pred == name and found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert math.isclose(found[i].score, score, abs_tol=2e-3) and math.isclose(found[i].bits_per_byte, bits, rel_tol=1e-3, abs_tol=1e-3)


def test_op10_scores(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = op10_quality.learn(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = {r.doc_id: r for r in queries.QUERIES["op10_quality_classifier"](spark, sf_dir).collect()}
    f = op10_quality.FILTERS
    for i in sorted(texts, key=lambda i: len(texts[i]))[:60]:
        raw = texts[i].encode()
        chunks = np.array(naive_chunks(raw, net)).reshape(-1, f)
        pooled = np.concatenate([chunks.mean(0), chunks.max(0), chunks.min(0)] if len(chunks) else [np.zeros(3 * f)])
        features = np.append(pooled, math.log1p(len(raw)) / 8)
        hidden = [max(0.0, float(features @ net.w["hidden"][:, h]) + float(net.w["hidden_bias"][h])) for h in range(op10_quality.HIDDEN)]
        score = 1 / (1 + math.exp(-(sum(h * float(w) for h, w in zip(hidden, net.w["out"], strict=True)) + float(net.w["out_bias"][0]))))
        assert math.isclose(found[i].score, score, abs_tol=1e-3)
        assert found[i].predicted == int(found[i].score >= 0.3) and found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)


def write(spark, folder, made):
    spark.createDataFrame(made, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], n % 2, 0) for n, r in enumerate(made[:12])], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("edge")), rows())


@pytest.fixture(scope="module")
def long_dir(spark, tmp_path_factory):
    """Texts over a megabyte: prose, the same with other words put in and a notice at its end, one word, one without letters."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    base = [word() for _ in range(180_000)]
    other = [*base[:90_000], *(word() for _ in range(50)), *base[90_000:]]
    texts = [" ".join(base), " ".join(other) + " mail a.b@host.example.com All rights reserved.", "x" * 1_200_000, "12 34\n" * 200_000, None, "", "short text of few words"]
    made = [(i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate([*texts, *(prose(50 + i, 80) for i in range(10))])]
    return write(spark, str(tmp_path_factory.mktemp("long")), made)


def by_text(spark, folder, name):
    """Texts by a number for each distinct row, and the query's rows by it: rows without an id or with a repeated one are told apart by order of id."""
    docs = [(r.doc_id, r.text) for r in table(spark, folder, "documents").collect()]
    found = defaultdict(list)
    for r in queries.QUERIES[name](spark, folder).collect():
        found[r.doc_id].append(r)
    return docs, found


@pytest.mark.parametrize("folder", ["edge_dir", "long_dir"])
class TestValues:
    def unique(self, spark, folder, request, name):
        docs, found = by_text(spark, request.getfixturevalue(folder), name)
        texts = {i: t for i, t in docs if i is not None}
        assert Counter(i for i, _ in docs) == Counter(i for i, rs in found.items() for _ in rs)
        return docs, texts, found

    def test_op1(self, spark, folder, request):
        docs, texts, found = self.unique(spark, folder, request, "op1_pii")
        check_spans({i: found[i][0] for i in texts}, {**texts})
        for i, t in texts.items():
            spans = base_by_pattern(t or "")
            assert [found[i][0][k] for k in ("n_email", "n_ip", "n_card", "n_phone")] == [sum(k == n for _, k, _ in spans) for n in range(4)]
            assert all(r == found[i][0] for r in found[i])

    def test_op2(self, spark, folder, request):
        docs, _, found = self.unique(spark, folder, request, "op2_substring_dedup")
        keys = list(enumerate(t for _, t in docs))
        rank = lambda r: (r.n_words, r.kept_sha256)
        place, taken = {}, Counter()
        # Rows of one id are the same text, but for the two without an id, of which one has no words.
        for n, (i, t) in enumerate(docs):
            own = sorted(found[i], key=rank, reverse=bool(t))
            place[n] = own[0] if i is None else own[taken[i]]
            taken[i] += 1
        check_op2(place, dict(keys))

    def test_op3(self, spark, folder, request):
        docs, found = by_text(spark, request.getfixturevalue(folder), "op3_licenses")
        small = dict(enumerate(t if t is None or len(t) < 20_000 else t[-2000:] for _, t in docs))
        cut = {n: 0 if t is None or len(t) < 20_000 else len(t) - 2000 for n, (_, t) in enumerate(docs)}
        want = Counter((docs[n][0], name, a + cut[n], b + cut[n]) for n, name, a, b, _ in notices_by_hand(small))
        assert Counter((i, r.license, r.start, r.end) for i, rs in found.items() for r in rs) == want

    def test_op5(self, spark, folder, request):
        where = request.getfixturevalue(folder)
        check_packing(queries.QUERIES["op5_packing"](spark, where).collect(), [(r.doc_id, r.text) for r in table(spark, where, "documents").collect()])

    def test_op6(self, spark, folder, request):
        import sentencepiece

        path = public_tokenizers.path("piece_bpe_32k.model")
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        docs = table(spark, request.getfixturevalue(folder), "documents")
        texts = [(r.doc_id, r.text or "") for r in docs.collect()]
        want = Counter((i, tuple(library.encode(t))) for i, t in texts)
        got = op06_sentencepiece.encode_documents(docs, path, with_ids=True).collect()
        assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
        assert Counter(r.decoded_sha256 for r in got) == Counter(hashlib.sha256(t.encode()).hexdigest() for _, t in texts)

    def test_op7(self, spark, folder, request):
        docs, found = by_text(spark, request.getfixturevalue(folder), "op7_simhash_dedup")
        prints = [simhash(t) for _, t in docs]
        assert Counter((i, r.fingerprint) for i, rs in found.items() for r in rs) == Counter((i, f"{p:016x}") for (i, _), p in zip(docs, prints, strict=True))
        root = smallest_linked(dict(enumerate(prints)))
        least = defaultdict(list)
        for n, r in root.items():
            if docs[n][0] is not None:
                least[r].append(docs[n][0])
        for n, (i, _) in enumerate(docs):
            if i is not None:
                assert {r.component_id for r in found[i]} == {min(least[root[n]])}

    def test_op8(self, spark, folder, request):
        docs, found = by_text(spark, request.getfixturevalue(folder), "op8_fingerprints")
        ids = [i for i, _ in docs]
        if len(set(ids)) == len(ids):
            ordered = sorted(docs)
            for (i, t), (_, after) in zip(ordered, [*ordered[1:], ordered[0]], strict=True):
                t, after = t or "", after or ""
                n = len(t) // 4
                assert (found[i][0].n_chars, found[i][0].edited_sha256) == (len(t), hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest())
        same = defaultdict(set)
        for i, t in docs:
            if i is not None:
                same[t or ""] |= {r.fingerprint for r in found[i]}
        assert all(len(v) == 1 for v in same.values()) and same[""] == {"0" * 32}

    def test_op9_and_op10(self, spark, folder, request):
        for name in ("op9_language_id", "op10_quality_classifier"):
            docs, _, found = self.unique(spark, folder, request, name)
            assert all(0 <= r.score <= 1 for rs in found.values() for r in rs)
            if name == "op9_language_id":
                assert all(r.lang_pred == "und" for i, t in docs if i is not None and not any(c.isalpha() for c in t or "") for r in found[i])


def test_op5_ignores_extra_columns(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = lambda df: sorted(map(repr, df.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))
    assert plain(op05_packing.pack(docs.withColumns({c: F.lit("x") for c in CLASHES}), path)) == plain(op05_packing.pack(docs, path))
