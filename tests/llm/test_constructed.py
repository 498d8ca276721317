"""Constructed inputs that shortcuts, weak hashes and unbounded samples get wrong."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_brute_force import WORD, base_by_pattern

from telemark.llm import common, op01_pii, op02_substring_dedup, op03_licenses, op04_ann, op08_fingerprints, op09_language_id, op10_quality, queries
from telemark.llm.common import table


def spelled(w):
    return op01_pii.alike(w)


def occurrences(text):
    """(start, end, kind, token, what it may be, patterns) by regular expressions over the words of a text."""
    known = sorted([*base_by_pattern(text), *op01_pii.secret_spans(text)])
    words = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
    places = [(s, e, k, text[s:e]) for s, k, e in known]
    places += [(e - len(last), e, k, last) for s, k, e in known if len(text[s:e].split()) > 1 for last in [text[s:e].split()[-1]]]
    for a, b in words:
        if not re.search("[0-9@]", text[a:b]) or any(s < b and e > a for s, _, e in known):
            continue
        run = text[a:b]
        cut = max([m.end() for m in re.finditer("[=:]", run[:-1])], default=0)
        bare = run[cut:].strip("\"'()[]{}<>.,;:!?#$%&*")
        if bare and ("@" in bare or len(re.findall("[0-9]", bare)) >= 4):
            at = text.index(bare, a + cut)
            places.append((at, at + len(bare), -1, bare))
    out = []
    for s, e, k, token in places:
        left = [spelled(w) for w in text[:s].rstrip("\"'([{<").split()[-2:]]
        right = [spelled(text[a:b]) for a, b in words if a >= e][:2]
        pats = {"< " + " ".join(left[-n:]) for n in (1, 2) if len(left) >= n} | {"> " + " ".join(right[:n]) for n in (1, 2) if len(right) >= n}
        if left and right:
            pats.add(f"<> {left[-1]} {right[0]}")
        if re.fullmatch("[0-9]{12,19}", token) and op01_pii.luhn(token):
            pats.add(f"# check digit {len(token)}")
        out.append((s, e, k, token.lower(), 1 << k if k >= 0 else op01_pii.possible(token), pats))
    return out


def bootstrapped(texts):
    """All spans of each text, by the pattern graph in plain loops."""
    seen = {i: occurrences(t or "") for i, t in texts.items()}
    kind, may, under = {}, {}, defaultdict(set)
    for rows in seen.values():
        for _, _, k, token, bits, pats in rows:
            kind[token] = max(k, kind.get(token, -1))
            may[token] = max(bits, may.get(token, 0))
            for p in pats:
                under[p].add(token)
    sure = {t: (k, 1.0) for t, k in kind.items() if k >= 0}
    seeds, accepted = set(sure), {}
    while True:
        fresh = {}
        for p, tokens in under.items():
            if len(tokens) < op01_pii.SUPPORT:
                continue
            mass, support = defaultdict(float), defaultdict(int)
            for t in tokens & set(sure):
                mass[sure[t][0]] += sure[t][1]
                support[sure[t][0]] += sure[t][1] >= 0.5
            for k, c in mass.items():
                score = round(c / (sum(mass.values()) + sum(t not in seeds and not may[t] >> k & 1 for t in tokens)), 9)
                if score >= op01_pii.ACCEPT and support[k] >= op01_pii.SUPPORT and (p, k) not in accepted:
                    fresh[p, k] = score
        if not fresh:
            break
        accepted |= fresh
        belief = defaultdict(lambda: 1.0)
        for (p, k), score in accepted.items():
            for t in under[p] - seeds:
                if may[t] >> k & 1:
                    belief[t, k] *= 1 - min(score, 0.99)
        sure = {t: sure[t] for t in seeds}
        for (t, k), doubt in belief.items():
            c = round(1 - doubt, 9)
            if t not in sure or (c, -k) > (sure[t][1], -sure[t][0]):
                sure[t] = (k, c)
    out = {}
    for i, rows in seen.items():
        spans = {(s, k, e) for s, k, e in [*base_by_pattern(texts[i] or ""), *op01_pii.secret_spans(texts[i] or "")]}
        for s, e, k, token, _, pats in rows:
            if k < 0:
                fits = [(score, -q) for (p, q), score in accepted.items() if p in pats and op01_pii.possible((texts[i] or "")[s:e]) >> q & 1]
                if fits:
                    spans.add((s, -max(fits)[1], e))
        out[i] = sorted(spans)
    return out


def check_spans(found, texts):
    for i, spans in bootstrapped(texts).items():
        name = lambda chosen: ",".join(f"{op01_pii.KINDS[k]}:{a}:{b}" for a, k, b in spans if chosen(k))
        assert (found[i].spans, found[i].secret_spans) == (name(lambda k: k < 4), name(lambda k: k == 4)), i
        assert found[i].n_secret == sum(k == 4 for _, k, _ in spans)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_op1_pattern_graph(spark, name):
    """All spans of the whole query; on the larger table patterns add some to the base ones."""
    d = f"/root/testdata/{name}"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    found = {r.doc_id: r for r in queries.QUERIES["op1_pii"](spark, d).collect()}
    check_spans(found, texts)
    if name == "sf0.01":
        assert any(len(r.spans) > 0 and r.n_email + r.n_ip + r.n_card + r.n_phone < len(r.spans.split(",")) for r in found.values())


def test_op1_planted_graph(spark):
    """Chains of patterns, contexts on either side, conflicting kinds, long words, secrets in new places: precision and recall 1 on what is planted."""
    rng = np.random.default_rng(3)
    texts = {i: f"note {i} call me at +1 555 01{i:02d} 22{i:02d} thanks" for i in range(12)}
    texts |= {100 + i: f"please call me at 555-01{i:02d}-x or later, ring back soon" for i in range(8)}  # unseen, found by 'call me at'
    texts |= {200 + i: f"{'w' * 80} 555-01{i:02d}-x or later, {i}" for i in range(8)}  # teaches what follows
    texts |= {300 + i: f"desk 777-{i:04d}-y or later, bye" for i in range(5)}  # found in the next round by what follows
    texts |= {400 + i: f"invoice {2000 + i} was paid in {1990 + i}" for i in range(20)}
    texts |= {500 + i: f'api_key = "{rng.bytes(12).hex()}a1b2"' for i in range(8)}
    texts |= {600 + i: f'api_key = {rng.bytes(12).hex()}z9y8 # unquoted' for i in range(4)}
    texts |= {700: None, 701: "", 702: "@ 1234 @@@@ 5555", 703: "x" * 5000 + "1234567 " + "9" * 3000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in op01_pii.personal_data(docs).collect()}
    check_spans(found, texts)
    assert all(found[i].spans.startswith("phone:") for i in [*range(12), *range(100, 108), *range(200, 208), *range(300, 305)])
    assert all(found[i].n_secret == 1 for i in [*range(500, 508), *range(600, 604)])
    assert not any(found[i].spans or found[i].n_secret for i in [*range(400, 420), 700, 701])


def thue_morse(n):
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a[:n], a[:n].translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("length", [64, 1024, 4096, 1 << 21])
def test_op2_regular_words(spark, length):
    """Words that polynomial hashes can't tell apart: windows that differ in one such word aren't repeats."""
    words = [f"w{i}" for i in range(34)]
    docs = spark.createDataFrame([(i, " ".join([*words[:17], w, *words[17:]])) for i, w in enumerate(thue_morse(length))], "doc_id long, text string")
    assert [r.n_removed for r in op02_substring_dedup.remove_repeats(docs, ["doc_id"]).collect()] == [0, 0]


def test_op2_regular_sequences(spark):
    """The same for sequences of two words; a true repeat beside them is found."""
    one, two = (" ".join(t) for t in thue_morse(64))
    docs = spark.createDataFrame([(1, one[:69]), (2, "c " + two[:69]), (3, "d " + one[:69] + " e")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in op02_substring_dedup.remove_repeats(docs, ["doc_id"]).collect()} == {1: 35, 2: 0, 3: 35}


def test_op2_many_equal_rows(spark):
    """Rows equal in id (here null) and text: hits are one set, each path is opened once, and branches beside them are told right."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(500)}" for _ in range(200)]
    branch = [*words[:90], "other", *words[91:]]
    rows = [(None, " ".join(words))] * 700 + [(1, " ".join(branch)), (2, "x " + " ".join(words[100:150])), (3, " ".join(f"u{i}" for i in range(60)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = op02_substring_dedup.remove_repeats(docs, ["doc_id"]).collect()
    assert [r.n_removed for r in found if r.doc_id is None] == [200] * 700
    assert {r.doc_id: r.n_removed for r in found if r.doc_id} == {1: 199, 2: 50, 3: 0}
    hits = op02_substring_dedup.repeated_windows(docs).collect()
    assert len(hits) == 3 and max(len(r.hits) for r in hits) <= 200

    keys = [0] * 5 + [1] * 2
    rows = pa.table({"k1": pa.array(keys, pa.int64()), "k2": pa.array(keys, pa.int64()), "text": [" ".join(words)] * 7, "paths": [[{"p": 0, "n": 3, "anchor": 9, "path": 9}]] * 7})
    for most in (1, 2, 7):
        assert sum(b.num_rows for b in op02_substring_dedup._open_windows(iter(rows.to_batches(most)))) == 6


def test_word_hashes_by_hand():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.bytes(rng.integers(1, 9)).hex() for _ in range(200)), "", None, " a  b\tc", "é" * 300 + " x", "b" * 1_200_000 + " end"]
    seen = {}
    for block in common.text_blocks(pa.array(texts, pa.string())):
        starts, ends, _ = common.word_spans(block)
        text, begin, end = common.joined_words(block, starts, ends)
        for h, a, b, s, e in zip(common.word_hashes(block, starts, ends).tolist(), begin, end, starts, ends, strict=True):
            assert text[a:b] == block.data[s:e].tobytes()
            assert seen.setdefault(text[a:b], h) == h
    assert len(set(seen.values())) == len(seen)
    # Of each kind: the sum over bytes of mixed (place, byte) numbers.
    one = common.word_hashes(common.TextBlock(np.frombuffer(b"q", np.uint8), np.array([0, 1]), 0), np.array([0]), np.array([1]))
    assert one[0] == common.mix(common.mix(np.array([ord("q") + 1], np.uint64) * common._STEP))[0]


def whole_alignment(template, words):
    """Best local alignment over all of ``words``: matched, first, last."""
    above, best = [(0, 0, -1)] * (len(words) + 1), (0, 0, -1, -1)
    for own in template:
        row = [(0, 0, -1)]
        for at, w in enumerate(words):
            s, n, f = above[at]
            if w == own:
                cell = (s + 2, n + 1, f if f >= 0 else at)
                if cell[:2] > best[:2]:
                    best = (*cell, at)
            else:
                cell = (s - 1, n, f)
            cell = max(cell, (above[at + 1][0] - 1, *above[at + 1][1:]), (row[-1][0] - 1, *row[-1][1:]), key=lambda c: c[:2])
            row.append(cell if cell[0] > 0 else (0, 0, -1))
        above = row
    return best[1:]


def notices_by_hand(texts):
    """(doc, licence, start, end, matched words) of unbanded alignments, split around what is found; then the best of siblings."""
    tokens = lambda t: [(m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[0-9A-Za-z\x80-\U0010ffff]+", t)]
    own = {n: [w for w, _, _ in tokens(t)] for n, t in op03_licenses.TEMPLATES.items()}
    out = []
    for i, text in texts.items():
        spans = tokens(text or "")
        words, got = [w for w, _, _ in spans], []

        def search(name, lo, hi, words=words, got=got):
            template, part = own[name], words[lo:hi]
            there = set(part)
            if sum(w in there for w in template) < 0.8 * len(template):
                return
            n, f, e = whole_alignment(template, part)
            if n >= 0.8 * len(template) - 1e-9:
                got.append((name, n, lo + f, lo + e))
                search(name, lo, lo + f)
                search(name, lo + e + 1, hi)

        for name in own:
            search(name, 0, len(words))
        kept = []
        for x in sorted(got, key=lambda x: (-x[1] / len(own[x[0]]), -x[1], list(own).index(x[0]), x[2])):
            family = next((s for s in op03_licenses.SIBLINGS if x[0] in s), set())
            if not any(y[0] in family and y[0] != x[0] and y[2] <= x[3] and x[2] <= y[3] for y in kept):
                kept.append(x)
        out += [(i, name, spans[f][1], spans[e][2], n) for name, n, f, e in kept]
    return sorted(out)


def test_op3_unbanded_alignment(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    found = queries.QUERIES["op3_licenses"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.license, r.start, r.end, r.matched_words) for r in found) == notices_by_hand(texts)


def test_op3_words_put_in(spark):
    """A notice with words put in anywhere is one row, however it is cut; two notices are two."""
    words = op03_licenses.TEMPLATES["MIT-permission"].split()
    texts = {}
    for n in (1, 8, 16, 20, 23, 25):
        for at in (4, 6, 8, 10, len(words) // 2, len(words) - 3):
            texts[100 * n + at] = " ".join(["before", *words[:at], *(f"x{j}" for j in range(n)), *words[at:], "after"])
    texts |= {1: " ".join(words * 3), 2: "All rights reserved. " * 50, 3: " ".join([*words, *["y"] * 200, *words]), 4: None, 5: "", 6: "the software " * 2000}
    rows = op03_licenses.find_licenses(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.start, r.end, r.matched_words) for r in rows) == notices_by_hand(texts)
    count = defaultdict(int)
    for r in rows:
        count[r.doc_id] += r.license in ("MIT-permission", "All-rights-reserved")
    assert all(count[i] == 1 for i in texts if i >= 100 and (len(words) // 2 == i % 100 or i // 100 <= 16))
    assert (count[1], count[2], count[3], count[4], count[6]) == (3, 50, 2, 0, 0)


@pytest.mark.parametrize(("n", "size", "clusters"), [(6000, 1024, 12), (6000, 32, 12), (4000, 4000, 2)])
def test_op4_through_codes(spark, n, size, clusters):
    """Lists far larger than what is reranked, and lists divided by residual centroids; recall against brute force."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(clusters, 16)) * 3
    x = (centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, 16))).astype(np.float32).astype(float)
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    index = op04_ann.Index(x, n, size)
    number, _ = index.encode(x)
    assert np.median(np.bincount(number)[number]) > op04_ann.RERANK or len(index.subs) > 1
    got = defaultdict(set)
    for r in op04_ann.nearest_vectors(docs, list_size=size).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, n, 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(set(np.argsort(d, kind="stable")[:10].tolist()) & got[q])
        assert len(got[q]) == 10
    assert hits >= 0.9 * 10 * (n // 100)


@pytest.mark.parametrize("shape", ["scales", "queries"])
def test_op4_uneven_vectors(spark, shape):
    """Rows of very different lengths, which one codebook can't tell apart; queries that lie elsewhere than other rows."""
    rng = np.random.default_rng(5)
    n, d = 6000, 64
    if shape == "scales":
        x = rng.normal(size=(n, d)) * np.exp(2 * rng.normal(size=(n, 1)))
    else:
        x = rng.normal(size=(100, d))[rng.integers(0, 100, n)] + 0.05 * rng.normal(size=(n, d))
        x[::100] = rng.normal(size=(n // 100, d))
    got = defaultdict(set)
    for r in op04_ann.nearest_vectors(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")).collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in range(0, n, 100):
        away = ((x - x[q]) ** 2).sum(1)
        away[q] = np.inf
        hits += len(set(np.argsort(away, kind="stable")[:10].tolist()) & got[q])
    assert hits >= 0.9 * 10 * (n // 100)


def test_op4_short_lists(spark):
    """Queries far away from all others still get ten."""
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=8) + (1e6 * i if i % 100 == 0 else 0)).tolist()) for i in range(1500)]
    got = defaultdict(list)
    for r in op04_ann.nearest_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got[r.query_id].append(r.vec_id)
    assert {len(v) for v in got.values()} == {10} and len(got) == 15


def test_op8_search_of_copies(spark):
    """Many copies: pairs between representatives, and who has them."""
    rows = [(i, 5, 7) for i in range(300)] + [(1000, 5, 6), (1001, 4, 6), (1002, -1, -1), (1003, 5, 7 ^ (1 << 63))]
    prints = spark.createDataFrame([(i, h, lo - (1 << 64) if lo >> 63 == 1 else lo) for i, h, lo in rows], "id long, hi long, lo long")
    got = sorted((r.query_id, r.id, r.distance) for r in op08_fingerprints.within(prints, prints, 2).collect())
    assert got == sorted([(0, 0, 0), (0, 1000, 1), (0, 1001, 2), (0, 1003, 1), (1000, 0, 1), (1000, 1000, 0), (1000, 1001, 1), (1000, 1003, 2), (1001, 0, 2), (1001, 1000, 1), (1001, 1001, 0), (1002, 1002, 0), (1003, 0, 1), (1003, 1000, 2), (1003, 1003, 0)])
    whose = {r.id: r.representative for r in op08_fingerprints.members(prints).collect()}
    assert all(whose[i] == 0 for i in range(300)) and whose[1001] == 1001


def test_op8_bits_by_hand(spark, sf_dir):
    """Fingerprints from signed votes of word, pair and byte run hashes, a term at a time."""
    def print_of(text):
        raw = text.encode()
        words = [w.encode() for w in WORD.findall(text)]
        hash_of = lambda w: int(common.word_hashes(common.TextBlock(np.frombuffer(w, np.uint8), np.array([0, len(w)]), 0), np.array([0]), np.array([len(w)]))[0])
        mixed = lambda x: int(common.mix(np.array([x & ((1 << 64) - 1)], np.uint64))[0])
        hashes = [hash_of(w) for w in words]
        terms = [(h, 64) for h in hashes] + [(mixed(a * 0x9E3779B97F4A7C15 + b), 128) for a, b in zip(hashes, hashes[1:], strict=False)]
        if len(words) < 64:
            terms += [(mixed(int.from_bytes(raw[i : i + 4], "little") + 1), 64 - len(words)) for i in range(len(raw) - 3)]
        digits = ""
        for salt in op08_fingerprints._SALTS:
            votes = [0] * 64
            for h, weight in terms:
                own = mixed(h ^ int(salt))
                for b in range(64):
                    votes[b] += weight if own >> b & 1 else -weight
            digits += f"{sum(1 << b for b in range(64) if votes[b] > 0):016x}"
        return digits

    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    found = {r.doc_id: r.fingerprint for r in queries.QUERIES["op8_fingerprints"](spark, sf_dir).collect()}
    short = sorted(texts, key=lambda i: len(texts[i]))[:40]
    assert {i: found[i] for i in short} == {i: print_of(texts[i]) for i in short}


def test_learning_samples_are_bounded(spark):
    """Twenty thousand rows of one id teach no more than a sample holds."""
    docs = spark.range(20_000).selectExpr("1L as doc_id", "concat('text ', id, ' abc') as text", "'en' as lang")
    trees = op09_language_id.learn(docs)
    assert trees is None or trees.counts[0][0][1].sum() <= 160 * 20
    seen = []
    real = op10_quality.learn_network
    op10_quality.learn_network = lambda texts, *a: seen.append(len(texts)) or real(texts[:40], *(x[:40] for x in a))
    try:
        labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1)] * 50, "doc_id long, quality int")
        op10_quality.learn(docs, labels)
    finally:
        op10_quality.learn_network = real
    assert all(n <= 2 * 2 * 900 * 1.6 for n in seen)


def test_scratch_tables(spark):
    df = spark.range(3).toDF("x")
    with common.scratch_scope(spark):
        gone, stays = common.stage_table(df, "a"), common.keep_table(common.stage_table(df, "b"))
    assert stays.count() == 3
    with pytest.raises(Exception):  # noqa: B017  whatever Spark says of missing files
        gone.collect()
    common.drop_table(stays)
    common.drop_table(df)  # no scratch table: nothing happens
