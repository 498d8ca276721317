"""Operators against plain restatements of their contracts on the small table."""

import bisect
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from telemark.llm import op01_pii, op02_substring_dedup, op03_licenses, op05_packing, op06_sentencepiece, op07_simhash_dedup, op08_fingerprints, queries
from telemark.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}


def result(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir).collect()


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def base_by_pattern(text):
    found = []
    for k, (_, pattern) in enumerate(PII):
        if k == 0 and "@" not in text:  # none can match, and the pattern takes quadratic time to say so
            continue
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            keep = [True, all(int(p) <= 255 for p in m[0].split(".")) if k == 1 else False, 12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15][k]
            if keep:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_op1(spark, sf_dir, docs):
    for r in result(spark, sf_dir, "op1_pii"):
        spans = base_by_pattern(docs[r.doc_id])
        spelled = ",".join(f"{PII[k][0]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(filter(None, spelled.split(","))) <= set(r.spans.split(","))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.9@+- ()5x2é", max_size=40))
def test_op1_patterns(text):
    assert op01_pii.base_spans(text) == base_by_pattern(text)


def test_op1_learns_contexts(spark):
    """Twelve phone numbers after one phrase teach it; a number that no base rule knows is found there, and nowhere else."""
    rows = [(i, f"note {i} call me at +1 555 01{i:02d} 22{i:02d} thanks", None, None, 0) for i in range(12)]
    rows += [(100, "please call me at 555-0199-x today", None, None, 0), (101, "invoice 555-0198-y was paid", None, None, 0)]
    found = {r.doc_id: r.spans for r in op01_pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert found[100] == "phone:18:28"
    assert found[101] == ""
    assert all(found[i].startswith("phone:") for i in range(12))


def removed(words, window=35):
    counts = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if counts[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append(gone)
    return out


def check_op2(found, texts):
    words = {i: WORD.findall(t or "") for i, t in texts.items()}
    for (i, w), gone in zip(words.items(), removed(list(words.values())), strict=True):
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()), i


def test_op2(spark, sf_dir, docs):
    check_op2({r.doc_id: r for r in result(spark, sf_dir, "op2_substring_dedup")}, docs)


def test_op2_oracle(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    theirs = con.execute(queries.ORACLE_SQL["op2_substring_dedup"]).fetchall()
    assert sorted(theirs) == sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result(spark, sf_dir, "op2_substring_dedup"))


def test_op2_planted(spark):
    """Shared passages of every length around the window, shifted, periodic and cut by other words."""
    words = [f"w{i}" for i in range(400)]
    texts = {n: " ".join([*(f"a{n}x{j}" for j in range(n % 7)), *words[n : n + n], *(f"b{n}x{j}" for j in range(5))]) for n in range(30, 60)}
    texts |= {100: "a b c " * 40, 101: "a b c " * 12, 102: "z " * 35, 103: "z " * 36, 104: " ".join(words[:35]), 105: " ".join(words[10:90]), 106: "", 107: None}
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    check_op2({r.doc_id: r for r in op02_substring_dedup.remove_repeats(docs, ["doc_id"]).collect()}, texts)


def test_op3(spark, sf_dir, docs):
    rows = result(spark, sf_dir, "op3_licenses")
    for name in ("Apache-2.0", "MIT", "GPL-3.0", "CC-BY-NC-4.0", "All-rights-reserved"):
        notice = op03_licenses.TEMPLATES[name]
        want = {(i, m.start(), m.end() - 1) for i, t in docs.items() for m in re.finditer(re.escape(notice), t)}
        assert want <= {(r.doc_id, r.start, r.end) for r in rows if r.license == name}, name


def test_op3_edited_notices(spark):
    full = op03_licenses.TEMPLATES["MIT-permission"]
    words = full.split()
    edited = " ".join(w for i, w in enumerate(words) if i % 11)  # a word in eleven is missing
    rows = [(1, "é " + full), (2, "# " + edited.upper()), (3, " ".join(words[:20])), (4, "permission to use a copy of it was granted")]
    found = op03_licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license) for r in sorted(found, key=lambda r: r.doc_id)] == [(1, "MIT-permission"), (2, "MIT-permission")]
    first = next(r for r in found if r.doc_id == 1)
    assert (first.start, first.end, first.coverage) == (2, 1 + len(full), 1.0)


def test_op4_recall(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    found = defaultdict(list)
    for r in sorted(result(spark, sf_dir, "op4_nearest_neighbours"), key=lambda r: r["rank"]):
        found[r.query_id].append((r.vec_id, r.score))
    hits = 0
    queries_at = np.flatnonzero(ids % 100 == 0)
    for q in queries_at:
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        d[q] = np.inf
        best = np.lexsort((ids, d))[:10]
        got = found[ids[q]]
        assert len(got) == 10 and got == sorted(got, key=lambda x: (x[1], x[0]))
        assert all(np.isclose(s, d[ids == i][0], rtol=1e-14) for i, s in got)
        hits += len({i for i, _ in got} & set(ids[best]))
    assert hits >= 0.9 * 10 * len(queries_at)


def test_op4_copies(spark):
    """A third of the rows is one vector, queries among them: neighbours are the smallest ids at distance zero."""
    from telemark.llm.op04_ann import nearest_vectors

    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(1200)]
    found = nearest_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    own = sorted((r["rank"], r.vec_id) for r in found if r.query_id == 300)
    assert own == list(enumerate(range(0, 30, 3), 1))
    assert [v for _, v in sorted((r["rank"], r.vec_id) for r in found if r.query_id == 0)] == list(range(3, 33, 3))


def check_packing(rows, texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for i, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            cut = ids[k : k + 4096]
            want[i, k // 4096, k, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    room = []
    for n in sorted((k[3] for k in want.elements()), reverse=True):
        at = bisect.bisect_left(room, n)
        bisect.insort(room, (room.pop(at) if at < len(room) else 4096) - n)
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert sorted(4096 - sum(n for _, n in p) for p in used.values()) == room


def test_op5(spark, sf_dir, docs):
    check_packing(result(spark, sf_dir, "op5_packing"), docs.items())


def test_op5_words(spark):
    texts = ["don't STOP. <|endoftext|> x<|startoftext|>y", "naïve—Ünïcode ﬁ ǅ İ ΑΣ. é ́", "a b\x1cc\x85d", "$$$ foo### (bar)*** ''s 'S 42.1 _x_", "ÀÉÎ µ ª º ß", "👩‍👩‍👧 漢字。"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_packing(op05_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect(), list(enumerate(texts)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_op5_plan(lengths):
    counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, int)
    plan, room, filled = op05_packing.best_fit_plan(counts, 64), [], defaultdict(int)
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(room, n)
        bisect.insort(room, (room.pop(at) if at < len(room) else 64) - n)
    for i, (length, rank, first, each, before) in sorted(enumerate(plan.tolist()), key=lambda x: (-x[1][0], x[1][1])):
        end = plan[i + 1][1] if i + 1 < len(plan) and plan[i + 1][0] == length else counts[length]
        for k in range(end - rank):
            assert filled[first + k // each] == 64 - before + k % each * length
            filled[first + k // each] += length
    assert sorted(64 - v for v in filled.values()) == room


def test_op6_round_trip(spark, sf_dir, docs):
    for r in result(spark, sf_dir, "op6_sentencepiece"):
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


@pytest.fixture(scope="module")
def codec():
    return op06_sentencepiece.Codec(*op06_sentencepiece.load_pieces(public_tokenizers.path("piece_bpe_32k.model")))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_op6_exact_decoding(codec, text):
    assert codec.decode(np.frombuffer(codec.encode(text), "<u4")) == text


def best_score(codec, scores, text):
    best = [0.0] + [-np.inf] * len(text)
    for e in range(1, len(text) + 1):
        for s in range(max(0, e - 16), e):
            if text[s:e] in scores:
                best[e] = max(best[e], best[s] + scores[text[s:e]])
        if text[e - 1] not in codec.singles:
            best[e] = max(best[e], best[e - 1] + op06_sentencepiece.BYTE_PRICE * len(text[e - 1].encode()))
    return best[-1]


def test_op6_scores_are_the_highest(codec, docs):
    pieces, _ = op06_sentencepiece.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    scores, by_id = {p: s for p, s, _ in pieces}, {i: s for _, s, i in pieces}
    for text in [*list(docs.values())[:8], "tab\there  two spaces\nñandú ☃ Ω≈ç", " leading", "trailing "]:
        text = text[:1500]
        ids = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert sum(by_id.get(i, op06_sentencepiece.BYTE_PRICE) for i in ids) == best_score(codec, scores, "▁" + text.replace(" ", "▁"))


def simhash(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_linked(prints, radius=2):
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_op7(spark, sf_dir, docs):
    prints = {i: simhash(t) for i, t in docs.items()}
    linked = smallest_linked(prints)
    for r in result(spark, sf_dir, "op7_simhash_dedup"):
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", linked[r.doc_id])


def test_op7_dense_fingerprints(spark, monkeypatch):
    """Chains and clusters of fingerprints, once with every bucket dealt again."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, size=12, dtype=np.int64)
    found = {int(x) for x in base}
    for x in base:
        for _ in range(25):
            x ^= np.int64(1) << np.int64(rng.integers(0, 60))
            found.add(int(x))
            found.add(int(x ^ (np.int64(7) << np.int64(rng.integers(0, 50)))))
    prints = dict(enumerate(sorted(found)))
    want = smallest_linked({i: f & ((1 << 64) - 1) for i, f in prints.items()})
    frame = spark.createDataFrame(list(prints.items()), "doc_id long, fp long")
    for hot in (4096, 1):
        monkeypatch.setattr(op07_simhash_dedup, "HOT", hot)
        got = {r.fp: r.component_id for r in op07_simhash_dedup.groups(frame).collect()}
        assert got == {f: want[i] for i, f in prints.items()}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 1023), min_size=1, max_size=300, unique=True), st.integers(0, 4))
def test_op7_bit_slices(values, radius):
    fps = np.array(values, dtype=np.uint64) * np.uint64(1 << 20)
    label = op07_simhash_dedup.linked(fps, np.full(len(fps), len(fps)), radius)
    want = smallest_linked(dict(enumerate(fps.tolist())), radius)
    assert label.tolist() == [want[i] for i in range(len(fps))]


def test_op8(spark, sf_dir, docs):
    ids = sorted(docs)
    rows = {r.doc_id: r for r in result(spark, sf_dir, "op8_fingerprints")}
    assert len({r.fingerprint for r in rows.values()}) <= len(set(docs.values()))
    seen = {}
    for k, i in enumerate(ids):
        text, after = docs[i], docs[ids[(k + 1) % len(ids)]]
        n = len(text) // 4
        changed = text[: len(text) - n] + after[:n]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
        bits = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / op08_fingerprints.BITS
        assert r.near_edited == bits(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == bits(r.fingerprint, rows[ids[(k + 1) % len(ids)]].fingerprint)
    assert np.mean([r.near_edited > r.near_next or r.near_next == 1 for r in rows.values()]) > 0.97


def test_op8_search(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-(1 << 62), 1 << 62, size=(40, 2))
    rows = []
    for i, (hi, lo) in enumerate(base.tolist()):
        for d in range(6):
            flip = rng.choice(126, d, replace=False)
            a, b = hi, lo
            for f in flip.tolist():
                if f < 63:
                    a ^= 1 << f
                else:
                    b ^= 1 << (f - 63)
            rows.append((10 * i + d, a, b))
    prints = spark.createDataFrame(rows, "id long, hi long, lo long")
    got = {(r.query_id, r.id, r.distance) for r in op08_fingerprints.within(prints, prints, 3).collect()}
    dist = lambda x, y: ((x[1] ^ y[1]) & ((1 << 64) - 1)).bit_count() + ((x[2] ^ y[2]) & ((1 << 64) - 1)).bit_count()
    assert got == {(x[0], y[0], dist(x, y)) for x in rows for y in rows if dist(x, y) <= 3}


def test_pipeline(spark, sf_dir, docs):
    """Stages 2 to 5 against brute force on what stage 1 keeps; stage 1 keeps every document with letters."""
    frame = table(spark, sf_dir, "documents")
    kept = {r.doc_id: r.text for r in corpus_pipeline.language(spark, frame, sf_dir).collect()}
    assert kept == {i: t for i, t in docs.items() if any(c.isalpha() for c in t)}
    linked = smallest_linked({i: simhash(t) for i, t in kept.items()})
    kept = {i: t for i, t in kept.items() if linked[i] == i}
    words = {i: WORD.findall(t) for i, t in kept.items()}
    for (i, w), gone in zip(words.items(), removed(list(words.values())), strict=True):
        if any(gone):
            kept[i] = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
    from test_constructed import bootstrapped

    clean = {i: op01_pii.redacted(kept[i], [dict(start=a, kind=k, end=b) for a, k, b in spans]) for i, spans in bootstrapped(kept).items()}
    check_packing(corpus_pipeline.run(spark, sf_dir).collect(), clean.items())
