"""Operators do the whole job: cases that a shortcut would miss."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from telemark.llm import op01_pii, op03_licenses, op06_sentencepiece, op08_fingerprints, op09_language_id
from telemark.llm.common import table


def test_op6_ids_are_the_librarys(spark, sf_dir):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [r.text for r in table(spark, sf_dir, "documents").collect()]
    texts += ["Elle a dit", "tab\there  two spaces\nñandú ☃ Ω≈ç", " leading", "trailing ", "x" * 5000 + "☃é" * 300, "a☃b 漢字👩‍👧"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in op06_sentencepiece.encode_documents(docs, path, with_ids=True).collect():
        assert r.ids == library.encode(texts[r.doc_id]), texts[r.doc_id][:80]


def test_op6_score_kinds():
    """Merge ranks are whole numbers; log probabilities are cut by the highest sum."""
    assert op06_sentencepiece.by_rank(op06_sentencepiece.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))[0])
    pieces = [("a", -1.5, 0), ("b", -1.5, 1), ("c", -1.5, 2), ("ab", -1.0, 3), ("bc", -0.5, 4), ("▁", -1.25, 5)]
    assert not op06_sentencepiece.by_rank(pieces)
    ids = [np.frombuffer(op06_sentencepiece.Codec(pieces, list(range(10, 266)), merges).encode("abc"), "<u4").tolist() for merges in (False, True)]
    assert ids == [[5, 0, 4], [5, 0, 4]]


@pytest.mark.parametrize(("known", "unseen"), [(5, 1), (12, 3), (12, 12), (100, 20)])
def test_op1_finds_many_unseen(spark, known, unseen):
    """Up to half of the identifiers after a phrase are unseen; years after another phrase are no phones."""
    rows = [(i, f"note {i} call me at +1 555 0{i:03d} 22{i:03d} thanks") for i in range(known)]
    rows += [(1000 + i, f"please call me at 555-0{i:03d}-x today") for i in range(unseen)]
    rows += [(2000 + i, f"born in +1 555 0{i:03d} 33{i:03d}") for i in range(6)] + [(3000 + i, f"born in {1950 + i} there") for i in range(30)]
    found = {r.doc_id: r.spans for r in op01_pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[1000 + i].startswith("phone:18:") for i in range(unseen))
    assert not any(found[3000 + i] for i in range(30))


def test_op8_no_border_of_length():
    """An edit across 32 words is as near as edits on either side of it."""
    words = [f"word{i * 7919 % 1000}" for i in range(60)]
    prints = op08_fingerprints.fingerprints(pa.array([" ".join(words[:n]) for n in range(24, 48)]))
    near = op08_fingerprints.likeness(prints[:-1], prints[1:])
    assert near[31 - 24] >= np.delete(near, 31 - 24).min()


def test_op9_learns_every_language(spark):
    docs = spark.createDataFrame([(4 * i + k, f"text {chr(0x400 + i) * 3} of {i}", f"l{i:03d}") for i in range(90) for k in range(4)], "doc_id long, text string, lang string")
    assert len(op09_language_id.learn(docs).languages) > 80


def test_op9_counts_rows_with_text(spark):
    docs = spark.range(60_000).selectExpr("id as doc_id", "if(id % 3000 = 0, 'nur wenige Texte hier', if(id % 2 = 0, null, '')) as text", "'de' as lang")
    assert op09_language_id.learn(docs).languages == ["de"]
    assert op09_language_id.learn(docs).counts[0][0][1].sum() >= 10 * len("nur wenige Texte hier")


def test_op9_order_is_the_same_at_every_size():
    from test_learned import code_length

    samples = {"a": [b"the cat sat on the mat", b"that hat"], "b": ["der Hund läuft über".encode(), b"und"], "c": [b"x"]}
    texts = ["the hat", "der über", "", "zzz \x01 the the cat sat", "x", "läuft the"]
    trees = op09_language_id.Trees(samples, max_table_mb=0)
    bits, _ = op09_language_id.code_lengths(pa.array(texts), trees, window=5)
    want = [[code_length(samples[n], t.encode(), 3) for n in trees.languages] for t in texts]
    assert len(trees.counts) == 4 and np.allclose(bits, want, rtol=1e-4, atol=1e-4)


def test_op3_names_the_right_sibling(spark):
    names = list(op03_licenses.TEMPLATES)
    docs = spark.createDataFrame([(i, f"some words {op03_licenses.TEMPLATES[n]} more words") for i, n in enumerate(names)], "doc_id long, text string")
    found = {}
    for r in op03_licenses.find_licenses(docs).collect():
        found.setdefault(r.doc_id, {})[r.license] = r.coverage
    for i, n in enumerate(names):
        assert found[i].get(n) == 1.0, n
        assert not any(n in s and m in s for s in op03_licenses.SIBLINGS for m in found[i] if m != n), n


def test_op3_single_changed_words(spark):
    """A word changed at any place leaves a template of five words or more above the coverage."""
    rows = []
    for n, text in op03_licenses.TEMPLATES.items():
        words = text.split()
        if 5 <= len(op03_licenses.TemplateIndex({n: text}, 0.8).words[0]) <= 60:
            rows += [(n, " ".join(["before", *words[:i], "changed", *words[i + 1 :], "after"])) for i in range(len(words)) if sum(c.isalnum() for c in words[i]) and words[i].strip(".,()\"").isalnum()]
    docs = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {}
    for r in op03_licenses.find_licenses(docs).collect():
        found.setdefault(r.doc_id, set()).add(r.license)
    for i, (n, text) in enumerate(rows):
        alike = next((s for s in op03_licenses.SIBLINGS if n in s), {n})
        assert found.get(i, set()) & alike, text
