"""Operator 1: personal data by base rules and bootstrapped contextual extraction.

Base rules find e-mail addresses, IP addresses, card and phone numbers in whole texts; a fifth kind, secrets, is
seeded by public key formats and by quoted values assigned to names such as ``token``. These matches seed a
bootstrap. Instances are the matches, the last word of matches of several words, and all other tokens that
look like an identifier (four digits or more, or an ``@``). Lexical patterns of an instance are the one and the
two words before it, the one and the two words after it, the words on either side together, and, for a number
whose check digit holds, that form.

Spark keeps the bipartite graph of patterns and distinct instances (combined counts, equi-joins) and scores it
in rounds until a round accepts nothing new. A pattern's score for a kind is the confidence of its instances of
that kind over that of all kinds and the number of its unlabelled instances that can't be of the kind; other
unlabelled instances say nothing, as they are what a pattern is to find. What a token can be follows from
its own form (``possible``). Patterns with ``SUPPORT`` confident instances and a score of ``ACCEPT`` are accepted and
stay so. An instance's confidence for a kind is the noisy-or of its accepted patterns; the best kind wins, of
equal ones the first listed. Marked occurrences become spans beside the base ones.

Regular expressions are written so that each text is read in linear time. Texts travel once, into
the scan; the graph holds identifiers and their neighbouring words only, words over ``LONGEST`` characters by
their hash. No list outgrows its own text.

Defined results. Null or empty text: no spans, hash of the empty string. Very long texts are read whole, a text at
a time. Offsets count code points. Ties between patterns: equal scores, then the kind listed first. Repeated
rows: equal results; in the graph they count as one instance. Null doc_id: like any id. Empty table: no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_table, drop_worker_cache, keyed, prepare, stage_table, text_blocks

KINDS = ("email", "ip", "card", "phone", "secret")
#: Kinds that the base rules cover; secrets are reported in columns of their own.
BASE_KINDS, SECRET = 4, 4
SUPPORT, ACCEPT, LONGEST = 5, 0.85, 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]+")
# Public formats of keys, and names that secrets are assigned to.
_KEYS = re.compile(
    r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,72}|AIza[0-9A-Za-z_-]{35}|[sr]k_live_[A-Za-z0-9]{24,64})(?![A-Za-z0-9_-])"
)
_ASSIGNED = re.compile(r"""(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']([^\s"']{12,}+)["']""")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TRIGGER = np.zeros(256, dtype=bool)
_TRIGGER[[ord(c) for c in "0123456789@+"]] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outward: the local part is all that may stand before it, back to the previous match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end), sorted."""
    found = [(s, 0, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of secrets in KINDS, end) of keys in a public format and of quoted values given to a telling name; sorted, the first of overlapping ones."""
    found = [(m.start(), m.end()) for m in _KEYS.finditer(text)]
    for m in _ASSIGNED.finditer(text):
        if any(c.isdigit() for c in m[1]) and any(c.isalpha() for c in m[1]):
            found.append(m.span(1))
    kept: list[tuple[int, int, int]] = []
    for start, end in sorted(found):
        if not kept or start >= kept[-1][2]:
            kept.append((start, SECRET, end))
    return kept


def alike(word: str) -> str:
    """A word as patterns spell it: lower case, digits as 0, long words by their hash."""
    word = re.sub(r"[0-9]", "0", word.lower())
    return word if len(word) <= LONGEST else hashlib.blake2b(word.encode(), digest_size=16).hexdigest()


def _before(text: str, at: int) -> list[str]:
    """The two words that end before ``at``, in their order; quotes and brackets that open there don't count."""
    found: list[str] = []
    while at > 0 and text[at - 1] in "\"'([{<":
        at -= 1
    while len(found) < 2:
        while at > 0 and text[at - 1].isspace():
            at -= 1
        end = at
        while at > 0 and not text[at - 1].isspace():
            at -= 1
        if at == end:
            break
        found.insert(0, alike(text[at:end]))
    return found


def _after(text: str, at: int) -> list[str]:
    """The two words that begin after ``at``, the rest of a word there not counted."""
    found: list[str] = []
    while at < len(text) and not text[at].isspace():
        at += 1
    while len(found) < 2:
        while at < len(text) and text[at].isspace():
            at += 1
        begin = at
        while at < len(text) and not text[at].isspace():
            at += 1
        if at == begin:
            break
        found.append(alike(text[begin:at]))
    return found


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of text[start:end]."""
    left, right, token = _before(text, start), _after(text, end), text[start:end]
    found = ["< " + " ".join(left[-k:]) for k in range(1, len(left) + 1)] + ["> " + " ".join(right[:k]) for k in range(1, len(right) + 1)]
    if left and right:
        found.append(f"<> {left[-1]} {right[0]}")
    if 12 <= len(token) <= 19 and token.isascii() and token.isdigit() and luhn(token):
        found.append(f"# check digit {len(token)}")
    return found


def possible(token: str) -> int:
    """What a token may be by its form, a bit for each kind."""
    digits = sum("0" <= c <= "9" for c in token)
    letters = sum(c.isalpha() for c in token)
    local, at, host = token.partition("@")
    email = bool(at and local and host)
    ip = not at and not letters and token.count(".") == 3
    card = not letters and 12 <= digits <= 19 and luhn("".join(c for c in token if "0" <= c <= "9"))
    phone = not at and 7 <= digits <= 15 and letters <= 4 and token.count(".") != 3
    secret = not at and len(token) >= 12 and letters >= 4 and digits >= 4
    return email | ip << 1 | card << 2 | phone << 3 | secret << 4


def instances(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, int, list[str]]]:
    """(start, place in KINDS or -1, end, token, what it may be, patterns) of known matches and of other identifier-like tokens."""
    found = []
    for s, k, e in known:
        found.append((s, k, e, named(text[s:e]), 1 << k, patterns(text, s, e)))
        words = text[s:e].split()
        if len(words) > 1:
            found.append((e - len(words[-1]), k, e, named(words[-1]), 1 << k, patterns(text, e - len(words[-1]), e)))
    taken = iter(sorted((s, e) for s, _, e in known))
    held, done = next(taken, None), 0
    for m in _MARK.finditer(text):
        if m.start() < done:
            continue
        start, end = m.start(), m.end()
        while start > done and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        done = end
        while held and held[1] <= start:
            held = next(taken, None)
        if held and held[0] < end:
            continue
        token = text[start:end]
        cut = max(token.rfind("=", 0, len(token) - 1), token.rfind(":", 0, len(token) - 1)) + 1
        bare = token[cut:].strip("\"'()[]{}<>.,;:!?#$%&*")
        if bare and ("@" in bare or sum("0" <= c <= "9" for c in bare) >= 4):
            at = text.index(bare, start + cut)
            found.append((at, -1, at + len(bare), named(bare), possible(bare), patterns(text, at, at + len(bare))))
    return found


def named(token: str) -> str:
    """An instance's name in the graph."""
    token = token.lower()
    return token if len(token) <= LONGEST else hashlib.blake2b(token.encode(), digest_size=16).hexdigest()


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_SEEN = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("token", pa.string()), ("may", pa.int32()), ("patterns", pa.list_(pa.string()))]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, k1, k2, text) rows to (doc_id, k1, k2, known, seen)."""
    drop_worker_cache()
    for batch in batches:
        known, seen = [], []
        for block in text_blocks(batch.column(3)):
            marks = np.concatenate([[0], np.cumsum(_TRIGGER[block.data])])
            for i, any_mark in enumerate(np.diff(marks[block.offsets]).tolist()):
                if not any_mark:
                    known.append([])
                    seen.append([])
                    continue
                text = block.text(i).decode()
                spans = sorted([*base_spans(text), *secret_spans(text)])
                known.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in spans])
                seen.append([dict(zip(("start", "kind", "end", "token", "may", "patterns"), s, strict=True)) for s in instances(text, spans)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(known, _SPANS), pa.array(seen, _SEEN)], names=["doc_id", "k1", "k2", "known", "seen"])


def accepted_patterns(edges: DataFrame) -> DataFrame:
    """(pattern, token, kind or -1, may) edges, distinct, to (pattern, kind, score) at the fixed point."""
    spark = edges.sparkSession
    seeds = stage_table(edges.groupBy("token").agg(F.max("kind").alias("kind")).filter("kind >= 0").withColumn("c", F.lit(1.0)), "seeds")
    # A seed counts as known under all its patterns, also where a rule missed it.
    open_ = edges.join(seeds.select("token"), "token", "left_anti")
    against = [F.count_if(F.col("may").bitwiseAND(F.lit(1 << k)) == 0).alias(f"a{k}") for k in range(len(KINDS))]
    degree = edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT).select("pattern")
    refused = open_.groupBy("pattern").agg(*against)
    known = degree.join(refused, "pattern", "left").select("pattern", F.array(*(F.coalesce(f"a{k}", F.lit(0)) for k in range(len(KINDS)))).alias("against"))
    links = stage_table(edges.select("pattern", "token", "may").join(known, "pattern"), "pattern-links")
    accepted, sure = spark.createDataFrame([], "pattern string, kind int, score double"), seeds
    while True:
        rated = links.join(sure, "token").groupBy("pattern", "kind").agg(
            F.sum("c").alias("c"), F.first("against").alias("against"), F.count_if(F.col("c") >= 0.5).alias("support")
        )
        all_kinds = F.sum("c").over(Window.partitionBy("pattern"))
        rated = rated.withColumn("score", F.round(F.col("c") / (all_kinds + F.element_at("against", F.col("kind") + 1)), 9))
        good = rated.filter((F.col("score") >= ACCEPT) & (F.col("support") >= SUPPORT)).select("pattern", "kind", "score")
        fresh = stage_table(good.join(accepted, ["pattern", "kind"], "left_anti"), "fresh-patterns")
        if fresh.isEmpty():
            return accepted
        last = accepted, sure
        accepted = stage_table(accepted.unionByName(fresh), "patterns")
        marked = links.join(accepted, "pattern").filter(F.expr("may & shiftleft(1, kind) <> 0")).join(seeds.select("token"), "token", "left_anti")
        rated = marked.groupBy("token", "kind").agg(F.round(1 - F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.99))))), 9).alias("c"))
        best = rated.groupBy("token").agg(F.max(F.struct("c", F.negate("kind").alias("k"))).alias("x")).select("token", (-F.col("x.k")).cast("int").alias("kind"), "x.c")
        sure = stage_table(seeds.unionByName(best), "confidence")
        drop_table(fresh)
        drop_table(last[0])
        if last[1] is not seeds:
            drop_table(last[1])


def find(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, base and spans (arrays of start, kind, end) for each row; spans hold the base ones, secrets and what patterns found."""
    prepare(docs.sparkSession)
    source = keyed(docs.select("doc_id", "text")).select("doc_id", "k1", "k2", "text")
    span = "array<struct<start:int,kind:int,end:int>>"
    shape = f"doc_id long, k1 long, k2 long, known {span}, seen array<struct<start:int,kind:int,end:int,token:string,may:int,patterns:array<string>>>"
    scanned = stage_table(source.mapInArrow(_scan, shape), "pii-scan")
    occurrences = scanned.select("k1", "k2", F.explode("seen").alias("x")).select("k1", "k2", "x.start", "x.kind", "x.end", "x.token", "x.may", F.explode("x.patterns").alias("pattern"))
    edges = stage_table(occurrences.groupBy("pattern", "token").agg(F.max("kind").alias("kind"), F.max("may").alias("may")), "pattern-edges")
    marked = occurrences.filter("kind < 0").drop("kind").join(accepted_patterns(edges), "pattern").filter(F.expr("may & shiftleft(1, kind) <> 0"))
    best = marked.groupBy("k1", "k2", "start", "end").agg(F.max(F.struct("score", F.negate("kind").alias("k"))).alias("x"))
    more = best.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", (-F.col("x.k")).cast("int").alias("kind"), "end")).alias("more"))
    spans = F.array_sort(F.concat("known", F.coalesce("more", F.expr(f"cast(array() as {span})"))))
    base = F.expr(f"filter(known, x -> x.kind < {BASE_KINDS})")
    return scanned.drop("seen").join(more, ["k1", "k2"], "left").select("doc_id", "k1", "k2", base.alias("base"), spans.alias("spans"))


def spelled(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat(element_at(array({names}), x.kind + 1), ':', x.start, ':', x.end)), ',')"


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and, for secrets, n_secret and secret_spans for each row of documents."""
    found = find(docs).withColumn("secrets", F.expr(f"filter(spans, x -> x.kind = {SECRET})")).withColumn("spans", F.expr(f"filter(spans, x -> x.kind < {BASE_KINDS})"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE_KINDS])]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(spelled("base")), 256).alias("base_sha256"), F.expr(spelled("spans")).alias("spans"),
        F.size("secrets").cast("long").alias("n_secret"), F.expr(spelled("secrets")).alias("secret_spans"),
    )


def redacted(text: str, spans: list[dict]) -> str:
    """Each span becomes its kind in brackets; overlapping spans become one, named after the first."""
    parts, done = [], 0
    for s in spans:
        if s["start"] >= done:
            parts += [text[done : s["start"]], f"[{KINDS[s['kind']].upper()}]"]
        done = max(done, s["end"])
    return "".join([*parts, text[done:]])


def _redact(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Rows with the text in column ``at`` and, last, its spans (null: none) to those columns and the redacted text."""
    for batch in batches:
        new = batch.column(at).to_pylist()
        spans = batch.column(batch.num_columns - 1)
        for i in np.flatnonzero(spans.value_lengths().fill_null(0).to_numpy()).tolist():
            new[i] = redacted(new[i], spans[i].as_py())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(new, pa.string())], names=[*batch.schema.names[:-1], "redacted"])


def redact(marked: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep``, the text among them, and ``redacted``, from rows that also have spans."""
    prepare(marked.sparkSession)
    source = marked.select(*keep, "spans")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[:-1])
    return source.mapInArrow(partial(_redact, at=keep.index("text")), fields + "redacted string")
