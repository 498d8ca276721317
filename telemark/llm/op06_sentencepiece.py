"""Operator 6: SentencePiece encoding in one Aho-Corasick pass, and exact decoding.

Pieces and scores come from a model file. An Aho-Corasick automaton over the pieces reads each unit
once; at every position its output links give the pieces that end there. A character that is no piece
becomes its UTF-8 byte pieces.

Where scores are merge ranks (a BPE file, as that of the query), the longest piece is taken that stands
beside the last piece of the text before it: merging the two alone leaves them as they are. A
segmentation whose neighbours all stand is the one that merging by rank gives, so ids are the library's.
Where scores are log probabilities (a unigram file), each piece relaxes the best score up to its end;
bytes cost a heavy price and ties go to the longer last piece.

A text is cut into units where no piece of the vocabulary can cross (checked when it is loaded: before
white space, and around marks that never share a piece with others), so units are cached in a bounded
dictionary; the cache changes the speed and never the ids.

Decoding joins pieces and bytes and drops the space put in front; it returns the text exactly. A literal
U+2581 is kept apart as bytes, as it stands for white space in pieces.

Defined results. Null or empty text: no pieces, decoded to the empty string. Repeated rows: equal results.
Empty table: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .common import prepare, text_blocks, worker_cache

SPACE = "▁"
BYTE_PRICE = -1e6
CACHED_UNITS = 400_000
CACHED_PAIRS = 500_000


def load_pieces(path: str) -> tuple[list[tuple[str, float, int]], list[int]]:
    """(piece, score, id) of the ordinary pieces, and the ids of the 256 byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, by_byte = [], [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            by_byte[int(piece[3:5], 16)] = i
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            pieces.append((piece, model.get_score(i), i))
    return pieces, by_byte


def by_rank(pieces: list[tuple[str, float, int]]) -> bool:
    """Whether the scores are merge ranks, which are whole numbers."""
    return all(score == int(score) for _, score, _ in pieces)


class Codec:
    """Cuts by the highest total score or, with ``merges``, as merging by score does."""

    def __init__(self, pieces: list[tuple[str, float, int]], by_byte: list[int], merges: bool = False):
        import ahocorasick

        self.by_byte = by_byte
        self.singles = {p for p, _, _ in pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score, i in pieces:
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        self.raw = {i: p.replace(SPACE, " ").encode() for p, _, i in pieces} | {i: bytes([b]) for b, i in enumerate(by_byte)}
        self.unit = self._unit_pattern([p for p, _, _ in pieces])
        self.cache: dict[str, bytes] = {}
        self.segment = self.merged if merges else self.viterbi
        self.score = {p: s for p, s, _ in pieces}
        self.made: dict[str, tuple[float, str, str] | None] = {}
        self.beside: dict[tuple[str, str], bool] = {}

    @staticmethod
    def _unit_pattern(pieces: list[str]) -> re.Pattern:
        """Runs that no piece crosses: white space then ordinary characters, or then marks that stand apart."""
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            return re.compile(r"(?s).+")
        apart = {chr(c) for c in range(128) if not chr(c).isalnum()}
        contents = [set(p.lstrip(SPACE)) for p in pieces]
        changed = True
        while changed:
            mixed = set().union(*(s & apart for s in contents if not s <= apart))
            changed = bool(mixed)
            apart -= mixed
        marks = re.escape("".join(sorted(apart)))
        return re.compile(f"{SPACE}*[^{SPACE}{marks}]+|{SPACE}*[{marks}]+|{SPACE}+" if marks else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def viterbi(self, unit: str) -> list[int]:
        n = len(unit)
        best, back = [0.0] + [-np.inf] * n, [None] * (n + 1)
        strange = [i for i, c in enumerate(unit) if c not in self.singles] if not self.singles.issuperset(unit) else []
        strange.append(n)
        waiting = 0
        for end, (length, score, piece) in self.automaton.iter(unit):
            while strange[waiting] < end:  # bytes reach the positions before this one first
                self._as_bytes(unit, strange[waiting], best, back)
                waiting += 1
            found = best[end + 1 - length] + score
            if found > best[end + 1]:
                best[end + 1], back[end + 1] = found, (end + 1 - length, [piece])
        for i in strange[waiting:-1]:
            self._as_bytes(unit, i, best, back)
        ids, at = [], n
        while at:
            at, step = back[at]
            ids += step[::-1]
        return ids[::-1]

    def _as_bytes(self, unit: str, i: int, best: list, back: list) -> None:
        raw = unit[i].encode()
        found = best[i] + BYTE_PRICE * len(raw)
        if found > best[i + 1]:
            best[i + 1], back[i + 1] = found, (i, [self.by_byte[b] for b in raw])

    def merge(self, text: str, least: int = 1) -> list[str]:
        """Characters merged pair by pair, the highest score first, the leftmost of equal ones, down to ``least`` parts."""
        parts, score = list(text), self.score
        found = [score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
        while len(parts) > least and found and (best := max(found)) > -np.inf:
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i:
                found[i - 1] = score.get(parts[i - 1] + parts[i], -np.inf)
            if i < len(found):
                found[i] = score.get(parts[i] + parts[i + 1], -np.inf)
        return parts

    def halves(self, piece: str) -> tuple[float, str, str] | None:
        """Score of a piece and what its last merge joins; none if merging its characters does not make it."""
        if piece not in self.made:
            if len(piece) == 1:
                self.made[piece] = np.inf, "", ""
            else:
                self.made[piece] = (self.score[piece], *self.merge(piece, 2)) if self.merge(piece) == [piece] else None
        return self.made[piece]

    def stands(self, before: str, piece: str) -> bool:
        """Whether merging leaves ``piece`` as it is after ``before`` (empty: at the beginning).

        Going back merge by merge, no pair across the border may have a merge due before the one undone.
        """
        right = self.halves(piece)
        if right is None or not before:
            return right is not None
        left, score = self.halves(before), self.score
        if before + piece in score:
            return False
        while True:
            if left[0] < right[0]:
                due, before = left[0], left[2]
                left = self.halves(before)
                if score.get(before + piece, -np.inf) > due:
                    return False
            elif right[0] < np.inf:
                due, piece = right[0], right[1]
                right = self.halves(piece)
                if score.get(before + piece, -np.inf) >= due:
                    return False
            else:
                return True

    def merged(self, unit: str) -> list[int]:
        n, stands, known = len(unit), self.stands, self.beside
        last: list[str | None] = [""] + [None] * n  # the last piece of the text up to each place
        ids: list[list[int]] = [[]] * (n + 1)
        strange = [i for i, c in enumerate(unit) if c not in self.singles] if not self.singles.issuperset(unit) else []
        strange.append(n)
        waiting = 0

        def alone(i: int) -> None:
            if last[i + 1] is None and last[i] is not None and stands(last[i], unit[i]):
                last[i + 1], ids[i + 1] = unit[i], [self.by_byte[b] for b in unit[i].encode()]

        for end, (length, _, piece) in self.automaton.iter(unit):  # the longest piece of each end comes first
            while strange[waiting] < end:
                alone(strange[waiting])
                waiting += 1
            if last[end + 1] is None:
                before, text = last[end + 1 - length], unit[end + 1 - length : end + 1]
                if before is None:
                    continue
                fits = known.get((before, text))
                if fits is None:
                    if len(known) >= CACHED_PAIRS:
                        known.clear()
                    fits = known[before, text] = stands(before, text)
                if fits:
                    last[end + 1], ids[end + 1] = text, [piece]
        for i in strange[waiting:-1]:
            alone(i)
        out, at = [], n
        while at:
            out += ids[at][::-1]
            at -= len(last[at])
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        if SPACE in text:
            literal = np.array([self.by_byte[b] for b in SPACE.encode()], dtype="<u4").tobytes()
            first, *rest = text.split(SPACE)
            return literal.join([self._units(SPACE + first.replace(" ", SPACE)), *(self._units(r.replace(" ", SPACE)) for r in rest)])
        return self._units(SPACE + text.replace(" ", SPACE))

    def _units(self, normal: str) -> bytes:
        units, cache = self.unit.findall(normal), self.cache
        new = set(units).difference(cache)
        if new:
            if len(cache) + len(new) > CACHED_UNITS:
                cache.clear()
                new = set(units)
            for unit in new:
                cache[unit] = np.array(self.segment(unit), dtype="<u4").tobytes()
        return b"".join([cache[u] for u in units])

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids.tolist()]).decode().removeprefix(" ")


def codec(model: Broadcast) -> Codec:
    pieces, by_byte = model.value
    return worker_cache(f"pieces {zlib.crc32(chr(10).join(p for p, _, _ in pieces).encode())}", lambda: Codec(pieces, by_byte, by_rank(pieces)))


def _encode(batches: Iterator[pa.RecordBatch], model: Broadcast, with_ids: bool) -> Iterator[pa.RecordBatch]:
    own = codec(model)
    for batch in batches:
        count, crc, sha, lists = [], [], [], []
        for block in text_blocks(batch.column(1)):
            for i in range(block.rows):
                raw = own.encode(block.text(i).decode())
                ids = np.frombuffer(raw, dtype="<u4")
                count.append(len(ids))
                crc.append(zlib.crc32(raw))
                sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
                lists.append(ids.astype(np.int32) if with_ids else None)
        out = [batch.column(0), pa.array(count, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha, pa.string())]
        yield pa.RecordBatch.from_arrays([*out, *[pa.array(lists, pa.list_(pa.int32()))] * with_ids], names=["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", *["ids"] * with_ids])


def encode_documents(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, decoded_sha256 (of the text decoded from the ids) and, if asked for, the ids."""
    spark = docs.sparkSession
    prepare(spark)
    model = spark.sparkContext.broadcast(load_pieces(model_path))
    return docs.select("doc_id", "text").mapInArrow(partial(_encode, model=model, with_ids=with_ids), "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string" + ", ids array<int>" * with_ids)
