"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the vocabulary reads a text once.  At each position it follows
the output links, that is all pieces ending there, and relaxes the best score of a
segmentation up to that position; back pointers give the pieces.  A character that no piece
covers becomes its UTF-8 bytes.

No piece has a space mark after another character, so a segmentation falls apart at word
starts (and at characters in no piece); words are segmented once per worker and kept in two
tables of CACHE_UNITS in all, the older dropped when the younger is full, so memory is bounded
and the result does not change.  Units over SHORT characters are not kept and take 20 bytes a
character while they are segmented.

A vocabulary file of the byte-pair kind scores pieces by rank, which is no likelihood: the
score of a piece is then -log(rank + 2), by Zipf's law; unigram files give their own scores.
Of equal scores the segmentation whose last piece is longer wins.

Spaces become the mark, one is put in front, nothing else is normalised, and a literal mark
is written as bytes, so decoding gives back any text exactly.  Null counts as empty, and an
empty text has no pieces.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MARK = "▁"
CACHE_UNITS = 400_000
SHORT = 256
UNCOVERED = 10.0  # a character that is no piece scores this much below the worst piece


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and scores; ids of the 256 bytes."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read on the driver; executors get the vocabulary itself."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        plain = [i for i in range(count) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        ranks = all(float(model.get_score(i)).is_integer() for i in plain)
        score = (lambda i: -math.log(2 - model.get_score(i))) if ranks else model.get_score
        return cls(tuple((model.id_to_piece(i), i, score(i)) for i in plain), tuple(byte_ids))


@dataclass
class Coder:
    vocabulary: Vocabulary
    known: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, i, score in self.vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.floor = min(s for _, _, s in self.vocabulary.pieces) - UNCOVERED
        self.ids = {p: i for p, i, _ in self.vocabulary.pieces}
        self.bytes = {i: p.replace(MARK, " ").encode() for p, i, _ in self.vocabulary.pieces} | {i: bytes([b]) for b, i in enumerate(self.vocabulary.byte_ids)}
        self.newline = not any("\n" in p for p, _, _ in self.vocabulary.pieces)

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation, one pass over the text; 20 bytes a character if long."""
        n, floor = len(text), self.floor
        if n <= SHORT:
            best, back, piece = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        else:
            best, back, piece = array("d", bytes(8 * (n + 1))), array("q", bytes(8 * (n + 1))), array("i", [-1]) * (n + 1)
        at = 0  # positions up to here have the edge over one character as bytes, always there
        for end, (size, i, score) in self.automaton.iter(text):
            end += 1
            while at < end:
                at += 1
                best[at] = best[at - 1] + floor
                back[at] = at - 1
            start = end - size
            total = best[start] + score
            if total > best[end] or (total == best[end] and start < back[end]):
                best[end], back[end], piece[end] = total, start, i
        while at < n:
            at += 1
            best[at] = best[at - 1] + floor
            back[at] = at - 1
        out = array("i")
        while n:
            start = back[n]
            if piece[n] >= 0:
                out.append(piece[n])
            else:
                out.extend(self.vocabulary.byte_ids[b] for b in reversed(text[start:n].encode()))
            n = start
        out.reverse()
        return out.tolist() if len(text) <= SHORT else out

    def _unit(self, unit: str) -> bytes:
        """A unit that is not in the younger table: from the older one, or segmented."""
        out = self.older.get(unit)
        if out is None:
            out = np.array(self.segment(unit), "<u4").tobytes()
        if len(unit) <= SHORT:
            if len(self.known) >= CACHE_UNITS // 2:
                self.older = dict(self.known)
                self.known.clear()
            self.known[unit] = out
        return out

    def _plain(self, text: str) -> Iterator[str]:
        """Units of a text without literal marks, its spaces already marks."""
        at, n = 0, len(text)
        while at < n:
            end = at
            while end < n and text[end] == MARK:
                end += 1
            stop = text.find(MARK, end)
            yield text[at : stop if stop >= 0 else n]
            at = stop if stop >= 0 else n

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        out, known = [], self.known
        literal = np.array([self.vocabulary.byte_ids[b] for b in MARK.encode()], "<u4").tobytes()
        for k, part in enumerate(text.split(MARK)):
            if k:
                out.append(literal)
            if k and not part:
                continue
            words = ((" " if not k else "") + part).replace(" ", MARK)
            if MARK * 2 in words or k:
                units = list(self._plain(words))
            else:
                units = [MARK + w for w in words[1:].split(MARK)]
            for unit in units:
                if self.newline and "\n" in unit:
                    for j, line in enumerate(unit.split("\n")):
                        if j:
                            out.append(known.get("\n") or self._unit("\n"))
                        if line:
                            out.append(known.get(line) or self._unit(line))
                else:
                    out.append(known.get(unit) or self._unit(unit))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        text = b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode()
        return text[1:]


_CODERS: dict[Vocabulary, Coder] = {}


def coder(vocabulary: Vocabulary) -> Coder:
    """One automaton and table of words per worker and vocabulary."""
    if vocabulary not in _CODERS:
        _CODERS.clear()
        _CODERS[vocabulary] = Coder(vocabulary)
    return _CODERS[vocabulary]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: little-endian 32-bit ids, packed."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(vocabulary.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([use.encode(t or "") for t in batch.column(1).to_pylist()], pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, text."""
    vocabulary = coded.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(vocabulary.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([use.decode(i or b"") for i in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pieces, n_bytes (pieces that are bytes), ids_sha256, decoded_sha256, round_trip."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(vocabulary.value)
        low = np.array(sorted(vocabulary.value.byte_ids))
        for batch in slices(batches):
            out = []
            for text in batch.column(1).to_pylist():
                ids = use.encode(text or "")
                back = use.decode(ids)
                single = int(np.isin(np.frombuffer(ids, "<u4"), low).sum())
                out.append((len(ids) // 4, single, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
            n, single, ids, back, same = zip(*out, strict=True) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(single, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string()), pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "n_bytes", "ids_sha256", "decoded_sha256", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, n_bytes long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
