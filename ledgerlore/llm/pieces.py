"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a one-pass Viterbi.

At each position the automaton's state and its output links name the pieces that end there, longest first; each
relaxes the best score at that position from the position where it starts. No piece of the vocabulary has a word
mark after another character, so a text falls into units (marks, then characters up to the next mark) whose best
segmentations are independent, and a unit seen before is looked up.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.llm.token_count import PIECES

MARK = "▁"
UNITS_KEPT = 1 << 18
#: A character that no piece covers falls back to its bytes, at a cost above that of any piece.
BYTE_COST = 20.0


def scored_pieces(path: str = PIECES) -> tuple[list[tuple[str, int, float]], list[int], int]:
    """(piece, id, score), the ids of the 256 byte pieces, and the size of the vocabulary.

    A vocabulary of merges holds ranks, not probabilities. Ranks of words and word parts follow Zipf's law closely, so
    a piece of rank r scores -log(r + 2): sums then compare segmentations as a unigram model does.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain, in_bytes = [], [0] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            in_bytes[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i)):
            plain.append((model.id_to_piece(i), i))
    return [(p, i, -math.log(rank + 2)) for rank, (p, i) in enumerate(plain)], in_bytes, model.get_piece_size()


class PieceAutomaton:
    def __init__(self, pieces: Iterable[tuple[str, int, float]], in_bytes: list[int], size: int):
        self.size, self.in_bytes = size, in_bytes
        self.names: dict[int, str] = {}
        self.next: list[dict[str, int]] = [{}]
        self.piece: list[tuple[int, int, float] | None] = [None]
        for text, number, score in pieces:
            node = 0
            for c in text:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.piece.append(None)
                node = self.next[node][c]
            self.piece[node] = (len(text), number, score)
            self.names[number] = text
        self.fail, self.output = [0] * len(self.next), [0] * len(self.next)
        queue = list(self.next[0].values())
        for node in queue:
            for c, child in self.next[node].items():
                at = self.fail[node]
                while at and c not in self.next[at]:
                    at = self.fail[at]
                self.fail[child] = self.next[at].get(c, 0)
                queue.append(child)
            to = self.fail[node]
            self.output[node] = to if self.piece[to] else self.output[to]
        self.bytes_of = {number: t.replace(MARK, " ").encode() for number, t in self.names.items()}
        self.bytes_of |= {number: bytes([b]) for b, number in enumerate(in_bytes)}
        self.independent = not any(MARK in t.lstrip(MARK) for t in self.names.values())

    def best(self, text: str) -> list[int]:
        """Ids of the best segmentation; on equal scores the longest last piece wins."""
        n = len(text)
        score, back = [0.0] + [-math.inf] * n, [(0, -1)] * (n + 1)
        node = 0
        for end, c in enumerate(text, 1):
            while node and c not in self.next[node]:
                node = self.fail[node]
            node = self.next[node].get(c, 0)
            at = node if self.piece[node] else self.output[node]
            while at:
                length, number, gain = self.piece[at]
                if score[end - length] + gain > score[end]:
                    score[end], back[end] = score[end - length] + gain, (end - length, number)
                at = self.output[at]
            if score[end] == -math.inf:
                score[end], back[end] = score[end - 1] - BYTE_COST * len(c.encode()), (end - 1, -1)
        ids: list[int] = []
        while n:
            start, number = back[n]
            ids.extend([number] if number >= 0 else [self.in_bytes[b] for b in reversed(text[start:n].encode())])
            n = start
        return ids[::-1]

    def decode(self, ids: Iterable[int]) -> str:
        """The text again: pieces in a row, marks as spaces, byte pieces as UTF-8, without the mark in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode()


class Units(dict):
    """Units of text to their ids."""

    def __init__(self, machine: PieceAutomaton):
        self.machine = machine

    def __missing__(self, unit: str) -> list[int]:
        ids = self.machine.best(unit)
        if len(unit) <= 64:
            if len(self) >= UNITS_KEPT:
                self.clear()
            self[unit] = ids
        return ids


_UNIT = regex.compile(f"{MARK}+[^{MARK}]*")


def encode(text: str, units: Units) -> list[int]:
    """A mark is put in front, as for every word, and spaces become marks. The empty text has no pieces.

    A text that holds the mark itself is spelt with the mark's bytes, so that decoding gives it back.
    """
    if not text:
        return []
    out: list[int] = []
    if MARK in text:
        for n, part in enumerate(text.split(MARK)):
            if n:
                out.extend(units.machine.in_bytes[b] for b in MARK.encode())
            if not n:
                out.extend(_encode(MARK + part.replace(" ", MARK), units))
            elif part:
                out.extend(_encode(part.replace(" ", MARK), units))
        return out
    return _encode(MARK + text.replace(" ", MARK), units)


def _encode(marked: str, units: Units) -> list[int]:
    if not units.machine.independent:
        return units.machine.best(marked)
    out: list[int] = []
    if marked[0] != MARK:
        cut = marked.find(MARK)
        cut = len(marked) if cut < 0 else cut
        out.extend(units[marked[:cut]])
        marked = marked[cut:]
    for ids in map(units.__getitem__, _UNIT.findall(marked)):
        out += ids
    return out


def encoded(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """``(doc_id, n_pieces, n_byte_pieces, pieces, decoded_equal)`` for every row of ``docs`` (doc_id, text).

    ``pieces`` are the ids; ``decoded_equal`` says whether decoding them gives the text again, which holds for every
    text. A null text has a null list and null counts, the empty text an empty list. Repeated rows give repeated
    results; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(scored_pieces(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = PieceAutomaton(*shipped.value)
        units = Units(machine)
        is_byte = np.zeros(machine.size, bool)
        is_byte[machine.in_bytes] = True
        for batch in C.arrow_rows(batches, 200):
            texts = batch.column(1).to_pylist()
            ids = [None if t is None else np.array(encode(t, units), np.int32) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([None if x is None else len(x) for x in ids], pa.int64()),
                    pa.array([None if x is None else int(is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([None if x is None else machine.decode(x.tolist()) == t for x, t in zip(ids, texts)]),
                ],
                names=["doc_id", "n_pieces", "n_byte_pieces", "pieces", "decoded_equal"],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id long, n_pieces long, n_byte_pieces long, pieces array<int>, decoded_equal boolean")
