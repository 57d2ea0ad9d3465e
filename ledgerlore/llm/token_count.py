"""Word-piece token counts by a linear longest-match automaton.

The automaton is a trie of the vocabulary. Each node has a failure link and the number of pieces that the greedy
longest match emits ("pops") before it stands at the link's node, so a word's count is the sum of pops along one
pass over its characters: no piece is ever built and no character is read twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"
DEAD = -1


def vocabulary(path: str = PIECES) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one, from a public vocabulary that marks word starts."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    first = [p[1:] for p in plain if p.startswith(START) and p.strip(START)]
    return [p for p in first if START not in p], [p for p in plain if START not in p]


class LongestMatch:
    """Greedy longest-match piece counts of words; -1 for a word that no sequence of pieces spells."""

    def __init__(self, first: Iterable[str], rest: Iterable[str]):
        # node 0: start of a word, node 1: after a piece; both are roots of one trie each
        self.next: list[dict[str, int]] = [{}, {}]
        is_piece = [False, False]
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                node = root
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        is_piece.append(False)
                    node = self.next[node][c]
                is_piece[node] = node > 1
        self.fail, self.pops = [DEAD] * len(self.next), [0] * len(self.next)
        queue = [0, 1]
        for node in queue:
            for c, child in self.next[node].items():
                if is_piece[child]:
                    self.fail[child], self.pops[child] = 1, 1
                else:
                    at, popped = self.fail[node], self.pops[node]
                    while at != DEAD and c not in self.next[at]:
                        popped += self.pops[at]
                        at = self.fail[at]
                    if at != DEAD:
                        self.fail[child], self.pops[child] = self.next[at][c], popped
                queue.append(child)

    def count(self, word: str) -> int:
        node = total = 0
        for c in word:
            while c not in self.next[node]:
                total += self.pops[node]
                node = self.fail[node]
                if node == DEAD:
                    return -1
            node = self.next[node][c]
        while node != 1:
            total += self.pops[node]
            node = self.fail[node]
            if node == DEAD:
                return -1
        return total


class Counts(dict):
    def __init__(self, machine: LongestMatch):
        self.machine = machine

    def __missing__(self, word: bytes) -> int:
        if len(self) >= C.CODES_KEPT // 2:
            self.clear()
        n = self[word] = self.machine.count(word.decode())
        return n


def token_counts(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """``(doc_id, n_words, n_tokens, n_unknown)`` for every row of ``docs`` (doc_id, text).

    Words are split at ASCII white space. ``n_tokens`` is the number of pieces of the greedy longest match, where a
    word that cannot be spelt counts as one unknown token, also given in ``n_unknown``. A null or blank text has
    zeros. Repeated rows give repeated results; other columns are not read.
    """
    # The vocabulary is one file of fixed size, read where the plan is made.
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(LongestMatch(*shipped.value))
        for batch in C.arrow_rows(batches, 1000):
            words, tokens, unknown = [], [], []
            for text in C.byte_texts(batch.column(1)):
                split = text.split()
                n = np.fromiter(map(counts.__getitem__, split), np.int64, len(split))
                bad = int((n < 0).sum())
                words.append(len(split))
                tokens.append(int(n.sum()) + 2 * bad)
                unknown.append(bad)
            columns = [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(count, "doc_id long, n_words long, n_tokens long, n_unknown long")
