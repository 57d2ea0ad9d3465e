"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton reads the words of all items once; a document's words then walk it, and the length of the longest
item substring that ends at each word is known after constant amortised work per word. Words that no item has end
every match, so only runs of item words as long as the shortest window are walked at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C

WINDOW = 10
SHARD_WORDS = 500_000  # item words in one automaton, which is what bounds the broadcast

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters and characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """All substrings of several word sequences; each state knows its length, link and the items it occurs in."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[str] = []
        self.ends: list[set[int]] = [set()]
        self.whole: dict[int, set[int]] = {}
        self.shortest = window
        for name, words in items:
            if not words:
                continue
            item = len(self.names)
            self.names.append(name)
            self.shortest = min(self.shortest, len(words))
            last = 0
            for word in words:
                last = self._extend(self.words.setdefault(word, len(self.words) + 1), last)
                self.ends[last].add(item)
            if len(words) < window:
                self.whole.setdefault(last, set()).add(item)
        # An item with the strings of a state has those of its link as well; only windows are asked for.
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.length[self.link[state]] >= window:
                self.ends[self.link[state]] |= self.ends[state]

    def ending(self, state: int, length: int) -> tuple[int, set[int]]:
        """Longest window that ends with a match of ``length`` at ``state``, and the items of all that do."""
        cover, items = 0, set()
        while state > 0:
            if self.length[self.link[state]] < self.window <= min(self.length[state], length):
                cover, items = max(cover, self.window), items | self.ends[state]
            if state in self.whole and self.length[state] <= length:
                cover, items = max(cover, self.length[state]), items | self.whole[state]
            state = self.link[state]
        return cover, items

    def scan(self, words: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans [from, to) in order, and the items whose windows occur; ``words`` are codes, 0 if in no item."""
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        known = np.flatnonzero(np.diff(np.concatenate([[0], words != 0, [0]])))
        for start, end in known.reshape(-1, 2):
            if end - start < self.shortest:
                continue
            state = length = 0
            for at, word in enumerate(words[start:end].tolist(), int(start)):
                while state and word not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
                if word in self.next[state]:
                    state, length = self.next[state][word], length + 1
                if length >= self.shortest:
                    cover, here = self.ending(state, length)
                    if cover:
                        items |= here
                        first = at + 1 - cover
                        while spans and spans[-1][1] >= first:
                            first = min(first, spans.pop()[0])
                        spans.append((first, at + 1))
        return spans, items

    def _extend(self, word: int, last: int) -> int:
        if word in self.next[last]:
            target = self.next[last][word]
            if self.length[target] == self.length[last] + 1:
                return target
            return self._clone(last, word, target)
        state = self._state({}, 0, self.length[last] + 1)
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            target = self.next[at][word]
            self.link[state] = target if self.length[target] == self.length[at] + 1 else self._clone(at, word, target)
        return state

    def _clone(self, at: int, word: int, target: int) -> int:
        copy = self._state(dict(self.next[target]), self.link[target], self.length[at] + 1)
        while at != -1 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        self.link[target] = copy
        return copy

    def _state(self, following: dict[int, int], link: int, length: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1


def automata(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> Iterator[SuffixAutomaton]:
    """One automaton per ``shard_words`` item words; a larger benchmark takes more passes, not more memory.

    Items without an id or without words are in none.
    """
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    shard, size = [], 0
    for name, text in rows.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = words_of(text.encode())
        if shard and size + len(words) > shard_words:
            yield SuffixAutomaton(shard, window)
            shard, size = [], 0
        shard.append((name, words))
        size += len(words)
    yield SuffixAutomaton(shard, window)


def merged(spans: np.ndarray) -> np.ndarray:
    """Union of spans [from, to), as a flat array in order."""
    out: list[list[int]] = []
    for start, end in sorted(spans.reshape(-1, 2).tolist()):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return np.array(out, np.int32).ravel()


def contamination(rows: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(row, text, n_words, spans, items)`` for each of ``rows`` (row: any type, text: string).

    ``spans`` holds the merged spans of hit words, [from, to) one after the other; ``items`` the distinct ids of the
    items with an occurring window, sorted as strings. A null or wordless text has no words and no hits. Repeated
    rows give repeated results; items that share an id are reported as one. An empty benchmark hits nothing.
    """
    context = rows.sparkSession.sparkContext
    rows = rows.select(
        "row", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items")
    )
    for automaton in automata(benchmark, window, shard_words):
        shipped = context.broadcast(automaton)

        def scan(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            machine = shipped.value
            known = machine.words.get
            for batch in C.arrow_rows(batches, 1000):
                counts, spans, items = [], C.list_rows(batch.column(3), np.int32), batch.column(4).to_pylist()
                for i, text in enumerate(C.byte_texts(batch.column(1))):
                    words = words_of(text)
                    counts.append(len(words))
                    codes = np.fromiter((known(w, 0) for w in words), np.int32, len(words))
                    if not codes.any():
                        continue
                    found, names = machine.scan(codes)
                    if found:
                        spans[i] = merged(np.concatenate([spans[i], np.array(found, np.int32).ravel()]))
                        items[i] = sorted({*items[i], *(machine.names[x] for x in names)})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(counts, pa.int64()),
                        C.lists(spans, pa.int32()),
                        pa.array(items, pa.list_(pa.string())),
                    ],
                    names=["row", "text", "n_words", "spans", "items"],
                )

        rows = rows.mapInArrow(scan, rows.schema)
    return rows


def digest(found: DataFrame) -> DataFrame:
    """The result columns of the query, from ``contamination`` over rows that are document ids."""
    signed = F.transform("spans", lambda at, i: F.when(i % 2 == 1, at).otherwise(-at).cast("long"))
    hit = F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)
    return found.select(
        F.col("row").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, most: float = 0.8) -> DataFrame:
    """``docs`` with the hit spans cut out of ``text``; a document goes whole if its hit share is above ``most``.

    Untouched documents keep their text byte for byte. All columns of ``docs`` stay; ``n_chars`` is counted anew where
    a text was cut.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), C.list_rows(batch.column(3), np.int32)
            keep = np.ones(batch.num_rows, bool)
            for i, pairs in enumerate(spans):
                if len(pairs):
                    hit = int((pairs[1::2] - pairs[::2]).sum())
                    keep[i] = hit <= most * batch.column(2)[i].as_py()
                    texts[i] = without_words(texts[i].encode(), pairs.reshape(-1, 2).tolist()) if keep[i] else None
            out = [batch.column(0), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["row", "text"]).filter(pa.array(keep))

    rows = docs.select(F.struct("*").alias("row"), F.col("text"))
    schema = rows.schema
    found = contamination(rows, benchmark, window).mapInArrow(cut, schema)
    changed = ~F.col("text").eqNullSafe(F.col("row.text"))
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("row")["n_chars"])
    return found.select(*[column.alias(name) for name, column in columns.items()])


def without_words(text: bytes, spans: list[list[int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    folded = text.translate(_FOLD)
    starts = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(folded, np.uint8) != 32, [0]])))
    begin, end = starts[::2], starts[1::2]
    parts, at = [], 0
    for first, last in spans:
        parts.append(text[at : begin[first]])
        at = int(end[last - 1])
    return b"".join([*parts, text[at:]]).decode()
