"""Substring dedup on paragraphs: MinHash banding, exact Jaccard on what collides, removal by components.

A *paragraph* is cut by content, not by lines: it begins at each word whose rolling hash is the smallest among ``REACH``
words on either side. Equal passages therefore fall into equal paragraphs wherever they stand, inside a line or across
several, but for the first and the last one. Equal paragraphs become one by a digest. ``BANDS`` bands of ``ROWS``
minima find a pair of similarity 0.8 with probability 1 - (1 - 0.8^2)^3 = 0.953; colliding paragraphs are then joined
exactly (``jaccard_join.resolve``), so a collision alone removes nothing. Of each component the occurrence with the
smallest (doc_id, paragraph) stays.

Elsewhere paragraphs in a row make a passage; a similar one next to an equal one is left to what follows. The passage
is extended word by word on both sides as far as the words around
the occurrences that stay are the same, joined to the next passage if at most ``GAP`` words or a fifth between them
differ, and removed if it has ``MIN_WORDS`` words by then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.llm.jaccard_join import resolve, shared_among
from ledgerlore.session import materialise

SHINGLE, PERCENT = 5, 80
MIN_WORDS = 40
REACH, ROLL = 6, 3
BANDS, ROWS = 3, 2
GAP = 4
CONTEXT = 64  # words around a paragraph that stays, to extend passages by
SLICE = 1 << 20  # bytes of text worked on at once

_SEEDS = np.random.default_rng(17).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LETTER = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the words of all texts one after the other, and how many words each text has.

    Words are split at ASCII white space, with A-Z in lower case. A code is a polynomial over the word's bytes; all
    words are coded at once.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    at = np.flatnonzero(~_SPACE[data])
    if not len(at):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    size = np.diff(np.append(first, len(at)))
    powers = np.cumprod(np.full(int(size.max()), np.uint64(0x9E3779B97F4A7C15)))
    within = np.arange(len(at)) - np.repeat(first, size)
    codes = C.mixed(np.add.reduceat(_LETTER[data[at]] * powers[within], first) + size.astype(np.uint64))
    stops = np.cumsum(np.array([len(t) + 1 for t in texts]))
    return codes, np.diff(np.searchsorted(at[first], stops), prepend=0)


def paragraph_starts(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Where paragraphs begin in the words of several texts; a text of ``SHINGLE`` words or more begins one.

    No paragraph has fewer than ``SHINGLE`` words, and none reaches into the next text.
    """
    if not len(words):
        return np.empty(0, np.int64)
    ends = np.cumsum(n)
    first = np.repeat(ends - n, n)  # per word, where its text begins and ends
    last = np.repeat(ends, n)
    at = np.arange(len(words))
    roll = np.full(len(words), np.uint64(ROLL))
    for i in range(ROLL):
        roll = roll * np.uint64(0x9E3779B97F4A7C15) + words[np.minimum(at + i, len(words) - 1)]
    roll = C.mixed(roll)
    roll[at + ROLL > last] = _LAST
    cut = (at - first >= SHINGLE) & (last - at >= SHINGLE)
    for away in range(1, REACH + 1):
        before, after = roll[np.maximum(at - away, 0)], roll[np.minimum(at + away, len(words) - 1)]
        cut &= (at - away < first) | (roll < before)
        cut &= (at + away >= last) | (roll <= after)
    cut[(ends - n)[n >= SHINGLE]] = True
    return np.flatnonzero(cut)


def paragraph_ends(starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the paragraphs end, and which text each is of."""
    ends = np.cumsum(n)
    text = np.searchsorted(ends, starts, side="right")
    return np.minimum(np.append(starts[1:], ends[-1:]), ends[text]), text


def paragraph_ids(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of the words of each paragraph, in order."""
    if not len(starts):
        return np.empty(0, np.uint64)
    size = ends - starts
    offset = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(offset, size)
    taken = words[np.repeat(starts, size) + within]
    each = C.mixed(taken + (within.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return C.mixed(np.add.reduceat(each, offset) + size.astype(np.uint64))


def band_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of ``BANDS`` keys per paragraph, from the minima over its shingles."""
    if not len(starts):
        return np.empty((0, BANDS), np.uint64)
    runs = C.shingle_codes(words, SHINGLE)
    size = ends - starts - SHINGLE + 1
    offset = np.cumsum(size) - size
    inside = runs[np.repeat(starts - offset, size) + np.arange(int(size.sum()))]
    keys = np.empty((len(starts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(starts), np.uint64(band + 1))
        for seed in _SEEDS[band * ROWS : (band + 1) * ROWS]:
            key = C.mixed(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(inside * seed, offset))
        keys[:, band] = key
    return keys


def keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, text)``; ``key`` stands for the row's content."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("key"), text.alias("text"))


def split(array: np.ndarray, owner: np.ndarray, rows: int, kind: pa.DataType = pa.int64()) -> pa.ListArray:
    """``array`` as one list per row, given the row of each element in order."""
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=rows))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(array, kind))


def described(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, ids, bands)`` for every row: the digests of its paragraphs in order, and their band keys."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_slices(batches, 2, SLICE):
            words, n = coded(C.byte_texts(batch.column(2)))
            starts = paragraph_starts(words, n)
            ends, text = paragraph_ends(starts, n)
            ids = split(C.signed(paragraph_ids(words, starts, ends)), text, batch.num_rows)
            bands = split(C.signed(band_keys(words, starts, ends).ravel()), np.repeat(text, BANDS), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids, bands], names=["doc_id", "key", "ids", "bands"])

    return keyed(docs).mapInArrow(describe, "doc_id long, key long, ids array<long>, bands array<long>")


def sets_of(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """``(id, tokens)``: the shingle sets of the paragraphs ``texts`` (id, key), each from the row with that key."""
    ids = docs.sparkSession.sparkContext.broadcast(C.id_filter(texts.select("id")))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_slices(batches, 2, SLICE):
            words, n = coded(C.byte_texts(batch.column(2)))
            starts = paragraph_starts(words, n)
            ends, text = paragraph_ends(starts, n)
            found = C.signed(paragraph_ids(words, starts, ends))
            wanted = np.flatnonzero(C.passes(ids.value, found))
            size = (ends - starts)[wanted] - SHINGLE + 1
            offset = np.cumsum(size) - size
            at = np.repeat(starts[wanted] - offset, size) + np.arange(int(size.sum()))
            tokens, owner = C.shingle_codes(words, SHINGLE)[at], np.repeat(np.arange(len(wanted)), size)
            order = np.lexsort((tokens, owner))
            tokens, owner = tokens[order], owner[order]
            new = np.ones(len(tokens), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
            keys = batch.column(1).to_numpy()[text[wanted]]
            sets = split(C.signed(tokens[new]), owner[new], len(wanted))
            yield pa.RecordBatch.from_arrays([pa.array(found[wanted]), pa.array(keys, pa.int64()), sets], names=["id", "key", "tokens"])

    built = C.sieve(keyed(docs), texts, "key").mapInArrow(build, "id long, key long, tokens array<long>")
    once = built.groupBy("id", "key").agg(F.first("tokens").alias("tokens"))
    return once.join(texts.select("id", "key"), ["id", "key"], "left_semi").select("id", "tokens")


def occurrences(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(doc_id, key, i, id)``: the paragraphs of ``described`` rows that are likely among the ids of ``wanted``, which
    are hashes already."""
    bitmap = rows.sparkSession.sparkContext.broadcast(C.id_filter(wanted.select("id")))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row, place = flat(batch.column(2))
            keep = C.passes(bitmap.value, ids)
            row = pa.array(row[keep])
            columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(place[keep], pa.int32()), pa.array(ids[keep])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "i", "id"])

    return rows.select("doc_id", "key", "ids").mapInArrow(pick, "doc_id long, key long, i int, id long")


def colliding_ids(rows: DataFrame) -> DataFrame:
    """``(hub, id)``: paragraphs that share a band key with others, under the smallest id that has it."""
    bands = rows.select("ids", F.posexplode("bands").alias("j", "token"))
    tokens = bands.select(F.col("ids")[F.floor(F.col("j") / BANDS).cast("int")].alias("id"), "token")
    shared = shared_among(tokens, "paragraphs")
    # Most keys are of one paragraph only and fall to a bitmap before they travel again.
    bitmap = rows.sparkSession.sparkContext.broadcast(C.id_filter(shared.select("token")))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = flat(batch.column(1))[0]
            keep = C.passes(bitmap.value, keys)
            ids = np.repeat(flat(batch.column(0))[0], BANDS)[keep]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys[keep])], names=["id", "token"])

    likely = rows.select("ids", "bands").mapInArrow(pick, "id long, token long")
    return materialise(C.join_groups(likely, shared, "token", "m").select(F.col("low").alias("hub"), "id").distinct(), "paragraphs")


def flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements of all lists, and for each the row and the place in it."""
    n = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values, np.repeat(np.arange(len(n)), n), np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)


def surroundings(docs: DataFrame, stays: DataFrame) -> DataFrame:
    """``(key, i, before, after)``: the words around paragraph ``i`` of the row ``key``, for each of ``stays`` (key, i).

    Words are 32-bit codes, up to ``CONTEXT`` on either side, the nearest one last in ``before`` and first in ``after``.
    """
    asked = stays.groupBy("key").agg(F.array_sort(F.collect_set("i")).alias("places"))
    rows = C.sieve(keyed(docs), asked, "key").dropDuplicates(["key"]).join(asked, "key").select("key", "places", "text")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_slices(batches, 2, SLICE):
            words, n = coded(C.byte_texts(batch.column(2)))
            starts = paragraph_starts(words, n)
            ends, text = paragraph_ends(starts, n)
            stop = np.cumsum(n)
            first = np.searchsorted(text, np.arange(batch.num_rows))
            keys, numbers, before, after = [], [], [], []
            words = words.astype(np.uint32)
            for row, (key, places) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                for i in places:
                    at = first[row] + i
                    keys.append(key)
                    numbers.append(i)
                    before.append(words[max(stop[row] - n[row], starts[at] - CONTEXT) : starts[at]].tobytes())
                    after.append(words[ends[at] : min(stop[row], ends[at] + CONTEXT)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(numbers, pa.int32()), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                names=["key", "i", "before", "after"],
            )

    return rows.mapInArrow(take, "key long, i int, before binary, after binary")


def repeats(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(key, places, kept_in, words)`` of the rows with paragraphs whose like stays in another document.

    ``places`` are the numbers of these paragraphs in order and ``kept_in`` the documents of those that stay. ``words``
    (i, before, after) has, for paragraphs at which a passage begins or stops, the words around the like. A written table.
    """
    rows = materialise(described(docs), "paragraphs")
    each = rows.select("doc_id", "key", F.posexplode("ids").alias("i", "id"))
    place = F.struct("doc_id", "key", "i")
    repeated = materialise(
        each.groupBy("id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1), "paragraphs"
    )
    members = colliding_ids(rows)
    near = materialise(members.select("id").distinct(), "paragraphs")
    # Paragraphs that collide may occur once, and then are not among the repeated ones.
    colliding = occurrences(rows, near).groupBy("id").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    colliding = materialise(colliding.join(near, "id", "left_semi"), "paragraphs")
    sets = materialise(sets_of(docs, materialise(colliding.select("id", F.col("first.key").alias("key")), "paragraphs")), "paragraphs")
    found = materialise(resolve(members, sets, percent, "paragraphs", few=64), "paragraphs")

    placed = repeated.unionByName(colliding.join(repeated, "id", "left_anti").join(found, "id", "left_semi"))
    placed = materialise(placed.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")), "paragraphs")
    groups = placed.groupBy("component").agg(F.min("first").alias("stays"), F.count(F.lit(1)).alias("n_texts"))
    labels = C.join_groups(placed, materialise(groups, "paragraphs"), "component", "n_texts")
    labels = materialise(labels.select("id", "n", "stays", (F.col("first") == F.col("stays")).alias("equal")), "paragraphs")
    gone = C.join_groups(occurrences(rows, labels), labels, "id", "n").where(~F.col("doc_id").eqNullSafe(F.col("stays.doc_id")))
    inside = F.struct("i", "equal", F.col("stays.doc_id").alias("kept_in"), F.col("stays.key").alias("like"), F.col("stays.i").alias("at"))
    lost = gone.groupBy("key").agg(F.array_sort(F.collect_set(inside)).alias("x"))

    def next_to(x: str, e, j, step: int):
        """Whether the paragraph on one side of ``e``, the j-th of the sorted ``x``, is in ``x`` as well; and equal."""
        other = F.get(x, j + step)
        beside = F.coalesce(other["i"] == e["i"] + step, F.lit(False))
        return beside, beside & F.coalesce(other["equal"], F.lit(False))

    # Beside a paragraph that is equal word by word, extending that one says more than a similar paragraph does.
    clear = F.filter("x", lambda e, j: e["equal"] | ~(next_to("x", e, j, -1)[1] | next_to("x", e, j, 1)[1]))
    ends = F.transform(
        "y",
        lambda e, j: F.struct(
            *[e[c].alias(c) for c in ("i", "kept_in", "like", "at")],
            (~next_to("y", e, j, -1)[0]).alias("begins"),
            (~next_to("y", e, j, 1)[0]).alias("stops"),
        ),
    )
    lost = lost.withColumn("y", clear).select("key", F.col("y.i").alias("places"), F.col("y.kept_in").alias("kept_in"), ends.alias("ends"))
    lost = materialise(lost, "paragraphs")
    # Only where a passage begins or stops do the words around its like matter.
    edges = lost.select("key", F.explode("ends").alias("e")).where("e.begins OR e.stops").select("key", "e.*")
    edges = edges.withColumn("place", F.xxhash64("like", "at"))
    asked = edges.groupBy("place").agg(F.first("like").alias("key"), F.first("at").alias("i"), F.count(F.lit(1)).alias("n"))
    asked = materialise(asked, "paragraphs")
    around = surroundings(docs, asked.select("key", "i")).withColumn("place", F.xxhash64("key", "i")).drop("key", "i")
    around = materialise(asked.select("place", "n").join(around, "place"), "paragraphs")
    words = C.join_groups(edges, around, "place", "n").select(
        "key",
        F.struct("i", F.when(F.col("begins"), F.col("before")).alias("before"), F.when(F.col("stops"), F.col("after")).alias("after")).alias("w"),
    )
    words = words.groupBy("key").agg(F.array_sort(F.collect_list("w")).alias("words"))
    return materialise(lost.drop("ends").join(words, "key"), "paragraphs")


def shared_end(one: np.ndarray, other: np.ndarray) -> int:
    """How many words two sequences have in common at their ends."""
    n = min(len(one), len(other))
    differ = np.flatnonzero(one[len(one) - n :][::-1] != other[len(other) - n :][::-1])
    return int(differ[0]) if len(differ) else n


def passages(
    words: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: list[int], before: list[bytes], after: list[bytes], least: int
) -> list[tuple[int, int]]:
    """Spans [from, to) of the words of one text that are removed; see the module's description."""
    runs: list[list[int]] = []  # from, to, and the last paragraph
    n = len(words)
    for at, i in enumerate(places):
        if runs and runs[-1][2] == i - 1:
            runs[-1][1:] = [int(ends[i]), i]
            continue
        left = int(starts[i])
        limit = runs[-1][1] if runs else 0
        context = np.frombuffer(before[at], np.uint32)
        left -= shared_end(words[limit:left], context)
        if runs:
            held = np.frombuffer(after[at - 1], np.uint32)
            right = limit + shared_end(words[limit:left][::-1], held[::-1])
            if left - right <= max(GAP, (int(starts[i]) - limit) // 5):
                runs[-1][1:] = [int(ends[i]), i]
                continue
            runs[-1][1] = right
        runs.append([left, int(ends[i]), i])
    if runs:
        held = np.frombuffer(after[-1], np.uint32)
        runs[-1][1] += shared_end(words[runs[-1][1] : n][::-1], held[::-1])
    return [(a, b) for a, b, _ in runs if b - a >= least]


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without the words of the spans and what stands between them; a line that is left empty goes as well."""
    letters = np.frombuffer(text, np.uint8)
    filled = ~np.isin(letters, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], filled.view(np.int8), [0]])))
    begin, end = edges[::2], edges[1::2]
    parts, at = [], 0
    for first, last in spans:
        start, stop = int(begin[first]), int(end[last - 1])
        parts.append(text[at:start])
        at = stop
        if (start == 0 or text[start - 1 : start] == b"\n") and text[stop : stop + 1] == b"\n":
            at += 1
    return b"".join([*parts, text[at:]])


def shortened(batch: pa.RecordBatch, least: int) -> Iterator[tuple[int, str, list[tuple[int, int]], np.ndarray]]:
    """(row, text, spans, paragraph starts) of the rows of (_, text, places, words) that lose something."""
    texts = C.byte_texts(batch.column(1))
    words, n = coded(texts)
    starts = paragraph_starts(words, n)
    ends, text = paragraph_ends(starts, n)
    stop, bounds = np.cumsum(n), np.searchsorted(text, np.arange(len(texts) + 1))
    words = words.astype(np.uint32)
    for row, places in enumerate(batch.column(2).to_pylist()):
        if not places:
            continue
        begin, own = stop[row] - n[row], slice(bounds[row], bounds[row + 1])
        around = {w["i"]: w for w in batch.column(3)[row].as_py()}
        before, after = ([(around.get(i) or {}).get(side) or b"" for i in places] for side in ("before", "after"))
        first, last = starts[own] - begin, ends[own] - begin
        spans = passages(words[begin : stop[row]], first, last, places, before, after, least)
        if spans:
            yield row, without_spans(texts[row], spans).decode(), spans, first


def paragraph_repeats(docs: DataFrame, least: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, text, n_passages, words_removed, kept_in)`` for every row of ``docs`` (doc_id, text), ``text`` being
    what is left of it.

    Untouched texts stay byte for byte; null stays null, and a text all of which goes becomes empty. Rows that share an
    id count as one document: what stays, stays in all of them, and repeats inside one document are left alone. A null
    id sorts first, so what it holds stays. ``kept_in`` lists the documents whose paragraphs the removed ones
    were matched with. Other columns are not read.
    """
    lost = repeats(docs, percent)
    rows = keyed(docs)
    none = [F.lit(0).cast("long").alias(c) for c in ("n_passages", "words_removed")]
    same = C.sieve(rows, lost, "key", likely=False).select("doc_id", "text", *none, F.array().cast("array<long>").alias("kept_in"))
    touched = C.sieve(rows, lost, "key").join(lost, "key", "left").select("doc_id", "text", "places", "words", "kept_in")
    names = same.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_slices(batches, 1, SLICE):
            texts = batch.column(1).to_pylist()
            numbers, removed, kept = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), [[]] * len(texts)
            for row, texts[row], spans, starts in shortened(batch, least):
                numbers[row], removed[row] = len(spans), sum(b - a for a, b in spans)
                owners = zip(batch.column(2)[row].as_py(), batch.column(4)[row].as_py())
                inside = {k for i, k in owners if any(a <= starts[i] < b for a, b in spans)}
                kept[row] = sorted(inside, key=lambda k: (k is not None, k))
            columns = [pa.array(texts, pa.string()), pa.array(numbers), pa.array(removed), pa.array(kept, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return same.unionByName(touched.mapInArrow(cut, same.schema))


def without_repeats(docs: DataFrame, least: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the passages that ``paragraph_repeats`` removes; a document that has no words left by it goes.

    All columns stay, whatever their names; ``n_chars`` is counted anew where words went. Nulls, ties and repeated rows
    are treated as there.
    """
    lost = repeats(docs, percent)
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"), text.alias("text"))
    same = C.sieve(rows, lost, "key", likely=False).select("row", "text")
    touched = C.sieve(rows, lost, "key").join(lost, "key", "left").select("row", "text", "places", "words")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.byte_slices(batches, 1, SLICE):
            texts, keep = batch.column(1).to_pylist(), np.ones(batch.num_rows, bool)
            for row, texts[row], _, _ in shortened(batch, least):
                keep[row] = bool(texts[row].strip())
            out = [batch.column(0), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["row", "text"]).filter(pa.array(keep))

    left = same.unionByName(touched.mapInArrow(cut, same.schema))
    columns = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col("row.text"))
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(F.col("row")["n_chars"])
    return left.select(*[column.alias(name) for name, column in columns.items()])
