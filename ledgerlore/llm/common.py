"""Helpers shared by the operators: word codes, shingle sets, joins that split hot keys, components."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.session import materialise

CODES_KEPT = 1 << 18  # words a task remembers; a memory bound only, a forgotten word is hashed again
HEAVY_SHARE = 1000  # a key is heavy above one 1/1000 of all rows, so at most 1,000 keys are
FILTER_BITS, FILTER_MOST = 1 << 23, 1 << 28  # of a bitmap of ids: at least, and at most (32 MB)
BITS_EACH = 32  # of a bitmap, for each id in it
FEW_EDGES = 1 << 18  # as many edges are brought to an end in one task

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


class Codes(dict):
    """Word (bytes) to a 64-bit hash, remembered; ``codes.__getitem__`` runs in C for known words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CODES_KEPT:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def byte_texts(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def word_codes(words: Sequence[bytes], codes: Codes) -> np.ndarray:
    return np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_codes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words in order; a shorter, non-empty sequence is one run."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    h = np.full(n, np.uint64(k))
    for i in range(k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(h)


def fold(values: np.ndarray) -> int:
    """One hash of a sequence of 64-bit values, as a signed long."""
    return xxhash.xxh3_64_intdigest(values.tobytes()) - (1 << 63)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def list_rows(column: pa.ListArray, dtype) -> list[np.ndarray]:
    """The lists of a column without nulls as NumPy views."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    offsets = column.offsets.to_numpy()
    offsets = offsets - offsets[0]
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def join_groups(rows: DataFrame, groups: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to the one row their key has in ``groups``, safe for keys with a large share of the rows.

    ``weight`` is the number of rows of a key. Keys with more than 1/1,000 of all weight are at most 1,000 by
    definition, so those travel to the rows as a broadcast; the other keys are joined by a shuffle in which none
    can make a task large. ``groups`` should be a written table, as it is read three times.
    """
    total = groups.agg(F.sum(weight)).first()[0] or 0
    bar = max(total // HEAVY_SHARE, 1000)
    values = [c for c in groups.columns if c != key]
    heavy = groups.where(F.col(weight) > bar).select(key, F.struct(*values).alias("__heavy"))
    light = groups.where(F.col(weight) <= bar).select(key, F.struct(*values).alias("__light"))
    marked = rows.join(F.broadcast(heavy), key, "left")
    many = marked.where(F.col("__heavy").isNotNull()).withColumnRenamed("__heavy", "__light")
    few = marked.where(F.col("__heavy").isNull()).drop("__heavy").join(light, key, how)
    return many.unionByName(few).select(*rows.columns, *[F.col("__light")[c].alias(c) for c in values])


def id_filter(hashes: DataFrame, size: int | None = None, least: int = FILTER_BITS) -> np.ndarray:
    """A bitmap over the one column of ``hashes`` (64 bits each): a first sieve that lets every wanted one pass.

    Each hash sets two bits. The bitmap grows with the number of hashes (a written table, as they are counted first), so
    the share of others that pass stays below 1 in 250 and their number in proportion to the input. From ``FILTER_MOST``
    bits on, which bounds what the driver and the tasks hold, more pass: at worst all, as without a sieve.
    """
    (name,) = hashes.columns
    size = size or max(least, min(FILTER_MOST, 1 << (BITS_EACH * hashes.count() - 1).bit_length()))
    places = F.array(F.col(name), F.shiftright(name, 32))
    words = (
        hashes.select(F.explode(places).alias("bit"))
        .select(F.col("bit").bitwiseAND(size - 1).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(size >> 6, np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bitmap


def hashed(column: str) -> Column:
    """The hash of an id, for ``id_filter`` and ``passes``."""
    return F.xxhash64(column).alias("hash")


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    last = (len(bitmap) << 6) - 1
    keep = np.ones(len(hashes), bool)
    for bits in (hashes & last, (hashes >> 32) & last):
        keep &= ((bitmap[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
    return keep


def sieve(
    rows: DataFrame, wanted: DataFrame, key: str, likely: bool = True, size: int | None = None, least: int = FILTER_BITS
) -> DataFrame:
    """The rows whose ``key`` is likely to be among those of ``wanted``, by a bitmap (``id_filter``); with ``likely``
    false the others. Every row whose key is wanted is likely; rows travel no further than through the task."""
    bitmap = rows.sparkSession.sparkContext.broadcast(id_filter(wanted.select(hashed(key)), size, least))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = passes(bitmap.value, batch.column(batch.num_columns - 1).to_numpy()) == likely
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(keep))

    return rows.select("*", hashed(key).alias("__hash")).mapInArrow(sift, rows.schema)


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """``(id, component)`` for all ends of ``edges`` (a, b: long): the smallest id that can be reached.

    Large-star and small-star steps, each written to the shared folder, until the edges stay the same. An edge
    list never leaves the cluster, and a hub's edges are joined with ``join_groups``. What is left when no more than
    ``FEW_EDGES`` are is finished in one task, which that number bounds.
    """
    state = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        purpose,
    )
    mark = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or not now[0]:
            return state.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                state.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
            )
        if now[0] <= FEW_EDGES:
            return materialise(state.coalesce(1).mapInArrow(few_components, "id long, component long"), purpose)
        mark = tuple(now)
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = materialise(
            both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n")), purpose
        )
        large = materialise(
            join_groups(both, lowest, "a", "n").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            purpose,
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), purpose)


def few_components(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, component)`` of edges (a, b) that fit into one task: each id takes the smallest label among its neighbours
    and that label's own, until nothing changes."""
    edges = pa.Table.from_batches(list(batches), pa.schema([("a", pa.int64()), ("b", pa.int64())]))
    ids, ends = np.unique(np.concatenate([edges["a"].to_numpy(), edges["b"].to_numpy()]), return_inverse=True)
    a, b = ends[: edges.num_rows], ends[edges.num_rows :]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[a], label[b])
        now = label.copy()
        for end in (a, b, label[a], label[b]):
            np.minimum.at(now, end, least)
        now = now[now]
        if (now == label).all():
            break
        label = now
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label])], names=["id", "component"])


def released() -> None:
    """Give memory back that tasks before this one have freed: a worker lives on, and its allocators keep what they had."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def arrow_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``size`` rows, to bound what a task holds beside them."""
    released()
    for batch in batches:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches whose texts (``column``, a string column) have at most ``size`` bytes in all, or one row."""
    released()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths.astype(np.int64)), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
