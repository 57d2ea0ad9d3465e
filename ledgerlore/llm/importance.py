"""Target-distribution importance resampling: hashed n-gram features, log ratios as integers, Gumbel top-k.

The bucket of a feature is its CRC-32. CRC is linear: a byte adds a value that only depends on the byte and on its
distance from the end of the span, so a table by (distance, byte) gives all contributions at once and
``bitwise_xor.reduceat`` over the spans gives all checksums; the register's start adds a constant for each length.
A span longer than the table is cut into blocks that are folded from the left, the register moving over a whole
block by the same table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.llm.decontamination import _FOLD
from ledgerlore.session import materialise

ORDER, BUCKETS, SEED = 1, 10_000, "2024"
MIN_WORDS, PERCENT = 20, 10
SPAN = 64  # distances in the table
SLICE = 1 << 20  # bytes of text, and of features, worked on at once
POLYNOMIAL = 0xEDB88320  # fixed: reflected CRC-32
START = np.uint32(0xFFFFFFFF)  # fixed: the register's first value, which the result is inverted with as well


def position_table(span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """``table[d, b]``: what byte ``b`` with ``d`` bytes behind it adds; ``constant[n]``: the start's share after n bytes."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> 1) ^ np.uint32(POLYNOMIAL), row >> 1)
    table = np.empty((span, 256), np.uint32)
    table[0] = row
    for d in range(1, span):
        table[d] = row[table[d - 1] & 0xFF] ^ (table[d - 1] >> 8)
    constant = np.empty(span + 1, np.uint32)
    constant[0] = START
    for n in range(1, span + 1):
        constant[n] = row[constant[n - 1] & 0xFF] ^ (constant[n - 1] >> np.uint32(8))
    return table, constant


_TABLE, _CONSTANT = position_table()


def moved(register: np.ndarray) -> np.ndarray:
    """Registers after ``SPAN`` further zero bytes: their four bytes stand where the first four of a block do."""
    out = _TABLE[SPAN - 1, register & 0xFF]
    for i in range(1, 4):
        out = out ^ _TABLE[SPAN - 1 - i, (register >> np.uint32(8 * i)) & 0xFF]
    return out


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for each span; spans may overlap and none is empty."""
    out = np.empty(len(starts), np.uint32)
    total = np.cumsum(ends - starts)
    first = 0
    while first < len(starts):
        before = int(total[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(total, before + SLICE, side="right")))
        out[first:last] = _crc32(data, starts[first:last], ends[first:last])
        first = last
    return out


def _crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    blocks = -(-lengths // SPAN)
    first_block = np.cumsum(blocks) - blocks
    owner = np.repeat(np.arange(len(starts)), blocks)
    back = (np.cumsum(np.ones(len(owner), np.int64)) - 1 - first_block[owner]) - blocks[owner] + 1  # 0 for the last block
    block_end = ends[owner] + back * SPAN
    block_start = np.maximum(block_end - SPAN, starts[owner])
    size = block_end - block_start
    offset = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(offset, size)
    parts = _TABLE[np.repeat(size, size) - 1 - within, data[np.repeat(block_start, size) + within]]
    shares = np.bitwise_xor.reduceat(parts, offset)
    register = shares[first_block] ^ _CONSTANT[size[first_block]]
    step, left = 1, np.flatnonzero(blocks > 1)
    while len(left):
        register[left] = moved(register[left]) ^ shares[first_block[left] + step]
        step += 1
        left = left[blocks[left] > step]
    return register ^ START


def features(texts: list[bytes], order: int = ORDER, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and for each feature its bucket and the number of its text.

    Features are the runs of 1 to ``order`` consecutive words of a text, joined by a space; repeats stay.
    """
    parts = [b" ".join(t.translate(_FOLD).split()) for t in texts]
    n_words = np.array([p.count(b" ") + 1 if p else 0 for p in parts], np.int64)
    data = np.frombuffer(b" ".join(p for p in parts if p), np.uint8)
    if not len(data):
        return n_words, np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(data))
    text = np.repeat(np.arange(len(texts)), n_words)
    found, owners = [], []
    for n in range(1, min(order, len(starts)) + 1):
        runs = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :])
        found.append(crc32_spans(data, starts[runs], ends[runs + n - 1]) % np.uint32(buckets))
        owners.append(text[runs])
    return n_words, np.concatenate(found).astype(np.int64), np.concatenate(owners)


def bucket_counts(rows: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts of ``rows`` (text) lie in each bucket; one array per task is summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in C.byte_slices(batches, 0, SLICE):
            counts += np.bincount(features(C.byte_texts(batch.column(0)), order, buckets)[1], minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    partial = rows.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    summed = partial.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # ``buckets`` rows at most
    out = np.zeros(buckets, np.int64)
    out[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, floor of 1,000 times the log ratio of its smoothed shares in the target and in the source."""
    buckets, total, aimed = len(source), float(source.sum()), float(target.sum())
    ratios = ((target + 1.0) * (total + buckets)) / ((source + 1.0) * (aimed + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` for every row of ``docs`` (doc_id, text)."""
    shipped = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shipped.value
        for batch in C.byte_slices(batches, 1, SLICE):
            n_words, found, owner = features(C.byte_texts(batch.column(1)), order, len(gain))
            weight = np.zeros(batch.num_rows, np.int64)
            np.add.at(weight, owner, gain[found])
            n = np.bincount(owner, minlength=batch.num_rows)
            columns = [batch.column(0), pa.array(n_words), pa.array(n, pa.int64()), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, percent: int, purpose: str = "importance") -> DataFrame:
    """``(row, rank)`` of the floor(percent * N / 100) first of the N rows of ``scored`` (row, doc_id, score).

    Rows are dealt out by ranges of (score, doc_id, row), numbered inside their range in order, and each range starts
    where the ranges before it end: the driver sees one count per range. ``row`` is unique, so no range is too large.
    """
    context = scored.sparkSession
    ranges = int(context.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    number = F.monotonically_increasing_id()  # the task above, the place in the task in the lower 33 bits
    dealt = scored.select("row", "doc_id", "score").repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = materialise(dealt.select("row", number.alias("at")), purpose)
    task = F.shiftright("at", 33)
    counts = dict(dealt.groupBy(task.alias("task")).agg(F.count(F.lit(1))).collect())
    last = percent * sum(counts.values()) // 100
    before, offsets = 0, []
    for t in sorted(counts):
        offsets.append((t, before))
        before += counts[t]
    starts = F.broadcast(context.createDataFrame(offsets, "task long, before long"))  # one row per range
    placed = dealt.select("row", "at", task.alias("task")).join(starts, "task")
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return placed.select("row", rank.alias("rank")).where(F.col("rank") <= last)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    order: int = ORDER,
    buckets: int = BUCKETS,
    seed: str = SEED,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` for every row of ``docs`` (doc_id, text); ``target`` has ``text``.

    The weight of a document is the sum of its features' gains, its score that weight plus a Gumbel draw that only
    depends on ``seed`` and the id, so the highest scores are a sample without replacement by importance. Of the
    documents with at least ``min_words`` words, ``percent`` in a hundred are drawn and ranked.

    Null and empty texts have no features and weigh 0. A null id draws as the empty id and stands behind other ids of
    its score. Repeated rows are scored and drawn each for itself; rows equal in score and id are ranked in the order
    in which they were read. An empty target gives every bucket the smoothed share; empty ``docs`` give no rows. Other
    columns are not read.
    """
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((draw.cast("double") + 0.5) / F.lit(4294967296.0))))
    scored = weights(docs, gain, order).withColumn("score", F.col("weight") + noise.cast("long"))
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "importance")
    drawn = ranked(scored.where(F.col("n_words") >= min_words), percent)
    return scored.join(drawn, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
