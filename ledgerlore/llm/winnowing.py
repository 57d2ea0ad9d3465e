"""Document fingerprints by winnowing.

Hashes of all runs of ``K`` characters; of every ``WINDOW`` hashes in a row the smallest is chosen, the rightmost where
several are smallest, and its position is kept. Two texts that share a run of ``K + WINDOW - 1`` characters hence share
a chosen hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C

K, WINDOW = 16, 8  # a shared run of 23 characters is found; about two hashes in nine are kept
BLOCK_ROWS = 2000  # documents of one block in the order of ids
MOST_BLOCKS = 10_000  # bounds what the driver learns; larger blocks are still read as a stream


def gram_hashes(chars: np.ndarray, k: int = K) -> np.ndarray:
    """32-bit hashes of the runs of ``k`` characters, by doubling; a shorter text is one run."""
    if not len(chars):
        return np.empty(0, np.uint32)
    k = min(k, len(chars))
    base = np.uint64(0x9E3779B97F4A7C15)
    power, h, done = base, chars.astype(np.uint64) + np.uint64(1), 1
    out, taken = None, 0
    bits = k
    while bits:
        if bits & 1:  # append a run of ``done`` characters to what is taken
            if out is None:
                out = h
            else:
                m = len(chars) - taken - done + 1
                out = out[:m] * power + h[taken : taken + m]
            taken += done
        bits >>= 1
        if bits:
            m = len(h) - done
            h = h[:m] * power + h[done : done + m]
            power = np.uint64(int(power) ** 2 % (1 << 64))
            done *= 2
    return (C.mixed(out) >> np.uint64(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, in order; fewer hashes than ``window`` are one window."""
    if not len(hashes):
        return hashes, np.empty(0, np.uint32)
    n = len(hashes)
    window = min(window, n)
    # smallest hash, then largest position, as one number per place
    keys = (hashes.astype(np.uint64) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(n, dtype=np.uint64))
    low, done = keys, 1
    while 2 * done <= window:
        low = np.minimum(low[: len(low) - done], low[done:])
        done *= 2
    if done < window:
        low = np.minimum(low[: n - window + 1], low[window - done : n - done + 1])
    low = low[np.append(True, low[1:] != low[:-1])]
    return (low >> np.uint64(32)).astype(np.uint32), (np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.uint32)


def chars_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Fingerprint:
    def __init__(self, chars: np.ndarray):
        self.hashes, self.positions = winnow(gram_hashes(chars))

    def text(self) -> str:
        """Hashes, then positions, each as eight hexadecimal digits."""
        return f"{self.hashes.astype('>u4').tobytes().hex()}:{self.positions.astype('>u4').tobytes().hex()}"

    def likeness(self, other: Fingerprint) -> float:
        """Jaccard likeness of the chosen hashes; two empty fingerprints are alike."""
        one, two = np.unique(self.hashes), np.unique(other.hashes)
        if not len(one) and not len(two):
            return 1.0
        common = len(np.intersect1d(one, two, assume_unique=True))
        return common / (len(one) + len(two) - common)


def in_order(docs: DataFrame) -> DataFrame:
    """``(block, doc_id, text, last)``: blocks of the order of ids with the first row of the next block as ``last``.

    The blocks come from quantiles of the ids, so their number is about rows / ``BLOCK_ROWS``; what is gathered per
    block is one row. Nulls come first, rows with one id go by their text, and the block after the last is the first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, low = rows.agg(F.count(F.lit(1)), F.min("doc_id")).first()
    parts = min(max(1, n // BLOCK_ROWS), MOST_BLOCKS)
    cuts = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = sorted({c for c in rows.agg(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0]})
    shipped = spark.sparkContext.broadcast(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shipped.value, ids.to_numpy(), side="right"))

    block = block_of(F.coalesce("doc_id", F.lit(-(1 << 63))))
    ids = rows.select(block.alias("block"), "doc_id")
    first = ids.groupBy("block").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("filled"), "doc_id")).alias("first"))
    heads = [(r["block"], r["first"]["doc_id"]) for r in first.orderBy("block").collect()]  # one small row a block
    if not heads:
        return spark.createDataFrame([], "block int, doc_id long, text string, last boolean")
    before = {heads[(i + 1) % len(heads)][0]: heads[i][0] for i in range(len(heads))}
    carried = spark.createDataFrame([(block, doc, before[block]) for block, doc in heads], "own int, head long, block int")
    # The text of each block's first row; of several rows with that id the one whose text comes first.
    texts = (
        rows.join(F.broadcast(carried), F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("block", "doc_id")
        .agg(F.min("text").alias("text"))
        .withColumn("last", F.lit(True))
    )
    placed = rows.select(block.alias("block"), "doc_id", "text", F.lit(False).alias("last"))
    columns = ["block", "doc_id", "text", "last"]
    return placed.select(*columns).unionByName(texts.select(*columns))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its fingerprint, and that of the text with its end replaced.

    The edited text has the last quarter of the characters (rounded down) replaced by as many first characters of the
    next row, or all it has, in ascending order of doc_id; the first row follows the last. Nulls in doc_id come first
    and rows with one id go by text. A null text is empty. The empty text has an empty fingerprint, and two empty
    fingerprints have likeness 1. Equal texts have equal fingerprints. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {}
        held = None  # block, doc_id, text, characters, fingerprint

        def finish(one, two) -> None:
            _, doc, text, chars, print_ = one
            n = len(chars)
            cut = n - n // 4
            edited = np.concatenate([chars[:cut], two[3][: n // 4]])
            other = Fingerprint(edited)
            values = {
                "doc_id": doc,
                "n_chars": n,
                "edited_sha256": hashlib.sha256(edited.tobytes().decode("utf-32-le").encode()).hexdigest(),
                "fingerprint": print_.text(),
                "edited_fingerprint": other.text(),
                "near_edited": print_.likeness(other),
                "near_next": print_.likeness(two[4]),
            }
            for name, value in values.items():
                out.setdefault(name, []).append(value)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), _TYPES)], names=list(out))
            out.clear()
            return batch

        for batch in C.arrow_rows(batches, 200):
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for block, doc, text, last in zip(*columns):
                chars = chars_of(text)
                row = (block, doc, text, chars, Fingerprint(chars))
                if held is not None and held[0] == block:
                    finish(held, row)
                held = None if last else row
            if out:
                yield flush()

    rows = in_order(docs)
    ordered = rows.repartition("block").sortWithinPartitions("block", "last", F.col("doc_id").isNotNull(), "doc_id", "text")
    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
