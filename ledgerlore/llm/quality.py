"""Quality classifier: random-indexing word vectors, pooled per document, under a small calibrated network.

Every term has a sparse random index vector that follows from its hash. One pass over the whole corpus adds, for each
term, the index vectors of its neighbours: its context vector. Terms share ``BUCKETS`` rows by hash, so the table has
a fixed size and is summed with partial sums. A document is the mean of its terms' vectors; a two-layer network is fit
on labelled documents and its logits are divided by a temperature fit on labelled documents that it did not see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C

BUCKETS, DIM, NONZERO = 1 << 12, 32, 2
FIT_DOCS = 20_000  # labelled documents that fit the network, chosen by hash
HIDDEN, EPOCHS, RATE, BATCH = 24, 30, 5e-3, 256
THRESHOLD = 0.3

_SHAPE = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256)
)


class Terms(dict):
    """Word to two buckets in one number: the word itself in lower case, and its shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= C.CODES_KEPT // 2:
            self.clear()
        shape = word.translate(_SHAPE)
        short = bytes([c for i, c in enumerate(shape) if not i or shape[i - 1] != c])
        value = self[word] = (xxhash.xxh3_64_intdigest(word.lower()) % BUCKETS) * BUCKETS + xxhash.xxh3_64_intdigest(short, 1) % BUCKETS
        return value


_REPEATED, _BLANK, _TWICE = (
    xxhash.xxh3_64_intdigest(x, 2) % BUCKETS for x in (b"repeated line", b"no words", b"repeated word")
)


def terms_of(text: bytes, terms: Terms) -> np.ndarray:
    """Buckets of a text's terms: its words, their shapes, and marks for lines that came before in the
    text and for words that follow themselves."""
    words = text.split()
    if not words:
        return np.array([_BLANK], np.int64)
    pairs = np.fromiter(map(terms.__getitem__, words), np.int64, len(words))
    out = np.empty(2 * len(words), np.int64)
    out[::2], out[1::2] = pairs // BUCKETS, pairs % BUCKETS
    lines = text.split(b"\n")
    again, twice = len(lines) - len(set(lines)), int((pairs[1:] == pairs[:-1]).sum())
    return np.concatenate([out, np.full(again, _REPEATED), np.full(twice, _TWICE)]) if again or twice else out


def index_entries() -> list[tuple[np.ndarray, np.ndarray]]:
    """The sparse random vectors from a fixed seed: ``NONZERO`` times the place and the sign of an entry of every bucket."""
    rng = np.random.default_rng(11)
    return [(rng.integers(0, DIM, BUCKETS), rng.choice([-1.0, 1.0], BUCKETS)) for _ in range(NONZERO)]


def index_vectors() -> np.ndarray:
    table = np.zeros((BUCKETS, DIM), np.float32)
    for place, sign in index_entries():
        table[np.arange(BUCKETS), place] += sign
    return table


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Sum of the index vectors of the terms within two places, by bucket, over all texts; a table of fixed size."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        entries, sums = index_entries(), np.zeros(BUCKETS * DIM)  # whole numbers, no table of pairs
        for batch in C.arrow_rows(batches, 500):
            at = [terms_of(t, terms) for t in C.byte_texts(batch.column(0))]
            if not at:
                continue
            flat, owner = np.concatenate(at), np.repeat(np.arange(len(at), dtype=np.int32), [len(a) for a in at])
            for step in (1, 2):
                same = owner[step:] == owner[:-step]
                left, right = flat[:-step][same], flat[step:][same]
                for term, near in ((left, right), (right, left)):
                    for place, sign in entries:
                        sums += np.bincount(term * DIM + place[near], weights=sign[near], minlength=BUCKETS * DIM)
        sums = sums.reshape(BUCKETS, DIM)
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), C.lists(list(sums[used]), pa.float64())], names=["bucket", "v"]
        )

    parts = docs.select("text").mapInArrow(gather, "bucket long, v array<double>")
    total = parts.groupBy("bucket").agg(*[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(DIM)]).toArrow()
    table = np.zeros((BUCKETS, DIM), np.float32)
    table[total["bucket"].to_numpy()] = np.stack([total[f"v{i}"].to_numpy() for i in range(DIM)], axis=1)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return np.concatenate([table / np.maximum(norm, 1e-6), index_vectors()], axis=1)


def pooled(texts: list[bytes], vectors: np.ndarray, terms: Terms) -> np.ndarray:
    """Mean vector of each text's terms."""
    counts = np.zeros((len(texts), BUCKETS), np.float32)
    for row, text in zip(counts, texts):
        buckets = terms_of(text, terms)
        row += np.bincount(buckets, minlength=BUCKETS) / len(buckets)
    return counts @ vectors


class Network:
    """Two layers, trained by Adam on the log loss; ``temperature`` divides the logits."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w = [
            rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, HIDDEN**-0.5, HIDDEN),
            np.zeros(1),
        ]
        self.temperature = 1.0
        held = rng.permutation(len(x)) % 5 == 0
        x = (x - self.mean) / self.scale
        self._train(x[~held], y[~held], rng)
        logits, truth = self._logits(x[held]), y[held]
        if len(truth):
            grid = np.geomspace(0.25, 8, 61)
            loss = [np.logaddexp(0, -np.where(truth > 0, logits, -logits) / t).mean() for t in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3][0]

    def _train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        first, second, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for start in range(0, len(x), BATCH):
                a, t = x[order[start : start + BATCH]], y[order[start : start + BATCH]]
                hidden = np.maximum(a @ self.w[0] + self.w[1], 0)
                off = (1 / (1 + np.exp(-np.clip(hidden @ self.w[2] + self.w[3][0], -30, 30))) - t) / len(t)
                back = np.outer(off, self.w[2]) * (hidden > 0)
                step += 1
                for i, g in enumerate((a.T @ back, back.sum(axis=0), hidden.T @ off, np.array([off.sum()]))):
                    g = g + 1e-4 * self.w[i]
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.w[i] = self.w[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)

    def score(self, x: np.ndarray) -> np.ndarray:
        logits = self._logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = FIT_DOCS) -> DataFrame:
    """``(text, quality)`` of at most ``most`` labelled documents that may be learnt from, the first by hash.

    A document whose labels disagree is left out, as is a null label.
    """
    truth = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("high"))
        .where(F.col("quality") == F.col("high"))
    )
    chosen = truth.select("doc_id", "quality", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(most)
    # ``most`` rows of two numbers are a bounded broadcast
    return docs.join(F.broadcast(chosen.select("doc_id", "quality")), "doc_id").select("text", "quality")


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, Network | None]:
    """Word vectors of all of ``docs`` and the network; no network where the labels hold one class or none."""
    vectors = context_vectors(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in C.arrow_rows(batches, 500):
            x = pooled(C.byte_texts(batch.column(0)), shipped.value, terms)
            yield pa.RecordBatch.from_arrays(
                [C.lists(list(x), pa.float32()), batch.column(1).cast(pa.int32())], names=["x", "quality"]
            )

    rows = labelled_sample(docs, labels).mapInArrow(pool, "x array<float>, quality int").toArrow()
    y = rows["quality"].to_numpy().astype(float)
    if len(np.unique(y)) < 2:
        return vectors, None
    x = np.stack(C.list_rows(rows["x"], np.float32))
    order = np.lexsort((*x.T[:4], y))  # the order of arrival must not matter
    return vectors, Network(x[order].astype(float), y[order])


def scored(docs: DataFrame, model: tuple[np.ndarray, Network | None]) -> DataFrame:
    """``docs`` with ``__score``; without a network every score is the undecided 0.5."""
    vectors, network = model
    shipped = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, net = shipped.value
        terms = Terms()
        for batch in C.arrow_rows(batches, 500):
            x = pooled(C.byte_texts(batch.column(1)), table, terms)
            values = net.score(x) if net else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], names=["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), "text")
    schema = rows.select("row", F.lit(0.0).alias("score")).schema
    out = rows.mapInArrow(score, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns], F.col("score").alias("__score"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs`` (doc_id, text).

    Only the text enters a score, so equal texts have equal scores. A null or blank text is scored by the vector of
    the "no words" mark. A null id is not held out. Repeated rows give repeated results.
    """
    model = fit(docs.select("doc_id", "text"), labels)
    plain = docs.select("doc_id", "text", held_out().alias("held_out"))
    rows = plain.select("doc_id", "held_out", F.col("text"))
    return scored(rows, model).select(
        "doc_id", "held_out", F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted")
    )
