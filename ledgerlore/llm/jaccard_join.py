"""N-gram Jaccard join by signature trees.

1. Every text becomes its set of shingles; texts with equal sets become one (a digest, grouped with partial sums).
2. Two sets with Jaccard ``p`` share a token among the first ``n - ceil(p n) + 1`` of each, in any order of the tokens
   that is the same for all sets. The order here puts tokens first that a count sketch over the whole corpus knows
   as rare, so a passage in many texts brings nobody together. Sets that share such a token meet under the smallest
   id among them, the hub: a *unit*.
3. In a unit, a signature tree is joined with itself by dual traversal (``signature_tree``). Units above
   ``UNIT`` sets are split into chunks that each hold the hub; components are taken, and only pairs of chunks that
   are not in one component yet meet again. So nothing is capped and no task gets an unbounded group.
4. Links go to distributed components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.llm.signature_tree import promising, self_join, signature
from ledgerlore.session import materialise

UNIT = 1024  # sets that one task compares at once
SKETCH = 1 << 22  # counters of the sketch, one byte each where they travel (4 MB)
TOKEN_BITS = 1 << 25  # of the sieve of shared tokens (4 MB), at least: many times as many tokens as ids are wanted
SLICE = 1 << 21  # bytes of text that a task takes apart at once


def distinct_shingles(text: bytes, k: int, codes: C.Codes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; words are split at ASCII white space, A-Z in lower case."""
    return np.unique(C.shingle_codes(C.word_codes(text.lower().split(), codes), k))


def count_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """In how many texts the tokens of each of ``SKETCH`` counters occur; a fixed size whatever the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = C.Codes(), np.zeros(SKETCH, np.int64)
        for batch in C.byte_slices(batches, 0, SLICE):
            sets = [distinct_shingles(t, k, codes) for t in C.byte_texts(batch.column(0))]
            if sets:
                counts += np.bincount((np.concatenate(sets) & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
        # Only counters far above the task's mean travel; the others are as rare as hashing can tell.
        at = np.nonzero(counts > 4 * counts.mean() + 2)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    seen = rows.toArrow()  # a quarter of the counters at most
    rank = np.zeros(SKETCH, np.uint8)
    rank[seen["at"].to_numpy()] = np.log2(seen["n"].to_numpy()).astype(np.uint8) + 1
    return rank


def prefix(tokens: np.ndarray, percent: int, rank: np.ndarray) -> np.ndarray:
    n = len(tokens)
    length = n - -(-percent * n // 100) + 1 if n else 0
    order = np.lexsort((tokens, rank[(tokens & np.uint64(SKETCH - 1)).astype(np.int64)]))
    return tokens[order[:length]]


def shingle_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``(doc_id, n, digest, prefix, bits)`` for every row; ``digest`` is null for an empty set."""
    rank = docs.sparkSession.sparkContext.broadcast(count_sketch(docs, k))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = C.Codes()
        for batch in C.byte_slices(batches, 1, SLICE):
            sets = [distinct_shingles(t, k, codes) for t in C.byte_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([C.fold(s) if len(s) else None for s in sets], pa.int64()),
                    C.lists([C.signed(prefix(s, percent, rank.value)) for s in sets], pa.int64()),
                    pa.array([signature(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "n", "digest", "prefix", "bits"],
            )

    return docs.select("doc_id", "text").mapInArrow(describe, "doc_id long, n long, digest long, prefix array<long>, bits binary")


def sets_of(docs: DataFrame, k: int, wanted: DataFrame) -> DataFrame:
    """``(id, tokens)``: the sets of ``wanted`` (id, doc_id), each from that document and once. A bitmap
    keeps most other documents out early; copies that pass it fall to the join with ``wanted``."""
    bitmap = docs.sparkSession.sparkContext.broadcast(C.id_filter(wanted.select(C.hashed("doc_id"))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = C.Codes()
        for batch in C.byte_slices(batches, 0, SLICE):
            batch = batch.filter(pa.array(C.passes(bitmap.value, batch.column(1).to_numpy())))
            sets = [distinct_shingles(t, k, codes) for t in C.byte_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([C.fold(s) for s in sets], pa.int64()),
                    batch.column(2),
                    C.lists([C.signed(s) for s in sets], pa.int64()),
                ],
                names=["id", "doc_id", "tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull())
    built = rows.select("text", C.hashed("doc_id"), "doc_id").mapInArrow(build, "id long, doc_id long, tokens array<long>")
    # Rows that repeat both id and text become one before they are dealt out; one shuffle serves this and the join.
    once = built.groupBy("id", "doc_id").agg(F.first("tokens").alias("tokens"))
    return once.join(wanted.select("id", "doc_id"), ["id", "doc_id"], "left_semi").select("id", "tokens")


def shared_among(tokens: DataFrame, purpose: str) -> DataFrame:
    """``(token, low, m)`` of the tokens that several ids have, as a written table; ``tokens`` is (id, token, ...)."""
    shared = tokens.groupBy("token").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("m"))
    return materialise(shared.where(F.col("low") != F.col("high")).select("token", "low", "m"), purpose)


def candidates(tokens: DataFrame, percent: int, purpose: str) -> DataFrame:
    """``(hub, id)`` such that ids which may be linked have a hub in common; ``tokens`` is (id, n, token).

    Linked sets share a token and have sizes within 100 / ``percent`` of each other. So the rows of a shared token meet
    again by bands of that width in the logarithm of the size, each in its own band and the next: sets that only have a
    passage in common mostly differ in size and drop out before any set is shipped. Most tokens are in one text only
    and fall to a bitmap before they travel again.
    """
    shared = shared_among(tokens, purpose)
    rows = C.join_groups(C.sieve(tokens, shared, "token", least=TOKEN_BITS), shared.select("token", "m"), "token", "m")
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent + 1e-6))
    banded = rows.select("id", F.explode(F.array(band, band + 1)).alias("band"), "token")
    banded = materialise(banded.select(F.xxhash64("token", "band").alias("key"), "id").distinct(), purpose)
    near = banded.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last"), F.count(F.lit(1)).alias("m"))
    near = materialise(near.where(F.col("hub") != F.col("last")).drop("last"), purpose)
    return materialise(C.join_groups(banded, near, "key", "m").select("hub", "id").distinct(), purpose)


def sieved(members: DataFrame, bits: DataFrame, percent: int, purpose: str, unit: int = UNIT) -> DataFrame:
    """The rows of ``members`` (hub, id) whose bitmap (``bits``: id, n, bits) allows a link within the unit.

    Bitmaps take a sixteenth of the sets' room, so sets travel only for what is left. A unit above ``unit`` sets keeps
    all, as its members are not looked at together. Of the units that keep the same members only the first stays: near
    copies share many tokens, and each may bring them together under another hub.
    """
    sizes = materialise(members.groupBy("hub").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), purpose)
    sized = materialise(C.join_groups(members, sizes, "hub", "m"), purpose)
    rows = sized.where(F.col("m") <= unit).join(bits, "id").select("hub", "id", "n", "bits")

    def sieve(group: pa.Table) -> pa.Table:
        keep = promising(group["n"].to_numpy(), group["bits"].to_pylist(), percent)
        left = group.select(["hub", "id"]).filter(pa.array(keep))
        mark = C.fold(np.unique(left["id"].to_numpy()))
        return left.append_column("members", pa.array([mark] * left.num_rows, pa.int64()))

    kept = materialise(rows.groupBy("hub").applyInArrow(sieve, "hub long, id long, members long"), purpose)
    first = kept.groupBy("members").agg(F.min("hub").alias("hub"))
    kept = kept.join(first, ["members", "hub"], "left_semi").select("hub", "id")
    return materialise(kept.unionByName(sized.where(F.col("m") > unit).select("hub", "id")), purpose)


def few_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Links (i, j) of a few sets, from how many tokens each two share."""
    n = np.array([len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.zeros((len(sets), int(token.max(initial=0)) + 1), np.float32)
    member[np.repeat(np.arange(len(sets)), n), token] = 1
    common = (member @ member.T).astype(np.int64)
    close = (common > 0) & (100 * common >= percent * (n[:, None] + n - common))
    return np.argwhere(np.triu(close, 1))


def linked(units: DataFrame, sets: DataFrame, percent: int, few: int = 2) -> DataFrame:
    """Links (a, b) inside each unit; ``units`` is (unit columns..., id, component). Up to ``few`` sets are compared
    without a tree."""
    keys = [c for c in units.columns if c not in ("id", "component")]
    rows = units.join(sets, "id").select(*keys, "id", "component", "tokens")

    def join_unit(ids: np.ndarray, tokens: list[np.ndarray], component: np.ndarray) -> np.ndarray:
        ids, at = np.unique(ids, return_index=True)
        if len(ids) <= few:
            pairs = few_links([tokens[i] for i in at], percent)
            pairs = pairs[component[at[pairs[:, 0]]] != component[at[pairs[:, 1]]]]
            return ids[pairs]
        _, known = np.unique(component[at], return_inverse=True)
        pairs = np.array(self_join([tokens[i] for i in at], percent, known), np.int64).reshape(-1, 2)
        return ids[pairs]

    def join_units(group: pa.Table) -> pa.Table:
        group = group.take(np.argsort(group["unit"].to_numpy(), kind="stable"))
        starts = np.flatnonzero(np.diff(group["unit"].to_numpy())) + 1
        tokens = [t.view(np.uint64) for t in C.list_rows(group["tokens"], np.int64)]
        ids, component = group["id"].to_numpy(), group["component"].to_numpy()
        found = [np.empty((0, 2), np.int64)]
        for a, b in zip(np.append(0, starts), np.append(starts, len(ids))):
            found.append(join_unit(ids[a:b], tokens[a:b], component[a:b]))
        pairs = np.concatenate(found)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    # Units are dealt to groups of about ``UNIT`` rows, and none has more than that itself.
    groups = units.count() // UNIT + 1
    dealt = rows.withColumn("unit", F.xxhash64(*keys)).withColumn("group", F.pmod(F.xxhash64("unit"), F.lit(groups)))
    return dealt.select("group", "unit", "id", "component", "tokens").groupBy("group").applyInArrow(join_units, "a long, b long")


def resolve(members: DataFrame, sets: DataFrame, percent: int, purpose: str, unit: int = UNIT, few: int = 2) -> DataFrame:
    """``(id, component)`` of the ids that are linked, given ``members`` (hub, id): every pair of ids that may be
    linked has a hub in common. The hub is a member of its own unit. Both arguments should be written tables."""
    # the hub itself may have dropped out, so each unit is numbered by it but joined to whoever is left
    sizes = materialise(members.groupBy("hub").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), purpose)
    sized = materialise(C.join_groups(members, sizes, "hub", "m"), purpose)
    chunks = F.ceil(F.col("m") / unit).cast("int")
    chunked = sized.where(F.col("id") != F.col("hub")).select(
        "hub", F.pmod(F.xxhash64("id"), chunks).cast("int").alias("chunk"), "id"
    )
    hubs = sizes.select("hub", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.col("hub").alias("id"))
    first = chunked.unionByName(hubs).withColumn("component", F.col("id"))
    links = materialise(linked(first, sets, percent, few), purpose)
    found = C.components(links, purpose)
    large = sized.where(F.col("m") > unit)
    if large.isEmpty():
        return found

    found = materialise(found, purpose)
    labelled = (
        large.join(found, "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
        .select("hub", "id", "component")
    )
    # Components with a chunk or more of a unit get chunks of their own; the others share chunks.
    weight = labelled.groupBy("hub", "component").agg(F.count(F.lit(1)).alias("w")).where(F.col("w") >= unit)
    placed = materialise(
        labelled.join(weight, ["hub", "component"], "left").select(
            "hub",
            "id",
            "component",
            F.col("w").isNotNull().alias("whole"),
            F.when(F.col("w").isNotNull(), F.col("component")).otherwise(F.lit(0)).alias("own"),
        ),
        purpose,
    )
    counts = placed.groupBy("hub", "whole", "own").agg(F.ceil(F.count(F.lit(1)) / unit).cast("int").alias("parts"))
    placed = placed.join(F.broadcast(counts) if counts.count() <= 10_000 else counts, ["hub", "whole", "own"]).select(
        "hub", "whole", "own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("chunk"), "id", "component"
    )
    blocks = counts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk"), "whole", "own")
    one = blocks.select("hub", F.struct("whole", "own", "chunk").alias("x"))
    other = blocks.select("hub", F.struct("whole", "own", "chunk").alias("y"))
    # Pairs of blocks, not of rows, and none where both lie in one component already.
    done = F.col("x.whole") & F.col("y.whole") & (F.col("x.own") == F.col("y.own"))
    pairs = one.join(other, "hub").where((F.col("x") <= F.col("y")) & ~done).withColumn("pair", F.xxhash64("hub", "x", "y"))
    pairs = materialise(pairs, purpose)
    if pairs.isEmpty():
        return found
    sides = pairs.select("hub", "pair", F.explode(F.array_distinct(F.array("x", "y"))).alias("z"))
    again = placed.join(sides.select("hub", "pair", "z.*"), ["hub", "whole", "own", "chunk"]).select("pair", "id", "component")
    more = materialise(linked(again, sets, percent, few), purpose)
    return C.components(links.unionByName(more), purpose)


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, unit: int = UNIT) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs`` (doc_id, text).

    Links are exact: 100 * |intersection| >= ``percent`` * |union| of the sets of ``k``-word shingles. Texts that
    are null or without words have an empty set and are a component of their own; a text of fewer words than ``k``
    is one shingle. Repeated rows give repeated results; rows that share an id but not the text count as texts of
    their own. A row with a null id is in no component and gets a null. Other columns are not read.
    """
    described = materialise(shingle_sets(docs, k, percent), "jaccard")
    filled = described.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    groups = materialise(
        filled.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "jaccard"
    )
    # Copies bring the same tokens under the same digest, so they need not be taken out before the tokens meet.
    tokens = filled.select(F.col("digest").alias("id"), "n", F.explode("prefix").alias("token"))
    members = candidates(tokens, percent, "jaccard")
    firsts = groups.join(members.select(F.col("id").alias("digest")).distinct(), "digest", "left_semi")
    same = [filled["digest"] == firsts["digest"], filled["doc_id"] == firsts["first"]]
    bits = filled.join(firsts, same, "left_semi").select(F.col("digest").alias("id"), "n", "bits")
    members = sieved(members, bits, percent, "jaccard", unit)
    wanted = groups.join(members.select(F.col("id").alias("digest")).distinct(), "digest", "left_semi")
    wanted = materialise(wanted.select(F.col("digest").alias("id"), F.col("first").alias("doc_id")), "jaccard")
    sets = materialise(sets_of(docs, k, wanted), "jaccard")
    found = materialise(resolve(members, sets, percent, "jaccard", unit), "jaccard")

    firsts = found.join(groups.select(F.col("digest").alias("id"), "first"), "id")
    smallest = materialise(
        firsts.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n_sets")), "jaccard"
    )
    of_set = C.join_groups(found, smallest, "component", "n_sets").select(F.col("id").alias("digest"), "component_id")
    labels = materialise(
        groups.select("digest", "first", "copies")
        .join(of_set, "digest", "left")
        .where(F.col("component_id").isNotNull() | (F.col("copies") > 1))
        .select("digest", "copies", F.coalesce("component_id", "first").alias("component_id")),
        "jaccard",
    )
    rows = described.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    return C.join_groups(rows, labels, "digest", "copies", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
