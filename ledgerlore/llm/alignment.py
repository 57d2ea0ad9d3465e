"""Cross-tokenizer alignment: token ends of two tokenizers matched along a diagonal, and id pairs counted corpus-wide.

Both token sequences spell the same bytes. Where they agree token by token their end positions are equal at one shift
between the indexes, so exponential probing compares ever longer slices of the two arrays of ends at that shift and
jumps the whole one-to-one stretch. An irregular group is resolved locally, by moving whichever side ends first until
both end together; then the shift is what it has become.

1. Texts are encoded once; ids travel as packed integers in a written table.
2. Every pair of overlapping tokens is counted over the corpus, with partial counts per task.
3. Pairs with over 1 / 2^21 of all links (2^21 pairs at most) go to all tasks and are looked up there. The others are
   joined with their counts by a shuffle: exact, and none of them is hot.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.session import materialise, scratch_path

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SLICE = 1 << 20  # bytes of text worked on at once
HEAD = 21  # pairs with more than total / 2^HEAD links are looked up in the task
FIRST_STEP = 16  # tokens compared one by one before probes take longer and longer slices
KEPT = 1 << 20  # distinct pairs that a task counts before it passes them on
#: Fixed: how byte-level BPE splits a text before it merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARK = "▁"


class ByteLevel:
    """A byte-level BPE vocabulary: ids, and the bytes of each."""

    def __init__(self, definition: bytes):
        import tiktoken

        model = json.loads(definition)
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        others = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        merged = [bytes(byte_of[c] for c in "".join(m if isinstance(m, list) else m.split(" "))) for m in model["model"]["merges"]]
        made = [ranks[t] for t in merged]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("the merges of this vocabulary are not in the order of their ids")
        self.size = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.encoding = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=())

    def joined(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


class Pieces:
    """A vocabulary of pieces with word marks and byte pieces: ids, and the bytes of each."""

    def __init__(self, definition: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=definition)
        self.size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(self.size)]
        self.bytes_of = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(MARK, " ").encode() for i, n in enumerate(names)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def lengths(tokens: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in tokens], np.int64)


def packed(size: int) -> np.dtype:
    """The integers in which ids below ``size`` travel."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def aligned(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group in order, how many tokens of A and of B end with it; both sequences end at the same byte."""
    n, m = len(ends_a), len(ends_b)
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    kind = np.int32 if not n or list_a[-1] < 1 << 31 else np.int64
    size = np.dtype(kind).itemsize
    raw_a, raw_b = ends_a.astype(kind).tobytes(), ends_b.astype(kind).tobytes()  # slices of bytes compare at once
    firsts_a: list[int] = []
    firsts_b: list[int] = []
    counts: list[int] = []
    i = j = 0
    while i < n:
        end_a, end_b = list_a[i], list_b[j]
        while end_a != end_b:  # an irregular group, resolved where it stands; the shift j - i is new after it
            if end_a < end_b:
                i += 1
                end_a = list_a[i]
            else:
                j += 1
                end_b = list_b[j]
        i, j = i + 1, j + 1
        first, shift = i, j - i
        near = min(n, i + FIRST_STEP, m - shift)
        while i < near and list_a[i] == list_b[i + shift]:
            i += 1
        if i == first + FIRST_STEP:  # a long one-to-one stretch: doubled steps while they match, then halved ones
            step, grow = 2 * FIRST_STEP, True
            while step:
                low, high, ahead = size * i, size * (i + step), size * shift
                if i + step <= n and i + shift + step <= m and raw_a[low:high] == raw_b[low + ahead : high + ahead]:
                    i += step
                    step = step * 2 if grow else step // 2
                else:
                    step, grow = step // 2, False
        j = i + shift
        firsts_a.append(first)
        firsts_b.append(first + shift)
        counts.append(i - first + 1)
    run = np.array(counts, np.int64)
    within = np.arange(int(run.sum())) - np.repeat(np.cumsum(run) - run, run)
    return np.repeat(np.array(firsts_a, np.int64), run) + within, np.repeat(np.array(firsts_b, np.int64), run) + within


def links(ids_a: np.ndarray, ids_b: np.ndarray, length_a: np.ndarray, length_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of A and of B for all pairs of tokens whose bytes overlap, in order of the text.

    Between two neighbouring ends, of either side, lies one pair.
    """
    ends_a, ends_b = np.cumsum(length_a[ids_a]), np.cumsum(length_b[ids_b])
    total = int(ends_a[-1]) if len(ends_a) else 0
    at_a, at_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
    at_a[ends_a] = True
    at_b[ends_b] = True
    ends = np.flatnonzero(at_a | at_b)
    return (
        ids_a[np.cumsum(at_a, dtype=np.int32)[ends] - at_a[ends]],
        ids_b[np.cumsum(at_b, dtype=np.int32)[ends] - at_b[ends]],
    )


class Digests:
    """Writes the groups of many texts as ``a1,a2|b1;a3|b2,b3`` and hashes each text's part."""

    def __init__(self, size: int):
        self.width = len(str(size - 1)) + 1
        names = np.array([str(i).encode() for i in range(size)], f"S{self.width}")
        self.digits = names.view(np.uint8).reshape(size, self.width)
        self.length = np.char.str_len(names).astype(np.int64)

    def of(self, ids_a, ids_b, cut_a, cut_b, stops: np.ndarray) -> list[str]:
        """``stops``: how many tokens, of A and of B together, end with each text; texts without any are left out."""
        groups = len(cut_a)
        group_a = np.repeat(np.arange(groups), np.diff(cut_a, prepend=0))
        group_b = np.repeat(np.arange(groups), np.diff(cut_b, prepend=0))
        place_a = np.arange(len(ids_a)) + (cut_b - np.diff(cut_b, prepend=0))[group_a]
        place_b = np.arange(len(ids_b)) + cut_a[group_b]
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        ids[place_a], ids[place_b] = ids_a, ids_b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[place_a[cut_a - 1]] = ord("|")
        mark[place_b[cut_b - 1]] = ord(";")
        size = self.length[ids]
        cells = self.digits[ids]
        cells[np.arange(len(ids)), size] = mark
        size = size + 1
        size[stops - 1] -= 1  # nothing follows a text's last token
        text = cells[np.arange(self.width) < size[:, None]].tobytes()
        ends = np.cumsum(size)[stops - 1].tolist()
        return [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends)]


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def tokenised(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(row, doc_id, n_a, n_b, n_groups, groups_sha256, a, b)`` as a written table; ``a`` and ``b`` are packed ids."""
    shipped = docs.sparkSession.sparkContext.broadcast((read_bytes(path_a), read_bytes(path_b)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteLevel(shipped.value[0]), Pieces(shipped.value[1])
        length_a, length_b = lengths(a.bytes_of), lengths(b.bytes_of)
        kind_a, kind_b = packed(a.size), packed(b.size)
        digests = Digests(max(a.size, b.size))
        none = np.empty(0, np.int64)
        for batch in C.byte_slices(batches, 1, SLICE):
            texts = batch.column(1).to_pylist()
            ids_a, ids_b = [none] * len(texts), [none] * len(texts)
            spelt = b.encode([t or "" for t in texts])
            for i, text in enumerate(texts):
                if text:
                    found, whole = a.encode(" " + text), b" " + text.encode()
                    if a.joined(found) == whole == b.joined(spelt[i]):
                        ids_a[i], ids_b[i] = found.astype(np.int64), np.array(spelt[i], np.int64)
            n_a, n_b = np.array([len(x) for x in ids_a]), np.array([len(x) for x in ids_b])
            n_groups, sha = np.zeros(len(texts), np.int64), [""] * len(texts)
            filled = np.flatnonzero(n_a)
            if len(filled):
                all_a, all_b = np.concatenate(ids_a), np.concatenate(ids_b)
                cut_a, cut_b = aligned(np.cumsum(length_a[all_a]), np.cumsum(length_b[all_b]))
                stop_a = np.cumsum(n_a)
                n_groups = np.diff(np.searchsorted(cut_a, stop_a, side="right"), prepend=0)
                stops = (stop_a + np.cumsum(n_b))[filled]
                for i, digest in zip(filled.tolist(), digests.of(all_a, all_b, cut_a, cut_b, stops)):
                    sha[i] = digest
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_a, pa.int64()),
                    pa.array(n_b, pa.int64()),
                    pa.array(n_groups, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array([x.astype(kind_a).tobytes() for x in ids_a], pa.binary()),
                    pa.array([x.astype(kind_b).tobytes() for x in ids_b], pa.binary()),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a", "b"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(encode, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a binary, b binary")
    path = scratch_path(docs.sparkSession, "alignment")
    found = found.withColumn("row", F.monotonically_increasing_id())
    found.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(found.schema).parquet(path)


def linked_ids(batch: pa.RecordBatch, a: int, b: int, sizes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The links of a batch of packed texts as pair keys ``id of A * size of B + id of B``."""
    length_a, length_b = sizes
    ids_a, ids_b = (
        np.frombuffer(b"".join(batch.column(c).to_pylist()), packed(len(size))).astype(np.int64)
        for c, size in ((a, length_a), (b, length_b))
    )
    of_a, of_b = links(ids_a, ids_b, length_a, length_b)
    return of_a * len(length_b) + of_b


def pair_counts(rows: DataFrame, sizes: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(pair, n)``: how many links of all rows hold each id pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        waiting = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            key, n = key[order], np.concatenate(counts)[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            return key[first], np.add.reduceat(n, first) if len(first) else n

        for batch in C.arrow_rows(batches, 100):
            key, n = np.unique(linked_ids(batch, 0, 1, sizes), return_counts=True)
            keys.append(key)
            counts.append(n)
            waiting += len(key)
            if waiting > KEPT:
                key, n = merged()
                if len(key) > KEPT // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])
                    key, n = key[:0], n[:0]
                keys, counts, waiting = [key], [n], len(key)
        key, n = merged()
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])

    partial = rows.where("n_a > 0").select("a", "b").mapInArrow(count, "pair long, n long")
    return materialise(partial.groupBy("pair").agg(F.sum("n").alias("n")), "alignment")


def token_alignment(docs: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECES, head: int = HEAD) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of ``docs`` (doc_id, text).

    Groups are cut at the bytes where tokens of both tokenizers end; links are the pairs of tokens that share bytes.
    ``n_best`` counts the links whose pair is, over all rows, the most frequent one of its B id (ties included);
    ``count_sum`` adds up the pairs' counts over the links.

    Null and empty texts, and texts that one of the tokenizers does not spell back, have no tokens: zeros and an empty
    digest. Repeated rows give repeated results and count repeatedly. Null ids stay. Other columns are not read.
    """
    a, b = ByteLevel(read_bytes(path_a)), Pieces(read_bytes(path_b))
    sizes = lengths(a.bytes_of), lengths(b.bytes_of)
    rows = tokenised(docs, path_a, path_b)
    counts = pair_counts(rows, sizes)
    best = counts.groupBy((F.col("pair") % b.size).alias("b")).agg(F.max("n").alias("most"))
    # One row per id of B; the larger side stays where it is.
    marked = counts.join(F.broadcast(best), F.col("pair") % b.size == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )
    bar = (counts.agg(F.sum("n")).first()[0] or 0) >> head
    frequent = marked.where(F.col("n") > bar).sort("pair").toArrow()  # fewer than 2^head rows, as each has over total / 2^head
    shipped = docs.sparkSession.sparkContext.broadcast(
        (frequent["pair"].to_numpy(), frequent["n"].to_numpy(), frequent["best"].to_numpy(zero_copy_only=False))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times, is_best = shipped.value
        for batch in C.arrow_rows(batches, 100):
            n_links = (batch.column(1).to_numpy() + batch.column(2).to_numpy()) - batch.column(3).to_numpy()
            key = linked_ids(batch, 4, 5, sizes)
            owner = np.repeat(np.arange(batch.num_rows), n_links)
            known = np.zeros(len(key), bool)
            n, top = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
            if len(pairs):
                at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                known = pairs[at] == key
                n, top = np.where(known, times[at], 0), is_best[at] & known
            total = np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner, n)
            rare_key, rare_owner = key[~known], owner[~known]
            order = np.lexsort((rare_key, rare_owner))
            rare_key, rare_owner = rare_key[order], rare_owner[order]
            first = np.flatnonzero((np.diff(rare_key, prepend=-1) != 0) | (np.diff(rare_owner, prepend=-1) != 0))
            often = np.diff(np.append(first, len(rare_key)))
            stops = np.append(0, np.cumsum(np.bincount(rare_owner[first], minlength=batch.num_rows))).astype(np.int32)
            offsets = pa.array(stops)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_links, pa.int64()),
                    pa.array(np.bincount(owner, top, minlength=batch.num_rows).astype(np.int64)),
                    pa.array(total),
                    pa.ListArray.from_arrays(offsets, pa.array(rare_key[first], pa.int64())),
                    pa.ListArray.from_arrays(offsets, pa.array(often, pa.int64())),
                ],
                names=["row", "n_links", "n_best", "count_sum", "rare", "often"],
            )

    read = rows.where("n_a > 0").select("row", "n_a", "n_b", "n_groups", "a", "b")
    scored = read.mapInArrow(look_up, "row long, n_links long, n_best long, count_sum long, rare array<long>, often array<long>")
    scored = materialise(scored, "alignment")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "often")).alias("x")).select(
        "row", F.col("x.rare").alias("pair"), F.col("x.often").alias("often")
    )
    added = rare.join(marked.where(F.col("n") <= bar), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("often")).otherwise(0)).alias("more_best"), F.sum(F.col("often") * F.col("n")).alias("more")
    )
    plain = rows.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    joined = plain.join(scored.select("row", "n_links", "n_best", "count_sum"), "row", "left").join(added, "row", "left")

    def number(*columns: str):
        return sum((F.coalesce(c, F.lit(0)) for c in columns), F.lit(0)).cast("long")

    return joined.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        number("n_links").alias("n_links"),
        number("n_best", "more_best").alias("n_best"),
        number("count_sum", "more").alias("count_sum"),
        "groups_sha256",
    )
