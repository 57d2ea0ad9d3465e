"""A vector index that is kept in step and searched: vectors in cells, one folder per sync, partitioned by cell.

``vectors/batch=n/cell=c`` holds what sync n wrote, ``keys/batch=n`` the same without vectors: key, cell, angle to the
cell's centre, and whether the key is gone. A sync takes changed rows alone and assigns them to the centres that are
there; cells that have grown beyond the bound are split, which rewrites those cells only. The newest batch of a key
decides, so an older version of a moved or deleted key is left out by its number, found from the narrow keys. After
``MOST_BATCHES`` batches the live rows are written as a new base, and readers open nothing older.

A search visits the cells that can hold a hit, and only their folders are opened.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.operators.changes import DELETE, latest_change, single_changes
from ledgerlore.operators.similarity import CellIndex, assign_cells, common_size, fit_cells, search_index
from ledgerlore.streaming.keyed_log import BATCH

CELL_ROWS = 8192
MOST_BATCHES = 8
STEPS = 3  # numbers per sync: its changes, the split of cells, a new base
SPLIT_SAMPLE = 4096  # rows of a cell that its parts are learnt from


def _batches(spark: SparkSession, folder: str, part: str) -> list[int]:
    """Numbers of the finished batches of a part, newest last; one name per folder is read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path)]
    done = [n for n in names if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{part}/{n}/_SUCCESS"))]
    return sorted(int(n.partition("=")[2]) for n in done if n.startswith(f"{BATCH}="))


def _read(spark: SparkSession, folder: str, part: str, numbers: list[int]) -> DataFrame:
    return spark.read.option("basePath", f"{folder}/{part}").parquet(*[f"{folder}/{part}/{BATCH}={n}" for n in numbers])


def _open(spark: SparkSession, folder: str) -> list[int]:
    """The batches that count: the newest base and what came after it."""
    bases = _batches(spark, folder, "bases")
    return [n for n in _batches(spark, folder, "keys") if not bases or n >= bases[-1]]


def _centres(spark: SparkSession, folder: str, numbers: list[int]) -> np.ndarray | None:
    """Centres by cell number, as the newest batch that changed them has them; a cell that was split has none any more
    and is a row of zeros here."""
    known = [n for n in _batches(spark, folder, "centres") if not numbers or n <= numbers[-1]]
    if not known:
        return None
    rows = spark.read.parquet(f"{folder}/centres/{BATCH}={known[-1]}").collect()  # one row per cell
    out = np.zeros((max(r["cell"] for r in rows) + 1, len(rows[0]["centre"])))
    for r in rows:
        out[r["cell"]] = r["centre"]
    return out


def _write_centres(spark: SparkSession, folder: str, centres: np.ndarray, number: int) -> None:
    rows = [(i, c.tolist()) for i, c in enumerate(centres) if c.any()]
    frame = spark.createDataFrame(rows, "cell int, centre array<double>")
    frame.coalesce(1).write.mode("overwrite").parquet(f"{folder}/centres/{BATCH}={number}")


def _nearest(rows: DataFrame, centres: np.ndarray, key: str, vector: str) -> DataFrame:
    """``(cell, key, vector, angle)`` among the cells that have a centre."""
    cells = np.flatnonzero(centres.any(axis=1))
    found = assign_cells(rows, centres[cells], id_col=key, vector=vector)
    number = F.get(F.array(*[F.lit(int(c)) for c in cells]), F.col("cell"))
    return found.select(number.alias("cell"), F.col("id").alias(key), F.col("vec").alias(vector), "angle")


def _write(rows: DataFrame, folder: str, number: int, key: str, gone: DataFrame | None = None) -> None:
    """Rows ``(cell, key, vector, angle)`` and deleted keys as batch ``number``; written again, it replaces itself.

    Vectors come first: a batch counts from the moment its keys are there.
    """
    path = f"{folder}/vectors/{BATCH}={number}"
    rows.write.mode("overwrite").partitionBy("cell").parquet(path)
    spark = rows.sparkSession
    kept = spark.read.schema(rows.schema).parquet(path)
    keys = kept.select(key, F.col("cell").cast("int").alias("cell"), "angle", F.lit(False).alias("deleted"))
    if gone is not None:
        nothing = [F.lit(None).cast("int").alias("cell"), F.lit(None).cast("double").alias("angle"), F.lit(True).alias("deleted")]
        keys = keys.unionByName(gone.select(key, *nothing))
    keys.write.mode("overwrite").parquet(f"{folder}/keys/{BATCH}={number}")


def _live(spark: SparkSession, folder: str, numbers: list[int], key: str) -> tuple[DataFrame, DataFrame]:
    """``(key, batch, cell, angle)`` of the rows that count, and ``(key, batch)`` of those that something newer replaced."""
    keys = _read(spark, folder, "keys", numbers)
    last = keys.groupBy(key).agg(F.max(BATCH).alias("last"), F.count(F.lit(1)).alias("versions"))
    several = last.where(F.col("versions") > 1)
    joined = keys.join(several, key, "left")
    newest = F.col("last").isNull() | (F.col(BATCH) == F.col("last"))
    live = joined.where(newest & ~F.col("deleted")).select(key, BATCH, "cell", "angle")
    return live, joined.where(~newest & ~F.col("deleted")).select(key, BATCH)


def _members(spark: SparkSession, folder: str, numbers: list[int], key: str, cells: list[int] | None = None) -> DataFrame:
    """``(cell, key, vector, angle, batch)`` of the live rows, from the folders of the given cells alone."""
    rows = _read(spark, folder, "vectors", numbers)
    if cells is not None:
        rows = rows.where(F.col("cell").isin(cells))
    return rows.join(_live(spark, folder, numbers, key)[1], [key, BATCH], "left_anti")


def sync_cells(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    folder: str,
    checkpoint: str,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    version: str | None = None,
    cell_rows: int = CELL_ROWS,
    most_batches: int = MOST_BATCHES,
) -> int:
    """Take the change files not yet taken into the index; then stop. Returns the number of micro-batches.

    ``schema`` is the key, the vector, ``_change_type`` and, when one key can change twice in a run, ``version``.
    Vectors without a direction, or of another size than the first ones, are in no cell; such a change removes the key.
    """
    ran = []

    def take(batch: DataFrame, batch_id: int) -> None:
        number = STEPS * batch_id
        ran.append(batch_id)
        decided = latest_change(batch, key, version).select(key, vector, "_change_type")
        if version is None:
            single_changes(decided, key).write.format("noop").mode("overwrite").save()
        filled = decided.where(F.col("_change_type") != DELETE)
        earlier = [n for n in _open(spark, folder) if n < number]
        centres = _centres(spark, folder, earlier) if earlier else None
        if centres is None and not common_size(filled, vector):
            return  # nothing that could be searched has arrived so far, so there is nothing to remove either
        if centres is None:
            centres = fit_cells(filled, max(1, min(round(filled.count() ** 0.5), 256)), vector=vector)
            _write_centres(spark, folder, centres, number)
        placed = _nearest(filled, centres, key, vector)
        _write(placed, folder, number, key, decided.join(placed.select(key), key, "left_anti"))
        _split(spark, folder, [*earlier, number], number + 1, key, vector, cell_rows)
        numbers = _open(spark, folder)
        if len(numbers) > most_batches:
            _rebase(spark, folder, numbers, number + 2, key, vector)

    query = (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(ran)


def _split(spark: SparkSession, folder: str, numbers: list[int], number: int, key: str, vector: str, cell_rows: int) -> None:
    """Part cells above ``cell_rows`` rows: their live rows move to new cells, as a batch of its own.

    A cell learns its parts from a bounded sample of its rows in a task of its own, and its rows stay spread. Vectors
    so alike that one part takes nearly all stay together; such a cell is split no further.
    """
    live, _ = _live(spark, folder, numbers, key)
    sizes = live.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > cell_rows)
    large = {r["cell"]: r["m"] for r in sizes.collect()}  # fewer than all rows / cell_rows
    if not large:
        return
    centres = _centres(spark, folder, numbers)
    rows = _members(spark, folder, numbers, key, list(large))
    size = F.element_at(F.create_map(*[F.lit(x) for pair in large.items() for x in pair]), F.col("cell"))
    share = F.pmod(F.xxhash64(key), F.lit(1 << 30)) * size < F.lit(SPLIT_SAMPLE << 30)

    def parts(group: pa.Table) -> pa.Table:
        cell = group["cell"][0].as_py()
        group = group.take(np.argsort(group["h"].to_numpy(), kind="stable"))
        sample = np.stack(group[vector].to_numpy()).astype(np.float64)
        sample /= np.sqrt(np.einsum("ij,ij->i", sample, sample))[:, None]
        k = min(max(2, -(-2 * large[cell] // cell_rows)), 64, len(sample))
        middle = sample[np.linspace(0, len(sample) - 1, k).astype(int)]
        for _ in range(8):
            near = (sample @ middle.T).argmax(axis=1)
            sums = np.zeros_like(middle)
            np.add.at(sums, near, sample)
            length = np.sqrt(np.einsum("ij,ij->i", sums, sums))[:, None]
            middle = np.where(length > 0, sums / np.where(length > 0, length, 1), middle)
        counts = np.bincount((sample @ middle.T).argmax(axis=1), minlength=k)
        middle = middle[counts > 0] if counts.max() < 0.95 * len(sample) else middle[:0]
        return pa.table({"cell": pa.array([cell] * len(middle), pa.int32()), "centre": pa.array(list(middle), pa.list_(pa.float64()))})

    drawn = rows.where(share).select(F.col("cell").cast("int").alias("cell"), F.xxhash64(key).alias("h"), vector)
    found = drawn.groupBy("cell").applyInArrow(parts, "cell int, centre array<double>").sort("cell").collect()
    if not found:
        return
    split = sorted({r["cell"] for r in found})
    new = np.concatenate([centres, [r["centre"] for r in found]])
    new[split] = 0
    # Rows of a cell that is split go to the nearest of all centres that are left; that may be a cell beside it.
    moved = _nearest(rows.where(F.col("cell").isin(split)), new, key, vector)
    _write_centres(spark, folder, new, number)
    _write(moved, folder, number, key)


def _rebase(spark: SparkSession, folder: str, numbers: list[int], number: int, key: str, vector: str) -> None:
    """All live rows as one batch that readers start from; older folders stay until the caller expires them."""
    _write(_members(spark, folder, numbers, key).select("cell", key, vector, "angle"), folder, number, key)
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/bases/{BATCH}={number}")


def read_cells(spark: SparkSession, folder: str, *, key: str = "vec_id") -> DataFrame:
    """The live rows: cell, key, vector."""
    return _members(spark, folder, _open(spark, folder), key).drop(BATCH, "angle")


def search_cells(
    spark: SparkSession,
    folder: str,
    queries: DataFrame,
    k: int,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    qid: str = "qid",
    exact: bool = True,
    probes: int = 2,
) -> DataFrame:
    """``(qid, rank, id, score)`` from the index as it stands after the last sync; see ``similarity.search_index``."""
    numbers = _open(spark, folder)
    if not numbers:
        none = queries.limit(0)  # no key has been seen, so its type is that of the queries' keys
        return none.select(F.col(qid).alias("qid"), F.lit(0).alias("rank"), F.col(qid).alias("id"), F.lit(0.0).alias("score"))
    centres = _centres(spark, folder, numbers)
    live, _ = _live(spark, folder, numbers, key)
    reach = {r["cell"]: r["r"] for r in live.groupBy("cell").agg(F.max("angle").alias("r")).collect()}  # one row per cell
    table = _members(spark, folder, numbers, key).select("cell", F.col(key).alias("id"), F.col(vector).alias("vec"))
    index = CellIndex(table, centres, reach, partitioned=True)
    return search_index(index, queries, k, qid=qid, vector=vector, exact=exact, probes=probes)
