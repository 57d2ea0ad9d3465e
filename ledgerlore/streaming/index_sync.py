"""Triggered sync of the embedding index with the chunk changes of its source folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.operators.changes import DELETE, latest_change, single_changes
from ledgerlore.streaming.keyed_log import BATCH, newest, read_log, write_batch


def sync_index(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    index: str,
    checkpoint: str,
    *,
    key: str = "chunk_id",
    embed: Callable[[DataFrame], DataFrame] | None = None,
    version: str | None = None,
) -> int:
    """Take the change files not yet taken, embed their chunks and add them to the index; then stop.

    The first run finds no checkpoint and takes everything; an idle run does nothing. Returns the number of
    micro-batches of this run. ``schema`` is the chunk columns with ``_change_type`` and, when one key can
    change twice in a run, the ``version`` column; without it such a run fails before it writes anything.
    """
    ran = []

    def upsert(batch: DataFrame, batch_id: int) -> None:
        decided = latest_change(batch, key, version)
        if version is None:
            single_changes(decided, key).write.format("noop").mode("overwrite").save()  # reads the keys alone
        deleted = F.col("_change_type") == DELETE
        kept = [c for c in decided.columns if c not in ("_change_type", key, version)]
        # A deletion is its key: nothing else of it is embedded or written.
        rows = decided.select(key, *[F.when(~deleted, F.col(c)).alias(c) for c in kept], deleted.alias("deleted"))
        write_batch(embed(rows) if embed else rows, index, batch_id)
        ran.append(batch_id)

    query = (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(ran)


def read_index(spark: SparkSession, index: str, *, key: str = "chunk_id", columns: list[Column] | None = None) -> DataFrame:
    """The index as it stands after the last sync: all columns, or the key and those that ``columns`` make of a row.

    The latter are taken before the versions of a key meet, so what they do not need of a row is not shuffled.
    """
    rows = read_log(spark, index)
    return newest(rows if columns is None else rows.select(key, *columns, BATCH, "deleted"), key)
