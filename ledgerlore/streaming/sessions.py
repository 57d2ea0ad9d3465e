"""Session history over a stream of messages: each user message leaves with the turns before it.

The state of a conversation is its last six messages. A micro-batch puts them in front of its own messages and
runs the batch operator on both, so streamed and batch results are the same, and a conversation that fills a
micro-batch is split into blocks as in the batch case instead of being handled by the one task of its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.operators.dialog import HISTORY_MESSAGES, history_before, spoken
from ledgerlore.streaming.keyed_log import BATCH, newest, read_log, write_batch


def _last_messages(rows: DataFrame) -> DataFrame:
    """``(conv_id, tail)``: the last messages; the limit applies before the shuffle as well."""
    newest_first = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    ranked = rows.withColumn("__rn", F.row_number().over(newest_first)).where(F.col("__rn") <= HISTORY_MESSAGES)
    return ranked.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "content", "source_used"))).alias("tail")
    )


def stream_histories(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    out: str,
    state: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
) -> None:
    """Write ``(conv_id, turn, question, history)`` for the messages that have arrived; then stop.

    Messages of a conversation arrive in the order of their turns, batch by batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = spoken(batch).select("conv_id", "turn", "role", "content", "source_used").withColumn("fresh", F.lit(True))
        rows = fresh
        if batch_id > 0:
            known = read_log(spark, state).where(F.col(BATCH) < batch_id)
            active = known.join(fresh.select("conv_id").distinct(), "conv_id", "left_semi")
            tails = newest(active, "conv_id").select("conv_id", F.inline("tail")).withColumn("fresh", F.lit(False))
            rows = fresh.unionByName(tails)
        answered = history_before(rows, keep=["fresh"]).where("fresh").drop("fresh")
        write_batch(answered, out, batch_id)
        write_batch(_last_messages(rows), state, batch_id)

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(source)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_histories(spark: SparkSession, out: str) -> DataFrame:
    return read_log(spark, out).drop(BATCH)
