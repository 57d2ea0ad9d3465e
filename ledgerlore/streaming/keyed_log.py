"""A keyed table kept as one folder of changes per micro-batch.

A run writes only what changed. A batch that is run again after a failure overwrites its own folder, so it
counts once. Readers take the newest row of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.session import DENSE

BATCH = "batch"


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    rows.write.mode("overwrite").option("compression", DENSE).parquet(f"{folder}/{BATCH}={batch_id}")


def newest(rows: DataFrame, key: str) -> DataFrame:
    """The newest version of each key, without the keys whose newest version is a deletion.

    Versions are counted on the key alone. Only keys with several of them, few next to the whole, meet the wide
    rows again, so the rows of the first load are normally neither sorted nor shuffled. A batch holds a key once.
    """
    changed = (
        rows.groupBy(key)
        .agg(F.max(BATCH).alias("__last"), F.count(F.lit(1)).alias("__versions"))
        .where(F.col("__versions") > 1)
        .select(key, "__last")
    )
    current = rows.join(changed, key, "left").where(F.col("__last").isNull() | (F.col(BATCH) == F.col("__last")))
    alive = current.where(~F.col("deleted")) if "deleted" in rows.columns else current
    return alive.drop("__last", BATCH, "deleted")


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(folder)


def compact(spark: SparkSession, folder: str, key: str, target: str) -> None:
    """Write the current rows as the first batch of a new folder; the old one stays until readers leave it."""
    rows = newest(read_log(spark, folder), key)
    write_batch(rows.withColumn("deleted", F.lit(False)), target, 0)
