"""Joins that stay even when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1000


def join_shared(rows: DataFrame, keys: DataFrame, key: str, weight: str, share: int = HEAVY_SHARE) -> DataFrame:
    """Inner join of ``rows`` with the one row that ``keys`` has for each key.

    ``weight`` says how many rows a key has. Keys above one ``share``-th of all weight, a thousandth, are fewer than
    ``share``, so those travel to the rows; the others meet by a shuffle in which none of them can make a task large. With
    a larger ``share`` fewer rows are shuffled. ``keys`` should be a written table, as it is read three times.
    """
    bar = (keys.agg(F.sum(weight)).first()[0] or 0) // share
    values = [c for c in keys.columns if c != key]
    frequent = keys.where(F.col(weight) > bar).select(key, F.struct(*values).alias("__f"))
    others = keys.where(F.col(weight) <= bar).select(key, F.struct(*values).alias("__f"))
    marked = rows.join(F.broadcast(frequent), key, "left")
    known = marked.where(F.col("__f").isNotNull())
    met = marked.where(F.col("__f").isNull()).drop("__f").join(others, key)
    return known.unionByName(met).select(*rows.columns, *[F.col(f"__f.{c}").alias(c) for c in values])
