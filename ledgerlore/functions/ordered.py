"""Ordered computations inside a group, without ever handing a whole group to one task.

A window over ``partitionBy(group)`` sends every row of a group to one task, which fails as soon as one
file or conversation holds a large share of the table. Here the integer order key is split into blocks
of ``2 ** BLOCK_BITS`` keys. Keys are unique inside a group, so a (group, block) pair holds at most that
many rows whatever the data look like. What a block must know of the earlier ones is computed from one
small row per block -- by the same function, so that level is bounded as well -- and enters the block as
extra "carry" rows in front. The rows themselves are shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16

_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min}


def key_range(df: DataFrame, key: str) -> tuple[int, int]:
    """Smallest and largest order key; one narrow aggregate."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    return (0, 0) if low is None else (int(low), int(high))


def _partition(group: Sequence[str], *more: str) -> list[Column]:
    return [F.col(c) for c in (*group, *more)] or [F.lit(0)]


def totals_before(
    df: DataFrame,
    group: Sequence[str],
    key: str,
    totals: Mapping[str, tuple[str, Column]],
    *,
    bits: int = BLOCK_BITS,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """Add running aggregates over the rows of the group with a smaller key (null for the first row).

    ``totals`` maps a new column to ``("sum" | "max" | "min", value)``. ``key`` is an integer column,
    unique inside the group.
    """
    low, high = bounds or key_range(df, key)
    valued = df.select("*", *[v.alias(f"__v_{n}") for n, (_, v) in totals.items()])
    kinds = {n: kind for n, (kind, _) in totals.items()}
    out = _totals_before(valued, list(group), key, kinds, bits, low, high)
    return out.drop(*[f"__v_{n}" for n in totals])


def _totals_before(df, group, key, kinds, bits, low, high):
    if high - low < 2**bits:
        window = Window.partitionBy(*_partition(group)).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *[_AGGREGATES[k](f"__v_{n}").over(window).alias(n) for n, k in kinds.items()])

    blocked = df.withColumn("__block", F.shiftright(F.col(key).cast("long"), bits))
    per_block = blocked.groupBy(*group, "__block").agg(
        *[_AGGREGATES[k](f"__v_{n}").alias(f"__v_{n}") for n, k in kinds.items()]
    )
    above = _totals_before(
        per_block.withColumnRenamed("__block", "__key"), group, "__key", kinds, bits, low >> bits, high >> bits
    )
    carry = above.select(
        *group,
        F.col("__key").alias("__block"),
        F.lit(True).alias("__carry"),
        *[F.col(n).alias(f"__v_{n}") for n in kinds],
    )
    rows = blocked.withColumn("__carry", F.lit(False)).unionByName(carry, allowMissingColumns=True)
    window = (
        Window.partitionBy(*_partition(group, "__block"))
        .orderBy(F.col("__carry").desc(), F.col(key))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.select("*", *[_AGGREGATES[k](f"__v_{n}").over(window).alias(n) for n, k in kinds.items()])
        .where(~F.col("__carry"))
        .drop("__carry", "__block")
    )


def previous_rows(
    df: DataFrame,
    group: Sequence[str],
    key: str,
    n: int,
    payload: Column,
    name: str,
    *,
    bits: int = BLOCK_BITS,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``name``: the payloads of the up to ``n`` rows before this one in its group, oldest first."""
    low, high = bounds or key_range(df, key)
    return _previous_rows(df.withColumn("__p", payload), list(group), key, n, name, bits, low, high).drop("__p")


def _previous_rows(df, group, key, n, name, bits, low, high):
    if high - low < 2**bits:
        window = Window.partitionBy(*_partition(group)).orderBy(key).rowsBetween(-n, -1)
        return df.withColumn(name, F.collect_list("__p").over(window))

    blocked = df.withColumn("__block", F.shiftright(F.col(key).cast("long"), bits))
    newest_first = Window.partitionBy(*_partition(group, "__block")).orderBy(F.col(key).desc())
    tails = (
        blocked.select(*group, "__block", F.col(key).alias("__at"), "__p")
        .withColumn("__rank", F.row_number().over(newest_first.orderBy(F.col("__at").desc())))
        .where(F.col("__rank") <= n)
        .groupBy(*group, "__block")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("__at"), F.col("__p")))).getField("__p").alias("__p"))
    )
    above = _previous_rows(
        tails.withColumnRenamed("__block", "__key"), group, "__key", n, "__tails", bits, low >> bits, high >> bits
    )
    last = F.flatten("__tails")
    carry = (
        above.select(*group, F.col("__key").alias("__block"), last.alias("__all"))
        .select(
            *group,
            "__block",
            F.posexplode(F.slice("__all", F.greatest(F.size("__all") - (n - 1), F.lit(1)), F.lit(n))).alias(
                "__pos", "__p"
            ),
        )
        .withColumn("__carry", F.lit(True))
    )
    rows = (
        blocked.withColumn("__carry", F.lit(False))
        .withColumn("__pos", F.lit(0))
        .unionByName(carry, allowMissingColumns=True)
    )
    window = (
        Window.partitionBy(*_partition(group, "__block"))
        .orderBy(F.col("__carry").desc(), "__pos", F.col(key))
        .rowsBetween(-n, -1)
    )
    return (
        rows.withColumn(name, F.collect_list("__p").over(window))
        .where(~F.col("__carry"))
        .drop("__carry", "__pos", "__block")
    )
