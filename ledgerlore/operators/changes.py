"""Change feed between two snapshots of a keyed table, and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.session import materialise

BUCKETS = 1 << 16
MANY_CHANGES = 1 << 18  # keys; fewer are left to adaptive execution, which lets a few megabytes travel
FEW_OTHERS = 1 << 21  # keys that travel to the rows where most keys changed
INSERT, DELETE = "insert", "delete"
BEFORE, AFTER = "update_preimage", "update_postimage"


def _digest(df: DataFrame) -> Column:
    """128 bits over all columns of a row; a null is not skipped, be it a value or an element of an array."""
    parts = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.AtomicType):
            parts += [c.isNull(), F.size(c), F.transform(c, lambda x: x.isNull()), c]
        elif isinstance(field.dataType, T.AtomicType):
            parts += [c.isNull(), c]
        else:
            parts.append(F.to_json(F.struct(c), {"ignoreNullFields": "false"}))
    return F.struct(F.xxhash64(*parts).alias("x"), F.xxhash64(F.lit(1), *parts).alias("y"))


def changed_keys(old: DataFrame, new: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``(key, in_old, in_new)`` of the keys whose rows differ, as a written table.

    Digests are compared by buckets of keys first; what lies in a bucket whose digests add up to the same is never
    looked at again. Of the other buckets key and digest alone are shuffled.
    """

    def narrow(df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        return df.select(F.col(key).alias("k"), _digest(df.select(*new.columns)).alias("d"), bucket.alias("bucket"))

    def summed(df: DataFrame, side: str) -> DataFrame:
        total = F.struct(F.count(F.lit(1)), F.bit_xor("d.x"), F.bit_xor("d.y")).alias(side)
        return narrow(df).groupBy("bucket").agg(total)

    both = summed(old, "a").join(summed(new, "b"), "bucket", "full_outer")
    open_buckets = materialise(both.where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket"), "buckets")
    # At most ``buckets`` numbers.
    a, b = (narrow(df).join(F.broadcast(open_buckets), "bucket", "left_semi").select("k", "d") for df in (old, new))
    a, b = a.withColumnRenamed("d", "o").alias("a"), b.withColumnRenamed("d", "n").alias("b")
    met = a.join(b, F.col("a.k").eqNullSafe(F.col("b.k")), "full_outer").where(~F.col("o").eqNullSafe(F.col("n")))
    in_old, in_new = F.col("o").isNotNull(), F.col("n").isNotNull()
    found = met.select(F.when(in_old, F.col("a.k")).otherwise(F.col("b.k")).alias("k"), in_old.alias("in_old"), in_new.alias("in_new"))
    return materialise(found, "changed-keys")


def change_feed(old: DataFrame, new: DataFrame, key: str, images: bool = True) -> DataFrame:
    """Rows of both snapshots that differ, labelled by what happened to their key; a null key is a key like others.

    Which keys changed is found from digests; the wide rows are read once more for those keys alone, so the rows that
    did not change are never shuffled while the changed keys are few enough to travel. Both snapshots are read several
    times and should be tables.

    Without ``images`` the old rows stay where they are, which is enough to follow the table: a deletion has its key and
    nulls, and there are no preimages.
    """
    changed = changed_keys(old, new, key)
    many = changed.count() > MANY_CHANGES
    here = F.col(key).eqNullSafe(F.col("k"))

    def rows(df: DataFrame, side: str, other: str, alone: str, both: str) -> DataFrame:
        wanted = changed.where(side).select("k", F.when(F.col(other), both).otherwise(alone).alias("_change_type"))
        if many:
            # Where most keys are on this side alone, the others are the few that travel.
            kept = df.select(F.col(key).alias("__key")).join(wanted, F.col("__key").eqNullSafe(F.col("k")), "left_anti")
            others = wanted.where(F.col("_change_type") == both).unionByName(
                kept.select(F.col("__key").alias("k"), F.lit(None).cast("string").alias("_change_type"))
            )
            others = materialise(others.distinct().withColumn("__other", F.lit(True)), "other-keys")
            if others.count() <= FEW_OTHERS:
                met = df.select(*new.columns).join(F.broadcast(others), here, "left")
                met = met.where(F.col("__other").isNull() | F.col("_change_type").isNotNull())
                return met.select(*new.columns, F.coalesce("_change_type", F.lit(alone)).alias("_change_type"))
        return df.select(*new.columns).join(wanted, here).select(*new.columns, "_change_type")

    after = rows(new, "in_new", "in_old", INSERT, AFTER)
    if not images:
        gone = changed.where(~F.col("in_new")).select(F.col("k").alias(key), F.lit(DELETE).alias("_change_type"))
        return after.unionByName(gone, allowMissingColumns=True)
    return rows(old, "in_old", "in_new", DELETE, BEFORE).unionByName(after)


def latest_change(feed: DataFrame, key: str, version: str | None = None) -> DataFrame:
    """The change that decides each key: the last one by version; preimages never decide."""
    rows = feed.where(F.col("_change_type") != BEFORE)
    if version is None:
        return rows
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), version).alias("c")).select(key, "c.*")


def single_changes(rows: DataFrame, key: str) -> DataFrame:
    """The keys of ``rows``; reading them fails where a key has several changes, as nothing says which one is last."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    message = F.concat(F.lit(f"several changes of one {key} need a version: "), F.col(key).cast("string"))
    return counted.select(F.when(F.col("__n") == 1, F.col(key)).otherwise(F.raise_error(message)).alias(key))


def apply_changes(target: DataFrame, feed: DataFrame, key: str, version: str | None = None) -> DataFrame:
    """The target after the feed: changed keys leave it, inserted and updated rows come in.

    Without a ``version`` a key may change once in a feed; a second change of it is an error.
    """
    decided = latest_change(feed, key, version)
    keys = decided.select(key) if version else single_changes(decided, key)
    kept = target.join(keys, key, "left_anti")
    return kept.select(*target.columns).unionByName(
        decided.where(F.col("_change_type") != DELETE).select(*target.columns)
    )
