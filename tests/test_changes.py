import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.operators import changes
from ledgerlore.operators.changes import apply_changes, change_feed, changed_keys
from ledgerlore.streaming.index_sync import read_index, sync_index
from ledgerlore.streaming.keyed_log import compact

SCHEMA = "id int, a string, b int"
snapshots = st.dictionaries(st.integers(0, 8), st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 1)), max_size=7)


def frame(spark, snapshot):
    return spark.createDataFrame([(k, *v) for k, v in snapshot.items()], SCHEMA)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshots, snapshots)
def test_feed_turns_old_into_new(spark, old, new):
    feed = change_feed(frame(spark, old), frame(spark, new), "id")
    rows = {(r["id"], r["_change_type"], r["a"], r["b"]) for r in feed.collect()}
    expected = {(k, "insert", *new[k]) for k in new.keys() - old.keys()} | {
        (k, "delete", *old[k]) for k in old.keys() - new.keys()
    }
    for k in old.keys() & new.keys():
        if old[k] != new[k]:
            expected |= {(k, "update_preimage", *old[k]), (k, "update_postimage", *new[k])}
    assert rows == expected
    applied = apply_changes(frame(spark, old), feed, "id")
    assert {r["id"]: (r["a"], r["b"]) for r in applied.collect()} == new


def test_latest_version_decides(spark):
    old = frame(spark, {1: ("x", 0), 2: ("x", 0)})
    feed = spark.createDataFrame(
        [(1, "y", 1, "update_postimage", 1), (1, "y", 1, "delete", 3), (2, "z", 5, "update_postimage", 2),
         (2, "w", 4, "update_postimage", 1), (3, "n", 1, "delete", 1), (3, "n", 2, "insert", 2)],
        SCHEMA + ", _change_type string, v int",
    )
    out = apply_changes(old, feed, "id", version="v").collect()
    assert {r["id"]: (r["a"], r["b"]) for r in out} == {2: ("z", 5), 3: ("n", 2)}


def test_second_change_without_version_is_an_error(spark, tmp_path):
    old = frame(spark, {1: ("x", 0)})
    feed = spark.createDataFrame(
        [(2, "n", 1, "insert"), (2, "m", 2, "update_postimage")], SCHEMA + ", _change_type string"
    )
    with pytest.raises(Exception, match="need a version"):
        apply_changes(old, feed, "id").collect()
    source, index, checkpoint = (str(tmp_path / n) for n in ("in", "index", "cp"))
    feed.write.parquet(source)
    with pytest.raises(Exception, match="need a version"):
        sync_index(spark, source, feed.schema, index, checkpoint, key="id")


def test_index_follows_its_source(spark, tmp_path):
    source, index, checkpoint = (str(tmp_path / n) for n in ("in", "index", "cp"))
    schema = T.StructType.fromDDL("chunk_id string, content string, _change_type string, v int")

    def arrive(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def sync():
        return sync_index(
            spark, source, schema, index, checkpoint, version="v",
            embed=lambda df: df.withColumn("embedding", F.array(F.length("content").cast("float"))),
        )

    def state(folder=index):
        return {r["chunk_id"]: (r["content"], r["embedding"]) for r in read_index(spark, folder).collect()}

    arrive(("a", "one", "insert", 1), ("b", "two", "insert", 1), ("c", "x", "insert", 1), ("c", "xx", "update_postimage", 2))
    assert sync() == 1
    assert state() == {"a": ("one", [3.0]), "b": ("two", [3.0]), "c": ("xx", [2.0])}
    assert sync() == 0
    arrive(("a", "one", "update_preimage", 3), ("a", "four", "update_postimage", 3), ("b", "two", "delete", 3),
           ("d", "new", "insert", 3))
    assert sync() == 1
    after = {"a": ("four", [4.0]), "c": ("xx", [2.0]), "d": ("new", [3.0])}
    assert state() == after
    compact(spark, index, "chunk_id", str(tmp_path / "compact"))
    assert state(str(tmp_path / "compact")) == after


def test_a_batch_written_twice_counts_once(spark, tmp_path):
    from ledgerlore.streaming.keyed_log import newest, read_log, write_batch

    rows = spark.createDataFrame([("a", "one", False)], "chunk_id string, content string, deleted boolean")
    for _ in range(2):
        write_batch(rows, str(tmp_path / "log"), 0)
    log = read_log(spark, str(tmp_path / "log"))
    assert (log.count(), newest(log, "chunk_id").count()) == (1, 1)




def test_nulls_and_array_elements_count(spark):
    schema = "id int, a string, b array<int>"
    old = [(1, None, [1]), (2, "x", None), (3, "x", [None, 1]), (4, "x", []), (None, "n", [1]), (6, "s", [1, 2])]
    new = [(1, None, [1]), (2, "x", []), (3, "x", [1]), (4, "x", None), (None, "m", [1]), (6, "s", [1, 2])]
    feed = change_feed(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), "id")
    assert sorted((str(r.id), r._change_type) for r in feed.collect()) == sorted(
        (str(k), c) for k in (2, 3, 4, None) for c in ("update_preimage", "update_postimage")
    )


def test_unchanged_content_is_not_shuffled(spark, tmp_path):
    rows = spark.range(2000).select(F.col("id").cast("int").alias("id"), F.repeat(F.col("id").cast("string"), 50).alias("content"))
    rows.write.parquet(f"{tmp_path}/old")
    rows.withColumn("content", F.when(F.col("id") == 7, "new").otherwise(F.col("content"))).write.parquet(f"{tmp_path}/new")
    old, new = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("old", "new"))
    assert [tuple(r) for r in changed_keys(old, new, "id").collect()] == [(7, True, True)]
    feed = change_feed(old, new, "id")
    assert feed.count() == 2
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_feed_is_the_same_when_most_keys_change(spark, monkeypatch):
    schema = "id int, a string, b int"
    old = [(i, f"o{i}", i) for i in range(40)] + [(None, "n", 0)]
    new = [(i, f"o{i}" if i < 33 else "v", i) for i in range(30, 37)] + [(100 + i, "m", i) for i in range(40)] + [(None, "n", 0)]
    old, new = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    plain = sorted(map(str, change_feed(old, new, "id").collect()))
    monkeypatch.setattr(changes, "MANY_CHANGES", 0)
    feed = change_feed(old, new, "id")
    assert sorted(map(str, feed.collect())) == plain
    monkeypatch.setattr(changes, "FEW_OTHERS", 0)
    assert sorted(map(str, change_feed(old, new, "id").collect())) == plain
    assert feed.where("_change_type = 'delete'").where("a is not null").count() == 33
    short = change_feed(old, new, "id", images=False)
    assert sorted(map(str, short.where("_change_type in ('insert', 'update_postimage')").collect())) == [
        r for r in plain if "insert" in r or "postimage" in r
    ]
    assert {(r.id, r.a, r.b, r._change_type) for r in short.collect() if r._change_type in ("delete", "update_preimage")} == {
        (i, None, None, "delete") for i in [*range(30), 37, 38, 39]
    }


def test_deletions_are_keys_and_a_narrow_reading_shuffles_no_vectors(spark, tmp_path):
    source, index, checkpoint = (str(tmp_path / n) for n in ("in", "index", "cp"))
    schema = T.StructType.fromDDL("chunk_id string, content string, _change_type string")

    def step(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        embed = lambda df: df.withColumn("embedding", F.array(F.length("content").cast("float")))
        sync_index(spark, source, schema, index, checkpoint, embed=embed)

    step(("a", "one", "insert"), ("b", "two", "insert"), ("c", "three", "insert"))
    step(("a", "one", "delete"), ("b", "twice", "update_postimage"))
    assert [r.content for r in spark.read.parquet(index).where("deleted").collect()] == [None]
    narrow = read_index(spark, index, columns=[F.md5("content").alias("digest"), F.size("embedding").alias("dims")])
    assert narrow.columns == ["chunk_id", "digest", "dims"]
    assert {(r.chunk_id, r.dims) for r in narrow.collect()} == {("b", 1), ("c", 1)}
    wide = read_index(spark, index).select("chunk_id", F.md5("content").alias("digest"))
    assert sorted(wide.collect()) == sorted(narrow.select("chunk_id", "digest").collect())
