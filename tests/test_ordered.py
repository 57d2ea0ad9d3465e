import random

import pytest
from pyspark.sql import functions as F

from ledgerlore.functions.ordered import previous_rows, totals_before


def sample(seed, bits):
    """Groups of very different size, keys with gaps and below zero, one group missing a name."""
    rng = random.Random(seed)
    rows = []
    far = 1 << (40 if bits == 16 else 3 * bits)
    for group, n, spread in (("hot", 120, 900), ("far", 15, far), (None, 20, 60), ("one", 1, 5)):
        for key in rng.sample(range(-spread // 2, spread), n):
            rows.append((group, key, rng.randint(0, 9)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [4, 7, 16])
def test_totals_before(spark, bits):
    rows = sample(1, bits)
    df = spark.createDataFrame(rows, "g string, k long, v int")
    out = totals_before(
        df, ["g"], "k",
        {"s": ("sum", F.col("v")), "n": ("sum", F.lit(1)), "first": ("min", F.struct("k", "v")), "top": ("max", F.col("v"))},
        bits=bits,
    )
    assert set(out.columns) == {"g", "k", "v", "s", "n", "first", "top"}
    got = {(r["g"], r["k"]): (r["s"], r["n"], r["first"] and tuple(r["first"]), r["top"]) for r in out.collect()}
    assert len(got) == len(rows)
    for g, k, _ in rows:
        before = sorted((k2, v2) for g2, k2, v2 in rows if g2 == g and k2 < k)
        values = [v for _, v in before]
        expected = (sum(values), len(values), before[0], max(values)) if before else (None, None, None, None)
        assert got[(g, k)] == expected


@pytest.mark.parametrize("bits", [4, 16])
@pytest.mark.parametrize("n", [1, 6])
def test_previous_rows(spark, bits, n):
    rows = sample(2, bits)
    df = spark.createDataFrame(rows, "g string, k long, v int")
    out = previous_rows(df, ["g"], "k", n, F.struct("k", "v"), "before", bits=bits).collect()
    assert len(out) == len(rows)
    for r in out:
        before = sorted((k2, v2) for g2, k2, v2 in rows if g2 == r["g"] and k2 < r["k"])
        assert [tuple(x) for x in r["before"]] == before[-n:]


def test_whole_table_is_one_group(spark):
    df = spark.range(0, 500, 3).select(F.col("id").alias("k"))
    out = totals_before(df, [], "k", {"n": ("sum", F.lit(1))}, bits=5)
    assert all((r["n"] or 0) == r["k"] // 3 for r in out.collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, k long, v int")
    assert totals_before(df, ["g"], "k", {"n": ("sum", F.lit(1))}).count() == 0
    assert previous_rows(df, ["g"], "k", 2, F.struct("v"), "before").count() == 0


def test_no_window_covers_a_whole_hot_group(spark):
    """With more keys than a block holds, windows are partitioned by block as well."""
    df = spark.range(1 << 17).select(F.lit("hot").alias("g"), F.col("id").alias("k"))
    plan = totals_before(df, ["g"], "k", {"n": ("sum", F.lit(1))})._jdf.queryExecution().analyzed().toString()
    assert "__block" in plan
