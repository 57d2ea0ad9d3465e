import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlore.operators.similarity import build_index, nearest, search_index, top_k
from ledgerlore.streaming.cell_index import _batches, read_cells, search_cells, sync_cells

SCHEMA = "vec_id long, embedding array<float>, _change_type string"


def brute(stored, queries, k):
    ids = sorted(stored)
    unit = np.array([stored[i] for i in ids], float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    out = {}
    for qid, v in queries.items():
        score = np.round(unit @ (np.array(v, float) / np.linalg.norm(v)), 6)
        order = np.lexsort((ids, -score))[:k]
        out[qid] = [ids[i] for i in order]
    return out


def test_index_through_many_syncs(spark, tmp_path):
    rng = np.random.default_rng(2)
    schema = spark.createDataFrame([], SCHEMA).schema
    source, folder, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "index", "checkpoint"))
    hub = rng.normal(size=8)
    stored: dict[int, list[float]] = {}
    for step in range(5):
        rows = []
        for i in range(step * 40, step * 40 + 40):
            v = np.float32(hub + rng.normal(size=8) * (0.3 if i % 3 else 2.0))
            stored[i] = v.tolist()
            rows.append((i, stored[i], "insert"))
        if step:
            for i in rng.choice(step * 40, 6, replace=False).tolist():
                if i in stored and i % 2:
                    stored[i] = np.float32(rng.normal(size=8)).tolist()
                    rows.append((i, stored[i], "update_postimage"))
                elif i in stored:
                    rows.append((i, stored.pop(i), "delete"))
        rows += [(1000 + step, [0.0] * 8, "insert"), (2000 + step, [float("inf")] * 8, "insert"), (3000 + step, [1.0, 2.0], "insert"), (4000 + step, None, "insert")]
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(source)
        assert sync_cells(spark, source, schema, folder, checkpoint, cell_rows=25, most_batches=4) == 1
        assert sync_cells(spark, source, schema, folder, checkpoint, cell_rows=25, most_batches=4) == 0
    assert {r.vec_id for r in read_cells(spark, folder).collect()} == set(stored)
    assert search_cells(spark, f"{tmp_path}/none", spark.createDataFrame([(1, [1.0])], "qid long, embedding array<double>"), 3).count() == 0
    assert _batches(spark, folder, "bases") and len(_batches(spark, folder, "centres")) > 1
    wanted = {i: rng.normal(size=8).tolist() for i in range(30)}
    queries = spark.createDataFrame(list(wanted.items()), "qid long, embedding array<double>")
    got = {}
    for r in search_cells(spark, folder, queries, 4).sort("qid", "rank").collect():
        got.setdefault(r.qid, []).append(r.id)
    assert got == brute(stored, wanted, 4)
    some = search_cells(spark, folder, queries, 4, exact=False, probes=3)
    found = sum(r.id in got[r.qid] for r in some.collect())
    assert found / 120 >= 0.5


def test_only_probed_cells_are_opened(spark, tmp_path):
    rows = [(i, np.random.default_rng(i).normal(size=4).astype(np.float32).tolist(), "insert") for i in range(200)]
    schema = spark.createDataFrame([], SCHEMA).schema
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/in")
    sync_cells(spark, f"{tmp_path}/in", schema, f"{tmp_path}/index", f"{tmp_path}/checkpoint")
    query = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0])], "qid long, embedding array<double>")
    hits = search_cells(spark, f"{tmp_path}/index", query, 3, exact=False, probes=1)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan.replace("isnotnull(cell#", "").replace("[isnotnull", "[") or "cell#" in plan.split("PartitionFilters:")[1].split("]")[0]


@pytest.mark.parametrize("k", [1, 2])
def test_infinite_and_ragged_vectors(spark, k):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [float("inf"), 1.0]), (4, [float("nan"), 1.0]), (5, [1.0]), (6, [1.0, 0.0, 0.0]), (7, [0.0, 0.0]), (8, None)]
    members = spark.createDataFrame(rows, "chunk_id long, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [float("inf"), 0.0]), (3, [2.0]), (4, [0.0, 0.0])], "qid long, embedding array<double>")
    want = [(1, i) for i in (1, 2)][:k]
    plain = [r.id for r in nearest(members, [1.0, 0.0], k).collect()]
    few = [(r.qid, r.id) for r in top_k(members, queries, k).sort("qid", "rank").collect()]
    many = [(r.qid, r.id) for r in top_k(members, queries, k, batch_rows=1).sort("qid", "rank").collect()]
    cells = [(r.qid, r.id) for r in search_index(build_index(members, n_cells=1), queries, k).sort("qid", "rank").collect()]
    assert plain == [i for _, i in want] and few == many == [*want, (3, 5)] and cells == want
    assert top_k(members, queries.where(F.col("qid") == 4), k).count() == 0
