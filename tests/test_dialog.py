import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerlore.functions.history import history_text, parse_history, recent, search_text
from ledgerlore.operators.dialog import contextual_questions, history_before, route_log, turn_pairs
from ledgerlore.streaming.sessions import read_histories, stream_histories


def model_pairs(messages):
    """Pair each answer with the open question; a later question replaces an open one."""
    pairs, asked = [], None
    for role, content, source in messages:
        if role == "user":
            asked = content
        elif role == "assistant" and asked is not None:
            pairs.append((asked, source or "UNKNOWN", content))
            asked = None
    return pairs


def conversations(seed, count=12):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        turn = 0
        for _ in range(rng.choice([0, 1, 2, 7, 25])):
            turn += rng.choice([1, 1, 2, 40])
            role = rng.choice(["user", "assistant", "assistant", "user", "system"])
            rows.append((conv, turn, role, f"m{conv}.{turn}", rng.choice(["SQL", "VECTOR", "ERROR"])))
    return rows


SCHEMA = "conv_id long, turn long, role string, content string, source_used string"


def spoken_before(rows, conv, turn):
    return [(r[2], r[3], r[4]) for r in sorted(rows) if r[0] == conv and r[1] < turn and r[2] != "system"]


@pytest.mark.parametrize("bits", [5, 16])
@pytest.mark.parametrize("seed", [3])
def test_pairs_and_history(spark, seed, bits):
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r["conv_id"], r["turn"]): (r["question"], r["source_used"], r["answer"]) for r in turn_pairs(df, bits=bits).collect()}
    expected = {}
    for conv in {r[0] for r in rows}:
        for r in sorted(x for x in rows if x[0] == conv and x[2] == "assistant"):
            pairs = model_pairs(spoken_before(rows, conv, r[1] + 1))
            before = model_pairs(spoken_before(rows, conv, r[1]))
            if len(pairs) > len(before):
                expected[(conv, r[1])] = pairs[-1]
    assert got == expected

    history = {(r["conv_id"], r["turn"]): [tuple(t) for t in r["history"]] for r in history_before(df, bits=bits).collect()}
    assert history == {
        (c, t): model_pairs(spoken_before(rows, c, t)[-6:]) for c, t, role, _, _ in rows if role == "user"
    }


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_stream_equals_batch(spark, tmp_path, files_per_batch):
    rows = conversations(9, 20)
    df = spark.createDataFrame(rows, SCHEMA)
    source = str(tmp_path / "in")
    turns = sorted({r[1] for r in rows})
    cuts = [turns[len(turns) // 3], turns[2 * len(turns) // 3]]
    parts = [df.where(F.col("turn") < cuts[0]), df.where((F.col("turn") >= cuts[0]) & (F.col("turn") < cuts[1])),
             df.where(F.col("turn") >= cuts[1])]
    args = [source, df.schema, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp")]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        stream_histories(spark, *args, files_per_batch=files_per_batch)
    stream_histories(spark, *args)
    streamed = sorted(map(repr, read_histories(spark, args[2]).collect()))
    assert streamed == sorted(map(repr, history_before(df).select("conv_id", "turn", "question", "history").collect()))


@pytest.mark.parametrize(
    "raw,turns",
    [(None, 0), ("", 0), ("null", 0), ("[]", 0), ("no json", 0), ("[{", 0),
     (json.dumps([{"question": "q", "source_used": "SQL", "answer": "é"}]), 1),
     (json.dumps([{"question": f"q{i}"} for i in range(4)]), 4)],
)
def test_history_json(spark, raw, turns):
    df = spark.createDataFrame([(raw,)], "h string").select(parse_history("h").alias("h"))
    row = df.select(F.size("h").alias("n"), F.size(recent(F.col("h"))).alias("r")).first()
    assert (row["n"], row["r"]) == (turns, min(turns, 3))


def test_search_text_and_history_text(spark):
    turn = "struct<question:string,source_used:string,answer:string>"
    df = spark.createDataFrame(
        [("now", []), ("now ", [("first", "SQL", "a1")]), ("now", [("q1", "SQL", "a1"), ("", "SQL", None)]),
         ("x", [(f"q{i}", "SQL", f"a{i}") for i in range(5)])],
        f"question string, history array<{turn}>",
    )
    rows = df.select(
        search_text(F.col("question"), F.col("history")).alias("s"), history_text(F.col("history")).alias("t")
    ).collect()
    assert [r["s"] for r in rows] == ["now", "first now", "now", "q4 x"]
    assert rows[0]["t"] == ""
    assert rows[1]["t"].startswith("\n\nRECENT CONVERSATION") and rows[1]["t"].endswith("\nUser: first\nAssistant: a1")
    assert rows[2]["t"].endswith("User: q1\nAssistant: a1\nUser: \nAssistant: ")
    assert rows[3]["t"].count("User: ") == 3 and "q1" not in rows[3]["t"]
    context = contextual_questions(df).collect()
    assert [r["previous_source"] for r in context] == [None, "SQL", "SQL", "SQL"]


@pytest.mark.parametrize("bits", [2, 16])
def test_follow_up_takes_the_last_known_route(spark, bits):
    asked = ["give me the details", "How many customers are there?", "give me the details", "what about that",
             "What is covered?", "show me more"]
    df = spark.createDataFrame([(1, i * 3, q) for i, q in enumerate(asked)], "user_id long, qid long, question string")
    out = route_log(df, group="user_id", order="qid", bits=bits).orderBy("qid").collect()
    assert [r["source_used"] for r in out] == ["VECTOR", "SQL", "SQL", "SQL", "VECTOR", "VECTOR"]
