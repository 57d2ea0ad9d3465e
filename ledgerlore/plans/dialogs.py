"""Queries over conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.functions.history import HISTORY_HEADER, history_text, parse_history, recent
from ledgerlore.operators import dialog
from ledgerlore.plans import inputs as I
from ledgerlore.plans.registry import query
from ledgerlore.session import scratch_path
from ledgerlore.streaming.sessions import read_histories, stream_histories

_SPOKEN = "(SELECT * FROM conversations WHERE role IN ('user', 'assistant'))"
_PAIRED = f"""
    SELECT *, coalesce(role = 'assistant' AND lag(role) OVER w = 'user', false) AS closes, lag(text) OVER w AS asked
    FROM {_SPOKEN} WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
"""
# A turn counts when its answer is among the five messages before: the sixth cannot bring its question along.
HISTORY_SQL = f"""
    SELECT conv_id, turn, text AS question, coalesce(h, []) AS history FROM (
        SELECT *, list({{'q': asked, 'a': text}} ORDER BY turn) FILTER (closes) OVER (
                   PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS h
        FROM ({_PAIRED})) WHERE role = 'user'
"""
_DIGEST_SQL = """md5(array_to_string(list_transform(history, lambda t: t.q || '|UNKNOWN|' || t.a), chr(10)))"""


def _digest(history: Column) -> Column:
    lines = F.transform(history, lambda t: F.concat_ws("|", t["question"], t["source_used"], t["answer"]))
    return F.md5(F.array_join(lines, "\n"))


@query(
    "turn_pairs",
    f"""
    SELECT conv_id, turn, asked AS question, 'UNKNOWN' AS source_used, text AS answer FROM ({_PAIRED}) WHERE closes
    """,
)
def turn_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return dialog.turn_pairs(I.messages(spark, folder))


@query(
    "history_before_question",
    f"SELECT conv_id, turn, question, len(history) AS turns, {_DIGEST_SQL} AS digest FROM ({HISTORY_SQL})",
)
def history_before_question(spark: SparkSession, folder: str) -> DataFrame:
    rows = dialog.history_before(I.messages(spark, folder))
    return rows.select("conv_id", "turn", "question", F.size("history").alias("turns"), _digest(F.col("history")).alias("digest"))


@query(
    "contextual_questions",
    f"""
    SELECT conv_id, turn, history[-1].q AS previous_question,
           CASE WHEN len(history) > 0 THEN 'UNKNOWN' END AS previous_source,
           CASE WHEN len(history) = 0 THEN question
                ELSE regexp_replace(history[-1].q || ' ' || question, '^\\s+|\\s+$', '', 'g') END AS search_text
    FROM ({HISTORY_SQL})
    """,
)
def contextual_questions(spark: SparkSession, folder: str) -> DataFrame:
    rows = dialog.contextual_questions(dialog.history_before(I.messages(spark, folder)))
    return rows.select("conv_id", "turn", "previous_question", "previous_source", "search_text")


@query(
    "history_text",
    f"""
    SELECT conv_id, turn, md5(CASE WHEN len(history) = 0 THEN '' ELSE
        chr(10) || chr(10) || '{HISTORY_HEADER.replace("'", "''")}' || chr(10) ||
        array_to_string(list_transform(history, lambda t: 'User: ' || t.q || chr(10) || 'Assistant: ' || t.a), chr(10))
        END) AS digest
    FROM ({HISTORY_SQL})
    """,
)
def history_as_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = dialog.history_before(I.messages(spark, folder))
    return rows.select("conv_id", "turn", F.md5(history_text(F.col("history"))).alias("digest"))


@query(
    "history_json",
    f"""
    SELECT conv_id, turn, len(history) AS turns, history[-1].a AS last_answer FROM ({HISTORY_SQL})
    UNION ALL SELECT conv_id, turn, 0, NULL FROM conversations WHERE role <> 'user'
    """,
)
def history_json(spark: SparkSession, folder: str) -> DataFrame:
    """Histories written as JSON and read back; the text of the other messages is no JSON and means no history."""
    messages = I.messages(spark, folder)
    asked = dialog.history_before(messages).select(
        "conv_id", "turn", F.to_json("history", {"ignoreNullFields": "false"}).alias("history_json")
    )
    others = messages.where(F.col("role") != "user").select("conv_id", "turn", F.col("content").alias("history_json"))
    parsed = asked.unionByName(others).withColumn("history", parse_history("history_json"))
    return parsed.select(
        "conv_id", "turn", F.size("history").alias("turns"),
        F.try_element_at(recent(F.col("history")), F.lit(-1))["answer"].alias("last_answer"),
    )


MESSAGE_STREAM = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)


@query(
    "session_history_stream",
    f"SELECT conv_id, turn, question, len(history) AS turns, {_DIGEST_SQL} AS digest FROM ({HISTORY_SQL})",
)
def session_history_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All messages arrive in two deliveries, by turn; the stream stops in between and goes on."""
    base = scratch_path(spark, "sessions")
    messages = I.messages(spark, folder).select(*[F.col(f.name).cast(f.dataType) for f in MESSAGE_STREAM.fields])
    middle = messages.agg(F.floor(F.avg("turn")).alias("t")).scalar()
    for early in (True, False):
        part = messages.where(F.col("turn") <= middle) if early else messages.where(F.col("turn") > middle)
        part.write.mode("append").parquet(f"{base}/in")
        stream_histories(spark, f"{base}/in", MESSAGE_STREAM, f"{base}/out", f"{base}/state", f"{base}/checkpoint")
    rows = read_histories(spark, f"{base}/out")
    return rows.select("conv_id", "turn", "question", F.size("history").alias("turns"), _digest(F.col("history")).alias("digest"))
