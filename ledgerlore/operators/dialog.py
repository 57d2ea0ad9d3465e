"""Conversations: paired turns, the bounded history before a message, the previous turn.

Messages are ``(conv_id, turn, role, content[, source_used])`` with ``turn`` unique in its conversation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlore.functions.history import HISTORY_TURNS, UNKNOWN_SOURCE, last_turn, search_text
from ledgerlore.functions.ordered import BLOCK_BITS, key_range, previous_rows, totals_before
from ledgerlore.functions.routing import asks_for_more, is_vague, needs_documents, needs_tables, own_route

HISTORY_MESSAGES = 2 * HISTORY_TURNS


def spoken(messages: DataFrame) -> DataFrame:
    """Messages of the two speakers; anything else (such as a system text) is no part of a turn."""
    rows = messages.where(F.col("role").isin("user", "assistant"))
    source = F.col("source_used") if "source_used" in messages.columns else F.lit(UNKNOWN_SOURCE)
    return rows.withColumn("source_used", source.cast("string"))


def _message() -> Column:
    return F.struct("role", "content", "source_used")


def turn_pairs(messages: DataFrame, *, bits: int = BLOCK_BITS) -> DataFrame:
    """``(conv_id, turn, question, source_used, answer)``: each answer with the user message right before it."""
    rows = previous_rows(spoken(messages), ["conv_id"], "turn", 1, F.struct("role", "content"), "before", bits=bits)
    asked = F.get("before", F.lit(0))
    return rows.where((F.col("role") == "assistant") & (asked["role"] == "user")).select(
        "conv_id", "turn", asked["content"].alias("question"), "source_used", F.col("content").alias("answer")
    )


def pairs_of(messages: Column) -> Column:
    """Turns inside an array of messages, oldest first: a user message and the answer right after it."""
    at = F.sequence(F.lit(0), F.size(messages) - 2)
    answered = F.filter(
        at,
        lambda i: (F.get(messages, i)["role"] == "user") & (F.get(messages, i + 1)["role"] == "assistant"),
    )
    turns = F.transform(
        answered,
        lambda i: F.struct(
            F.get(messages, i)["content"].alias("question"),
            F.get(messages, i + 1)["source_used"].alias("source_used"),
            F.get(messages, i + 1)["content"].alias("answer"),
        ),
    )
    nothing = F.array().cast("array<struct<question:string,source_used:string,answer:string>>")
    return F.when(F.size(messages) >= 2, turns).otherwise(nothing)


def history_before(messages: DataFrame, *, keep: Sequence[str] = (), bits: int = BLOCK_BITS) -> DataFrame:
    """Every user message with ``history``: the turns among the six messages before it, at most three."""
    rows = previous_rows(spoken(messages), ["conv_id"], "turn", HISTORY_MESSAGES, _message(), "before", bits=bits)
    return rows.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("content").alias("question"), pairs_of(F.col("before")).alias("history"), *keep
    )


def contextual_questions(questions: DataFrame) -> DataFrame:
    """Add the previous turn and the search text to questions that carry a ``history``."""
    last = last_turn(F.col("history"))
    return questions.select(
        "*",
        last["question"].alias("previous_question"),
        last["source_used"].alias("previous_source"),
        search_text(F.col("question"), F.col("history")).alias("search_text"),
    )


def route_log(questions: DataFrame, *, group: str, order: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Route every question of a log; a vague follow-up takes the route of the last question that was not.

    ``questions`` is ``(group, order, question)``. Carrying the route forward is a running maximum of
    (order, route) over the questions that have one of their own.
    """
    question = F.col("question")
    cues = questions.select(
        "*", needs_tables(question).alias("__t"), needs_documents(question).alias("__d"),
        asks_for_more(question).alias("__m"),
    )
    judged = cues.select(
        *questions.columns,
        own_route(F.col("__t"), F.col("__d")).alias("__own"),
        is_vague(F.col("__t"), F.col("__d"), F.col("__m")).alias("__vague"),
    )
    known = F.when(~F.col("__vague"), F.struct(F.col(order).alias("at"), F.col("__own").alias("route")))
    rows = totals_before(judged, [group], order, {"__last": ("max", known)}, bits=bits, bounds=key_range(questions, order))
    inherited = F.when(F.col("__vague"), F.col("__last.route"))
    return rows.withColumn("source_used", F.coalesce(inherited, F.col("__own"))).drop("__last", "__own", "__vague")
