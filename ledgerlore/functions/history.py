"""Conversation history as an array of ``{question, source_used, answer}`` structs, oldest first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlore.functions.text import strip
from ledgerlore.schemas import TURN

# Fixed values that decide results.
HISTORY_TURNS = 3
UNKNOWN_SOURCE = "UNKNOWN"
HISTORY_HEADER = (
    "RECENT CONVERSATION (use only to resolve references like 'those', 'the details', 'that policy' "
    "— do not repeat it verbatim):"
)
TURNS_TYPE = f"array<{TURN.simpleString()}>"


def parse_history(c: Column | str) -> Column:
    """History from JSON. Null, empty and invalid text all mean: no history."""
    return F.coalesce(F.from_json(F.col(c) if isinstance(c, str) else c, TURNS_TYPE), F.array().cast(TURNS_TYPE))


def recent(history: Column, turns: int = HISTORY_TURNS) -> Column:
    """The last turns; ``slice`` with a negative start returns nothing on a shorter array."""
    return F.slice(history, F.greatest(F.size(history) - (turns - 1), F.lit(1)), F.lit(turns))


def last_turn(history: Column) -> Column:
    return F.try_element_at(history, F.lit(-1))


def search_text(question: Column, history: Column) -> Column:
    """The question with the previous question in front, so that a follow-up carries its topic."""
    previous = F.coalesce(last_turn(history).getField("question"), F.lit(""))
    return F.when(F.size(history) == 0, question).otherwise(strip(F.concat_ws(" ", previous, question)))


def history_text(history: Column) -> Column:
    """History as text for a reader; empty without history."""
    lines = F.flatten(
        F.transform(
            recent(history),
            lambda t: F.array(
                F.concat(F.lit("User: "), F.coalesce(t["question"], F.lit(""))),
                F.concat(F.lit("Assistant: "), F.coalesce(t["answer"], F.lit(""))),
            ),
        )
    )
    text = F.array_join(F.concat(F.array(F.lit("\n\n" + HISTORY_HEADER)), lines), "\n")
    return F.when(F.size(history) == 0, F.lit("")).otherwise(text)
