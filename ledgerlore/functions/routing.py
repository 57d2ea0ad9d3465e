"""Deterministic routing of a question to the tables, the documents, or both."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SQL, VECTOR, HYBRID = "SQL", "VECTOR", "HYBRID"
ROUTES = (SQL, VECTOR, HYBRID)

# Fixed values that decide results: the cues of each source, and of a follow-up that names no topic.
STRUCTURED_CUES = (
    r"how much", r"how many", r"list of", r"total", r"paid", r"payments?", r"payouts?", r"customers?", r"c\d{3,}",
)
DOCUMENT_CUES = (
    r"cover(ed|age|s)?", r"exclu(ded|sions?|des?)", r"waiting periods?", r"claim process", r"how do i",
    r"cashless", r"defin(ed?|itions?)", r"premium for",
)
FOLLOW_UP_CUES = (r"give me the details", r"what about that", r"show me more", r"and the amount")


def _mentions(question: Column, cues: tuple[str, ...]) -> Column:
    return question.rlike(r"(?i)\b(" + "|".join(cues) + r")\b")


def needs_tables(question: Column) -> Column:
    return _mentions(question, STRUCTURED_CUES)


def needs_documents(question: Column) -> Column:
    return _mentions(question, DOCUMENT_CUES)


def asks_for_more(question: Column) -> Column:
    return _mentions(question, FOLLOW_UP_CUES)


def own_route(tables: Column, documents: Column) -> Column:
    """Route of a question taken alone, from the sources it needs."""
    return F.when(tables & documents, HYBRID).when(tables, SQL).otherwise(VECTOR)


def is_vague(tables: Column, documents: Column, more: Column) -> Column:
    """A reference to the turn before: a follow-up phrase and no cue of either source."""
    return more & ~tables & ~documents


def route(question: Column, previous_route: Column) -> Column:
    """Route of a question; a vague follow-up goes where the turn before went, if that is known."""
    tables, documents = needs_tables(question), needs_documents(question)
    inherits = is_vague(tables, documents, asks_for_more(question)) & previous_route.isin(*ROUTES)
    return F.when(inherits, previous_route).otherwise(own_route(tables, documents))


def normalise_label(raw: Column) -> Column:
    """First route named in a free-text label, tried in a fixed order; the document route otherwise."""
    upper = F.upper(raw)
    named = [(upper.contains(label), label) for label in (HYBRID, SQL, VECTOR)]
    chain = reduce(lambda acc, pair: acc.when(*pair), named[1:], F.when(*named[0]))
    return chain.otherwise(VECTOR)


def uses_tables(label: Column) -> Column:
    return label.isin(SQL, HYBRID)


def uses_documents(label: Column) -> Column:
    return label.isin(VECTOR, HYBRID)
