"""From a batch of questions to typed responses: one plan from the question's text to the response.

History is read from JSON, the route follows from the question or from the turn before, and each branch sees only its own
questions: the tables branch finds what is named and asked for and looks the answer up, the documents branch searches
the chunks with the question and the one before it. A question that a branch cannot serve says so in its own row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.functions.history import last_turn, parse_history, search_text
from ledgerlore.functions.routing import route, uses_documents, uses_tables
from ledgerlore.operators import entities
from ledgerlore.operators.answering import answer_batch, excerpt_context, structured_context
from ledgerlore.operators.joins import join_shared
from ledgerlore.operators.postings import TextIndex, search_text_index, terms_of
from ledgerlore.operators.similarity import hit_members, with_columns
from ledgerlore.session import materialise
from ledgerlore.sources.questions import question_batch

TOP_K = 5
ANSWER_COLUMNS = ["kind", "entity_id", "n", "amount"]


def understood(questions: DataFrame) -> DataFrame:
    """``(qid, question, history, source_used, search_text)`` of a question batch, as a written table."""
    parsed = question_batch(questions).withColumn("history", parse_history("history_json"))
    question = F.coalesce("question", F.lit(""))
    return materialise(
        parsed.select(
            "qid",
            "question",
            "history",
            route(question, last_turn(F.col("history"))["source_used"]).alias("source_used"),
            search_text(question, F.col("history")).alias("search_text"),
        ),
        "questions",
    )


def asked_of_tables(questions: DataFrame, names: DataFrame) -> DataFrame:
    """``(qid, kind, entity_id)`` of the questions whose words, or whose words and those of the turn before, say enough."""
    tables = questions.where(uses_tables(F.col("source_used"))).select("qid", "question", "search_text")
    alone = entities.mentions(tables, names).withColumnRenamed("mentions", "own")
    # Where the turn before adds no words, its mentions are the question's own and are not looked for again.
    differ = tables.where(~F.col("search_text").eqNullSafe(F.col("question"))).select("qid").distinct()
    differ = materialise(differ.withColumn("again", F.lit(True)), "followed-up")
    before = entities.mentions(tables.join(differ, "qid", "left_semi"), names, text="search_text").withColumnRenamed("mentions", "before")
    mentions = F.when(F.col("again"), F.col("before")).otherwise(F.col("own")).alias("mentions")
    joined = tables.join(differ, "qid", "left").join(alone, "qid", "left").join(before, "qid", "left")
    joined = joined.select(*tables.columns, "own", mentions).where(F.col("mentions").isNotNull())
    asked = F.coalesce(
        entities.asked_for(F.col("question"), F.col("own")),
        entities.asked_for(F.col("search_text"), F.col("own")),
        entities.asked_for(F.col("search_text"), F.col("mentions")),
    )
    found = joined.select("qid", asked.alias("a")).where(F.col("a").isNotNull())
    return materialise(found.select("qid", "a.kind", "a.entity_id"), "asked")


def predict(
    questions: DataFrame,
    index: TextIndex,
    chunks: DataFrame,
    customers: DataFrame,
    transactions: DataFrame,
    policies: DataFrame,
    *,
    premium: str,
    claim: str,
    k: int = TOP_K,
) -> DataFrame:
    """Typed responses with ``qid``; an empty batch gives an empty table.

    ``questions`` is what ``question_batch`` takes. ``index`` holds the texts of ``chunks``.
    """
    batch = understood(questions)
    asked = asked_of_tables(batch, entities.name_table(customers, policies))
    answers = entities.table_answers(asked.select("kind", "entity_id"), customers, transactions, policies, premium=premium, claim=claim)
    of_one = F.concat_ws("\n", "kind", "entity_id")
    counted = asked.groupBy(of_one.alias("about")).agg(F.count(F.lit(1)).alias("askers"))
    keyed = materialise(answers.withColumn("about", of_one).join(counted, "about").select("about", "n", "amount", "askers"), "answers")
    rows = join_shared(asked.withColumn("about", of_one), keyed, "about", "askers")
    structured = structured_context(rows.select("qid", *ANSWER_COLUMNS), ["kind"], ANSWER_COLUMNS)

    documents = batch.where(uses_documents(F.col("source_used")))
    hits = materialise(search_text_index(index, documents.select("qid", "search_text"), k, text="search_text"), "hits")
    shown = with_columns(hits, hit_members(hits, chunks), ["policy_name", "page_number", "content"])
    excerpts = excerpt_context(shown)

    statement = F.format_string("SELECT n, amount FROM answers WHERE kind = '%s' AND entity_id = '%s'", "kind", "entity_id")
    routed = batch.join(asked, "qid", "left").select(
        "qid",
        "question",
        "source_used",
        F.when(F.col("kind").isNotNull(), statement).alias("sql_query"),
        (F.size(terms_of(F.col("search_text"))) > 0).alias("has_vector"),
    )
    return answer_batch(routed, structured, excerpts)
