"""A batch of questions to typed responses: both retrievals merged per question, in one plan.

Nothing here loops over questions. Routing, guarding, context and response are columns; the retrieved rows
come in as tables keyed by ``qid`` and are reduced to one row per question before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.functions.routing import uses_documents, uses_tables
from ledgerlore.functions.text import EXCERPT_CHARS, ROWS_JSON_CHARS, guard_message, strip_fence
from ledgerlore.schemas import RESPONSE, require_columns

# Fixed values that decide results.
ROWS_TITLE = "STRUCTURED DATA (from SQL query):"
EXCERPTS_TITLE = "POLICY DOCUMENT EXCERPTS:"
NO_ANSWER = "(no answer returned)"
NO_VECTOR = "no vector for the search text"


def row_json(columns: list[str]) -> Column:
    """One result row as a JSON object of texts, nulls kept."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})


def rows_needed(columns: list[str], chars: int = ROWS_JSON_CHARS) -> int:
    """No more than this many rows can show in the first ``chars`` characters of the JSON array.

    A row takes at least its column names, their quotes and colons, an empty text per column, the braces and
    one separator, so the rows behind are cut off by the character limit in any case.
    """
    shortest = sum(len(c) + 3 + 2 for c in columns) + (len(columns) - 1) + 2 + 1
    return -(-chars // shortest) + 1


def structured_context(rows: DataFrame, order: list[str], columns: list[str], *, key: str = "qid") -> DataFrame:
    """``(key, sql_rows_returned, rows_json)`` from result rows.

    ``key`` is the question or what several questions ask about, such as a customer: then the rows are put into
    text once and not per question. Counting combines on the map side. Only the rows that can appear in the text
    are gathered, so a key with a huge result stays a small group.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("sql_rows_returned"))
    first = Window.partitionBy(key).orderBy(*order)
    shown = (
        rows.select(*dict.fromkeys([key, *order, *columns]))
        .withColumn("__rn", F.row_number().over(first))
        .where(F.col("__rn") <= rows_needed(columns))
        .select(key, "__rn", row_json(columns).alias("__json"))
    )
    texts = shown.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__rn", "__json"))).alias("__rows"))
    joined = F.concat(F.lit("["), F.array_join(F.col("__rows.__json"), ","), F.lit("]"))
    return counts.join(texts, key).select(
        key, "sql_rows_returned", F.substring(joined, 1, ROWS_JSON_CHARS).alias("rows_json")
    )


def excerpt_context(hits: DataFrame, *, key: str = "qid") -> DataFrame:
    """``(key, vector_chunks_used, excerpts)`` from top-k hits, in rank order; at most k rows per key."""
    line = F.concat(
        F.lit("["), F.coalesce("policy_name", F.lit("None")), F.lit(", page "), F.col("page_number").cast("string"),
        F.lit("]: "), F.substring("content", 1, EXCERPT_CHARS),
    )
    lines = hits.select(key, F.struct(F.col("rank"), line.alias("line")).alias("hit"))
    return lines.groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias("vector_chunks_used"),
        F.array_join(F.array_sort(F.collect_list("hit")).getField("line"), "\n\n").alias("excerpts"),
    )


def context_text(question: Column, label: Column, rows_json: Column, excerpts: Column) -> Column:
    """Question, then the rows whenever the tables were asked (even in vain), then the excerpts if any."""
    rows = F.when(uses_tables(label), F.concat(F.lit(ROWS_TITLE + "\n"), F.coalesce(rows_json, F.lit("[]"))))
    found = F.when(uses_documents(label), F.concat(F.lit(EXCERPTS_TITLE + "\n"), excerpts))
    return F.concat(F.lit("QUESTION: "), question, F.lit("\n\n"), F.concat_ws("\n\n", rows, found))


def route_branches(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The questions for the tables and the questions for the documents; a hybrid one is in both."""
    label = F.col("source_used")
    return routed.where(uses_tables(label)), routed.where(uses_documents(label))


def merge_retrievals(
    routed: DataFrame, structured: DataFrame, excerpts: DataFrame, *, rows_key: str = "qid", hits_key: str = "qid"
) -> DataFrame:
    """One row per question with the results of the paths it takes; each side has one row per key."""
    label = F.col("source_used")
    merged = routed.join(structured, rows_key, "left").join(excerpts, hits_key, "left")
    return merged.select(
        *routed.columns,
        *[F.when(uses_tables(label), F.col(c)).alias(c) for c in ("sql_rows_returned", "rows_json")],
        *[F.when(uses_documents(label), F.col(c)).alias(c) for c in ("vector_chunks_used", "excerpts")],
    )


def answer_batch(
    routed: DataFrame,
    structured: DataFrame,
    excerpts: DataFrame,
    *,
    rows_key: str = "qid",
    hits_key: str = "qid",
    with_context: bool = False,
) -> DataFrame:
    """Typed responses of a batch; an empty batch gives an empty table.

    ``routed`` is ``(qid, question, source_used, sql_query, has_vector)`` and the keys; ``structured`` and
    ``excerpts`` come from the functions above. A statement that fails the guard returns no rows and its message;
    a question without a vector returns no chunks and says so; neither stops the other questions. No prose is
    generated: ``answer`` is the retrieved context itself.
    """
    require_columns(
        routed, {"question": T.StringType, "source_used": T.StringType, "sql_query": T.StringType, "has_vector": T.BooleanType}
    )
    label = F.col("source_used")
    tables, documents = uses_tables(label), uses_documents(label)
    statement = strip_fence("sql_query")
    checked = routed.withColumn("sql_query", F.when(tables, statement)).withColumn(
        "sql_error", F.when(tables, guard_message("sql_query"))
    )
    merged = merge_retrievals(checked, structured, excerpts, rows_key=rows_key, hits_key=hits_key)
    ran = tables & F.col("sql_error").isNull()
    seen = documents & F.col("has_vector")
    rows_json = F.when(ran, F.col("rows_json"))
    excerpts = F.when(seen, F.col("excerpts"))
    context = context_text(F.col("question"), label, rows_json, excerpts)
    answer = F.concat_ws("\n\n", rows_json, excerpts)
    responses = merged.select(
        "qid",
        "question",
        "source_used",
        F.when(answer == "", NO_ANSWER).otherwise(answer).alias("answer"),
        "sql_query",
        F.when(tables, F.when(ran, F.coalesce("sql_rows_returned", F.lit(0))).otherwise(0)).alias("sql_rows_returned"),
        "sql_error",
        F.when(documents, F.when(seen, F.coalesce("vector_chunks_used", F.lit(0))).otherwise(0)).alias(
            "vector_chunks_used"
        ),
        F.when(documents & ~F.col("has_vector"), NO_VECTOR).alias("vector_search_error"),
        context.alias("retrieved_context"),
    )
    contract = [F.col(f.name).cast(f.dataType) for f in RESPONSE.fields]
    return responses.select("qid", *contract, *(["retrieved_context"] if with_context else []))
