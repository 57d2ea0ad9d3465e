"""Queries that route questions, retrieve for them and form the responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.functions.routing import normalise_label
from ledgerlore.functions.text import REFUSED, guard_message, strip_fence
from ledgerlore.operators import analytics as A
from ledgerlore.operators import answering, dialog, evaluation, ingest
from ledgerlore.operators.similarity import top_k, with_columns
from ledgerlore.plans import inputs as I
from ledgerlore.plans.registry import query
from ledgerlore.plans.search import DEFAULT_K, EMBEDDED_DOCUMENTS_SQL, TOPIC_HITS_SQL, topics, vectors
from ledgerlore.sources.questions import question_batch
from ledgerlore.sources.tables import scan

# The route each kind of event's question must take; a click asks for "the details" of what went before.
_ROUTED_SQL = """
    SELECT event_id AS qid, user_id, event_type, CASE
        WHEN event_type <> 'click' THEN own
        ELSE coalesce(last_value(CASE WHEN event_type <> 'click' THEN own END IGNORE NULLS) OVER (
            PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'VECTOR')
        END AS source_used,
        CASE event_type
            WHEN 'purchase' THEN 'How many premium payments has customer C' || user_id || ' made?'
            WHEN 'view' THEN 'What is excluded under the Critical Illness policy?'
            WHEN 'error' THEN 'Is the last claim covered, and how much was paid to customer ' || user_id || '?'
            WHEN 'click' THEN 'give me the details' ELSE 'Good morning' END AS question
    FROM (SELECT *, CASE event_type WHEN 'purchase' THEN 'SQL' WHEN 'error' THEN 'HYBRID' ELSE 'VECTOR' END AS own
          FROM events)
"""


def routed_questions(spark: SparkSession, folder: str) -> DataFrame:
    return dialog.route_log(I.question_log(spark, folder), group="user_id", order="qid")


@query(
    "question_batch",
    """
    SELECT conv_id * 1000 + turn AS qid, text AS question, CAST(NULL AS VARCHAR) AS history_json
    FROM conversations WHERE role = 'user'
    """,
)
def questions_without_history(spark: SparkSession, folder: str) -> DataFrame:
    """The first column is the question where no column is called so; no history column means none."""
    asked = I.messages(spark, folder).where(F.col("role") == "user")
    return question_batch(asked.select("content", (F.col("conv_id") * 1000 + F.col("turn")).alias("qid")))


@query("route_labels", f"SELECT qid, question, source_used FROM ({_ROUTED_SQL})")
def route_labels(spark: SparkSession, folder: str) -> DataFrame:
    return routed_questions(spark, folder).select("qid", "question", "source_used")


@query(
    "route_branches",
    f"""
    SELECT 'tables' AS branch, source_used, count(*) AS questions FROM ({_ROUTED_SQL})
    WHERE source_used IN ('SQL', 'HYBRID') GROUP BY ALL
    UNION ALL SELECT 'documents', source_used, count(*) FROM ({_ROUTED_SQL})
    WHERE source_used IN ('VECTOR', 'HYBRID') GROUP BY ALL
    """,
)
def route_branches(spark: SparkSession, folder: str) -> DataFrame:
    tables, documents = answering.route_branches(routed_questions(spark, folder))
    both = tables.select("source_used", F.lit("tables").alias("branch")).unionByName(
        documents.select("source_used", F.lit("documents").alias("branch"))
    )
    return both.groupBy("branch", "source_used").agg(F.count(F.lit(1)).alias("questions"))


@query(
    "normalised_labels",
    """
    SELECT event_id, CASE WHEN contains(raw, 'hybrid') THEN 'HYBRID' WHEN contains(raw, 'sql') THEN 'SQL'
                          ELSE 'VECTOR' END AS label
    FROM (SELECT event_id, CASE event_type WHEN 'purchase' THEN 'mysql, not vector'
              WHEN 'error' THEN 'vector or sql: hybrid' WHEN 'view' THEN 'label: vector.'
              ELSE event_type END AS raw FROM events)
    """,
)
def normalised_labels(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    raw = (
        F.when(kind == "purchase", "MySQL, not Vector")
        .when(kind == "error", "Vector or SQL: Hybrid")
        .when(kind == "view", "Label: vector.")
        .otherwise(kind)
    )
    return scan(spark, folder, "events").select("event_id", normalise_label(raw).alias("label"))


@query(
    "statement_guard",
    f"""
    SELECT event_id, CASE event_type
               WHEN 'click' THEN 'SELECT * FROM orders WHERE o_custkey = ' || user_id
               WHEN 'view' THEN 'with t as (select ' || user_id || ' as k) select * from t'
               WHEN 'error' THEN 'DELETE FROM orders WHERE o_custkey = ' || user_id
               WHEN 'purchase' THEN 'SELECT ''drop'' AS word, ' || user_id || ' AS k'
               ELSE 'SELECT created_at FROM customer WHERE c_custkey = ' || user_id END AS statement,
           CASE WHEN event_type IN ('error', 'purchase') THEN '{REFUSED}' END AS sql_error
    FROM events
    """,
)
def statement_guard(spark: SparkSession, folder: str) -> DataFrame:
    """Statements in a fence or bare; write keywords are refused even inside a literal, never inside a word."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    raw = (
        F.when(kind == "click", F.concat(F.lit("```SQL\nSELECT * FROM orders WHERE o_custkey = "), user, F.lit("\n```")))
        .when(kind == "view", F.concat(F.lit("with t as (select "), user, F.lit(" as k) select * from t")))
        .when(kind == "error", F.concat(F.lit("  DELETE FROM orders WHERE o_custkey = "), user))
        .when(kind == "purchase", F.concat(F.lit("SELECT 'drop' AS word, "), user, F.lit(" AS k")))
        .otherwise(F.concat(F.lit("SELECT created_at FROM customer WHERE c_custkey = "), user))
    )
    cleaned = scan(spark, folder, "events").select("event_id", strip_fence(raw).alias("statement"))
    return cleaned.withColumn("sql_error", guard_message("statement"))


_TOTALS_SQL = """
    SELECT o_custkey AS customer_id, o_orderpriority AS transaction_type, count(*) AS n,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS paid
    FROM orders GROUP BY ALL
"""
RESULT_COLUMNS = ["transaction_type", "n", "paid"]


def customer_totals(spark: SparkSession, folder: str) -> DataFrame:
    """What a question about a customer can be answered with: number and sum by transaction type."""
    return (
        I.transactions(spark, folder)
        .groupBy("customer_id", "transaction_type")
        .agg(F.count("transaction_id").alias("n"), F.sum(A.money("amount")).alias("paid"))
    )


def topic_hits(spark: SparkSession, folder: str) -> DataFrame:
    """``(topic, rank, policy_name, page_number, content)``: the chunks found for each policy."""
    pages = ingest.number_pages(I.page_rows(spark, folder), order="doc_id").select(
        F.col("doc_id").alias("vec_id"), F.col("source_file").alias("policy_name"), "page_number", F.col("text").alias("content")
    )
    known = pages.select("vec_id")
    stored = vectors(spark, folder).join(known, "vec_id")
    hits = top_k(stored, topics(spark, folder), DEFAULT_K, member_id="vec_id")
    return with_columns(hits, pages, ["policy_name", "page_number", "content"], member_id="vec_id").withColumnRenamed(
        "qid", "topic"
    )


def with_topic(spark: SparkSession, folder: str, routed: DataFrame) -> DataFrame:
    """The policy of the asking customer is the topic to search for, where that policy has a vector."""
    policy = I.customers(spark, folder).select(F.col("customer_id").alias("user_id"), F.col("policy_number").alias("topic"))
    known = vectors(spark, folder).select(F.col("label").alias("topic")).distinct().withColumn("has_vector", F.lit(True))
    return (
        routed.join(policy, "user_id", "left")
        .join(known, "topic", "left")
        .withColumn("has_vector", F.coalesce("has_vector", F.lit(False)))
    )


def retrieved(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The results to choose from: rows as text per customer, excerpts per topic."""
    rows = customer_totals(spark, folder).withColumnRenamed("customer_id", "user_id")
    structured = answering.structured_context(rows, ["transaction_type"], RESULT_COLUMNS, key="user_id")
    return structured, answering.excerpt_context(topic_hits(spark, folder), key="topic")


_HITS_SQL = f"""
    SELECT h.qid AS topic, h.rank, p.source AS policy_name, p.page_number, p.text AS content
    FROM ({TOPIC_HITS_SQL.format(members=EMBEDDED_DOCUMENTS_SQL, k=DEFAULT_K)}) h
    JOIN (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_number FROM documents) p
      ON p.doc_id = h.id
"""
_ANSWER_PARTS_SQL = f"""
    SELECT r.qid, r.question, r.source_used, (t.topic IS NOT NULL) AS has_vector,
           CASE WHEN r.source_used <> 'VECTOR' THEN coalesce(s.n_rows, 0) END AS sql_rows,
           CASE WHEN r.source_used <> 'SQL' AND t.topic IS NOT NULL THEN x.n_hits
                WHEN r.source_used <> 'SQL' THEN 0 END AS chunks,
           s.rows_json, CASE WHEN r.source_used <> 'SQL' THEN x.excerpts END AS excerpts
    FROM ({_ROUTED_SQL}) r
    LEFT JOIN customer c ON c.c_custkey = r.user_id
    LEFT JOIN (SELECT DISTINCT label AS topic FROM embeddings) t ON t.topic = c.c_nationkey
    LEFT JOIN (
        SELECT customer_id, count(*) AS n_rows, substr('[' || string_agg('{{"transaction_type":"' || transaction_type ||
               '","n":"' || n || '","paid":"' || paid || '"}}', ',' ORDER BY transaction_type) || ']', 1, 3000) AS rows_json
        FROM ({_TOTALS_SQL}) GROUP BY customer_id) s ON s.customer_id = r.user_id AND r.source_used <> 'VECTOR'
    LEFT JOIN (
        SELECT topic, count(*) AS n_hits, string_agg('[' || policy_name || ', page ' || page_number || ']: ' ||
               substr(content, 1, 400), chr(10) || chr(10) ORDER BY rank) AS excerpts
        FROM ({_HITS_SQL}) GROUP BY topic) x ON x.topic = t.topic
"""


@query("hybrid_merge", f"SELECT qid, source_used, sql_rows, chunks FROM ({_ANSWER_PARTS_SQL})")
def hybrid_merge(spark: SparkSession, folder: str) -> DataFrame:
    questions = with_topic(spark, folder, routed_questions(spark, folder))
    merged = answering.merge_retrievals(questions, *retrieved(spark, folder), rows_key="user_id", hits_key="topic")
    label = F.col("source_used")
    return merged.select(
        "qid", "source_used",
        F.when(answering.uses_tables(label), F.coalesce("sql_rows_returned", F.lit(0))).alias("sql_rows"),
        F.when(answering.uses_documents(label), F.coalesce("vector_chunks_used", F.lit(0))).alias("chunks"),
    )


def _responses(spark: SparkSession, folder: str) -> DataFrame:
    questions = with_topic(spark, folder, routed_questions(spark, folder))
    statement = F.concat(
        F.lit("```sql\n"),
        F.when(F.col("event_type") == "error", "UPDATE").otherwise("SELECT * FROM"),
        F.lit(" totals WHERE customer_id = "), F.col("user_id").cast("string"), F.lit("\n```"),
    )
    return answering.answer_batch(
        questions.withColumn("sql_query", statement),
        *retrieved(spark, folder),
        rows_key="user_id",
        hits_key="topic",
        with_context=True,
    )


_RESPONSES_SQL = f"""
    SELECT qid, question, source_used,
        CASE WHEN source_used <> 'VECTOR' THEN CASE WHEN refused THEN 'UPDATE' ELSE 'SELECT * FROM' END ||
             ' totals WHERE customer_id = ' || user_id END AS sql_query,
        CASE WHEN source_used <> 'VECTOR' AND refused THEN 0 ELSE sql_rows END AS sql_rows_returned,
        CASE WHEN source_used <> 'VECTOR' AND refused THEN '{REFUSED}' END AS sql_error,
        chunks AS vector_chunks_used,
        CASE WHEN source_used <> 'SQL' AND NOT has_vector THEN '{answering.NO_VECTOR}' END AS vector_search_error,
        CASE WHEN source_used <> 'VECTOR' AND NOT refused THEN rows_json END AS shown_rows, excerpts
    FROM ({_ANSWER_PARTS_SQL})
    JOIN (SELECT event_id AS qid, user_id, event_type = 'error' AS refused FROM events) USING (qid)
"""


@query(
    "responses",
    f"""
    SELECT qid, question, source_used, sql_query, sql_rows_returned, sql_error, vector_chunks_used, vector_search_error,
           md5(CASE WHEN shown_rows IS NULL AND excerpts IS NULL THEN '{answering.NO_ANSWER}'
               ELSE concat_ws(chr(10) || chr(10), shown_rows, excerpts) END) AS answer
    FROM ({_RESPONSES_SQL})
    """,
)
def responses(spark: SparkSession, folder: str) -> DataFrame:
    """Typed responses of all questions; the long text is compared by its digest."""
    return _responses(spark, folder).withColumn("answer", F.md5("answer")).drop("retrieved_context")


@query(
    "context_blocks",
    f"""
    SELECT qid, md5('QUESTION: ' || question || chr(10) || chr(10) || concat_ws(chr(10) || chr(10),
        CASE WHEN source_used <> 'VECTOR'
             THEN '{answering.ROWS_TITLE}' || chr(10) || coalesce(shown_rows, '[]') END,
        '{answering.EXCERPTS_TITLE}' || chr(10) || excerpts)) AS digest
    FROM ({_RESPONSES_SQL})
    """,
)
def context_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _responses(spark, folder).select("qid", F.md5("retrieved_context").alias("digest"))


@query(
    "result_json",
    """
    SELECT c_nationkey AS qid, CAST(count(*) AS INTEGER) AS sql_rows_returned,
           substr('[' || string_agg('{"transaction_id":"' || o_orderkey || '","transaction_type":"' || o_orderpriority ||
                  '","status":"' || o_orderstatus || '"}', ',' ORDER BY o_orderkey) || ']', 1, 3000) AS rows_json
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey
    """,
)
def result_json(spark: SparkSession, folder: str) -> DataFrame:
    """Every policy's transactions as one result: far more rows than the text has room for."""
    held = I.customers(spark, folder).select("customer_id", F.col("policy_number").alias("qid"))
    rows = I.transactions(spark, folder).join(held, "customer_id")
    return answering.structured_context(rows, ["transaction_id"], ["transaction_id", "transaction_type", "status"])


@query(
    "route_confusion",
    f"""
    SELECT CASE event_type WHEN 'purchase' THEN 'SQL' WHEN 'error' THEN 'HYBRID' ELSE 'VECTOR' END AS expected,
           source_used AS actual, count(*) AS questions
    FROM ({_ROUTED_SQL}) GROUP BY ALL
    """,
)
def route_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.route_confusion(_labelled(spark, folder))


@query(
    "route_coverage",
    f"""
    SELECT expected, count(*) AS questions, round(avg(CASE WHEN expected = actual THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
           count(*) >= 3 AS enough
    FROM (SELECT CASE event_type WHEN 'purchase' THEN 'SQL' WHEN 'error' THEN 'HYBRID' ELSE 'VECTOR' END AS expected,
                 source_used AS actual FROM ({_ROUTED_SQL})) GROUP BY expected
    """,
)
def route_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.route_coverage(_labelled(spark, folder))


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    expected = F.when(kind == "purchase", "SQL").when(kind == "error", "HYBRID").otherwise("VECTOR")
    return routed_questions(spark, folder).select(expected.alias("expected"), F.col("source_used").alias("actual"))


@query(
    "last_claim_context",
    f"""
    SELECT l.customer_id, l.transaction_id, l.amount, h.rank, h.policy_name, h.page_number, md5(h.content) AS digest
    FROM (SELECT o_custkey AS customer_id, o_orderkey AS transaction_id,
                 CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount
          FROM orders WHERE o_orderpriority = '2-HIGH'
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1) l
    JOIN customer c ON c.c_custkey = l.customer_id JOIN ({_HITS_SQL}) h ON h.topic = c.c_nationkey
    """,
)
def last_claim_context(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer's last claim with the chunks found for the customer's policy."""
    claims = I.transactions(spark, folder).where(F.col("transaction_type") == I.CLAIM)
    held = I.customers(spark, folder).select("customer_id", F.col("policy_number").alias("topic"))
    last = A.latest_per_customer(claims).join(held, "customer_id")
    return last.join(topic_hits(spark, folder), "topic").select(
        "customer_id", "transaction_id", F.col("amount").cast("double").alias("amount"), "rank", "policy_name",
        "page_number", F.md5("content").alias("digest"),
    )


@query(
    "paid_and_policy_text",
    f"""
    SELECT p.customer_id, p.payments, p.paid, count(h.rank) AS chunks, min(h.policy_name) AS first_policy
    FROM (SELECT c_custkey AS customer_id, c_nationkey, count(o_orderkey) AS payments,
                 CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS paid
          FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON o_custkey = c_custkey
          GROUP BY ALL) p
    LEFT JOIN ({_HITS_SQL}) h ON h.topic = p.c_nationkey GROUP BY ALL
    """,
)
def paid_and_policy_text(spark: SparkSession, folder: str) -> DataFrame:
    """What each customer has paid, with the text found for the policy; one row per policy meets the customers."""
    per_topic = topic_hits(spark, folder).groupBy(F.col("topic").alias("policy_number")).agg(
        F.count(F.lit(1)).alias("chunks"), F.min("policy_name").alias("first_policy")
    )
    paid = A.paid_so_far(
        I.customers(spark, folder), I.transactions(spark, folder), I.policies(spark, folder), I.PREMIUM
    )
    return paid.join(per_topic, "policy_number", "left").select(
        "customer_id", "payments", F.col("paid").cast("double").alias("paid"),
        F.coalesce("chunks", F.lit(0)).alias("chunks"), "first_policy",
    )
