"""Queries from the text of questions to their answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.functions import routing
from ledgerlore.functions.text import NO_STATEMENT
from ledgerlore.operators import answering, dialog, entities
from ledgerlore.operators.postings import TERM, build_text_index
from ledgerlore.operators.predict import TOP_K, asked_of_tables, predict, understood
from ledgerlore.plans import inputs as I
from ledgerlore.plans.corpus import CHUNKS_SQL, document_chunks
from ledgerlore.plans.dialogs import HISTORY_SQL
from ledgerlore.plans.registry import query
from ledgerlore.plans.search import text_hits_sql
from ledgerlore.session import materialise

# Every customer asks one question, worded by the number; the third kind follows up on the turn before.
_ASKED_SQL = """
    SELECT 'c' || c_custkey AS qid, c_custkey, CASE c_custkey % 6
        WHEN 0 THEN 'How many premium payments has customer C' || lpad(c_custkey::VARCHAR, 7, '0') || ' made?'
        WHEN 1 THEN 'What was the last claim of customer C' || c_custkey || ', and is it covered?'
        WHEN 2 THEN 'give me the details'
        WHEN 3 THEN 'Total claim payouts under the ' || n_name || ' policy?'
        WHEN 4 THEN 'How many claims do people in ' || c_mktsegment || ' have?'
        ELSE 'How many customers are on the ' || n_name || ' policy in ' || r_name || '?' END AS question,
        CASE WHEN c_custkey % 6 = 2 THEN 'How much has ' || c_name || ' paid in premiums?' END AS previous_question,
        CASE WHEN c_custkey % 6 = 2 THEN 'SQL' END AS previous_source
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
"""


def customer_questions(spark: SparkSession, folder: str) -> DataFrame:
    """``(qid, question, history_json)``: one question of every customer."""
    asking = I.customers(spark, folder).join(I.policies(spark, folder), "policy_number", "left")
    number = F.col("customer_id").cast("string")
    kind = F.col("customer_id") % 6
    wording = (
        F.when(kind == 0, F.concat(F.lit("How many premium payments has customer C"), F.lpad(number, 7, "0"), F.lit(" made?")))
        .when(kind == 1, F.concat(F.lit("What was the last claim of customer C"), number, F.lit(", and is it covered?")))
        .when(kind == 2, F.lit("give me the details"))
        .when(kind == 3, F.concat(F.lit("Total claim payouts under the "), F.col("policy_name"), F.lit(" policy?")))
        .when(kind == 4, F.concat(F.lit("How many claims do people in "), F.col("city"), F.lit(" have?")))
        .otherwise(F.concat(F.lit("How many customers are on the "), F.col("policy_name"), F.lit(" policy in "), F.col("coverage_type"), F.lit("?")))
    )
    turn = F.struct(
        F.concat(F.lit("How much has "), F.col("name"), F.lit(" paid in premiums?")).alias("question"),
        F.lit(routing.SQL).alias("source_used"),
        F.lit("").alias("answer"),
    )
    return asking.select(
        F.concat(F.lit("c"), number).alias("qid"), wording.alias("question"), F.when(kind == 2, F.to_json(F.array(turn))).alias("history_json")
    )


def message_questions(spark: SparkSession, folder: str) -> DataFrame:
    """``(qid, question, history_json)``: every user message with the turns before it."""
    rows = dialog.history_before(I.messages(spark, folder))
    return rows.select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("qid"),
        "question",
        F.to_json("history", {"ignoreNullFields": "false"}).alias("history_json"),
    )


def _words_sql(text: str) -> str:
    return rf"list_transform(regexp_extract_all(lower(coalesce({text}, '')), '{TERM}'), lambda t: regexp_replace(t, '^c0+([0-9])', 'c\1'))"


_NAMES_SQL = f"""
    SELECT DISTINCT array_to_string(w, ' ') AS gram, len(w) AS words, entity_type, entity_id FROM (
        SELECT {_words_sql("'C' || c_custkey")} AS w, 'customer' AS entity_type, c_custkey::VARCHAR AS entity_id FROM customer
        UNION ALL SELECT {_words_sql("c_name")}, 'customer', c_custkey::VARCHAR FROM customer
        UNION ALL SELECT {_words_sql("n_name")}, 'policy', n_nationkey::VARCHAR FROM nation
        UNION ALL SELECT {_words_sql("r_name")}, 'coverage', r_name FROM region
        UNION ALL SELECT {_words_sql("c_mktsegment")}, 'city', c_mktsegment FROM customer)
"""


def _mentions_sql(texts: str) -> str:
    """Mentions (qid, start, words, entity_type, entity_id) in SQL from a relation (qid, text)."""
    return f"""
    SELECT a.* FROM (SELECT DISTINCT qid, start, words, entity_type, entity_id FROM (
        SELECT qid, i AS start, array_to_string(w[i + 1 : i + n], ' ') AS gram FROM (
            SELECT qid, w, n, unnest(range(0, len(w) - n + 1)) AS i
            FROM (SELECT qid, {_words_sql("text")} AS w FROM ({texts})), (SELECT DISTINCT words AS n FROM ({_NAMES_SQL}))))
        JOIN ({_NAMES_SQL}) USING (gram)) a
    """


def _longest_sql(texts: str) -> str:
    found = _mentions_sql(texts)
    return f"""
    SELECT a.* FROM ({found}) a WHERE NOT EXISTS (
        SELECT 1 FROM ({found}) o WHERE o.qid = a.qid AND o.start < a.start + a.words AND a.start < o.start + o.words
        AND (o.words > a.words OR (o.words = a.words AND o.start < a.start)))
    """


@query("question_mentions", _longest_sql(f"SELECT qid, question AS text FROM ({_ASKED_SQL})"))
def question_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """What the customers' questions name."""
    names = entities.name_table(I.customers(spark, folder), I.policies(spark, folder))
    found = entities.mentions(customer_questions(spark, folder).select("qid", "question"), names)
    return found.select("qid", F.explode("mentions").alias("m")).select("qid", "m.*")


_BATCH_SQL = f"""
    SELECT qid, question, previous_question, previous_source,
           CASE WHEN previous_question IS NULL THEN question ELSE previous_question || ' ' || question END AS search_text
    FROM ({_ASKED_SQL})
    UNION ALL
    SELECT conv_id || '/' || turn, question, history[-1].q, CASE WHEN len(history) > 0 THEN 'UNKNOWN' END,
           CASE WHEN len(history) = 0 THEN question
                ELSE regexp_replace(history[-1].q || ' ' || question, '^\\s+|\\s+$', '', 'g') END
    FROM ({HISTORY_SQL})
"""


def _cue_sql(cues: tuple[str, ...] | str, text: str = "question") -> str:
    joined = cues if isinstance(cues, str) else "|".join(cues)
    return rf"regexp_matches({text}, '(?i)\b({joined})\b')"


_ROUTED_SQL = f"""
    SELECT *, CASE WHEN more AND NOT t AND NOT d AND previous_source IN ('SQL', 'VECTOR', 'HYBRID') THEN previous_source
                   WHEN t AND d THEN 'HYBRID' WHEN t THEN 'SQL' ELSE 'VECTOR' END AS source_used
    FROM (SELECT *, {_cue_sql(routing.STRUCTURED_CUES)} AS t, {_cue_sql(routing.DOCUMENT_CUES)} AS d,
                 {_cue_sql(routing.FOLLOW_UP_CUES)} AS more FROM batch)
"""


def _first_kind_sql(text: str, found: str) -> str:
    """(qid, kind, entity_id) of the first kind whose cue and entity a question has."""
    rows = " UNION ALL ".join(
        f"SELECT q.qid, {i} AS place, '{kind}' AS kind, m.entity_id, m.start FROM tables_asked q JOIN {found} m USING (qid) "
        f"WHERE m.entity_type = '{entity}' AND {_cue_sql(cue, 'q.' + text)}"
        for i, (kind, cue, entity) in enumerate(entities.KINDS)
    )
    return f"SELECT qid, kind, entity_id FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY qid ORDER BY place, start, entity_id) = 1"


_PAID = "sum(CAST(o_totalprice AS DECIMAL(18,2)))::DECIMAL(18,2)"
_CLAIMS = f"(SELECT * FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '{I.CLAIM}')"
_TABLE_ANSWERS_SQL = f"""
    SELECT 'last_claim' AS kind, o_custkey::VARCHAR AS entity_id, 1 AS n, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
    FROM orders WHERE o_orderpriority = '{I.CLAIM}'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
    UNION ALL SELECT 'premiums_paid', o_custkey::VARCHAR, count(*), {_PAID} FROM orders WHERE o_orderpriority = '{I.PREMIUM}' GROUP BY o_custkey
    UNION ALL SELECT 'claims_in_city', c_mktsegment, count(*), {_PAID} FROM {_CLAIMS} GROUP BY c_mktsegment
    UNION ALL SELECT 'customers_on_policy', c_nationkey::VARCHAR, count(*), NULL FROM customer GROUP BY c_nationkey
    UNION ALL SELECT 'claims_on_policy', c_nationkey::VARCHAR, count(*), {_PAID} FROM {_CLAIMS} GROUP BY c_nationkey
    UNION ALL SELECT 'claims_on_coverage', r_name, count(*), {_PAID} FROM {_CLAIMS}
              JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY r_name
"""
_ASKED_OF_TABLES_SQL = f"""
    batch AS MATERIALIZED ({_BATCH_SQL}), routed AS MATERIALIZED ({_ROUTED_SQL}),
    tables_asked AS MATERIALIZED (SELECT * FROM routed WHERE source_used IN ('SQL', 'HYBRID')),
    own AS MATERIALIZED ({_longest_sql("SELECT qid, question AS text FROM tables_asked")}),
    before AS MATERIALIZED ({_longest_sql("SELECT qid, search_text AS text FROM tables_asked")}),
    asked AS MATERIALIZED (
        SELECT coalesce(a.qid, b.qid, c.qid) AS qid, coalesce(a.kind, b.kind, c.kind) AS kind, coalesce(a.entity_id, b.entity_id, c.entity_id) AS entity_id
        FROM ({_first_kind_sql("question", "own")}) a FULL JOIN ({_first_kind_sql("search_text", "own")}) b ON a.qid = b.qid
        FULL JOIN ({_first_kind_sql("search_text", "before")}) c ON c.qid = coalesce(a.qid, b.qid)),
    answers AS MATERIALIZED (
        SELECT qid, kind, entity_id, coalesce(n, 0) AS n, amount FROM asked LEFT JOIN ({_TABLE_ANSWERS_SQL}) USING (kind, entity_id))
"""


@query("entity_answers", f"WITH {_ASKED_OF_TABLES_SQL} SELECT qid, kind, entity_id, n, amount::DOUBLE AS amount FROM answers")
def entity_answers(spark: SparkSession, folder: str) -> DataFrame:
    """The number and sum behind the answer to every question that names something the tables know."""
    customers, policies = I.customers(spark, folder), I.policies(spark, folder)
    batch = understood(customer_questions(spark, folder).unionByName(message_questions(spark, folder)))
    asked = asked_of_tables(batch, entities.name_table(customers, policies))
    answers = entities.table_answers(
        asked.select("kind", "entity_id"), customers, I.transactions(spark, folder), policies, premium=I.PREMIUM, claim=I.CLAIM
    )
    return asked.join(answers, ["kind", "entity_id"]).select("qid", "kind", "entity_id", "n", F.col("amount").cast("double").alias("amount"))


_HITS_SQL = text_hits_sql(
    f"SELECT chunk_id AS id, content FROM ({CHUNKS_SQL})", "SELECT qid, search_text AS content FROM routed WHERE source_used <> 'SQL'", TOP_K
)
_JSON_SQL = """'[{"kind":"' || kind || '","entity_id":"' || entity_id || '","n":"' || n || '","amount":' ||
    coalesce('"' || amount || '"', 'null') || '}]'"""
_ANSWER_SQL = f"""
    WITH {_ASKED_OF_TABLES_SQL},
    chunk_rows AS MATERIALIZED (SELECT chunk_id, policy_name, page_number, content FROM ({CHUNKS_SQL})),
    hits AS MATERIALIZED ({_HITS_SQL}),
    excerpts AS (
        SELECT qid, count(*)::INTEGER AS n_hits, string_agg('[' || policy_name || ', page ' || page_number || ']: ' ||
               substr(content, 1, 400), chr(10) || chr(10) ORDER BY rank) AS excerpts
        FROM hits JOIN chunk_rows ON chunk_id = id GROUP BY qid),
    parts AS (
        SELECT r.qid, r.question, r.source_used, r.source_used <> 'VECTOR' AS t, r.source_used <> 'SQL' AS d, a.kind, a.entity_id,
               CASE WHEN a.kind IS NOT NULL AND r.source_used <> 'VECTOR' THEN {_JSON_SQL} END AS rows_json,
               coalesce(x.n_hits, 0) AS n_hits, x.excerpts, len(regexp_extract_all(coalesce(r.search_text, ''), '{TERM}')) > 0 AS has_vector
        FROM routed r LEFT JOIN answers a ON a.qid = r.qid LEFT JOIN excerpts x ON x.qid = r.qid)
    SELECT qid, question, source_used,
           CASE WHEN t AND kind IS NOT NULL
                THEN 'SELECT n, amount FROM answers WHERE kind = ''' || kind || ''' AND entity_id = ''' || entity_id || '''' END AS sql_query,
           CASE WHEN t THEN CASE WHEN kind IS NULL THEN 0 ELSE 1 END END AS sql_rows_returned,
           CASE WHEN t AND kind IS NULL THEN '{NO_STATEMENT}' END AS sql_error,
           CASE WHEN d THEN n_hits END AS vector_chunks_used,
           CASE WHEN d AND NOT has_vector THEN '{answering.NO_VECTOR}' END AS vector_search_error,
           md5(CASE WHEN rows_json IS NULL AND excerpts IS NULL THEN '{answering.NO_ANSWER}'
                    ELSE concat_ws(chr(10) || chr(10), rows_json, excerpts) END) AS answer
    FROM parts
"""


@query("answer_questions", _ANSWER_SQL)
def answer_questions(spark: SparkSession, folder: str) -> DataFrame:
    """All user messages and one question of every customer, each with its history as JSON, to typed responses."""
    chunks = materialise(document_chunks(spark, folder).select("chunk_id", "policy_name", "page_number", "content"), "chunks", dense=True)
    responses = predict(
        customer_questions(spark, folder).unionByName(message_questions(spark, folder)),
        build_text_index(chunks),
        chunks,
        I.customers(spark, folder),
        I.transactions(spark, folder),
        I.policies(spark, folder),
        premium=I.PREMIUM,
        claim=I.CLAIM,
    )
    return responses.withColumn("answer", F.md5("answer"))
