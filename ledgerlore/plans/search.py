"""Similarity queries over the embeddings and over text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.functions.text import one_line
from ledgerlore.functions.vectors import mean_vector
from ledgerlore.operators import evaluation
from ledgerlore.operators.postings import build_text_index, search_text_index
from ledgerlore.operators.similarity import build_index, nearest, search_index, top_k, with_columns
from ledgerlore.plans.corpus import CHUNKS_SQL, document_chunks
from ledgerlore.plans.registry import query
from ledgerlore.sources.tables import scan

TEST_K = 3
DEFAULT_K = 5

# Element-wise means without naming 64 columns: unnest with position, then average per position.
_CENTRES_SQL = """
    SELECT label AS qid, list(m ORDER BY i) AS v FROM (
        SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM (
            SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
        GROUP BY label, i) GROUP BY label
"""
_OVERALL_SQL = """
    SELECT list(m ORDER BY i) AS v FROM (
        SELECT i, avg(CAST(x AS DOUBLE)) AS m FROM (
            SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
        GROUP BY i)
"""
_SCORE = "round(list_cosine_similarity(q.v, CAST(e.embedding AS DOUBLE[])), 6)"
TOPIC_HITS_SQL = f"""
    SELECT qid, rank, id, score FROM (
        SELECT q.qid, e.vec_id AS id, {_SCORE} AS score,
               CAST(row_number() OVER (PARTITION BY q.qid ORDER BY {_SCORE} DESC, e.vec_id) AS INTEGER) AS rank
        FROM ({_CENTRES_SQL}) q, {{members}} e)
    WHERE rank <= {{k}}
"""
_NEIGHBOURS_SQL = f"""
    SELECT qid, rank, id, score FROM (
        SELECT q.qid, e.vec_id AS id, {_SCORE} AS score,
               CAST(row_number() OVER (PARTITION BY q.qid ORDER BY {_SCORE} DESC, e.vec_id) AS INTEGER) AS rank
        FROM (SELECT vec_id AS qid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) q, embeddings e
        WHERE q.qid <> e.vec_id)
    WHERE rank <= {DEFAULT_K}
"""
EMBEDDED_DOCUMENTS_SQL = "(SELECT e.vec_id, e.embedding FROM embeddings e JOIN documents d ON e.vec_id = d.doc_id)"


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "embeddings")


def vector_length(spark: SparkSession, folder: str) -> int:
    first = vectors(spark, folder).select(F.size("embedding").alias("n")).first()
    return first["n"] if first else 1


def topics(spark: SparkSession, folder: str) -> DataFrame:
    """``(qid, embedding)``: one query per label, the mean of its vectors."""
    means = mean_vector(vectors(spark, folder), ["label"], "embedding", vector_length(spark, folder))
    return means.withColumnRenamed("label", "qid")


def embedded_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that have a vector."""
    documents = scan(spark, folder, "documents").select(F.col("doc_id").alias("vec_id"), "source", "text")
    return vectors(spark, folder).join(documents, "vec_id")


@query("top_k_per_query", TOPIC_HITS_SQL.format(members="embeddings", k=DEFAULT_K))
def top_k_per_query(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(vectors(spark, folder), topics(spark, folder), DEFAULT_K, member_id="vec_id")


@query(
    "top_k_one_query",
    f"""
    SELECT e.vec_id AS id, {_SCORE} AS score FROM ({_OVERALL_SQL}) q, embeddings e
    ORDER BY score DESC, id LIMIT {TEST_K}
    """,
)
def top_k_one_query(spark: SparkSession, folder: str) -> DataFrame:
    """One query vector, the mean of all stored ones, and its first k."""
    stored = vectors(spark, folder)
    wanted = mean_vector(stored, [], "embedding", vector_length(spark, folder)).first()["embedding"]
    return nearest(stored, wanted, TEST_K, member_id="vec_id")


@query("nearest_neighbours", _NEIGHBOURS_SQL)
def nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Every stored vector as a query."""
    stored = vectors(spark, folder)
    queries = stored.withColumnRenamed("vec_id", "qid")
    return top_k(stored, queries, DEFAULT_K, member_id="vec_id", exclude_self=True)


@query("nearest_neighbours_by_cells", _NEIGHBOURS_SQL)
def nearest_neighbours_by_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same through cells: the way for more queries than can travel with the tasks."""
    stored = vectors(spark, folder)
    index = build_index(stored, member_id="vec_id")
    return search_index(index, stored.withColumnRenamed("vec_id", "qid"), DEFAULT_K, exclude_self=True)


@query(
    "hit_projection",
    f"""
    SELECT h.qid, h.rank, h.id AS vec_id, d.source, replace(substr(d.text, 1, 250), chr(10), ' ') AS preview,
           printf('%.4f', h.score) AS score
    FROM ({TOPIC_HITS_SQL.format(members=EMBEDDED_DOCUMENTS_SQL, k=TEST_K)}) h JOIN documents d ON h.id = d.doc_id
    """,
)
def hit_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Chosen columns of the hits with the score behind them, as a reader sees it."""
    members = embedded_documents(spark, folder)
    hits = top_k(members, topics(spark, folder), TEST_K, member_id="vec_id")
    shown = with_columns(hits, members, ["vec_id", "source", "text"], member_id="vec_id")
    return shown.select(
        "qid", "rank", "vec_id", "source", one_line("text").alias("preview"), F.format_string("%.4f", "score").alias("score")
    )


@query(
    "retrieval_quality",
    f"""
    WITH h AS ({_NEIGHBOURS_SQL}),
    j AS (SELECT h.qid, min(h.rank) FILTER (m.label = q.label) AS first, count(*) FILTER (m.label = q.label) AS found
          FROM h JOIN embeddings m ON m.vec_id = h.id JOIN embeddings q ON q.vec_id = h.qid GROUP BY h.qid)
    SELECT count(*) AS queries, round(avg(CASE WHEN first IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS hit_rate,
           round(avg(coalesce(1.0 / first, 0.0)), 6) AS mrr,
           round(avg(coalesce(found, 0) / {DEFAULT_K}.0), 6) AS precision_at_k
    FROM embeddings e LEFT JOIN j ON j.qid = e.vec_id
    """,
)
def retrieval_quality(spark: SparkSession, folder: str) -> DataFrame:
    stored = vectors(spark, folder)
    expected = stored.select(F.col("vec_id").alias("qid"), F.col("label").alias("expected"))
    labels = stored.select(F.col("vec_id").alias("id"), "label")
    return evaluation.retrieval_quality(nearest_neighbours(spark, folder), expected, labels, DEFAULT_K)


@query("probed_recall")
def probed_recall(spark: SparkSession, folder: str) -> DataFrame:
    """How many of the exact neighbours a search of the nearest cells finds."""
    stored = vectors(spark, folder)
    queries = stored.withColumnRenamed("vec_id", "qid")
    index = build_index(stored, member_id="vec_id")
    found = search_index(index, queries, DEFAULT_K, exclude_self=True, probes=4, exact=False)
    return evaluation.recall(found, nearest_neighbours(spark, folder))


def text_hits_sql(texts: str, queries: str, k: int) -> str:
    """Top-k by tf × idf in SQL, from relations ``texts`` (id, content) and ``queries`` (qid, content)."""
    words = r"unnest(regexp_extract_all(lower(coalesce(content, '')), '[\p{L}\p{N}_]+'))"
    return rf"""
    WITH texts AS ({texts}), queries AS ({queries}),
    counted AS (SELECT id, term, count(*) AS tf FROM (SELECT id, {words} AS term FROM texts) GROUP BY ALL),
    terms AS (
        SELECT * FROM (SELECT term, ln(((SELECT count(*) FROM texts) + 1.0::DOUBLE) / (count(*) + 1.0::DOUBLE)) AS idf
                       FROM counted GROUP BY term) WHERE idf > 0),
    stored AS (SELECT id, term, tf * idf AS x FROM counted JOIN terms USING (term)),
    lengths AS (SELECT id, sqrt(sum(x * x)) AS l FROM stored GROUP BY id),
    asked AS (
        SELECT qid, term, tf * idf AS x FROM (
            SELECT qid, term, count(*) AS tf FROM (SELECT qid, {words} AS term FROM queries) GROUP BY ALL) JOIN terms USING (term)),
    asked_lengths AS (SELECT qid, sqrt(sum(x * x)) AS l FROM asked GROUP BY qid),
    scored AS (
        SELECT qid, id, round(s / a.l / b.l, 6) AS score
        FROM (SELECT qid, id, sum(q.x * t.x) AS s FROM asked q JOIN stored t USING (term) GROUP BY qid, id)
        JOIN asked_lengths a USING (qid) JOIN lengths b USING (id))
    SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank, id, score
    FROM scored QUALIFY rank <= {k}
    """


_CHUNK_TEXTS_SQL = f"SELECT chunk_id AS id, content FROM ({CHUNKS_SQL})"
_ASKED_SQL = "SELECT conv_id || '/' || turn AS qid, text AS content FROM conversations WHERE role = 'user'"


@query("text_search", text_hits_sql(_CHUNK_TEXTS_SQL, _ASKED_SQL, TEST_K))
def text_search(spark: SparkSession, folder: str) -> DataFrame:
    """Every user message against all document chunks, by weighted postings."""
    index = build_text_index(document_chunks(spark, folder).select("chunk_id", "content"))
    asked = scan(spark, folder, "conversations").where(F.col("role") == "user").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("qid"),
        F.col("text").alias("content"),
    )
    return search_text_index(index, asked, TEST_K)
