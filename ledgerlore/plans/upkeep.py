"""Queries that keep tables in step: change feed, its application, the triggered index sync."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.functions.vectors import embed_text, fit_text_embedding
from ledgerlore.operators import ingest
from ledgerlore.operators.changes import INSERT, apply_changes, change_feed
from ledgerlore.plans import inputs as I
from ledgerlore.plans.corpus import CHUNKS_SQL, chunk_sql, document_chunks
from ledgerlore.plans.registry import query
from ledgerlore.schemas import CHUNKS
from ledgerlore.session import DENSE, materialise, scratch_path
from ledgerlore.sources.tables import scan
from ledgerlore.streaming.cell_index import search_cells, sync_cells
from ledgerlore.streaming.index_sync import read_index, sync_index

EMBEDDING_DIM = 256

# The later snapshot: documents labelled toxic are gone, those of low quality are revised.
_LATER_PAGES_SQL = """
    SELECT source AS source_file, doc_id,
           CAST(row_number() OVER (PARTITION BY source ORDER BY d.doc_id) AS INTEGER) AS page_number,
           CASE WHEN l.quality = 0 THEN 'Revised.' || chr(10) ELSE '' END || coalesce(text, '') AS text
    FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(l.toxic, 0) = 0
"""
LATER_CHUNKS_SQL = chunk_sql(_LATER_PAGES_SQL)


def later_chunks(spark: SparkSession, folder: str) -> DataFrame:
    labels = scan(spark, folder, "labels").select("doc_id", "quality", "toxic")
    pages = I.page_rows(spark, folder).join(labels, "doc_id", "left").where(F.coalesce("toxic", F.lit(0)) == 0)
    mark = F.when(F.col("quality") == 0, "Revised.\n").otherwise("")
    revised = pages.select("source_file", "doc_id", F.concat(mark, F.coalesce("text", F.lit(""))).alias("text"))
    return ingest.chunk_documents(revised, order="doc_id", number=True)


@query(
    "change_feed",
    f"""
    WITH o AS ({CHUNKS_SQL}), n AS ({LATER_CHUNKS_SQL}),
    changed AS (SELECT o.chunk_id FROM o JOIN n USING (chunk_id)
                WHERE (o.source_file, o.policy_name, o.page_number, o.content, o.char_count)
                      IS DISTINCT FROM (n.source_file, n.policy_name, n.page_number, n.content, n.char_count))
    SELECT chunk_id, policy_name, char_count, md5(content) AS digest, kind AS _change_type FROM (
        SELECT *, 'insert' AS kind FROM n WHERE chunk_id NOT IN (SELECT chunk_id FROM o)
        UNION ALL SELECT *, 'delete' FROM o WHERE chunk_id NOT IN (SELECT chunk_id FROM n)
        UNION ALL SELECT *, 'update_preimage' FROM o WHERE chunk_id IN (SELECT chunk_id FROM changed)
        UNION ALL SELECT *, 'update_postimage' FROM n WHERE chunk_id IN (SELECT chunk_id FROM changed))
    """,
)
def chunk_changes(spark: SparkSession, folder: str) -> DataFrame:
    old, later = (materialise(rows, "snapshot") for rows in (document_chunks(spark, folder), later_chunks(spark, folder)))
    feed = change_feed(old, later, "chunk_id")
    return feed.select("chunk_id", "policy_name", "char_count", F.md5("content").alias("digest"), "_change_type")


@query(
    "apply_change_feed",
    f"SELECT chunk_id, source_file, policy_name, page_number, char_count, md5(content) AS digest FROM ({LATER_CHUNKS_SQL})",
)
def applied_changes(spark: SparkSession, folder: str) -> DataFrame:
    old = materialise(document_chunks(spark, folder), "snapshot")
    feed = change_feed(old, materialise(later_chunks(spark, folder), "snapshot"), "chunk_id")
    applied = apply_changes(old, feed, "chunk_id")
    return applied.select(
        "chunk_id", "source_file", "policy_name", "page_number", "char_count", F.md5("content").alias("digest")
    )


@query(
    "index_sync",
    f"""
    SELECT chunk_id, policy_name, char_count, md5(content) AS digest, {EMBEDDING_DIM} AS dims
    FROM ({LATER_CHUNKS_SQL})
    """,
)
def index_sync(spark: SparkSession, folder: str) -> DataFrame:
    """First run takes the whole chunk table, an idle run nothing, the next run the changes alone."""
    base = scratch_path(spark, "index")
    source, index, checkpoint = f"{base}/changes", f"{base}/index", f"{base}/checkpoint"
    schema = T.StructType([*CHUNKS.fields, T.StructField("_change_type", T.StringType())])

    def arrive(changes: DataFrame) -> None:
        changes.write.mode("append").option("compression", DENSE).parquet(source)

    def sync() -> int:
        return sync_index(spark, source, schema, index, checkpoint, embed=lambda rows: embed_text(model, rows, "content"))

    arrive(document_chunks(spark, folder).withColumn("_change_type", F.lit(INSERT)))
    # The files that are there now are the first snapshot, so it is written once.
    old = spark.read.schema(schema).parquet(source).drop("_change_type")
    model = fit_text_embedding(old.select("content"), dim=EMBEDDING_DIM)
    sync()
    if sync():
        raise RuntimeError("an idle run must do nothing")
    later = materialise(later_chunks(spark, folder), "snapshot", dense=True)
    arrive(change_feed(old, later, "chunk_id", images=False))
    sync()
    shown = [F.unhex(F.md5("content")).alias("digest"), F.size("embedding").alias("dims")]
    rows = read_index(spark, index, columns=[F.col("policy_name"), F.col("char_count"), *shown])
    return rows.withColumn("digest", F.lower(F.hex("digest")))


# The later state of the vectors: those of toxic documents are gone, those of low quality are read backwards.
_LATER_VECTORS_SQL = """
    SELECT vec_id, CASE WHEN l.quality = 0 THEN list_reverse(embedding) ELSE embedding END AS embedding
    FROM embeddings e LEFT JOIN labels l ON l.doc_id = e.vec_id WHERE coalesce(l.toxic, 0) = 0
"""
INDEX_K = 5


@query(
    "synced_index_search",
    f"""
    WITH stored AS ({_LATER_VECTORS_SQL}),
    scored AS (
        SELECT q.vec_id AS qid, s.vec_id AS id,
               round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(s.embedding AS DOUBLE[])), 6) AS score
        FROM embeddings q, stored s WHERE q.vec_id % 20 = 0)
    SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS INTEGER) AS rank, id, score
    FROM scored QUALIFY rank <= {INDEX_K}
    """,
)
def synced_index_search(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors enter the index, an idle sync takes nothing, a third takes the changes; then the index is searched.

    Queries are the vectors whose id is divisible by 20, against all rows.
    """
    base = scratch_path(spark, "cells")
    source, index, checkpoint = f"{base}/changes", f"{base}/index", f"{base}/checkpoint"
    old = scan(spark, folder, "embeddings").select("vec_id", "embedding")
    labels = scan(spark, folder, "labels").select(F.col("doc_id").alias("vec_id"), "quality", "toxic")
    kept = old.join(labels, "vec_id", "left").where(F.coalesce("toxic", F.lit(0)) == 0)
    turned = F.when(F.col("quality") == 0, F.reverse("embedding")).otherwise(F.col("embedding"))
    later = materialise(kept.select("vec_id", turned.alias("embedding")), "snapshot")
    changes = old.withColumn("_change_type", F.lit(INSERT))

    def sync() -> int:
        return sync_cells(spark, source, changes.schema, index, checkpoint)

    changes.write.mode("append").parquet(source)
    sync()
    if sync():
        raise RuntimeError("an idle run must do nothing")
    change_feed(old, later, "vec_id").select(changes.columns).write.mode("append").parquet(source)
    sync()
    queries = old.where(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "qid")
    return search_cells(spark, index, queries, INDEX_K)
