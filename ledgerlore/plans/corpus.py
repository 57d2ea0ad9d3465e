"""Queries over documents: page text, chunks, titles, manifest, tables and their description."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.functions.text import first_line, is_filled, one_line
from ledgerlore.operators import ingest
from ledgerlore.plans import inputs as I
from ledgerlore.plans.registry import query
from ledgerlore.session import scratch_path
from ledgerlore.sources import tables
from ledgerlore.sources.files import has_suffix, page_text
from ledgerlore.sources.tables import scan

_TITLE = r"""list_filter(list_transform(string_split({text}, chr(10)),
    lambda l: regexp_replace(l, '^\s+|\s+$', '', 'g')), lambda l: l <> '')[1]"""

# The page text of raw HTML, with the same patterns in the same order.
_STRIPPED = r"""regexp_replace(regexp_replace(coalesce(html, ''),
    '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'gis'), '<[^>]*>', ' ', 'gs')"""
_DECODED = _STRIPPED
for _entity, _plain in (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"),
    ("&middot;", "·"), ("&amp;", "&"),
):
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_plain}')"
PAGE_TEXT_SQL = rf"trim(regexp_replace({_DECODED}, '\s+', ' ', 'g'), ' ')"


def chunk_sql(pages: str, size: int = 400, overlap: int = 50) -> str:
    """Chunk table in SQL from a relation (source_file, page_number, text)."""
    title = _TITLE.format(text="text")
    return rf"""
    SELECT source_file || '_p' || page_number || '_c' || (row_number() OVER (
               PARTITION BY source_file ORDER BY page_number, start) - 1) AS chunk_id,
           source_file, policy_name, page_number, content, length(content) AS char_count
    FROM (
        SELECT source_file, page_number, start, substr(text, start + 1, {size}) AS content,
               coalesce(first_value(title) OVER (PARTITION BY source_file ORDER BY page_number, start),
                        source_file) AS policy_name
        FROM (SELECT source_file, page_number, text, {title} AS title,
                     unnest(range(0, length(text), {size - overlap})) AS start FROM ({pages}))
    ) WHERE regexp_matches(content, '\S')
    """


PAGES_SQL = """
    SELECT source AS source_file, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS page_number,
           coalesce(text, '') AS text, doc_id
    FROM documents
"""
CHUNKS_SQL = chunk_sql(PAGES_SQL)


def document_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.chunk_documents(I.page_rows(spark, folder), order="doc_id", number=True)


def html_pages(spark: SparkSession, folder: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return page_text(scan(spark, folder, "pages"), file="url", html="html", keep=keep)


def html_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Pages of one address are pages of one file, in the order of their ids."""
    return ingest.chunk_documents(html_pages(spark, folder, ("page_id",)), order="page_id", number=True)


@query(
    "files_with_suffix",
    "SELECT url AS source_file FROM pages WHERE lower(url) LIKE '%ref=x' ORDER BY url",
)
def files_with_suffix(spark: SparkSession, folder: str) -> DataFrame:
    named = scan(spark, folder, "pages").select(F.col("url").alias("source_file"))
    return named.where(has_suffix("source_file", "REF=X")).orderBy("source_file")


@query("page_text", f"SELECT url AS source_file, 1 AS page_number, {PAGE_TEXT_SQL} AS text FROM pages")
def html_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_pages(spark, folder)


@query("chunk_table", CHUNKS_SQL)
def chunk_table(spark: SparkSession, folder: str) -> DataFrame:
    return document_chunks(spark, folder)


_PAGE_CHUNKS_SQL = chunk_sql(
    f"""SELECT url AS source_file, row_number() OVER (PARTITION BY url ORDER BY page_id) AS page_number,
               {PAGE_TEXT_SQL} AS text FROM pages"""
)


@query(
    "chunk_union",
    f"""
    SELECT chunk_id, source_file, page_number, char_count, md5(content) AS digest
    FROM (({CHUNKS_SQL}) UNION ALL ({_PAGE_CHUNKS_SQL}))
    """,
)
def chunk_union(spark: SparkSession, folder: str) -> DataFrame:
    both = ingest.union_chunks(document_chunks(spark, folder), html_chunks(spark, folder))
    return both.select("chunk_id", "source_file", "page_number", "char_count", F.md5("content").alias("digest"))


@query("wide_overlap_chunks", f"SELECT chunk_id, char_count, md5(content) AS digest FROM ({chunk_sql(PAGES_SQL, 900, 600)})")
def wide_overlap_chunks(spark: SparkSession, folder: str) -> DataFrame:
    chunks = ingest.chunk_documents(I.page_rows(spark, folder), order="doc_id", number=True, size=900, overlap=600)
    return chunks.select("chunk_id", "char_count", F.md5("content").alias("digest"))


@query("page_numbers", f"SELECT source_file, doc_id, page_number FROM ({PAGES_SQL})")
def page_numbers(spark: SparkSession, folder: str) -> DataFrame:
    rows = I.page_rows(spark, folder).select("source_file", "doc_id")
    return ingest.number_pages(rows, order="doc_id")


@query(
    "document_titles",
    f"SELECT doc_id, coalesce({_TITLE.format(text='text')}, source) AS title, regexp_matches(text, '\\S') AS filled FROM documents",
)
def document_titles(spark: SparkSession, folder: str) -> DataFrame:
    title = F.coalesce(first_line("text"), F.col("source"))
    return scan(spark, folder, "documents").select("doc_id", title.alias("title"), is_filled("text").alias("filled"))


@query(
    "chunk_previews",
    f"SELECT chunk_id, replace(substr(content, 1, 250), chr(10), ' ') AS preview FROM ({CHUNKS_SQL})",
)
def chunk_previews(spark: SparkSession, folder: str) -> DataFrame:
    return document_chunks(spark, folder).select("chunk_id", one_line("content").alias("preview"))


@query(
    "document_manifest",
    f"""
    SELECT doc_id AS filename, coalesce({_TITLE.format(text='text')}, CAST(doc_id AS VARCHAR)) AS policy_name,
           source AS policy_number, lang AS coverage_type, strlen(coalesce(text, '')) AS size_bytes
    FROM documents
    """,
)
def document_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.manifest(
        scan(spark, folder, "documents"), file="doc_id", text="text", policy_number="source", coverage_type="lang"
    )


@query(
    "corpus_stats",
    f"""
    SELECT count(DISTINCT source_file) AS files, count(DISTINCT (source_file, page_number)) AS pages,
           count(*) AS chunks, CAST(sum(char_count) AS BIGINT) AS chars FROM ({CHUNKS_SQL})
    """,
)
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.corpus_stats(document_chunks(spark, folder))


@query(
    "chunks_per_file",
    f"""
    SELECT source_file, policy_name, count(*) AS num_chunks, max(page_number) AS last_page
    FROM ({CHUNKS_SQL}) GROUP BY ALL
    """,
)
def chunks_per_file(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.chunks_per_file(document_chunks(spark, folder))


@query(
    "document_preview",
    "SELECT doc_id, source, replace(substr(text, 1, 250), chr(10), ' ') AS preview FROM documents ORDER BY doc_id LIMIT 5",
)
def document_preview(spark: SparkSession, folder: str) -> DataFrame:
    first = scan(spark, folder, "documents").orderBy("doc_id").limit(5)
    return first.select("doc_id", "source", one_line("text").alias("preview"))


_ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@query("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _ALL_TABLES))
def row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.row_counts({t: scan(spark, folder, t) for t in _ALL_TABLES})




def _namespace(spark: SparkSession) -> str:
    """A new schema in the shared folder, so that runs do not meet each other's tables."""
    location = scratch_path(spark, "tables")
    name = "ledgerlore_" + location.rsplit("-", 1)[-1]
    tables.ensure_namespace(spark, name, location)
    return name



@query(
    "table_overwrite",
    """
    SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS policy_number, c_mktsegment AS city
    FROM customer
    """,
)
def table_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A managed table written with one schema, replaced with another, and read back."""
    table = f"{_namespace(spark)}.customers"
    tables.overwrite_table(I.customers(spark, folder).select("customer_id", "city"), table)
    tables.overwrite_table(I.customers(spark, folder), table)
    return spark.table(table)


_COMMENTS = {
    "customers": (
        "Policyholders, one row each, with the policy they hold.",
        {
            "customer_id": "Number of the customer",
            "policy_number": "Policy held by the customer",
        },
    ),
    "transactions": (
        "Payments in and out, one row each.",
        {"status": "Where the payment stands"},
    ),
}

_LISTED_SQL = "(SELECT string_agg(DISTINCT {c}, ' | ' ORDER BY {c}) FROM {t})"


@query(
    "schema_context",
    f"""
    SELECT 'customers' AS table_name, 'Table: customers' || chr(10) ||
           '  Description: {_COMMENTS["customers"][0]}' || chr(10) ||
           '  Columns: customer_id (bigint, Number of the customer), name (string), ' ||
           'policy_number (int, Policy held by the customer), city (string, ' ||
           {_LISTED_SQL.format(c="c_mktsegment", t="customer")} || ')' AS context
    UNION ALL
    SELECT 'transactions', 'Table: transactions' || chr(10) ||
           '  Description: {_COMMENTS["transactions"][0]}' || chr(10) ||
           '  Columns: transaction_id (bigint), customer_id (bigint), transaction_type (string, ' ||
           {_LISTED_SQL.format(c="o_orderpriority", t="orders")} ||
           '), amount (double), transaction_date (timestamp_ntz), status (string, Where the payment stands: ' ||
           {_LISTED_SQL.format(c="o_orderstatus", t="orders")} || ')'
    """,
)
def schema_context(spark: SparkSession, folder: str) -> DataFrame:
    """Tables written to the catalog, commented, and described from the catalog and their values."""
    namespace = _namespace(spark)
    for name, rows in (("customers", I.customers), ("transactions", I.transactions)):
        table = f"{namespace}.{name}"
        tables.overwrite_table(rows(spark, folder), table)
        comment, columns = _COMMENTS[name]
        tables.comment_table(spark, table, comment, columns)
    described = tables.schema_context(
        spark,
        {
            f"{namespace}.customers": ["city"],
            f"{namespace}.transactions": ["transaction_type", "status"],
        },
    )
    plain = F.lit(f"{namespace}.")
    return described.select(
        F.replace("table_name", plain, F.lit("")).alias("table_name"),
        F.replace("context", plain, F.lit("")).alias("context"),
    )
