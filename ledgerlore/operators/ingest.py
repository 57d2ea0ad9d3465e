"""Documents to chunks: page numbers, titles, overlapping chunks, chunk numbers that run through a file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlore.functions.ordered import BLOCK_BITS, key_range, totals_before
from ledgerlore.functions.text import CHUNK_OVERLAP, CHUNK_SIZE, chunk_text, first_line
from ledgerlore.schemas import CHUNKS, conform


def number_pages(pages: DataFrame, *, file: str = "source_file", order: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Add ``page_number``: 1, 2, … in the order of an integer key that is unique inside its file."""
    counted = totals_before(pages, [file], order, {"__before": ("sum", F.lit(1))}, bits=bits)
    return counted.withColumn("page_number", (F.coalesce("__before", F.lit(0)) + 1).cast("int")).drop("__before")


def chunk_documents(
    pages: DataFrame,
    *,
    file: str = "source_file",
    order: str = "page_number",
    text: str = "text",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    number: bool = False,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """Chunk table of a corpus of pages.

    ``order`` is the integer page key of a file; with ``number=True`` the page number is its rank, else it is
    the key itself. A title is the first filled line of a file's first page, or the file name. The chunk number
    counts the filled chunks of all earlier pages of the file, so it needs per page only the *number* of its
    chunks; the text crosses the network once.
    """
    chunked = pages.select(
        F.col(file).alias("source_file"),
        F.col(order).alias("__order"),
        F.coalesce(first_line(text), F.lit("")).alias("__title"),
        chunk_text(F.coalesce(F.col(text), F.lit("")), size, overlap).alias("__chunks"),
    )
    own = F.struct(F.col("__order"), F.col("__title"))
    numbered = totals_before(
        chunked,
        ["source_file"],
        "__order",
        {
            "__chunks_before": ("sum", F.size("__chunks")),
            "__pages_before": ("sum", F.lit(1)),
            "__first": ("min", own),
        },
        bits=bits,
        bounds=key_range(pages, order),
    )
    rank = F.coalesce("__pages_before", F.lit(0)) + 1
    title = F.least("__first", own).getField("__title")
    rows = numbered.select(
        "source_file",
        F.when(title == "", F.col("source_file")).otherwise(title).alias("policy_name"),
        (rank if number else F.col("__order")).cast("int").alias("page_number"),
        F.coalesce("__chunks_before", F.lit(0)).alias("__offset"),
        F.posexplode("__chunks").alias("__pos", "content"),
    )
    return conform(
        rows.withColumn(
            "chunk_id",
            F.concat(
                "source_file", F.lit("_p"), F.col("page_number").cast("string"), F.lit("_c"),
                (F.col("__offset") + F.col("__pos")).cast("string"),
            ),
        ).withColumn("char_count", F.char_length("content")),
        CHUNKS,
    )


def union_chunks(*tables: DataFrame) -> DataFrame:
    """One chunk table from several corpora."""
    out = conform(tables[0], CHUNKS)
    for other in tables[1:]:
        out = out.unionByName(conform(other, CHUNKS))
    return out


def manifest(pages: DataFrame, *, file: str, text: str, **columns: str) -> DataFrame:
    """One row per document: file, title, the named descriptive columns and its size in bytes."""
    return pages.select(
        F.col(file).alias("filename"),
        F.coalesce(first_line(text), F.col(file).cast("string")).alias("policy_name"),
        *[F.col(source).alias(name) for name, source in columns.items()],
        F.coalesce(F.octet_length(text), F.lit(0)).alias("size_bytes"),
    )


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """Files, pages, chunks and characters; per-file rows are combined first, whatever their sizes."""
    per_page = chunks.groupBy("source_file", "page_number").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("char_count").alias("chars")
    )
    per_file = per_page.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("chunks").alias("chunks"), F.sum("chars").alias("chars")
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("pages").alias("pages"),
        F.sum("chunks").alias("chunks"),
        F.sum("chars").alias("chars"),
    )


def chunks_per_file(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("source_file", "policy_name").agg(
        F.count(F.lit(1)).alias("num_chunks"), F.max("page_number").alias("last_page")
    )
