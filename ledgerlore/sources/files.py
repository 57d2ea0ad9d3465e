"""Document files: listing by suffix and page-wise text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.functions.text import html_text


def has_suffix(name: Column | str, suffix: str) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    return F.lower(name).endswith(suffix.lower())


def list_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """``(source_file, path, size_bytes)`` of the files with the suffix in any case, sorted by name.

    Only metadata is read: the content column is never selected.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", F.col("length").alias("size_bytes"))
    named = files.withColumn("source_file", F.element_at(F.split("path", "/"), -1))
    return named.where(has_suffix("source_file", suffix)).select("source_file", "path", "size_bytes").orderBy("source_file")


def read_html_files(spark: SparkSession, folder: str, suffix: str = ".html") -> DataFrame:
    """``(source_file, page_number, text)`` of every HTML file in a folder; one page per file."""
    files = spark.read.format("binaryFile").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("source_file"), F.decode("content", "UTF-8").alias("html"))
    return page_text(named.where(has_suffix("source_file", suffix)), file="source_file", html="html")


def page_text(raw: DataFrame, *, file: str, html: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(source_file, page_number, text)`` from raw HTML rows, one page each; missing text is empty."""
    return raw.select(
        F.col(file).alias("source_file"), F.lit(1).alias("page_number"), html_text(html).alias("text"), *keep
    )
