"""The corpus pipeline: quality, near copies, repeated paragraphs, benchmark passages, then encoding.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; all but the last return the columns of
documents. ``run`` writes each stage to the shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.llm import decontamination, jaccard_join, pieces, quality, substring_dedup
from ledgerlore.llm.common import documents, table
from ledgerlore.session import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts get a score like others; repeated rows get the same score, so all stay or all go. An empty
    table stays empty.
    """
    scored = quality.scored(docs, quality.fit(docs.select("doc_id", "text"), table(spark, folder, "labels")))
    return scored.where(F.col("__score") >= quality.THRESHOLD).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, 0.8) the document with the smallest id.

    Documents without an id or without words are in no component and stay; of repeated rows with one id all stay.
    """
    found = jaccard_join.jaccard_components(docs.select("doc_id", "text"), k=5, percent=80)
    copies = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_repeated_paragraphs(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the passages that stay in a document with a smaller id; one with no words left goes.

    Null and empty texts stay. What stays, stays in all rows of its id; a null id comes first.
    """
    return substring_dedup.without_repeats(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without benchmark passages; one of which most is hit goes.

    Null and wordless texts stay; repeated rows are cut alike; items without an id or without words hit nothing.
    """
    return decontamination.decontaminated(docs, table(spark, folder, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, n_pieces, n_byte_pieces, pieces, decoded_equal)`` of what is left; null texts have null lists."""
    return pieces.encoded(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("substring dedup", drop_repeated_paragraphs),
    ("benchmark decontamination", drop_benchmark_passages),
    ("SentencePiece encoding and decoding", encode),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
