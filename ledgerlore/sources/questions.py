"""The question batch: a question column and, when given, its history as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlore.schemas import require_columns
from ledgerlore.session import materialise


def question_batch(df: DataFrame, *, key: str = "qid") -> DataFrame:
    """``(qid, question, history_json)``. Without a ``question`` column the first column is the question.

    Without a ``key`` column rows are numbered and written once, so that every later reading sees the same numbers.
    """
    name = "question" if "question" in df.columns else next(c for c in df.columns if c != key)
    history = F.col("history_json") if "history_json" in df.columns else F.lit(None)
    ident = F.col(key) if key in df.columns else F.monotonically_increasing_id()
    out = df.select(
        ident.alias("qid"), F.col(name).cast("string").alias("question"), history.cast("string").alias("history_json")
    )
    require_columns(out, {"question": T.StringType, "history_json": T.StringType})
    return out if key in df.columns else materialise(out, "questions")
