"""Quality of routing and of retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_QUESTIONS_PER_ROUTE = 3


def route_confusion(labelled: DataFrame) -> DataFrame:
    """Questions per expected and actual route."""
    return labelled.groupBy("expected", "actual").agg(F.count(F.lit(1)).alias("questions"))


def route_coverage(labelled: DataFrame) -> DataFrame:
    """Per expected route: questions, share routed as expected, and whether there are enough of them."""
    right = F.count_if(F.col("expected") == F.col("actual"))
    return labelled.groupBy("expected").agg(
        F.count(F.lit(1)).alias("questions"),
        F.round(right / F.count(F.lit(1)), 6).alias("accuracy"),
        (F.count(F.lit(1)) >= MIN_QUESTIONS_PER_ROUTE).alias("enough"),
    )


def retrieval_quality(hits: DataFrame, queries: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Hit rate, mean reciprocal rank and precision of top-k hits, over every query.

    ``queries`` is ``(qid, expected)`` and ``members`` is ``(id, label)``; a query without hits counts as a miss.
    """
    judged = hits.join(members, "id").join(queries, "qid")
    good = F.col("label") == F.col("expected")
    per_query = judged.groupBy("qid").agg(
        F.min(F.when(good, F.col("rank"))).alias("first"), F.count_if(good).alias("found")
    )
    scored = queries.join(per_query, "qid", "left")
    return scored.agg(
        F.count(F.lit(1)).alias("queries"),
        F.round(F.avg(F.when(F.col("first").isNotNull(), 1.0).otherwise(0.0)), 6).alias("hit_rate"),
        F.round(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))), 6).alias("mrr"),
        F.round(F.avg(F.coalesce("found", F.lit(0)) / k), 6).alias("precision_at_k"),
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that another search found as well."""
    both = found.select("qid", "id", F.lit(1).alias("hit"))
    return exact.join(both, ["qid", "id"], "left").agg(
        F.count(F.lit(1)).alias("expected_hits"), F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("recall")
    )
