"""The given tables under the column names the operators know. Only names change, so filters and column
choices still reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.sources.tables import scan

# Values of the given tables that stand for transaction types and a city.
PREMIUM, CLAIM = "1-URGENT", "2-HIGH"
CITY = "BUILDING"
POLICY = "NATION_7"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("policy_number"),
        F.col("c_mktsegment").alias("city"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("transaction_type"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("o_orderstatus").alias("status"),
    )


def policies(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = scan(spark, folder, "nation"), scan(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("policy_number"),
        F.col("n_name").alias("policy_name"),
        F.col("r_name").alias("coverage_type"),
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "conversations").select(
        "conv_id", F.col("turn"), "role", F.col("text").alias("content")
    )


def page_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as pages of the file named by their source."""
    return scan(spark, folder, "documents").select(F.col("source").alias("source_file"), "doc_id", "text")


def question_log(spark: SparkSession, folder: str) -> DataFrame:
    """``(qid, user_id, question)``: one question per event, worded by the kind of the event."""
    events = scan(spark, folder, "events").select("event_id", "user_id", "event_type")
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    wording = (
        F.when(kind == "purchase", F.concat(F.lit("How many premium payments has customer C"), user, F.lit(" made?")))
        .when(kind == "view", F.lit("What is excluded under the Critical Illness policy?"))
        .when(kind == "error", F.concat(F.lit("Is the last claim covered, and how much was paid to customer "), user, F.lit("?")))
        .when(kind == "click", F.lit("give me the details"))
        .otherwise(F.lit("Good morning"))
    )
    return events.select(F.col("event_id").alias("qid"), "user_id", "event_type", wording.alias("question"))
