"""Customers, transactions and policies: counts, sums, lookups, integrity.

Column names are those of the customer and transaction tables (``schemas.py``). Facts are counted or summed
per customer before they meet the customers, so that a customer with a large share of all transactions costs
one row in the join instead of one overloaded task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# A dimension is sent to every executor only below this many rows; otherwise both sides are shuffled.
DIMENSION_ROWS = 100_000


def money(amount: str | Column) -> Column:
    """Exact money: decimal sums do not depend on the order of the rows."""
    return (F.col(amount) if isinstance(amount, str) else amount).cast(MONEY)


def small(dimension: DataFrame, limit: int = DIMENSION_ROWS) -> DataFrame:
    """Hint a broadcast when the table is known to be small: at most ``limit + 1`` rows are looked at."""
    return F.broadcast(dimension) if dimension.limit(limit + 1).count() <= limit else dimension


def per_customer(transactions: DataFrame) -> DataFrame:
    """``(customer_id, n, paid)``: combined on the map side, one row per customer afterwards."""
    return transactions.groupBy("customer_id").agg(
        F.count("transaction_id").alias("n"), F.sum(money("amount")).alias("paid")
    )


def customers_per_policy(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers and transactions per policy; customers without transactions count as well."""
    counted = transactions.groupBy("customer_id").agg(F.count("transaction_id").alias("n"))
    return (
        customers.select("customer_id", "policy_number")
        .join(counted, "customer_id", "left")
        .groupBy("policy_number")
        .agg(
            F.countDistinct("customer_id").alias("num_customers"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("num_transactions"),
        )
        .orderBy("policy_number")
    )


def customer_activity(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Every customer with the number and sum of the given transactions; null sum where there are none."""
    return customers.join(per_customer(transactions), "customer_id", "left").select(
        "customer_id", "name", "policy_number", F.coalesce("n", F.lit(0)).alias("num_transactions"), "paid"
    )


def with_policy(customers: DataFrame, policies: DataFrame) -> DataFrame:
    """Customers with the name and coverage of their policy."""
    return customers.join(small(policies), "policy_number")


def matches_policy(text: str) -> Column:
    """A policy meant by name or by coverage, as in "the Senior Citizen policy"."""
    return F.lower("policy_name").contains(text.lower()) | F.lower("coverage_type").contains(text.lower())


def customers_on_policy(customers: DataFrame, policies: DataFrame, text: str | None = None) -> DataFrame:
    """Number of customers per policy, for one policy or for all."""
    wanted = policies if text is None else policies.where(matches_policy(text))
    held = customers.groupBy("policy_number").agg(F.count("customer_id").alias("n"))
    return (
        wanted.join(held, "policy_number", "left")
        .select("policy_number", "policy_name", F.coalesce("n", F.lit(0)).alias("num_customers"))
    )


def totals_by_policy(
    customers: DataFrame, transactions: DataFrame, policies: DataFrame, kind: str, text: str | None = None
) -> DataFrame:
    """Number and sum of the transactions of one type per policy, e.g. the claim payouts."""
    wanted = policies if text is None else policies.where(matches_policy(text))
    paid = per_customer(transactions.where(F.col("transaction_type") == kind))
    return (
        paid.join(customers.select("customer_id", "policy_number"), "customer_id")
        .groupBy("policy_number")
        .agg(F.sum("n").alias("num_transactions"), F.sum("paid").alias("total_amount"))
        .join(small(wanted.select("policy_number", "policy_name")), "policy_number")
        .select("policy_number", "policy_name", "num_transactions", "total_amount")
    )


def counts_by_customer_and_type(facts: DataFrame, customer: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """How many facts of the listed types each customer has."""
    return (
        facts.where(F.col(kind).isin(*kinds))
        .groupBy(F.col(customer).alias("customer_id"), F.col(kind).alias("transaction_type"))
        .agg(F.count(F.lit(1)).alias("num_transactions"))
    )


def count_in_city(customers: DataFrame, transactions: DataFrame, kind: str, city: str) -> DataFrame:
    """How many transactions of a type customers of a city have."""
    there = customers.where(F.col("city") == city).select("customer_id", "city")
    counted = per_customer(transactions.where(F.col("transaction_type") == kind))
    return (
        counted.join(there, "customer_id")
        .groupBy("city")
        .agg(F.count(F.lit(1)).alias("num_customers"), F.sum("n").alias("num_transactions"))
    )


def details_in_city(customers: DataFrame, transactions: DataFrame, kind: str, city: str) -> DataFrame:
    """The transactions behind ``count_in_city``, one row each."""
    there = customers.where(F.col("city") == city).select("customer_id", "name", "city")
    return transactions.where(F.col("transaction_type") == kind).join(there, "customer_id").select(
        "transaction_id", "customer_id", "name", "city", money("amount").alias("amount"), "transaction_date", "status"
    )


def lookup(spark: SparkSession, view: str, column: str, value: object) -> DataFrame:
    """Point lookup as a parameterised statement; the value is bound, never pasted into the text."""
    return spark.sql(
        "SELECT * FROM IDENTIFIER(:view) WHERE IDENTIFIER(:column) = :value",
        args={"view": view, "column": column, "value": value},
    )


def latest_per_customer(transactions: DataFrame) -> DataFrame:
    """Last transaction of every customer, the smaller id on equal dates; a maximum, combined on the map side."""
    newest = F.max_by(
        F.struct("transaction_id", "transaction_type", money("amount").alias("amount"), "transaction_date", "status"),
        F.struct(F.col("transaction_date"), -F.col("transaction_id")),
    )
    return transactions.groupBy("customer_id").agg(newest.alias("t")).select("customer_id", "t.*")


def outside(df: DataFrame, allowed: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per enumerated column: rows inside and outside its allowed values, and nulls."""
    counts = df.agg(
        *[F.count_if(F.col(c).isin(*v)).alias(f"in_{c}") for c, v in allowed.items()],
        *[F.count_if(~F.col(c).isin(*v)).alias(f"out_{c}") for c, v in allowed.items()],
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in allowed],
    )
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.col(f"in_{c}").alias("allowed"),
                    F.col(f"out_{c}").alias("not_allowed"),
                    F.col(f"null_{c}").alias("missing"),
                )
                for c in allowed
            ]
        )
    )
    return counts.select(rows)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``(key, n)``: keys of the child that the parent lacks, with their number of rows.

    The child shrinks to one row per key before the anti join; a null key refers to nothing and is no orphan.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key"))
    counted = keys.agg(F.count(F.lit(1)).alias("n"))
    return counted.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def integrity_report(checks: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """One row per foreign key: orphan keys and orphan rows."""
    out = None
    for name, (child, child_key, parent, parent_key) in checks.items():
        row = orphans(child, child_key, parent, parent_key).agg(
            F.lit(name).alias("foreign_key"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def covered_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key the parent has: the complement of the orphans."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def disagreements(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """How often two foreign keys of one row name the same parent, and how often not."""
    same = F.col(left) == F.col(right)
    return pairs.agg(F.count_if(same).alias("agree"), F.count_if(~same).alias("disagree"))


def key_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(side, key)``: keys of only one table, and of both; each table brings one column."""
    a, b = left.toDF("key"), right.toDF("key")
    return (
        a.subtract(b).withColumn("side", F.lit("left only"))
        .unionByName(b.subtract(a).withColumn("side", F.lit("right only")))
        .unionByName(a.intersect(b).withColumn("side", F.lit("both")))
    )


def paid_so_far(customers: DataFrame, transactions: DataFrame, policies: DataFrame, kind: str) -> DataFrame:
    """Per customer the policy held and what has been paid: the structured half of a cross-source answer."""
    paid = per_customer(transactions.where(F.col("transaction_type") == kind))
    return (
        with_policy(customers, policies)
        .join(paid, "customer_id", "left")
        .select(
            "customer_id", "policy_number", "policy_name", F.coalesce("n", F.lit(0)).alias("payments"),
            F.coalesce("paid", F.lit(0).cast(MONEY)).alias("paid"),
        )
    )
