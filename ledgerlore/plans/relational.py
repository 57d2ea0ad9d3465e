"""Queries over customers, transactions and policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.operators import analytics as A
from ledgerlore.plans import inputs as I
from ledgerlore.plans.registry import query
from ledgerlore.sources.tables import scan


@query(
    "customers_per_policy",
    """
    SELECT c.c_nationkey AS policy_number, count(DISTINCT c.c_custkey) AS num_customers,
           count(o.o_orderkey) AS num_transactions
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY c.c_nationkey
    """,
)
def customers_per_policy(spark: SparkSession, folder: str) -> DataFrame:
    return A.customers_per_policy(I.customers(spark, folder), I.transactions(spark, folder))


@query(
    "customer_activity",
    """
    SELECT c.c_custkey AS customer_id, c.c_name AS name, c.c_nationkey AS policy_number,
           count(o.o_orderkey) AS num_transactions,
           CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS paid
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    GROUP BY ALL
    """,
)
def customer_activity(spark: SparkSession, folder: str) -> DataFrame:
    out = A.customer_activity(I.customers(spark, folder), I.transactions(spark, folder))
    return out.withColumn("paid", F.col("paid").cast("double"))


_TABLE_CHECKS = {
    "orders to customer": ("orders", "o_custkey", "customer", "c_custkey"),
    "customer to nation": ("customer", "c_nationkey", "nation", "n_nationkey"),
    "supplier to nation": ("supplier", "s_nationkey", "nation", "n_nationkey"),
    "nation to region": ("nation", "n_regionkey", "region", "r_regionkey"),
    "lineitem to orders": ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    "lineitem to part": ("lineitem", "l_partkey", "part", "p_partkey"),
    "labels to documents": ("labels", "doc_id", "documents", "doc_id"),
    "documents to labels": ("documents", "doc_id", "labels", "doc_id"),
    "documents to embeddings": ("documents", "doc_id", "embeddings", "vec_id"),
    "orders to events": ("orders", "o_custkey", "events", "user_id"),
}


@query(
    "integrity_report",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS foreign_key, count(DISTINCT {ck}) AS orphan_keys, count({ck}) AS orphan_rows
            FROM {c} WHERE {ck} NOT IN (SELECT {pk} FROM {p})"""
        for name, (c, ck, p, pk) in _TABLE_CHECKS.items()
    ),
)
def integrity_report(spark: SparkSession, folder: str) -> DataFrame:
    return A.integrity_report(
        {n: (scan(spark, folder, c), ck, scan(spark, folder, p), pk) for n, (c, ck, p, pk) in _TABLE_CHECKS.items()}
    )


@query(
    "orphan_documents",
    "SELECT doc_id AS key, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id",
)
def orphan_documents(spark: SparkSession, folder: str) -> DataFrame:
    return A.orphans(scan(spark, folder, "documents"), "doc_id", scan(spark, folder, "labels"), "doc_id")


@query(
    "labelled_documents",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = scan(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return A.covered_rows(documents, "doc_id", scan(spark, folder, "labels"), "doc_id")


@query(
    "policy_key_agreement",
    """
    SELECT count(*) FILTER (c.c_nationkey = s.s_nationkey) AS agree,
           count(*) FILTER (c.c_nationkey <> s.s_nationkey) AS disagree
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    JOIN customer c ON c.c_custkey = o.o_custkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
    """,
)
def policy_key_agreement(spark: SparkSession, folder: str) -> DataFrame:
    sold_by = scan(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("fact_policy")
    )
    holder = I.customers(spark, folder).select("customer_id", F.col("policy_number").alias("customer_policy"))
    lines = scan(spark, folder, "lineitem").select("l_orderkey", "l_suppkey")
    orders = I.transactions(spark, folder).select(F.col("transaction_id").alias("l_orderkey"), "customer_id")
    # Rows of one customer with one supplier are counted together before the two lookups.
    counted = lines.join(orders, "l_orderkey").groupBy("customer_id", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    pairs = counted.join(A.small(sold_by), "l_suppkey").join(holder, "customer_id")
    same = F.col("fact_policy") == F.col("customer_policy")
    return pairs.agg(
        F.coalesce(F.sum(F.when(same, F.col("n"))), F.lit(0)).alias("agree"),
        F.coalesce(F.sum(F.when(~same, F.col("n"))), F.lit(0)).alias("disagree"),
    )


@query(
    "customers_with_policy",
    """
    SELECT c_custkey AS customer_id, c_name AS name, n_name AS policy_name, r_name AS coverage_type
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def customers_with_policy(spark: SparkSession, folder: str) -> DataFrame:
    joined = A.with_policy(I.customers(spark, folder), I.policies(spark, folder))
    return joined.select("customer_id", "name", "policy_name", "coverage_type")


_HELD = """
    SELECT n.n_nationkey AS policy_number, n.n_name AS policy_name, count(c.c_custkey) AS num_customers
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey {where}
    GROUP BY ALL
"""


@query("customers_on_each_policy", _HELD.format(where=""))
def customers_on_each_policy(spark: SparkSession, folder: str) -> DataFrame:
    return A.customers_on_policy(I.customers(spark, folder), I.policies(spark, folder))


@query("customers_on_one_policy", _HELD.format(where="WHERE lower(n_name) = 'nation_7'"))
def customers_on_one_policy(spark: SparkSession, folder: str) -> DataFrame:
    return A.customers_on_policy(I.customers(spark, folder), I.policies(spark, folder), I.POLICY)


_CLAIMS = """
    SELECT n.n_nationkey AS policy_number, n.n_name AS policy_name, count(*) AS num_transactions,
           CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE o.o_orderpriority = '2-HIGH' {where} GROUP BY ALL
"""


@query("claims_by_policy", _CLAIMS.format(where=""))
def claims_by_policy(spark: SparkSession, folder: str) -> DataFrame:
    out = A.totals_by_policy(
        I.customers(spark, folder), I.transactions(spark, folder), I.policies(spark, folder), I.CLAIM
    )
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("claims_for_coverage", _CLAIMS.format(where="AND contains(lower(r.r_name), 'asia')"))
def claims_for_coverage(spark: SparkSession, folder: str) -> DataFrame:
    out = A.totals_by_policy(
        I.customers(spark, folder), I.transactions(spark, folder), I.policies(spark, folder), I.CLAIM, "asia"
    )
    return out.withColumn("total_amount", F.col("total_amount").cast("double"))


@query(
    "counts_by_customer_and_type",
    """
    SELECT user_id AS customer_id, event_type AS transaction_type, count(*) AS num_transactions
    FROM events WHERE event_type IN ('purchase', 'signup', 'error') GROUP BY ALL
    """,
)
def counts_by_customer_and_type(spark: SparkSession, folder: str) -> DataFrame:
    return A.counts_by_customer_and_type(
        scan(spark, folder, "events"), "user_id", "event_type", ["purchase", "signup", "error"]
    )


@query(
    "claims_in_city",
    """
    SELECT c_mktsegment AS city, count(DISTINCT c_custkey) AS num_customers, count(*) AS num_transactions
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' AND o_orderpriority = '2-HIGH' GROUP BY ALL
    """,
)
def claims_in_city(spark: SparkSession, folder: str) -> DataFrame:
    return A.count_in_city(I.customers(spark, folder), I.transactions(spark, folder), I.CLAIM, I.CITY)


@query(
    "claim_details_in_city",
    """
    SELECT o_orderkey AS transaction_id, c_custkey AS customer_id, c_name AS name, c_mktsegment AS city,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           strftime(o_orderdate, '%Y-%m-%d') AS transaction_date, o_orderstatus AS status
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' AND o_orderpriority = '2-HIGH'
    """,
)
def claim_details_in_city(spark: SparkSession, folder: str) -> DataFrame:
    out = A.details_in_city(I.customers(spark, folder), I.transactions(spark, folder), I.CLAIM, I.CITY)
    return out.withColumn("amount", F.col("amount").cast("double")).withColumn(
        "transaction_date", F.date_format("transaction_date", "yyyy-MM-dd")
    )


@query(
    "customer_lookup",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_name = 'Customer#000000042'",
)
def customer_lookup(spark: SparkSession, folder: str) -> DataFrame:
    scan(spark, folder, "customer").createOrReplaceTempView("lookup_customer")
    return A.lookup(spark, "lookup_customer", "c_name", "Customer#000000042")


@query(
    "latest_transaction",
    """
    SELECT o_custkey AS customer_id, o_orderkey AS transaction_id, o_orderpriority AS transaction_type,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
           strftime(o_orderdate, '%Y-%m-%d') AS transaction_date, o_orderstatus AS status
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1
    """,
)
def latest_transaction(spark: SparkSession, folder: str) -> DataFrame:
    out = A.latest_per_customer(I.transactions(spark, folder))
    return out.withColumn("amount", F.col("amount").cast("double")).withColumn(
        "transaction_date", F.date_format("transaction_date", "yyyy-MM-dd")
    )


_ALLOWED = {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}


@query(
    "enumeration_check",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IN {tuple(v)}) AS allowed,
            count(*) FILTER ({c} NOT IN {tuple(v)}) AS not_allowed, count(*) FILTER ({c} IS NULL) AS missing
            FROM orders"""
        for c, v in _ALLOWED.items()
    ),
)
def enumeration_check(spark: SparkSession, folder: str) -> DataFrame:
    return A.outside(scan(spark, folder, "orders"), _ALLOWED)


@query(
    "policy_key_difference",
    """
    WITH a AS (SELECT DISTINCT o_custkey AS key FROM orders),
         b AS (SELECT DISTINCT user_id AS key FROM events)
    SELECT 'left only' AS side, key FROM a WHERE key NOT IN (SELECT key FROM b)
    UNION ALL SELECT 'right only', key FROM b WHERE key NOT IN (SELECT key FROM a)
    UNION ALL SELECT 'both', key FROM a WHERE key IN (SELECT key FROM b)
    """,
)
def policy_key_difference(spark: SparkSession, folder: str) -> DataFrame:
    payers = I.transactions(spark, folder).select("customer_id")
    return A.key_difference(payers, scan(spark, folder, "events").select("user_id"))


@query(
    "paid_so_far",
    """
    SELECT c.c_custkey AS customer_id, n.n_nationkey AS policy_number, n.n_name AS policy_name,
           count(o.o_orderkey) AS payments,
           CAST(coalesce(sum(CAST(o.o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS paid
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') o ON o.o_custkey = c.c_custkey
    GROUP BY ALL
    """,
)
def paid_so_far(spark: SparkSession, folder: str) -> DataFrame:
    out = A.paid_so_far(
        I.customers(spark, folder), I.transactions(spark, folder), I.policies(spark, folder), I.PREMIUM
    )
    return out.withColumn("paid", F.col("paid").cast("double"))


@query(
    "formatted_ids",
    r"""
    SELECT o_orderkey AS key, printf('C%04d', o_custkey) AS customer_id, printf('T%05d', o_orderkey) AS transaction_id,
           strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS due_date,
           printf('%.2f', CAST(o_totalprice AS DECIMAL(18,2))) AS amount_text
    FROM orders
    """,
)
def formatted_ids(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("key"),
        F.format_string("C%04d", "o_custkey").alias("customer_id"),
        F.format_string("T%05d", "o_orderkey").alias("transaction_id"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), 30), "yyyy-MM-dd").alias("due_date"),
        F.format_string("%.2f", F.round("o_totalprice", 2)).alias("amount_text"),
    )
