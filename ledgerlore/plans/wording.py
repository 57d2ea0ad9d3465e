"""Queries that assemble policy documents from records and shared clauses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.operators import assembly
from ledgerlore.plans import inputs as I
from ledgerlore.plans.registry import query
from ledgerlore.sources.tables import scan

CLAUSES_TITLE = "Terms and Conditions"


def policy_records(spark: SparkSession, folder: str) -> DataFrame:
    """Policies with their lists: segments insured, payment states, waiting periods, suppliers in the network."""
    held = I.customers(spark, folder).groupBy("policy_number").agg(
        F.sort_array(F.collect_set("city")).alias("inclusions"), F.count(F.lit(1)).alias("holders")
    )
    network = scan(spark, folder, "supplier").groupBy(F.col("s_nationkey").alias("policy_number")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    number = F.col("policy_number")
    return (
        I.policies(spark, folder)
        .join(held, "policy_number", "left")
        .join(network, "policy_number", "left")
        .select(
            "policy_number", "policy_name", "coverage_type",
            F.concat("coverage_type", F.lit(" Health")).alias("insurer"),
            F.coalesce("holders", F.lit(0)).cast("string").alias("sum_insured"),
            F.concat((number * 100).cast("string"), F.lit(" / year")).alias("premium"),
            F.array(
                F.struct(
                    F.lit("Specific illness").alias("period"),
                    F.concat((number + 12).cast("string"), F.lit(" months")).alias("length"),
                ),
                F.struct(
                    F.lit("Initial").alias("period"),
                    F.concat((number + 30).cast("string"), F.lit(" days")).alias("length"),
                ),
            ).alias("waiting_periods"),
            "inclusions",
            F.array(F.lit("Self-inflicted injuries"), F.lit("War")).alias("exclusions"),
            F.lit(None).cast("array<string>").alias("claim_process"),
            F.concat(F.coalesce("suppliers", F.lit(0)).cast("string"), F.lit(" network hospitals")).alias("network_note"),
        )
    )


def shared_clauses(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "benchmark").select(
        F.lit(7).alias("section_no"), F.col("item_id").alias("ordinal"), F.lit(CLAUSES_TITLE).alias("heading"), "text"
    )


_RECORDS_SQL = """
    SELECT n_nationkey AS policy_number, n_name AS policy_name, r_name AS coverage_type, h.inclusions,
           coalesce(h.holders, 0) AS holders, coalesce(s.suppliers, 0) AS suppliers
    FROM nation JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN (SELECT c_nationkey, list_sort(list(DISTINCT c_mktsegment)) AS inclusions, count(*) AS holders
               FROM customer GROUP BY c_nationkey) h ON h.c_nationkey = n_nationkey
    LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY s_nationkey) s
           ON s.s_nationkey = n_nationkey
"""
_LINES_SQL = f"""
    SELECT policy_number, section_no, ordinal - 1 AS ordinal, heading, lines[ordinal] AS text FROM (
        SELECT policy_number, section_no, heading, lines, unnest(range(1, len(lines) + 1)) AS ordinal FROM (
            SELECT policy_number, 1 AS section_no, 'Policy' AS heading,
                   [policy_name, 'Insurer: ' || coverage_type || ' Health', 'Policy Number: ' || policy_number,
                    'Coverage Type: ' || coverage_type, 'Sum Insured: ' || holders,
                    'Premium: ' || (policy_number * 100) || ' / year'] AS lines FROM ({_RECORDS_SQL})
            UNION ALL SELECT policy_number, 2, 'Waiting Periods',
                   ['Specific illness: ' || (policy_number + 12) || ' months',
                    'Initial: ' || (policy_number + 30) || ' days'] FROM ({_RECORDS_SQL})
            UNION ALL SELECT policy_number, 3, 'Inclusions / What''s Covered', inclusions FROM ({_RECORDS_SQL})
            UNION ALL SELECT policy_number, 4, 'Exclusions / What''s Not Covered',
                   ['Self-inflicted injuries', 'War'] FROM ({_RECORDS_SQL})
            UNION ALL SELECT policy_number, 6, 'Network Hospitals',
                   [suppliers || ' network hospitals'] FROM ({_RECORDS_SQL})))
"""


@query(
    "policy_sections",
    f"""
    SELECT policy_number, section_no, CAST(ordinal AS INTEGER) AS ordinal, heading, text FROM ({_LINES_SQL})
    UNION ALL SELECT NULL, 7, CAST(item_id AS INTEGER), '{CLAUSES_TITLE}', text FROM benchmark
    """,
)
def policy_sections(spark: SparkSession, folder: str) -> DataFrame:
    return assembly.policy_sections(policy_records(spark, folder), shared_clauses(spark, folder))


@query(
    "policy_documents",
    f"""
    WITH own AS (
        SELECT policy_number, section_no, heading || chr(10) || string_agg(text, chr(10) ORDER BY ordinal) AS body
        FROM ({_LINES_SQL}) GROUP BY policy_number, section_no, heading
        UNION ALL SELECT n_nationkey, 5, 'Claim Process' || chr(10) FROM nation),
    shared AS (SELECT '{CLAUSES_TITLE}' || chr(10) || string_agg(text, chr(10) ORDER BY item_id) AS body FROM benchmark)
    SELECT policy_number, n_name AS policy_name, length(document) AS chars, md5(document) AS digest FROM (
        SELECT policy_number, string_agg(body, chr(10) ORDER BY section_no) || chr(10) || (SELECT body FROM shared)
               AS document FROM own GROUP BY policy_number) JOIN nation ON n_nationkey = policy_number
    """,
)
def policy_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = assembly.policy_documents(policy_records(spark, folder), shared_clauses(spark, folder))
    return documents.select(
        "policy_number", "policy_name", F.char_length("document").alias("chars"), F.md5("document").alias("digest")
    )


@query(
    "procedure_benefits",
    """
    SELECT position, p_name AS procedure, CASE position % 5
               WHEN 0 THEN 'Up to 10% of Sum Insured' WHEN 1 THEN 'Up to 15% of Sum Insured'
               WHEN 2 THEN 'Covered up to actuals (network hospital)'
               WHEN 3 THEN 'Up to 20% of Sum Insured per event'
               ELSE 'As per Reasonable and Customary Charges' END AS note
    FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS position FROM part)
    """,
)
def procedure_benefits(spark: SparkSession, folder: str) -> DataFrame:
    return assembly.procedure_benefits(scan(spark, folder, "part"), order="p_partkey", name="p_name")


@query(
    "waiting_periods",
    """
    SELECT n_nationkey AS policy_number, CAST(0 AS INTEGER) AS ordinal, 'Specific illness' AS period,
           (n_nationkey + 12) || ' months' AS length FROM nation
    UNION ALL SELECT n_nationkey, 1, 'Initial', (n_nationkey + 30) || ' days' FROM nation
    """,
)
def waiting_periods(spark: SparkSession, folder: str) -> DataFrame:
    return assembly.waiting_period_rows(policy_records(spark, folder))
