import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlore.operators import analytics as A
from ledgerlore.operators import assembly, ingest
from ledgerlore.schemas import CHUNKS, CUSTOMERS, POLICIES, TRANSACTIONS, conform, require_columns
from ledgerlore.session import scratch_path
from ledgerlore.sources import files, tables
from ledgerlore.sources.questions import question_batch


@pytest.fixture(scope="module")
def policies(spark):
    rows = [
        {"policy_number": "P-1", "policy_name": "Shield Senior", "coverage_type": "Senior Citizen", "insurer": "Co",
         "sum_insured": "5", "premium": "1", "waiting_periods": [("Initial", "30 days"), ("Existing", "36 months")],
         "inclusions": ["a", "b"], "exclusions": ["war"], "claim_process": ["notify"], "network_note": "many"},
        {"policy_number": "P-2", "policy_name": "Safe", "coverage_type": "Diabetes"},
    ]
    return tables.literal_rows(spark, rows, POLICIES)


@pytest.fixture(scope="module")
def customers(spark):
    rows = [
        {"customer_id": "C0001", "policy_number": "P-1", "city": "Pune", "name": "n1"},
        {"customer_id": "C0002", "policy_number": "P-1", "city": "Delhi", "name": "n2"},
        {"customer_id": "C0003", "policy_number": "P-9", "city": "Pune", "name": "n3"},
    ]
    return tables.literal_rows(spark, rows, CUSTOMERS)


@pytest.fixture(scope="module")
def transactions(spark):
    day = datetime.date(2024, 1, 1)
    rows = [
        ("T1", "C0001", "P-1", "claim_payout", 0.1, day, "completed"),
        ("T2", "C0001", "P-1", "claim_payout", 0.2, day, "failed"),
        ("T3", "C0001", "P-1", "refund", 5.0, day, "completed"),
        ("T4", "C0003", "P-9", "claim_payout", 7.0, day, "completed"),
        ("T5", "C0099", "P-1", "refund", 7.0, day, "completed"),
    ]
    return spark.createDataFrame(rows, TRANSACTIONS)


def test_customers_without_transactions_count(customers, transactions):
    rows = A.customers_per_policy(customers, transactions).collect()
    assert [tuple(r) for r in rows] == [("P-1", 2, 3), ("P-9", 1, 1)]
    activity = {r["customer_id"]: r["num_transactions"] for r in A.customer_activity(customers, transactions).collect()}
    assert activity == {"C0001": 3, "C0002": 0, "C0003": 1}


def test_claims(customers, transactions, policies):
    rows = A.totals_by_policy(customers, transactions, policies, "claim_payout", "senior citizen").collect()
    assert [(r["policy_name"], r["num_transactions"], str(r["total_amount"])) for r in rows] == [("Shield Senior", 2, "0.30")]
    held = {r["policy_number"]: r["num_customers"] for r in A.customers_on_policy(customers, policies).collect()}
    assert held == {"P-1": 2, "P-2": 0}
    there = A.count_in_city(customers, transactions, "claim_payout", "Pune").first()
    assert (there["num_customers"], there["num_transactions"]) == (2, 3)
    assert A.details_in_city(customers, transactions, "claim_payout", "Pune").count() == 3


def test_integrity(customers, transactions, policies):
    report = A.integrity_report(
        {
            "customer policy": (customers, "policy_number", policies, "policy_number"),
            "transaction customer": (transactions, "customer_id", customers, "customer_id"),
        }
    ).collect()
    assert [tuple(r) for r in report] == [("customer policy", 1, 1), ("transaction customer", 1, 1)]
    assert A.covered_rows(transactions, "customer_id", customers, "customer_id").count() == 4
    both = transactions.join(customers.select("customer_id", F.col("policy_number").alias("held")), "customer_id")
    assert tuple(A.disagreements(both, "policy_number", "held").first()) == (4, 0)
    sides = {(r["side"], r["key"]) for r in A.key_difference(
        customers.select("customer_id"), transactions.select("customer_id")).collect()}
    assert sides == {("both", "C0001"), ("both", "C0003"), ("left only", "C0002"), ("right only", "C0099")}


def test_enumerations(transactions):
    row = A.outside(transactions, {"transaction_type": ["claim_payout"], "status": ["completed", "failed"]}).collect()
    assert [tuple(r) for r in row] == [("transaction_type", 3, 2, 0), ("status", 5, 0, 0)]


def test_lookup_binds_its_value(spark, customers):
    customers.createOrReplaceTempView("people")
    assert A.lookup(spark, "people", "city", "Pune").count() == 2
    assert A.lookup(spark, "people", "city", "Pune' OR '1'='1").count() == 0


def test_large_dimension_is_not_broadcast(spark):
    df = spark.range(50).withColumn("v", F.lit(1))
    hinted = A.small(df, limit=100)._jdf.queryExecution().logical().toString()
    plain = A.small(df, limit=10)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted and "broadcast" not in plain


def test_tables_comments_and_context(spark, customers):
    tables.ensure_namespace(spark, "ctx", scratch_path(spark, "ctx"))
    tables.overwrite_table(customers.select("customer_id"), "ctx.people")
    tables.overwrite_table(customers.select("customer_id", "city"), "ctx.people")
    assert spark.table("ctx.people").columns == ["customer_id", "city"]
    tables.comment_table(spark, "ctx.people", "People's table", {"customer_id": "it's the key"})
    text = tables.schema_context(spark, {"ctx.people": ["city"]}).first()["context"]
    assert text == (
        "Table: ctx.people\n  Description: People's table\n"
        "  Columns: customer_id (string, it's the key), city (string, Delhi | Pune)"
    )
    many = spark.range(25).select(F.format_string("%02d", "id").alias("code"))
    assert tables.listed_values(many, ["code"]).first()["listed"] == " | ".join(f"{i:02d}" for i in range(25))
    assert tables.schema_context(spark, {"ctx.people": []}).count() == 1


def test_files(spark, tmp_path):
    for name in ("b.HTML", "a.html", "c.txt"):
        (tmp_path / name).write_text(f"<p>{name} &amp; é</p>", encoding="utf-8")
    listed = files.list_files(spark, str(tmp_path), ".html").collect()
    assert [r["source_file"] for r in listed] == ["a.html", "b.HTML"] and listed[0]["size_bytes"] > 0
    texts = {r["source_file"]: r["text"] for r in files.read_html_files(spark, str(tmp_path)).collect()}
    assert texts == {"a.html": "a.html & é", "b.HTML": "b.HTML & é"}


def test_question_batch(spark):
    df = spark.createDataFrame([("a", "h")], "text string, history_json string")
    assert question_batch(df).select("question", "history_json").first() == ("a", "h")
    numbered = question_batch(df.union(df).repartition(2))
    again = [sorted(r["qid"] for r in numbered.repartition(n).collect()) for n in (1, 3)]
    assert again[0] == again[1] and len(set(again[0])) == 2
    df = spark.createDataFrame([(7, "x", "q")], "qid int, other string, question string")
    assert tuple(question_batch(df).first()) == (7, "q", None)


def test_chunk_numbers_run_through_a_file(spark):
    pages = spark.createDataFrame(
        [("f", 1, "\n Title \n" + "x" * 500), ("f", 2, "  \n"), ("f", 3, "y" * 700), ("f", 4, None), ("g", 1, ""), ("g", 2, "z")],
        "source_file string, page_number int, text string",
    )
    for bits in (1, 16):
        chunks = ingest.chunk_documents(pages, bits=bits)
        assert chunks.schema.simpleString() == CHUNKS.simpleString()
        rows = [(r["chunk_id"], r["policy_name"], r["char_count"]) for r in chunks.orderBy("source_file", "chunk_id").collect()]
        assert rows == [("f_p1_c0", "Title", 400), ("f_p1_c1", "Title", 159), ("f_p3_c2", "Title", 400),
                        ("f_p3_c3", "Title", 350), ("g_p2_c0", "g", 1)]
    stats = ingest.corpus_stats(chunks).first().asDict()
    assert stats == {"files": 2, "pages": 3, "chunks": 5, "chars": 1310}


def test_documents_from_records_and_clauses(spark, policies):
    clauses = spark.createDataFrame(
        [(8, 0, "FAQ", "q1"), (7, 1, "Terms", "t2"), (7, 0, "Terms", "t1")],
        "section_no int, ordinal int, heading string, text string",
    )
    documents = {r["policy_number"]: r["document"] for r in assembly.policy_documents(policies, clauses).collect()}
    assert documents["P-1"].startswith("Policy\nShield Senior\nInsurer: Co\n")
    assert "Waiting Periods\nInitial: 30 days\nExisting: 36 months\nInclusions" in documents["P-1"]
    assert all(d.endswith("Terms\nt1\nt2\nFAQ\nq1") for d in documents.values())
    sections = assembly.policy_sections(policies.where("policy_number = 'P-1'"), clauses)
    assert sections.where("policy_number is null").count() == 3
    assert sections.where("section_no = 3").select("text").orderBy("ordinal").collect() == [("a",), ("b",)]
    periods = assembly.waiting_period_rows(policies).orderBy("ordinal").collect()
    assert [tuple(r) for r in periods] == [("P-1", 0, "Initial", "30 days"), ("P-1", 1, "Existing", "36 months")]


def test_shared_text_is_checked(spark, policies, monkeypatch):
    clauses = spark.createDataFrame([(7, 0, "Terms", "long")], "section_no int, ordinal int, heading string, text string")
    monkeypatch.setattr(assembly, "MAX_SHARED_BYTES", 3)
    with pytest.raises(ValueError, match="policy_sections"):
        assembly.policy_documents(policies, clauses)


def test_benefit_notes_take_turns(spark):
    df = spark.range(10, 24, 2).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    rows = assembly.procedure_benefits(df, order="k", name="name", bits=2).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(7))
    assert [r["note"] for r in rows] == [*assembly.BENEFIT_NOTES, *assembly.BENEFIT_NOTES[:2]]


def test_contracts(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="missing"):
        conform(df, CHUNKS)
    with pytest.raises(ValueError, match="'a' is int"):
        from pyspark.sql import types as T

        require_columns(df, {"a": T.StringType})
