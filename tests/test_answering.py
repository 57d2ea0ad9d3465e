import json

import pytest

from ledgerlore.functions.text import REFUSED
from ledgerlore.operators import answering as A
from ledgerlore.operators.evaluation import route_confusion, route_coverage
from ledgerlore.schemas import RESPONSE

QUESTIONS = "qid int, question string, source_used string, sql_query string, has_vector boolean"
ROWS = "qid int, n int, city string"
HITS = "qid int, rank int, policy_name string, page_number int, content string"


@pytest.fixture(scope="module")
def answers(spark):
    questions = spark.createDataFrame(
        [
            (1, "count?", "SQL", "```sql\nSELECT 1\n```", True),
            (2, "cover?", "VECTOR", "SELECT 1", True),
            (3, "both?", "HYBRID", "SELECT 2", True),
            (4, "bad", "HYBRID", "DROP TABLE t", True),
            (5, "no vector", "VECTOR", None, False),
            (6, "nothing", "SQL", "SELECT 3", True),
        ],
        QUESTIONS,
    )
    rows = spark.createDataFrame([(1, 2, "Pune"), (1, 1, None), (3, 7, "Kochi"), (4, 9, "Delhi")], ROWS)
    hits = spark.createDataFrame(
        [(q, r, f"P{r}", r, "x" * 500 if r == 1 else "short") for q in (2, 3, 4, 5) for r in (2, 1)], HITS
    )
    out = A.answer_batch(
        questions, A.structured_context(rows, ["n"], ["n", "city"]), A.excerpt_context(hits), with_context=True
    )
    return {r["qid"]: r for r in out.collect()}


def test_contract(spark, answers):
    row = answers[1]
    assert list(row.asDict())[1:-1] == [f.name for f in RESPONSE.fields]


def test_paths(answers):
    assert (answers[1]["sql_query"], answers[1]["sql_rows_returned"], answers[1]["sql_error"]) == ("SELECT 1", 2, None)
    assert (answers[1]["vector_chunks_used"], answers[1]["vector_search_error"]) == (None, None)
    assert (answers[2]["sql_query"], answers[2]["sql_rows_returned"], answers[2]["vector_chunks_used"]) == (None, None, 2)
    assert (answers[3]["sql_rows_returned"], answers[3]["vector_chunks_used"]) == (1, 2)
    assert (answers[4]["sql_rows_returned"], answers[4]["sql_error"], answers[4]["vector_chunks_used"]) == (0, REFUSED, 2)
    assert (answers[5]["vector_chunks_used"], answers[5]["vector_search_error"]) == (0, A.NO_VECTOR)
    assert (answers[6]["sql_rows_returned"], answers[6]["answer"]) == (0, A.NO_ANSWER)


def test_context(answers):
    rows = '[{"n":"1","city":null},{"n":"2","city":"Pune"}]'
    excerpts = "[P1, page 1]: " + "x" * 400 + "\n\n[P2, page 2]: short"
    assert answers[1]["retrieved_context"] == f"QUESTION: count?\n\n{A.ROWS_TITLE}\n{rows}"
    assert answers[2]["retrieved_context"] == f"QUESTION: cover?\n\n{A.EXCERPTS_TITLE}\n{excerpts}"
    assert answers[4]["retrieved_context"] == f"QUESTION: bad\n\n{A.ROWS_TITLE}\n[]\n\n{A.EXCERPTS_TITLE}\n{excerpts}"
    assert answers[5]["retrieved_context"] == "QUESTION: no vector\n\n"


def test_questions_share_the_text_of_what_they_ask_about(spark):
    questions = spark.createDataFrame(
        [(i, "q", ("SQL", "VECTOR", "HYBRID")[i % 3], "SELECT 1", True, i % 2, 7) for i in range(6)],
        QUESTIONS + ", customer int, topic int",
    )
    rows = spark.createDataFrame([(0, 5, "Pune"), (0, 6, "Pune")], "customer int, n int, city string")
    hits = spark.createDataFrame([(7, 1, "P", 1, "text")], HITS.replace("qid", "topic"))
    out = A.answer_batch(
        questions, A.structured_context(rows, ["n"], ["n"], key="customer"), A.excerpt_context(hits, key="topic"),
        rows_key="customer", hits_key="topic",
    )
    got = {r["qid"]: (r["sql_rows_returned"], r["vector_chunks_used"]) for r in out.collect()}
    assert got == {0: (2, None), 1: (None, 1), 2: (2, 1), 3: (0, None), 4: (None, 1), 5: (0, 1)}


def test_empty_batch(spark):
    rows, hits = spark.createDataFrame([], ROWS), spark.createDataFrame([], HITS)
    structured, excerpts = A.structured_context(rows, ["n"], ["n", "city"]), A.excerpt_context(hits)
    out = A.answer_batch(spark.createDataFrame([], QUESTIONS), structured, excerpts)
    assert out.count() == 0 and out.columns == ["qid", *[f.name for f in RESPONSE.fields]]


def test_wrong_input_is_refused_early(spark):
    short = spark.createDataFrame([], "qid int, question string, source_used string, sql_query string")
    with pytest.raises(ValueError, match="has_vector"):
        A.answer_batch(short, short, short)


@pytest.mark.parametrize("width", [0, 3, 200])
def test_cut_rows_equal_the_cut_of_all_rows(spark, width):
    rows = [(1, i, "c" * width) for i in range(900)] + [(2, 1, "")]
    out = A.structured_context(spark.createDataFrame(rows, ROWS), ["n"], ["n", "city"]).collect()
    texts = {r["qid"]: (r["sql_rows_returned"], r["rows_json"]) for r in out}
    whole = json.dumps([{"n": str(i), "city": "c" * width} for i in range(900)], separators=(",", ":"))
    assert texts == {1: (900, whole[:3000]), 2: (1, '[{"n":"1","city":""}]')}
    assert A.rows_needed(["n", "city"]) < 900


def test_evaluation(spark):
    df = spark.createDataFrame([("SQL", "SQL")] * 3 + [("SQL", "VECTOR"), ("HYBRID", "HYBRID")], "expected string, actual string")
    counts = {(r["expected"], r["actual"]): r["questions"] for r in route_confusion(df).collect()}
    assert counts == {("SQL", "SQL"): 3, ("SQL", "VECTOR"): 1, ("HYBRID", "HYBRID"): 1}
    cover = {r["expected"]: (r["questions"], r["accuracy"], r["enough"]) for r in route_coverage(df).collect()}
    assert cover == {"SQL": (4, 0.75, True), "HYBRID": (1, 1.0, False)}


def test_branches(spark):
    df = spark.createDataFrame([("SQL",), ("VECTOR",), ("HYBRID",)], "source_used string")
    tables, documents = A.route_branches(df)
    assert {r[0] for r in tables.collect()} == {"SQL", "HYBRID"}
    assert {r[0] for r in documents.collect()} == {"VECTOR", "HYBRID"}
