import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from ledgerlore.functions import text as X


def model_chunks(text, size=400, overlap=50):
    windows = [text[i : i + size] for i in range(0, len(text), size - overlap)]
    return [w for w in windows if w.strip()]


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


EDGES = ["", " ", "\n\n\n", "a", "x" * 350, "x" * 351, "x" * 400, "x" * 401, "y" * 750, "😀" * 801, "a\r\nb" * 300,
         " " * 700 + "end", "é\n" * 500, "a" * 349 + " " * 800 + "z"]


@pytest.mark.parametrize("size,overlap", [(400, 50), (10, 0), (10, 9), (10, 5), (7, 4), (900, 600)])
def test_chunks_equal_the_model(spark, size, overlap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGES)], "i int, t string")
    rows = df.select("i", X.chunk_text("t", size, overlap).alias("c")).collect()
    assert {r["i"]: r["c"] for r in rows} == {i: model_chunks(t, size, overlap) for i, t in enumerate(EDGES)}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs", "Cc"]), max_size=120), min_size=1, max_size=30),
    st.integers(2, 30), st.data(),
)
def test_chunks_of_any_text(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", X.chunk_text("t", size, overlap).alias("c")).collect()
    assert {r["i"]: r["c"] for r in rows} == {i: model_chunks(t, size, overlap) for i, t in enumerate(texts)}


def test_chunk_sizes_that_cannot_advance_are_refused():
    for size, overlap in ((10, 10), (10, 11), (0, 0), (10, -1)):
        with pytest.raises(ValueError):
            X.chunk_text("t", size, overlap)


@pytest.mark.parametrize(
    "text,filled,title",
    [("", False, None), (" \t\n ", False, None), ("  ", False, None), ("\n\n  Title \r\nrest", True, "Title"),
     ("  Wide  \nx", True, "Wide"), ("only", True, "only")],
)
def test_blank_and_title(spark, text, filled, title):
    assert one(spark, X.is_filled("t"), t=text) is filled
    assert one(spark, X.first_line("t"), t=text) == title


def test_preview_and_html(spark):
    assert one(spark, X.one_line("t", 5), t="ab\ncdef") == "ab cd"
    html = "<html><script>var a='<p>';</script><style>p{}</style><!-- <b> --><p>A &amp;lt; B&nbsp;&copy;</p>\n<i>C</i>"
    assert one(spark, X.html_text("t"), t=html) == "A &lt; B © C"
    assert one(spark, X.html_text("t"), t=None) == ""


@pytest.mark.parametrize(
    "raw,clean",
    [("```sql\nSELECT 1\n```", "SELECT 1"), ("```SQL SELECT 1```", "SELECT 1"), ("SELECT 1", "SELECT 1"),
     ("`SELECT 1`", "SELECT 1"), ("```\nSELECT 1\n```", "SELECT 1"), ("  SELECT\n1 \n", "SELECT\n1")],
)
def test_fence(spark, raw, clean):
    assert one(spark, X.strip_fence("t"), t=raw) == clean


@pytest.mark.parametrize(
    "statement,allowed",
    [("SELECT 1", True), ("  with t as (select 1) select * from t", True), ("SELECT created_at FROM t", True),
     ("SELECT 'drop' FROM t", False), ("DELETE FROM t", False), ("SELECT 1; drop table t", False),
     ("SHOW TABLES", False), ("", False), ("SELECTED", False), ("select * from t where update_time > 1", True),
     ("WITH x AS (SELECT 1) MERGE INTO t USING x", False)],
)
def test_guard(spark, statement, allowed):
    assert one(spark, X.is_read_only("t"), t=statement) is allowed
    assert one(spark, X.guard_message("t"), t=statement) == (None if allowed else X.REFUSED)


def test_missing_statement_does_not_run(spark):
    assert one(spark, X.guard_message("t"), t=None) == X.NO_STATEMENT
