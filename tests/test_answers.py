import math
import pickle
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlore.operators import entities, postings, predict, similarity
from ledgerlore.operators.joins import join_shared

WORDS = [f"w{i}" for i in range(60)]


def brute_search(texts, queries, k):
    found = {i: Counter(re.findall(r"\w+", (t or "").lower())) for i, t in texts}
    df = Counter(t for c in found.values() for t in c)
    idf = {t: math.log((len(texts) + 1) / (n + 1)) for t, n in df.items() if len(texts) > n}

    def unit(counts):
        v = {t: n * idf[t] for t, n in counts.items() if t in idf}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / length for t, x in v.items()} if length else {}

    stored = {i: unit(c) for i, c in found.items()}
    out = set()
    for qid, text in queries:
        q = unit(Counter(re.findall(r"\w+", (text or "").lower())))
        scores = [(-round(sum(w * v[t] for t, w in q.items() if t in v), 6), i) for i, v in stored.items() if v.keys() & q.keys()]
        out |= {(qid, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize("block", [16, 8192])
def test_text_search_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(postings, "BLOCK_ROWS", block)
    rng = random.Random(5)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    texts = [(f"t{i:03}", " ".join(rng.choices(WORDS, weights, k=rng.randint(1, 30)))) for i in range(120)]
    texts += [("x1", None), ("x2", ""), ("x3", "w0"), ("x4", texts[0][1]), ("x5", "Ünïcode W1 w1")]
    queries = [(i, " ".join(rng.choices(WORDS, k=rng.randint(1, 12)))) for i in range(40)] + [(90, None), (91, "unknown"), (92, texts[0][1])]
    index = postings.build_text_index(spark.createDataFrame(texts, "chunk_id string, content string"))
    got = postings.search_text_index(index, spark.createDataFrame(queries, "qid long, content string"), 3)
    have = {(r.qid, r.rank, r.id, round(r.score, 6)) for r in got.collect()}
    want = brute_search(texts, queries, 3)
    assert {(q, r, i) for q, r, i, _ in have} == {(q, r, i) for q, r, i, _ in want}
    assert all(abs(s - dict(((q, r), x) for q, r, _, x in want)[q, r]) < 2e-6 for q, r, _, s in have)
    empty = postings.build_text_index(spark.createDataFrame([], "chunk_id string, content string"))
    assert postings.search_text_index(empty, spark.createDataFrame(queries, "qid long, content string"), 3).count() == 0
    assert postings.search_text_index(index, spark.createDataFrame([], "qid long, content string"), 3).count() == 0


def test_vectors_are_not_copied_per_block_or_batch(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_ROWS", 16)
    rng = random.Random(6)
    texts = [(f"t{i:03}", " ".join(rng.choices(WORDS, k=rng.randint(1, 30)))) for i in range(150)]
    queries = [(i, f"w1 w2 w3 u{i}") for i in range(60)] + [(100 + i, " ".join(rng.choices(WORDS, k=5))) for i in range(20)]
    index = postings.build_text_index(spark.createDataFrame(texts, "chunk_id string, content string"))
    asked = spark.createDataFrame(queries, "qid long, content string")
    got = postings.search_text_index(index, asked, 3)
    plan = got._jdf.queryExecution().toString()
    assert "sequence(" not in plan and "CoGroup" not in plan  # both sides met in a shuffle of copies
    want = {(q, r, i) for q, r, i, _ in brute_search(texts, queries, 3)}
    assert {(r.qid, r.rank, r.id) for r in got.collect()} == want
    monkeypatch.setattr(postings, "PASS_TERMS", 20)
    assert {(r.qid, r.rank, r.id) for r in postings.search_text_index(index, asked, 3).collect()} == want


def test_join_of_hot_and_rare_keys(spark):
    rows = spark.range(5000).select(F.col("id"), F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"))
    keys = spark.createDataFrame([(1, 3000, "hot"), (4000, 1, "rare"), (9999, 1, "none")], "k long, n long, v string")
    found = join_shared(rows, keys, "k", "n")
    assert Counter(r.v for r in found.collect()) == {"hot": 3000, "rare": 1}


CUSTOMERS = [(1, "Ann Bo", 10, "NORTH"), (12, "Ann Bo Cee", 11, "SOUTH"), (3, "Dee", 10, "NORTH"), (4, None, None, None)]
POLICIES = [(10, "GRAND PLAN", "HEALTH"), (11, "PLAN", "TRAVEL")]
TRANSACTIONS = [
    (1, 1, "premium", 10.0, "2024-01-01", "done"),
    (2, 1, "premium", 5.5, "2024-01-02", "done"),
    (3, 1, "claim", 7.0, "2024-01-03", "done"),
    (4, 1, "claim", 8.0, "2024-01-03", "done"),
    (5, 12, "claim", 9.0, "2024-02-01", "done"),
    (6, 99, "claim", 1.0, "2024-02-01", "done"),
]


@pytest.fixture(scope="module")
def tables(spark):
    return (
        spark.createDataFrame(CUSTOMERS, "customer_id long, name string, policy_number int, city string"),
        spark.createDataFrame(TRANSACTIONS, "transaction_id long, customer_id long, transaction_type string, amount double, transaction_date string, status string"),
        spark.createDataFrame(POLICIES, "policy_number int, policy_name string, coverage_type string"),
    )


def test_the_longest_name_wins(spark, tables):
    customers, _, policies = tables
    names = entities.name_table(customers, policies)
    asked = [(1, "Ann Bo Cee on the grand plan in North?"), (2, "C0012 or c1"), (3, None), (4, "nothing"), (5, "plan, PLAN")]
    found = entities.mentions(spark.createDataFrame(asked, "qid long, question string"), names)
    rows = {r.qid: [(m.start, m.entity_type, m.entity_id) for m in r.mentions] for r in found.collect()}
    assert rows[1] == [(0, "customer", "12"), (5, "policy", "10"), (8, "city", "NORTH")]
    assert rows[2] == [(0, "customer", "12"), (2, "customer", "1")]
    assert rows[5] == [(0, "policy", "11"), (1, "policy", "11")] and not {3, 4} & rows.keys()


def test_predict(spark, tables):
    chunks = [("a", "Plan", 1, "maternity is covered after a waiting period"), ("b", "Plan", 2, "claims are paid in cash"), ("c", "Other", 1, None)]
    chunks = spark.createDataFrame(chunks, "chunk_id string, policy_name string, page_number int, content string")
    history = '[{"question": "How many claims in North?", "source_used": "SQL", "answer": ""}]'
    asked = [
        (1, "How many premium payments has customer C0001 made?", None),
        (2, "Was the last claim of customer c1 covered?", "not json"),
        (3, "give me the details", history),
        (4, "Is maternity covered?", "[]"),
        (5, "How many claims has nobody made?", ""),
        (6, None, None),
        (7, "How many customers on the grand plan?", None),
        (8, "Total claim payouts of travel?", None),
        (9, "How many premium payments has customer C12 made?", None),
    ]
    questions = spark.createDataFrame(asked, "qid long, question string, history_json string")
    customers, transactions, policies = tables
    index = postings.build_text_index(chunks)

    def run(batch):
        return predict.predict(batch, index, chunks, customers, transactions, policies, premium="premium", claim="claim")

    rows = {r.qid: r for r in run(questions).collect()}
    assert len(rows) == len(asked)
    assert rows[1].source_used == "SQL" and '"n":"2","amount":"15.50"' in rows[1].answer and rows[1].vector_chunks_used is None
    assert rows[2].source_used == "HYBRID" and '"amount":"7.00"' in rows[2].answer and "covered after" in rows[2].answer
    assert rows[3].source_used == "SQL" and '"entity_id":"NORTH","n":"2","amount":"15.00"' in rows[3].answer
    assert rows[4].source_used == "VECTOR" and rows[4].answer.startswith("[Plan, page 1]: maternity") and rows[4].sql_query is None
    assert rows[5].sql_error and rows[5].sql_rows_returned == 0 and rows[5].answer == "(no answer returned)"
    assert rows[6].source_used == "VECTOR" and rows[6].vector_search_error and rows[6].vector_chunks_used == 0
    assert '"n":"2","amount":null' in rows[7].answer and '"n":"1","amount":"9.00"' in rows[8].answer
    assert '"kind":"premiums_paid","entity_id":"12","n":"0","amount":null' in rows[9].answer
    assert run(questions.limit(0)).count() == 0


def test_only_follow_ups_are_searched_for_names_twice(spark, tables, monkeypatch):
    customers, _, policies = tables
    looked = []
    plain = entities.mentions
    monkeypatch.setattr(entities, "mentions", lambda rows, *a, **k: looked.append(rows.count()) or plain(rows, *a, **k))
    rows = [("a", "premium paid by C1?", "SQL", "premium paid by C1?"), ("b", "and the details?", "SQL", "premium paid by C1? and the details?")]
    asked = spark.createDataFrame(rows, "qid string, question string, source_used string, search_text string")
    found = predict.asked_of_tables(asked, entities.name_table(customers, policies)).collect()
    assert sorted(tuple(r) for r in found) == [("a", "premiums_paid", "1"), ("b", "premiums_paid", "1")]
    assert looked == [2, 1]


def test_questions_that_differ_in_unknown_words_are_searched_once(spark, monkeypatch):
    index = postings.build_text_index(spark.createDataFrame([("t1", "a claim is covered"), ("t2", "a premium is paid")], "chunk_id string, content string"))
    sent = []
    plain = postings._queries
    monkeypatch.setattr(postings, "_queries", lambda rows: sent.append(rows.num_rows) or plain(rows))
    asked = spark.createDataFrame([(i, f"is the claim of customer c{i} covered?") for i in range(40)], "qid long, content string")
    found = postings.search_text_index(index, asked, 1).collect()
    assert {(r.qid, r.id) for r in found} == {(i, "t1") for i in range(40)} and sent == [1]


def test_vectors_are_counts_and_what_travels_names_no_class(spark, monkeypatch):
    texts = spark.createDataFrame([("a", "x x y"), ("b", "x z"), ("c", "q"), ("d", None)], "chunk_id string, content string")
    monkeypatch.setattr(postings, "FREQUENT", 2)
    index = postings.build_text_index(texts)
    idf = {r.number: r.idf for r in index.terms.collect()}
    rows = index.vectors.collect()
    assert sorted(r.id for r in rows) == ["a", "b", "c"] and sorted(rows[0].counts + rows[1].counts + rows[2].counts) == [1, 1, 1, 1, 2]
    for r in rows:
        assert abs(math.sqrt(sum((n * idf[t]) ** 2 for t, n in zip(r.terms, r.counts))) - r.length) < 1e-12
    sent, plain = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value) or plain(self, value))
    hits = postings.search_text_index(index, spark.createDataFrame([(1, "y"), (2, "nothing")], "qid int, content string"), 2)
    assert [(r.qid, r.id) for r in hits.collect()] == [(1, "a")]
    assert sent and b"ledgerlore" not in pickle.dumps(sent)


def test_only_hit_members_are_joined(spark):
    hits = spark.createDataFrame([(1, "a"), (2, "a"), (2, "c")], "qid int, id string")
    members = spark.createDataFrame([("a",), ("b",), ("c",)], "chunk_id string")
    assert sorted(r.chunk_id for r in similarity.hit_members(hits, members).collect()) == ["a", "c"]
    assert similarity.hit_members(hits, members, limit=1).count() == 3


def test_frequent_words_are_not_walked_for_texts_that_cannot_win(spark, monkeypatch):
    monkeypatch.setattr(postings, "GROUP_BITS", 4)
    rng = random.Random(8)
    words = [f"v{i}" for i in range(3000)]
    weights = [1 / (i + 1) for i in range(3000)]
    texts = [(f"t{i:04}", " ".join(rng.choices(words, weights, k=rng.randint(5, 60)))) for i in range(1200)]
    queries = [(i, " ".join(rng.choices(words, weights, k=25))) for i in range(30)]
    index = postings.build_text_index(spark.createDataFrame(texts, "chunk_id string, content string"))
    wide = postings.term_counts(spark.createDataFrame(queries, "qid long, content string"), "qid", "content")
    rows = postings._unit(wide, index.terms, "qid").selectExpr("string(qid) as vector", "terms", "idf", "weights").toArrow()
    asked = postings._queries(rows)
    stored = index.vectors.toArrow().select(["id", "terms", "counts", "length"])
    block = postings._Block(stored, asked.terms, asked.idf)
    walked = []
    plain = postings._Block._walk
    monkeypatch.setattr(postings._Block, "_walk", lambda self, q, f, sizes, w: walked.append(int(sizes.sum())) or plain(self, q, f, sizes, w))
    want = {(q, i): s for q, r, i, s in brute_search(texts, queries, 3)}
    floor = [min(s for (q, _), s in want.items() if q == int(name)) for name in asked.names.to_pylist()]
    query, text, score = block.hits(asked, postings.np.array(floor), 3)
    have = {(int(asked.names[q].as_py()), block.ids[t].as_py()): s for q, t, s in zip(query.tolist(), text.tolist(), score.tolist())}
    assert have.keys() == want.keys() and all(abs(have[p] - want[p]) < 2e-6 for p in want)
    postings_of_queries = int((block.ends[asked.place + 1] - block.ends[asked.place]).sum())
    assert 0 < sum(walked) < postings_of_queries / 4


def test_texts_are_searched_with_the_scores_of_the_lots_before(spark, monkeypatch):
    monkeypatch.setattr(postings, "LOTS", (2, 4, 8))
    rng = random.Random(9)
    texts = [(f"t{i:03}", " ".join(rng.choices(WORDS, k=rng.randint(1, 30)))) for i in range(200)]
    queries = [(i, " ".join(rng.choices(WORDS, k=6))) for i in range(20)]
    index = postings.build_text_index(spark.createDataFrame(texts, "chunk_id string, content string"))
    seen, plain = [], postings._floors
    monkeypatch.setattr(postings, "_floors", lambda *a: seen.append(plain(*a)) or seen[-1])
    got = postings.search_text_index(index, spark.createDataFrame(queries, "qid long, content string"), 3)
    assert {(r.qid, r.rank, r.id) for r in got.collect()} == {(q, r, i) for q, r, i, _ in brute_search(texts, queries, 3)}
    assert len(seen) == 2 and (seen[0] > 0).all() and (seen[1] >= seen[0]).all()


def test_spans_are_compared_and_not_all_that_share_a_name(spark):
    names = [("ann lee", 2, "customer", str(i)) for i in range(40)] + [("lee", 1, "city", "Lee"), ("ann", 1, "city", "Ann")]
    names = spark.createDataFrame(names, "gram string, words int, entity_type string, entity_id string")
    asked = spark.createDataFrame([(1, "Did Ann Lee or Lee pay?"), (2, "nobody")], "qid int, question string")
    found = entities.mentions(asked, names)
    (row,) = found.collect()
    assert sorted((m.start, m.words, m.entity_id) for m in row.mentions) == sorted([(1, 2, str(i)) for i in range(40)] + [(4, 1, "Lee")])
    assert row.mentions == sorted(row.mentions)
    assert "exists(all" not in found._jdf.queryExecution().toString()  # every mention was compared with every other
