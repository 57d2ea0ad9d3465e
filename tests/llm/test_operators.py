import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from ledgerlore.llm import common as C
from ledgerlore.llm import (
    decontamination,
    jaccard_join,
    language_model,
    pieces,
    quality,
    queries,
    signature_tree,
    substring_dedup,
    token_count,
    url_filter,
    warc,
    winnowing,
)

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i % 977}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
ODD = [
    (1, PASSAGE, "x", 1),
    (2, f"intro line here\n{PASSAGE}\nand an end", "x", 2),
    (3, None, "x", 3),
    (4, "", "x", 4),
    (5, "  \n ", "x", 5),
    (6, LONG, "x", 6),
    (6, LONG, "x", 6),
    (None, "no id at all", "x", 7),
    (8, "▁ mark, 漢字 and ☃𝕏 \t end ", "x", 8),
    (9, PASSAGE.replace("passage30", "changed"), "x", 9),
]
SCHEMA = "doc_id long, text string, row string, spans long"  # the last two clash with names used inside
LABELS = [(1, 1, 0), (2, 1, 0), (4, 0, 0), (6, 0, 0), (9, 1, 0), (9, 0, 0), (None, 1, 0), (8, None, 0)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in check.TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    started = check.contract.queries
    check.contract.queries = lambda: started() | queries.QUERIES
    try:
        verdict = check.compare(spark, con, FOLDER, name)
    finally:
        check.contract.queries = started
    assert verdict.startswith("equal"), verdict


def test_self_join_connects_what_all_pairs_connect():
    rng = np.random.default_rng(1)
    base = [rng.integers(0, 1 << 62, rng.integers(5, 90), dtype=np.uint64) for _ in range(40)]
    sets = [np.unique(s) for s in base]
    for s in base * 2:
        changed = s.copy()
        changed[: rng.integers(0, 4)] = rng.integers(0, 1 << 62)
        sets.append(np.unique(changed))

    def label(pairs):
        at = list(range(len(sets)))
        for a, b in pairs:
            at = [at[a] if x == at[b] else x for x in at]
        return [[i for i in range(len(sets)) if at[i] == x] for x in at]

    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if 100 * len(c := np.intersect1d(sets[i], sets[j])) >= 80 * (len(sets[i]) + len(sets[j]) - len(c))
    ]
    assert label(signature_tree.self_join(sets, 80)) == label(links)
    keep = signature_tree.promising(np.array([len(s) for s in sets]), [signature_tree.signature(s) for s in sets], 80)
    assert {i for pair in links for i in pair} <= set(np.flatnonzero(keep).tolist())


def test_units_split_into_chunks_keep_every_link(spark):
    rows = [(i, " ".join(f"w{(i // 40)}x{k}" for k in range(60)) + f" own{i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, 3, 90, unit=16).collect()}
    assert found == {i: i // 40 * 40 for i in range(120)}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 60)], "a long, b long")
    found = {r.id: r.component for r in C.components(edges).collect()}
    assert found == {i: 0 for i in range(21)} | {40: 40, 50: 40, 60: 40}


def test_jaccard_join_on_odd_rows(odd, none):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(odd).collect()}
    assert (3, 0, 3) in rows and (4, 0, 4) in rows and (5, 0, 5) in rows and (None, 2, None) in rows
    assert (1, 58, 1) in rows and (9, 58, 1) in rows
    assert jaccard_join.jaccard_components(none).count() == 0


def test_jaccard_sets_come_once_for_each_digest(spark, monkeypatch):
    monkeypatch.setattr(C, "passes", lambda bitmap, bits: np.ones(len(bits), bool))  # as a full sieve does
    rows = [(i, PASSAGE, "x", i) for i in range(30)] + [(40, PASSAGE.replace("passage30", "changed"), "x", 40)] * 3 + [(50, LONG, "x", 50)]
    docs = spark.createDataFrame(rows, SCHEMA)
    digests = {r.doc_id: r.digest for r in jaccard_join.shingle_sets(docs, 3, 90).collect()}
    wanted = spark.createDataFrame([(digests[0], 0), (digests[40], 40)], "id long, doc_id long")
    sets = jaccard_join.sets_of(docs, 3, wanted).collect()
    assert sorted(r.id for r in sets) == sorted([digests[0], digests[40]]) and all(len(r.tokens) == 58 for r in sets)


def test_substring_dedup(odd, none):
    rows = {r.doc_id: r for r in substring_dedup.paragraph_repeats(odd).collect()}
    assert len(rows) == 9 and rows[1].n_passages == 0 and rows[1].text == PASSAGE
    assert rows[2].text == "intro line here\nand an end" and rows[2].kept_in == [1] and rows[2].words_removed == 60
    assert rows[9].text == "" and rows[9].n_passages == 1 and rows[6].text == LONG and rows[3].text is None and rows[8].text == ODD[8][1]
    left = substring_dedup.without_repeats(odd)
    kept = {r.doc_id: r.text for r in left.collect()}
    assert left.columns == odd.columns and left.count() == len(ODD) - 1
    assert kept[2] == "intro line here\nand an end" and 9 not in kept and kept[6] == LONG and kept[3] is None and kept[4] == ""
    assert substring_dedup.paragraph_repeats(none).count() == 0 and substring_dedup.without_repeats(none).count() == 0


def shared_runs(rows, n=50):
    """Runs of ``n`` words that several documents have."""
    seen = {}
    for doc, text in rows:
        words = (text or "").lower().split()
        for i in range(len(words) - n + 1):
            seen.setdefault(" ".join(words[i : i + n]), set()).add(doc)
    return {run for run, docs in seen.items() if len(docs) > 1}


def test_passages_inside_and_across_lines(spark):
    """Against brute force: no run of 50 words is left in two documents, and what is unique stays word for word."""
    rng = random.Random(3)
    prose = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    docs = []
    for passage in [prose(rng.randint(51, 90)) for _ in range(60)]:
        for _ in range(rng.randint(2, 4)):
            words = [prose(rng.randint(0, 120)), passage, prose(rng.randint(0, 120))]
            docs.append(([" ".join(w) for w in words], "".join(w + rng.choice(" " * 12 + "\n") for w in sum(words, [])).strip()))
    rng.shuffle(docs)
    rows = [(i, text) for i, (_, text) in enumerate(docs)]
    found = {r.doc_id: r for r in substring_dedup.paragraph_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for i, ((_, passage, _), _) in enumerate(docs):
        first.setdefault(passage, i)
    assert len(shared_runs(rows)) > 1000 and not shared_runs([(i, r.text) for i, r in found.items()])
    for i, ((before, passage, after), text) in enumerate(docs):
        if first[passage] == i:
            assert found[i].text == text and found[i].n_passages == 0
        else:
            assert found[i].text.split() == f"{before} {after}".split() and first[passage] in found[i].kept_in


def test_repeated_passages_of_the_documents(spark):
    rows = [tuple(r) for r in C.documents(spark, FOLDER).select("doc_id", "text").collect()]
    found = substring_dedup.paragraph_repeats(C.documents(spark, FOLDER)).collect()
    before, after = shared_runs(rows), shared_runs([(r.doc_id, r.text) for r in found])
    assert len(after) <= 0.02 * len(before) and len(found) == len(rows)


def test_word_codes_agree_with_splitting():
    texts = [" A b\tc\n".encode(), b"", b"  ", "ÄB x".encode(), b"b A"]
    codes, n = substring_dedup.coded(texts)
    words = [w for t in texts for w in t.lower().split()]
    assert n.tolist() == [len(t.lower().split()) for t in texts]
    assert len({(c, w) for c, w in zip(codes.tolist(), words)}) == len(set(words)) == len(set(codes.tolist()))


def test_decontamination(spark, odd, none):
    items = spark.createDataFrame([(7, PASSAGE), (8, "no id at all"), (9, ""), (None, "x"), (10, None)], "item_id long, text string")
    rows = odd.select(F.col("doc_id").alias("row"), "text")
    found = {r.doc_id: r for r in decontamination.digest(decontamination.contamination(rows, items)).collect()}
    assert found[1].n_hit == 60 and found[1].items_sha256 == hashlib.sha256(b"7").hexdigest()
    assert found[9].n_hit == 59 and found[2].n_words == 66 and found[None].n_hit == 4 and found[3].n_words == 0
    shards = decontamination.digest(decontamination.contamination(rows, items, shard_words=1))
    assert {r.doc_id: r for r in shards.collect()} == found
    clean = {r.doc_id: r.text for r in decontamination.decontaminated(odd, items, most=0.95).collect()}
    assert clean[2] == "intro line here\n\nand an end" and 1 not in clean and clean[8] == ODD[8][1]
    assert decontamination.contamination(rows, items.limit(0)).where("size(spans) > 0").isEmpty()
    assert decontamination.decontaminated(none, items).count() == 0


def test_suffix_automaton_against_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        items = [(str(i), [rng.choice("abcd").encode() for _ in range(rng.randint(1, 9))]) for i in range(4)]
        words = [rng.choice("abcde").encode() for _ in range(60)]
        machine = decontamination.SuffixAutomaton(items, 4)
        spans, names = machine.scan(np.array([machine.words.get(w, 0) for w in words]))
        hit, found = set(), set()
        for name, item in items:
            k = min(4, len(item))
            for i in range(len(item) - k + 1):
                for j in range(len(words) - k + 1):
                    if words[j : j + k] == item[i : i + k]:
                        hit |= set(range(j, j + k))
                        found.add(name)
        assert {p for a, b in spans for p in range(a, b)} == hit and {machine.names[i] for i in names} == found


def test_longest_match_counts():
    first, rest = ["a", "ab", "abcd", "x"], ["b", "c", "cd", "bcd", "d", "xy"]
    machine = token_count.LongestMatch(first, rest)

    def greedy(word):
        at = n = 0
        while at < len(word):
            known = first if at == 0 else rest
            ends = [e for e in range(at + 1, len(word) + 1) if word[at:e] in known]
            if not ends:
                return -1
            at, n = max(ends), n + 1
        return n

    rng = random.Random(2)
    words = {"".join(rng.choice("abcdxy") for _ in range(rng.randint(1, 8))) for _ in range(3000)}
    assert all(machine.count(w) == greedy(w) for w in words)


def test_token_counts_on_odd_rows(odd, none):
    rows = {r.doc_id: r for r in token_count.token_counts(odd).collect()}
    assert rows[3].n_tokens == rows[4].n_words == 0 and rows[6].n_words == 30_000 and rows[8].n_unknown > 0
    assert token_count.token_counts(none).count() == 0


def test_pieces_round_trip_and_best_score(odd, none):
    rows = {r.doc_id: r for r in pieces.encoded(odd).collect()}
    assert rows[3].pieces is None and rows[4].pieces == []
    assert all(r.decoded_equal for r in rows.values() if r.pieces is not None)
    assert pieces.encoded(none).count() == 0
    scores = {"▁": -1.0, "▁a": -2.0, "a": -1.5, "b": -1.2, "ab": -2.0, "ba": -3.5, "bab": -3.0}
    machine = pieces.PieceAutomaton([(p, i, s) for i, (p, s) in enumerate(scores.items())], list(range(100, 356)), 356)

    def best(text):
        if not text:
            return 0.0
        return max([best(text[: -len(p)]) + s for p, s in scores.items() if text.endswith(p)], default=-99.0)

    rng = random.Random(6)
    for _ in range(200):
        text = "▁" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        assert sum(scores[machine.names[i]] for i in machine.best(text)) == pytest.approx(best(text))


def test_winnowing(odd, none):
    rows = winnowing.fingerprints(odd).collect()
    assert len(rows) == len(ODD)
    of = {r.doc_id: r for r in rows}
    assert of[3].fingerprint == of[4].fingerprint == ":" and of[1].n_chars == len(PASSAGE)
    twins = [r for r in rows if r.doc_id == 6]
    assert twins[0].fingerprint == twins[1].fingerprint and {r.near_next for r in twins} >= {1.0}
    edited = PASSAGE[: len(PASSAGE) - len(PASSAGE) // 4] + ODD[1][1][: len(PASSAGE) // 4]
    assert of[1].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert winnowing.fingerprints(none).count() == 0


def test_short_texts_keep_their_likeness():
    rng = random.Random(4)
    near = []
    for _ in range(300):
        n = rng.randint(40, 78)
        text = "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
        edited = text[: n - n // 4] + "z" * (n // 4)
        one, two = (winnowing.Fingerprint(winnowing.chars_of(t)) for t in (text, edited))
        near.append(one.likeness(two))
    # three quarters are equal, so hardly any pair may look unrelated and most lie between the ends
    assert np.mean(np.equal(near, 0)) < 0.1 and np.mean([0 < x < 1 for x in near]) > 0.8


def test_winnow_chooses_rightmost_minimum():
    rng = np.random.default_rng(3)
    for _ in range(50):
        h = rng.integers(0, 6, rng.integers(1, 40)).astype(np.uint32)
        w = min(5, len(h))
        want = sorted({max(i for i in range(s, s + w) if h[i] == h[s : s + w].min()) for s in range(len(h) - w + 1)})
        values, at = winnowing.winnow(h, 5)
        assert at.tolist() == want and values.tolist() == h[want].tolist()
    chars = winnowing.chars_of("abcdefghijklmnopqrstuvwxyz" * 3)
    hashes = winnowing.gram_hashes(chars, 7)
    assert len(hashes) == len(chars) - 6 and hashes[0] == hashes[26] and len(set(hashes[:26].tolist())) == 26


def test_quality(spark, odd, none, labels):
    rows = quality.quality_scores(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.quality_scores(none, labels).count() == 0
    assert {r.score for r in quality.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    docs, truth = C.documents(spark, "/root/testdata/sf0.01"), C.table(spark, "/root/testdata/sf0.01", "labels")
    scored = quality.quality_scores(docs, truth).join(truth, "doc_id").where("held_out").toPandas()
    assert (scored.predicted == scored.quality).mean() > 0.9


def test_language_model(odd, none):
    rows = {r.doc_id: r for r in language_model.lm_scores(odd).collect()}
    train = [(t or "").lower().split() + [None] for i, t, *_ in ODD if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = {}
    for words in train:
        for w in words:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, text, *_ in ODD:
        words = (text or "").lower().split() + [None]
        want = sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words)
        assert rows[i].base_score == pytest.approx(want) and rows[i].train_tokens == n and rows[i].n_tokens == len(words)
        assert rows[i].n_known == sum(w in counts for w in words) and rows[i].score < 0
    assert language_model.lm_scores(none).count() == 0


def test_score_does_not_depend_on_which_words_are_frequent(spark, monkeypatch):
    rows = [(i, f"common words here w{i} end", "x", i) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(1)
    of = lambda: {r.doc_id: (r.score, r.base_score, r.n_known) for r in language_model.lm_scores(docs).collect()}
    whole = of()
    monkeypatch.setattr(language_model, "FREQUENT", 8)  # now only the common words travel to the tasks
    cut = of()
    monkeypatch.setattr(language_model, "FREQUENT", 1)  # and now none
    for other in (cut, of()):
        assert all(other[i] == pytest.approx(whole[i], rel=1e-6) for i in whole)


def test_windows_score_each_piece_once():
    lengths = np.array([1, 5, 32, 33, 100, 56])
    at, real, counts = language_model.windows(lengths)
    assert sorted(at[counts].tolist()) == list(range(int(lengths.sum()))) and (counts <= real).all()


def test_rounds_learn_from_every_piece_once(spark, monkeypatch):
    lengths, shifts = np.array([1, 5, 32, 33, 100, 56, 2000]), np.array([0, 1, 0, 1, 0, 1, 1])
    turns = [language_model.taken(lengths, shifts, i) for i in range(language_model.ROUNDS)]
    assert sorted(p for at, scored in turns for p in at[scored].tolist()) == list(range(int(lengths.sum())))
    # two runs on the same partitions learn the same weights
    docs = spark.createDataFrame([(i, f"{PASSAGE} {i}", "x", i) for i in range(60)], SCHEMA).repartition(3, "doc_id")
    one, two = (language_model.Corpus(docs.where(~language_model.held_out())).weights for _ in range(2))
    assert all((a == b).all() for a, b in zip(one, two))


def test_url_rules(spark):
    urls = [
        (1, "http://WWW.Example.com/en/a?x=1"), (2, "https://m.example.com/en/"), (3, "https://a.net/es/q#f"), (4, "ftp://a.org/en/"),
        (5, None), (6, "no scheme"), (7, "http://example.com"), (8, ""), (None, "http://b.net/fr/"), (1, "http://WWW.Example.com/en/a?x=1"),
    ]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, found string")
    rows = {r.page_id: r for r in url_filter.judged(pages).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert rows[2].rule == "example.com/en/" and rows[2].verdict == "block" and rows[3].rule == "net/es/" and rows[None].rule == "net/fr/"
    assert (rows[5].host, rows[5].path, rows[5].rule) == ("", "", None) and rows[6].host == "" and rows[7].rule is None
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_trees_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = url_filter.Trees(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == (y[1500:] > 0)).mean() > 0.95


@pytest.mark.parametrize("version", [1, 2])
def test_warc(spark, version):
    big, hard = "ä" * 700, "a\r\n\r\nWARC/1.1\r\n\r\nb\n" * 200
    rows = [(1, "http://a b/\n", big), (2, None, big), (2, None, big), (3, "u", None), (4, "u", "s"), (5, "v", "s"), (None, "w", hard), (6, "w", hard)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, uri string")
    out = sorted(warc.archived(pages, version).collect(), key=repr)
    assert len(out) == len(rows)
    for page, _, html in rows:
        mine = [r for r in out if r.page_id == page]
        assert all(r.payload_digest == hashlib.sha1((html or "").encode()).hexdigest() for r in mine)
        assert all(r.payload_bytes == len((html or "").encode()) for r in mine)
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in out)
    assert kinds == [(0, "revisit", 6), (1, "revisit", 2), (2, "response", 0), (2, "revisit", 2), (3, "response", 0), (4, "response", 0), (5, "response", 0), (6, "response", 0)]
    assert warc.archived(pages.limit(0), version).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = C.documents(spark, FOLDER)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.schema["text"] == docs.schema["text"], name
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert 0 < len(rows) < docs.count() and all(r.decoded_equal for r in rows)


def test_a_larger_sieve_lets_fewer_others_pass(spark):
    rows, wanted = spark.range(4000).withColumnRenamed("id", "token"), spark.range(0, 4000, 8).withColumnRenamed("id", "token")
    small, large = ({r.token for r in C.sieve(rows, wanted, "token", size=size).collect()} for size in (1 << 10, 1 << 20))
    assert set(range(0, 4000, 8)) <= large <= set(range(4000)) and len(large) < 510 < len(small)


def test_the_share_of_others_that_pass_a_sieve_does_not_grow(spark):
    rng = np.random.default_rng(1)
    others = rng.integers(-(1 << 63), 1 << 63, 200_000)
    for n in (20_000, 400_000):  # in a bitmap of 2^23 bits, whatever the number, 4.7 % of the others pass the larger
        wanted = spark.range(n).selectExpr("xxhash64(id) AS id")
        bitmap = C.id_filter(wanted)
        assert C.passes(bitmap, np.array([r.id for r in wanted.limit(5000).collect()])).all()
        assert C.passes(bitmap, others).sum() < 0.004 * len(others)


def test_many_words_are_cut_into_pieces_at_once_as_one_by_one():
    pieces = language_model.Pieces(*language_model.vocabulary()[:2])
    texts = [b"", "The unbelievable\tcafé 日本語 ▁ ▁▁a \x00 \x1c".encode(), b" \n ", b"x" * 100 + b" THE the q", PASSAGE.encode()]
    flat, lengths = language_model.piece_stream(language_model.Words(texts), pieces)
    want = [[i for w in t.lower().split() for i in pieces.one(w)] + [language_model.END] for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and flat.tolist() == [i for w in want for i in w]


def test_learning_looks_only_at_places_that_count():
    rng = np.random.default_rng(2)
    at, real, scored = language_model.windows(np.array([70, 5, 200]))
    ids, target = rng.integers(0, 50, 275)[at].astype(np.int32), rng.integers(0, 41, 275)[at]
    model = language_model.Attention(language_model.Attention.fresh(50))
    whole = model.log_probability(ids, target, np.ones_like(scored))
    assert model.log_probability(ids, target, scored)[scored] == pytest.approx(whole[scored], rel=1e-4)
    # the step follows the slope of the loss
    loss = lambda: -model.log_probability(ids, target, scored)[scored].mean(dtype=np.float64)
    state, before = [np.zeros_like(w) for w in model.w], loss()
    old = [w.copy() for w in model.w]
    model.learn(ids, target, scored, state)
    slopes = [np.sqrt(s) for s in state]
    for i, j in ((1, (9, 3)), (2, (4, 20)), (2, (3, 2)), (3, (5, 5)), (4, (2, 7))):
        ends = []
        for step in (1e-2, -1e-2):
            model.w, model.tables = [w.copy() for w in old], []
            model.w[i][j] += step
            ends.append(loss())
        assert abs(ends[0] - ends[1]) / 2e-2 == pytest.approx(slopes[i][j], rel=0.05, abs=1e-4)
    assert loss() == pytest.approx(before, rel=0.1)
