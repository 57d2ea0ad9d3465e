"""The registered queries of the operators, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.llm import alignment, decontamination, embedding_dedup, importance, jaccard_join, language_model, pieces, quality, substring_dedup, token_count, url_filter, warc, winnowing

QUERIES = {}
CHECKS = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


JACCARD_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON m.a = d.doc_id
"""


@query("op6_jaccard_join", JACCARD_SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(C.documents(spark, folder), k=3, percent=90)


CONTAMINATION_SQL = """
WITH folded AS (
  SELECT doc_id AS id, false AS item, text FROM documents UNION ALL SELECT item_id, true, text FROM benchmark),
words AS (
  SELECT id, item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM folded),
item_windows AS (
  SELECT DISTINCT id, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM words WHERE item AND len(w) > 0)),
doc_windows AS (
  SELECT id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, (SELECT DISTINCT k FROM item_windows) WHERE NOT item AND len(w) >= k)),
hits AS (SELECT d.id, d.i, d.k, m.id AS item_id FROM doc_windows d JOIN item_windows m ON d.k = m.k AND d.g = m.g),
hit_words AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY id),
hit_items AS (
  SELECT id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT id, item_id::VARCHAR AS item_id FROM hits) GROUP BY id)
SELECT w.id AS doc_id, len(w.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h ON h.id = w.id LEFT JOIN hit_items t ON t.id = w.id WHERE NOT w.item
"""


@query("op2_decontamination", CONTAMINATION_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = C.documents(spark, folder).select(F.col("doc_id").alias("row"), "text")
    return decontamination.digest(decontamination.contamination(rows, C.table(spark, folder, "benchmark")))


@query("op5_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return token_count.token_counts(C.documents(spark, folder))


@query("op10_sentencepiece")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = pieces.encoded(C.documents(spark, folder))
    return found.select("doc_id", "n_pieces", "n_byte_pieces", F.xxhash64("pieces").alias("pieces_hash"), "decoded_equal")


@query("op8_winnowing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.fingerprints(C.documents(spark, folder))


@query("op9_quality_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(C.documents(spark, folder), C.table(spark, folder, "labels"))


@query("op7_lm_scoring")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.lm_scores(C.documents(spark, folder))


@query("op1_substring_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.paragraph_repeats(C.documents(spark, folder))


@query("op3_url_filter")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(C.table(spark, folder, "pages"))


WARC_SQL = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
kept AS (SELECT payload_digest, max(page_id) AS page_id FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.page_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k.page_id <> p.page_id THEN k.page_id END AS refers_to
FROM payloads p LEFT JOIN kept k ON k.payload_digest = p.payload_digest AND p.payload_bytes >= 1000
"""


@query("op4_warc", WARC_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived(C.table(spark, folder, "pages")).drop("uri")


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
IMPORTANCE_SQL = f"""
WITH texts AS (SELECT doc_id, true AS here, text FROM documents UNION ALL SELECT NULL, false, text FROM benchmark),
words AS (SELECT doc_id, here, regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
each AS (SELECT doc_id, here, unnest(w) AS f FROM words),
remainders AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
           lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)) AS t),
codes AS (
  SELECT f, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT)),
           lambda r, b: xor(r >> 8, t[(xor(r, b) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM each), remainders),
counts AS (
  SELECT bucket, count(*) FILTER (here) AS s, count(*) FILTER (NOT here) AS t FROM each JOIN codes USING (f) GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS big_s, sum(t)::DOUBLE AS big_t FROM counts),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1.0::DOUBLE) * (big_s + 10000)) / ((s + 1.0::DOUBLE) * (big_t + 10000))))::BIGINT AS gain
  FROM counts, totals),
summed AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM each JOIN codes USING (f) JOIN gain USING (bucket) WHERE here GROUP BY doc_id),
scored AS (
  SELECT w.doc_id, len(w.w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || w.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words w LEFT JOIN summed ON summed.doc_id = w.doc_id WHERE w.here),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN p.rank <= 10 * p.n // 100 THEN p.rank END AS rank
FROM scored s LEFT JOIN placed p ON p.doc_id = s.doc_id
"""


@query("op13_importance_resampling", IMPORTANCE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(C.documents(spark, folder), C.table(spark, folder, "benchmark"))


@query("op11_token_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.token_alignment(C.documents(spark, folder))


@query("op12_embedding_dedup")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(C.table(spark, folder, "embeddings"))
