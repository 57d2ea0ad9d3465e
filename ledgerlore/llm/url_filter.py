"""URL filter: rules on host and path, and gradient-boosted trees on lexical features for the rest.

The rules label URLs; the trees learn from those labels what the rules leave open. Features are length, depth, digit
share, entropy, parameter counts and the statistics of the host's suffix and of the path's first segment: how many URLs
have it, over the whole table, and the share of blocked ones among those that are labelled. A labelled URL's own host
does not enter its shares (hosts are dealt to folds, and its fold is left out), and a suffix or segment without labels
counts as the middle one of the labelled URLs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.session import materialise

#: (verdict, host, path)
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
FIT_URLS = 20_000  # labelled URLs that fit the trees, the first by hash
TREES, DEPTH, RATE, BINS, LEAST = 40, 3, 0.2, 32, 20
FOLDS = 5
SMOOTH = 20  # labelled URLs that the share of all counts as, in the share of one suffix or segment
#: Of features that split the labelled URLs alike the first is taken, so shares come before counts.
STATISTICS = ["suffix_blocked", "segment_blocked", "suffix_count", "segment_count"]
FEATURES = ["length", "host_length", "depth", "digits", "entropy", "parameters", "hyphens", "labels", *STATISTICS]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty for null or none."""
    return F.coalesce(C.lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``(verdict, rule)`` of the longest rule that fits, else null; of equally long ones a block, then by name."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        named = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))
        found = F.when(fits, named).otherwise(found)
    return found


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def segment_of(path: Column) -> Column:
    return F.regexp_extract(path, r"(?s)^/*([^/]*)", 1)


def lexical(url: str | None, host: str, path: str) -> list[float]:
    url = url or ""
    n = len(url)
    _, counts = np.unique(np.frombuffer(url.encode("utf-32-le"), np.uint32), return_counts=True)
    share = counts / max(n, 1)
    query = url.partition("?")[2].partition("#")[0]
    return [
        n,
        len(host),
        sum(1 for part in path.split("/") if part),
        sum(c.isdigit() for c in url) / max(n, 1),
        float(-(share * np.log2(share)).sum()),
        sum(1 for part in query.split("&") if part),
        host.count("-"),
        host.count(".") + 1 if host else 0,
    ]


class Trees:
    """Gradient-boosted trees on the log loss, with features cut into quantile bins; all splits of a level at once."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        binned, f = self._bins(x), np.full(len(x), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            f += self._leaf_values(tree, binned)

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, column, side="right") for c, column in zip(self.cuts, x.T)], axis=1)

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray):
        inner = (1 << DEPTH) - 1
        feature, cut = np.full(inner, -1), np.zeros(inner, np.int64)
        node = np.zeros(len(binned), np.int64)
        for level in range(DEPTH):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-6)
            for j in range(binned.shape[1]):
                place = (node - first) * BINS + binned[:, j]
                sums = [np.bincount(place, weights=w, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1) for w in (g, h, np.ones_like(g))]
                gl, hl, nl = (s[:, :-1] for s in sums)
                ga, ha, na = (s[:, -1:] for s in sums)
                gain = gl**2 / (hl + 1) + (ga - gl) ** 2 / (ha - hl + 1) - ga**2 / (ha + 1)
                gain = np.where((nl >= LEAST) & (na - nl >= LEAST), gain, -1)
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better] = top[better]
                feature[first : first + width][better] = j
                cut[first : first + width][better] = at[better]
            j = feature[node]
            right = (j >= 0) & (binned[np.arange(len(node)), np.maximum(j, 0)] > cut[node])
            node = 2 * node + 1 + right
        leaf = node - inner
        size = 1 << DEPTH
        value = RATE * np.bincount(leaf, weights=g, minlength=size) / (np.bincount(leaf, weights=h, minlength=size) + 1)
        return feature, cut, value

    def _leaf_values(self, tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(DEPTH):
            j = feature[node]
            node = 2 * node + 1 + ((j >= 0) & (binned[rows, np.maximum(j, 0)] > cut[node]))
        return value[node - ((1 << DEPTH) - 1)]

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned = self._bins(x)
        f = self.start + sum((self._leaf_values(t, binned) for t in self.trees), np.zeros(len(x)))
        return 1 / (1 + np.exp(-f))


def _features(batch: pa.RecordBatch) -> np.ndarray:
    """Columns url, host, path and ``STATISTICS`` to one matrix."""
    own = [lexical(*row) for row in zip(*(batch.column(i).to_pylist() for i in range(3)))]
    rest = np.stack([batch.column(3 + i).to_numpy(zero_copy_only=False) for i in range(len(STATISTICS))], axis=1)
    return np.concatenate([np.array(own, float).reshape(-1, len(FEATURES) - len(STATISTICS)), rest.astype(float)], axis=1)


def described(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``(page_id, url, host, path, found, fold, suffix_blocked, ...)`` for every row of ``pages``."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    rows = rows.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.select(
        "*",
        rule_of(F.col("host"), F.col("path"), rules).alias("found"),
        F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int").alias("fold"),
        suffix_of(F.col("host")).alias("suffix"),
        segment_of(F.col("path")).alias("segment"),
    )
    is_block = (F.col("found.verdict") == "block").cast("double")
    prior = rows.agg(F.coalesce(F.avg(is_block), F.lit(0.0))).first()[0]
    for key in ("suffix", "segment"):
        counts = [F.count(F.lit(1)).alias("n")]
        for name, value in (("blocked", F.coalesce(is_block, F.lit(0.0))), ("labelled", is_block.isNotNull().cast("double"))):
            counts += [F.sum(value).alias(name), F.array(*[F.sum(F.when(F.col("fold") == i, value).otherwise(0.0)) for i in range(FOLDS)]).alias(f"{name}_in")]
        statistics = materialise(rows.groupBy(key).agg(*counts), "urls")
        own = F.when(F.col("found").isNotNull(), F.col("fold"))

        def left(name: str, own=own) -> Column:
            return F.col(name) - F.coalesce(F.get(f"{name}_in", own), F.lit(0.0))

        # one suffix or segment may have most rows, so they are joined as heavy keys
        joined = C.join_groups(rows, statistics, key, "n")
        rows = joined.select(
            *rows.columns,
            F.log1p(F.col("n").cast("double")).alias(f"{key}_count"),
            ((left("blocked") + SMOOTH * prior) / (left("labelled") + SMOOTH)).alias(f"{key}_blocked"),
            (F.col("labelled") > 0).alias(f"{key}_known"),
        )
    rows = materialise(rows, "urls")
    # What no rule labels is like the middle one of the labelled URLs: its count must not say which class it is in.
    usual = rows.where(F.col("found").isNotNull()).agg(*[F.percentile_approx(c, 0.5).alias(c) for c in STATISTICS]).first()
    columns = {c: F.when(F.col(f"{c.split('_')[0]}_known"), F.col(c)).otherwise(F.coalesce(F.lit(usual[c]), F.col(c))) for c in STATISTICS}
    return rows.withColumns(columns).drop("suffix", "segment", "suffix_known", "segment_known")


def fit(rows: DataFrame) -> tuple[Trees | None, float]:
    """Trees learnt from the labelled ones among ``rows``, and the answer without trees, where they have one class only."""
    wanted = rows.where(F.col("found").isNotNull()).select("url", "host", "path", *STATISTICS, (F.col("found.verdict") == "block").alias("y"))
    sample = wanted.orderBy(F.xxhash64("url"), "url").limit(FIT_URLS).toArrow().combine_chunks()
    y = sample["y"].to_numpy().astype(float)
    model = Trees(_features(sample.to_batches()[0]), y) if len(np.unique(y)) == 2 else None
    return model, float(y[0]) if len(y) else 0.0


def scored(rows: DataFrame, model: tuple[Trees | None, float]) -> DataFrame:
    """``(page_id, host, path, found, blocked)`` of ``described`` rows."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, same = shipped.value
        for batch in batches:
            x = _features(batch)
            p = trees.probability(x) if trees and len(x) else np.full(len(x), same)
            columns = [*(batch.column(i) for i in (3 + len(STATISTICS), 1, 2, 4 + len(STATISTICS))), pa.array(p, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "found", "blocked"])

    shaped = rows.select("url", "host", "path", *STATISTICS, "page_id", "found")
    return shaped.mapInArrow(judge, shaped.select("page_id", "host", "path", "found", F.lit(0.0).alias("blocked")).schema)


def held_out(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``(blocked, label)`` of the labelled URLs of hosts that the trees have not seen: one fold of the hosts."""
    rows = described(pages, rules)
    found = scored(rows.where("fold = 0 AND found IS NOT NULL"), fit(rows.where("fold > 0")))
    return found.select("blocked", (F.col("found.verdict") == "block").alias("label"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, blocked)`` for every row of ``pages`` (page_id, url).

    ``blocked`` is the trees' probability that a URL like it is blocked, for all rows; ``verdict`` is the rule's, else
    block from 0.5. A null URL and one without ``://`` have an empty host and path and go to the trees like others. If
    the labelled URLs are of one class, that class is the answer; without labelled URLs the verdict is allow. Repeated
    rows give repeated results; other columns are not read.
    """
    rows = described(pages, rules)
    return scored(rows, fit(rows)).select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("blocked") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "blocked",
    )
