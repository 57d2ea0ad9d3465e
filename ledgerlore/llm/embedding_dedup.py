"""Embedding near-dedup: a robust-pruned flat graph built on overlapping cluster shards, and range-expanding search.

1. Equal vectors become one point with a number of copies.
2. Points are dealt to cells by k-means on a bounded sample; a cell above ``CELL`` points is split again by a sample of
   its own. Each split puts a point into its nearest cell, its *home*, and at first also into the next ``OVERLAP`` ones.
3. In each cell every point gets robust-pruned neighbours, and the cell's medoid is joined to whatever it cannot reach.
   The lists of a point from all its cells are united.
4. A search task holds one cell: its home points with their lists, and the neighbours that live elsewhere. From the
   medoid and the entry point a greedy beam search finds the query's surroundings, then all points within the range are
   expanded until no more come. Hits are verified in double precision, and counted only where they are at home, so
   a pair is counted once and never shipped. Neighbours within reach that live elsewhere send the query to their cells;
   rounds go on until no query has a cell left to visit.
5. An audit compares a bounded sample of points with all others; below ``RECALL`` the index is built again with more
   overlap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlore.llm import common as C
from ledgerlore.session import materialise

THRESHOLD = 0.9
CELL = 2048  # points of a cell, which is what one task compares at once
CHILDREN = 256
FIT_VECTORS = 4096  # rows of a cell that its centres are learnt from
DEALT = 16_384  # points that one task deals to the children of a cell
OVERLAP = 2
DEGREE, ALPHA, NEAREST = 24, 1.2, 64
BEAM = 24
SLACK = 0.05  # points this far below the threshold are still expanded
AUDIT, RECALL, ATTEMPTS = 512, 0.98, 3


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def points_of(rows: DataFrame) -> DataFrame:
    """``(pid, vector, first, copies)``: distinct usable vectors of ``rows`` (vec_id, embedding), scaled to length 1.

    A vector is usable if it has components, all of them finite, and a length. ``pid`` is a 64-bit hash of the vector.
    """
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    largest = F.array_max(F.transform("vector", F.abs))
    # Scaled by the largest component first, so that no square leaves the range of doubles.
    safe = F.transform("vector", lambda x: x / F.col("largest"))
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    read = rows.select(F.col("vec_id").cast("long").alias("vec_id"), key_of().alias("pid"), doubles.alias("vector"))
    usable = read.where(F.col("pid").isNotNull()).withColumn("largest", largest)
    usable = usable.where(F.col("largest") > 0)
    found = usable.groupBy("pid").agg(
        F.first("vector").alias("vector"), F.first("largest").alias("largest"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    unit = F.transform("vector", lambda x: x / F.col("length"))
    scaled = found.withColumn("vector", safe).withColumn("length", length)
    return materialise(scaled.select("pid", unit.alias("vector"), "first", "copies"), "embeddings")


def key_of() -> Column:
    """The point of an embedding, null for one that is not usable but for its length; -0.0 is 0.0."""
    doubles = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))  # not so for NaN
    return F.when(finite & (F.size("embedding") > 0), F.xxhash64(doubles))


def k_means(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Centres of length 1 of at most ``k`` groups of the sample, by spherical k-means."""
    rng = np.random.default_rng(len(sample))
    centres = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres


def cells_of(points: DataFrame, overlap: int, cell: int = CELL, children: int = CHILDREN) -> DataFrame:
    """``(pid, vector, cell, home)``: each point in its home cell and in overlapping ones; no cell above ``cell`` rows.

    Cells are split until all are small enough. Every copy of a point goes to its nearest child; the first split also
    puts points into the ``overlap`` next ones, and later ones a home copy into the second nearest. Children whose points are too alike to
    part (one child gets all) are parted by a hash of the point.
    """
    rows = points.select("pid", "vector", F.lit(0).cast("long").alias("cell"), F.lit(True).alias("home"))
    total = points.count()
    if total <= cell:
        return rows
    split, done, depth = rows.withColumn("m", F.lit(total).cast("long")), None, 0
    while True:
        share = F.lit(float(FIT_VECTORS)) / F.col("m")
        drawn = split.where(F.pmod(F.xxhash64("pid", "home", F.lit(depth)), F.lit(1 << 30)) < share * float(1 << 30))

        def fit(group: pa.Table) -> pa.Table:
            m = group["m"][0].as_py()
            k = max(2, min(children, math.ceil(2 * (1 + overlap) * m / cell)))
            group = group.take(np.argsort(group["pid"].to_numpy(), kind="stable"))
            centres = k_means(matrix(group["vector"]), k)
            return pa.table({"cell": group["cell"].slice(0, 1), "m": pa.array([m]), "centres": pa.array([centres.ravel().tolist()])})

        centres = drawn.select("cell", "m", "pid", "vector").groupBy("cell").applyInArrow(fit, "cell long, m long, centres array<double>")
        centres = materialise(centres, "embeddings")
        places = 1 + overlap if depth == 0 else 2

        def deal(left: pa.Table, right: pa.Table) -> pa.Table:
            own, pid, home = matrix(left["vector"]), left["pid"].to_numpy(), left["home"].to_numpy(zero_copy_only=False)
            middle = matrix(right["centres"]).reshape(-1, own.shape[1])
            parent = np.uint64(left["cell"][0].as_py() & 0xFFFFFFFFFFFFFFFF)
            order = np.argsort(-(own @ middle.T), axis=1, kind="stable")[:, :places]
            if (middle == middle[0]).all():  # nothing to tell the points apart by
                order = (C.mixed(pid.view(np.uint64)) % np.uint64(len(middle))).astype(np.int64)[:, None]
            take, place = np.nonzero((np.arange(order.shape[1]) == 0) | home[:, None])
            child = C.mixed(parent * np.uint64(0x9E3779B97F4A7C15) + order[take, place].astype(np.uint64) + np.uint64(1))
            rows = left.select(["pid", "vector"]).take(take)
            return rows.append_column("cell", pa.array(C.signed(child))).append_column("home", pa.array(home[take] & (place == 0)))

        chunks = F.ceil(F.col("m") / DEALT).cast("int")
        asked = split.withColumn("chunk", F.pmod(F.xxhash64("pid"), chunks).cast("int")).drop("m")
        held = centres.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1))).drop("m")
        dealt = asked.groupBy("cell", "chunk").cogroup(held.groupBy("cell", "chunk")).applyInArrow(deal, rows.schema)
        rows = materialise(dealt, "embeddings")
        depth += 1
        sizes = materialise(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("m")), "embeddings")
        marked = C.join_groups(rows, sizes, "cell", "m")
        small, split = marked.where(F.col("m") <= cell).drop("m"), marked.where(F.col("m") > cell)
        done = small if done is None else done.unionByName(small)
        if sizes.where(F.col("m") > cell).isEmpty():
            return done


def pruned(own: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, nearest: int = NEAREST) -> np.ndarray:
    """Robust-pruned neighbours of each vector, nearest first, filled up with -1.

    Of the ``nearest`` other vectors the closest one is taken, those go that are ``alpha`` times closer to it than to
    the vector itself, and so on until ``degree`` are taken.
    """
    n = len(own)
    width = min(nearest, n - 1)
    out = np.full((n, max(1, min(degree, width))), -1, np.int64)
    for start in range(0, n if width > 0 else 0, 128):
        at = np.arange(start, min(n, start + 128))
        close = own[at] @ own.T
        close[np.arange(len(at)), at] = -np.inf
        near = np.argpartition(-close, width - 1, axis=1)[:, :width]
        score = np.take_along_axis(close, near, axis=1)
        order = np.argsort(-score, axis=1, kind="stable")
        near, score = np.take_along_axis(near, order, axis=1), np.take_along_axis(score, order, axis=1)
        away = np.sqrt(np.maximum(0, 2 - 2 * score))
        among = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("icd,ied->ice", own[near], own[near])))
        alive = np.ones(near.shape, bool)
        row = np.arange(len(at))
        for step in range(out.shape[1]):
            first = alive.argmax(axis=1)
            left = alive[row, first]
            out[at[left], step] = near[row[left], first[left]]
            alive &= ~(left[:, None] & (alpha * among[row, first] <= away))
            alive[row, first] = False
    return out


def reachable(edges: np.ndarray, start: int) -> np.ndarray:
    seen = np.zeros(len(edges) + 1, bool)
    front = np.array([start])
    seen[start] = seen[-1] = True
    while len(front):
        front = np.unique(edges[front])
        front = front[~seen[front]]
        seen[front] = True
    return seen[:-1]


def graph(cells: DataFrame, reach: float) -> DataFrame:
    """``(pid, cell, medoid, neighbours, close)`` for every row of ``cells``: pruned lists, both ways, all reachable.

    ``close`` are the neighbours with a cosine of ``reach`` or more.
    """

    def build(group: pa.Table) -> pa.Table:
        group = group.take(np.argsort(group["pid"].to_numpy(), kind="stable"))
        pid, own = group["pid"].to_numpy(), matrix(group["vector"])
        out = pruned(own)
        middle = own @ own.mean(axis=0)
        medoid = int(np.where(group["home"].to_numpy(zero_copy_only=False), middle, middle - 4).argmax())  # one at home here
        back: list[list[int]] = [[] for _ in pid]
        for place in range(min(out.shape[1], DEGREE // 3)):  # the nearest ones know of it as well
            for i, to in enumerate(out[:, place].tolist()):
                if to >= 0 and len(back[to]) < DEGREE:
                    back[to].append(i)
        lists = [np.unique(np.append(row[row >= 0], b)).astype(np.int64) for row, b in zip(out, back)]
        width = max(map(len, lists))
        padded = np.full((len(pid), width + 1), len(pid), np.int64)
        for i, row in enumerate(lists):
            padded[i, : len(row)] = row
        seen = reachable(padded, medoid)
        while not seen.all():  # each part that is left hangs on to the seen point nearest to one of its points
            lost = int(np.flatnonzero(~seen)[0])
            at = np.flatnonzero(seen)
            to = int(at[(own[at] @ own[lost]).argmax()])
            lists[to] = np.append(lists[to], lost)
            seen |= reachable(padded, lost)
        n = len(pid)
        return pa.table(
            {
                "pid": group["pid"],
                "cell": group["cell"],
                "medoid": pa.array(np.arange(n) == medoid),
                "neighbours": C.lists([pid[x] for x in lists], pa.int64()),
                "close": C.lists([pid[x[own[x] @ v >= reach]] for x, v in zip(lists, own)], pa.int64()),
            }
        )

    rows = cells.select("pid", "cell", "vector", "home").groupBy("cell").applyInArrow(build, "pid long, cell long, medoid boolean, neighbours array<long>, close array<long>")
    return materialise(rows, "embeddings")


class Cell:
    """One cell's searchable part of the graph: home points with lists, neighbours from elsewhere without."""

    def __init__(self, nodes: pa.Table):
        nodes = nodes.take(np.argsort(nodes["pid"].to_numpy(), kind="stable"))
        self.pid, self.vectors = nodes["pid"].to_numpy(), matrix(nodes["vector"])
        self.home = nodes["home"].to_numpy().astype(np.int64)
        self.own = self.home == nodes["cell"][0].as_py()
        self.copies = nodes["copies"].to_numpy()
        n = len(self.pid)
        lists = [x[np.isin(x, self.pid)] for x in C.list_rows(nodes["neighbours"], np.int64)]
        lists = [np.searchsorted(self.pid, x) for x in lists]
        self.edges = np.full((n + 1, max(1, max(map(len, lists)))), n, np.int64)
        for i, row in enumerate(lists):
            self.edges[i, : len(row)] = row
        self.entries = np.flatnonzero(nodes["medoid"].to_numpy(zero_copy_only=False))

    def within(self, query: np.ndarray, entries: np.ndarray, threshold: float, slack: float = SLACK) -> tuple[np.ndarray, np.ndarray]:
        """All points found at ``threshold - slack`` and above, and their cosines."""
        seen = np.zeros(len(self.pid) + 1, bool)
        seen[-1] = True
        start = np.unique(np.concatenate([self.entries, entries]))
        seen[start] = True
        found, score = start, self.vectors[start] @ query
        expanded = np.zeros(len(start), bool)
        while True:  # greedy: the four best points not yet expanded, while they are among the ``BEAM`` best
            best = np.argpartition(-score, BEAM)[:BEAM] if len(score) > BEAM else np.arange(len(score))
            best = best[~expanded[best]]
            if not len(best):
                break
            best = best[np.argsort(-score[best])[:4]]
            expanded[best] = True
            more = np.unique(self.edges[found[best]])
            more = more[~seen[more]]
            seen[more] = True
            found, score = np.append(found, more), np.append(score, self.vectors[more] @ query)
            expanded = np.append(expanded, np.zeros(len(more), bool))
        while True:  # range: whatever lies within reach, until nothing new does
            front = np.flatnonzero(~expanded & (score >= threshold - slack))
            if not len(front):
                break
            expanded[front] = True
            more = np.unique(self.edges[found[front]])
            more = more[~seen[more]]
            seen[more] = True
            found, score = np.append(found, more), np.append(score, self.vectors[more] @ query)
            expanded = np.append(expanded, np.zeros(len(more), bool))
        near = score >= threshold - slack
        return found[near], score[near]


def visited(queries: DataFrame, nodes: DataFrame, threshold: float, purpose: str = "embeddings") -> DataFrame:
    """One round: the queries (pid, cell, entry) searched in their cells, as a written table of four kinds of rows.

    ``(pid, n, other, cell)``: ``n`` copies of hits at home in the cell; or a link (pid, other) that connects; or, with
    ``cell``, the cell where the search goes on from ``other``.
    """
    chunks = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).cast("int").alias("chunks"), F.count(F.lit(1)).alias("m"))
    chunks = materialise(chunks, purpose)
    dealt = C.join_groups(queries, chunks, "cell", "m").withColumn("chunk", F.pmod(F.xxhash64("pid"), F.col("chunks")).cast("int"))
    asked = dealt.select("cell", "chunk", "pid", "vector", "entry")
    held = C.join_groups(nodes, chunks, "cell", "chunks").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    held = held.select("cell", "chunk", "pid", "vector", "home", "copies", "medoid", "neighbours")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: dict[str, list[np.ndarray]] = {"pid": [], "n": [], "other": [], "cell": []}

        def add(pid, n, other, cell):
            for name, values in zip(columns, np.broadcast_arrays(pid, n, other, cell)):
                columns[name].append(np.atleast_1d(values).astype(np.int64))

        if left.num_rows and right.num_rows:
            cell = Cell(right)
            pids, asked = left["pid"].to_numpy(), matrix(left["vector"])
            entries = np.searchsorted(cell.pid, left["entry"].to_numpy())
            extra = np.setdiff1d(pids, cell.pid)
            names = np.concatenate([cell.pid, extra])
            label = np.arange(len(names))
            here = np.where(np.isin(pids, cell.pid), np.searchsorted(cell.pid, pids), len(cell.pid) + np.searchsorted(extra, pids))
            for pid, query, entry, at in zip(pids.tolist(), asked, entries, here.tolist()):
                found, score = cell.within(query, entry[None], threshold)
                other = cell.pid[found] != pid
                found, score = found[other], score[other]
                hit = score >= threshold
                at_home = hit & cell.own[found]
                add(pid, int(cell.copies[found[at_home]].sum()), 0, 0)
                same = np.unique(label[np.append(found[hit], at)])
                if len(same) > 1:
                    label[np.isin(label, same)] = same[0]
                away = np.flatnonzero(~cell.own[found])
                if len(away):
                    away = away[np.lexsort((-score[away], cell.home[found[away]]))]
                    homes, first = np.unique(cell.home[found[away]], return_index=True)
                    add(pid, -1, cell.pid[found[away[first]]], homes)
            tied = np.flatnonzero(label != np.arange(len(label)))
            add(names[tied], -2, names[label[tied]], 0)
        arrays = [pa.array(np.concatenate(v) if v else np.empty(0, np.int64), pa.int64()) for v in columns.values()]
        return pa.table(arrays, names=list(columns))

    found = asked.groupBy("cell", "chunk").cogroup(held.groupBy("cell", "chunk")).applyInArrow(search, "pid long, n long, other long, cell long")
    return materialise(found, purpose)


def searched(points: DataFrame, overlap: int, threshold: float, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """``(pid, n)``: linked copies of other points; and links (a, b) that connect what all links do."""
    placed = materialise(cells_of(points, overlap, cell), "embeddings")
    # Of two points within reach of a query, one reached through the other, the angle is twice that reach at most.
    lists = graph(placed, 2 * (threshold - SLACK) ** 2 - 1)
    homes = materialise(placed.where("home").select("pid", "cell"), "embeddings")
    united = lists.groupBy("pid").agg(
        *[F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("neighbours", "close")]
    )
    medoids = lists.where("medoid").select("cell", "pid", "medoid")
    at_home = homes.join(united, "pid").join(medoids, ["cell", "pid"], "left")
    at_home = materialise(at_home.select("pid", "cell", F.coalesce("medoid", F.lit(False)).alias("medoid"), "neighbours", "close"), "embeddings")
    # Neighbours from elsewhere have no lists here; only those count that a search can have within its range.
    around = at_home.select("cell", F.explode("close").alias("pid")).distinct()
    around = around.join(homes, ["cell", "pid"], "left_anti")
    none = F.array().cast("array<long>")
    shown = at_home.drop("close").unionByName(around.select("pid", "cell", F.lit(False).alias("medoid"), none.alias("neighbours")))
    facts = points.select("pid", "vector", "copies").join(homes.withColumnRenamed("cell", "home"), "pid")
    nodes = materialise(shown.join(facts, "pid"), "embeddings")
    asked = homes.join(points.select("pid", "vector"), "pid").withColumn("entry", F.col("pid"))
    done = homes
    results = []
    while True:
        found = visited(asked, nodes, threshold)
        results.append(found)
        ahead = found.where(F.col("n") == -1).groupBy("pid", "cell").agg(F.min("other").alias("entry"))
        ahead = materialise(ahead.join(done, ["pid", "cell"], "left_anti"), "embeddings")
        if ahead.isEmpty():
            break
        asked = ahead.join(points.select("pid", "vector"), "pid")
        done = done.unionByName(ahead.select("pid", "cell"))
    rows = results[0]
    for more in results[1:]:
        rows = rows.unionByName(more)
    counts = rows.where(F.col("n") >= 0).groupBy("pid").agg(F.sum("n").alias("n"))
    return materialise(counts, "embeddings"), rows.where(F.col("n") == -2).select(F.col("pid").alias("a"), F.col("other").alias("b"))


def exact_counts(points: DataFrame, asked: DataFrame, threshold: float, block: int = AUDIT) -> DataFrame:
    """``(pid, n)``: linked copies of other points for each of ``asked`` (pid, vector), against all points.

    ``asked`` is a stated query set: it travels in blocks to the points, which stay in place and give partial counts.
    """
    wanted = asked.select("pid", "vector").sort("pid").toArrow()
    out = []
    for start in range(0, wanted.num_rows, block):
        part = wanted.slice(start, block)
        shipped = points.sparkSession.sparkContext.broadcast((part["pid"].to_numpy(), matrix(part["vector"])))

        def compare(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            pids, queries = shipped.value
            total = np.zeros(len(pids), np.int64)
            for batch in C.arrow_rows(batches, 2048):
                if batch.num_rows:
                    linked = (matrix(batch.column(1)) @ queries.T >= threshold) & (batch.column(0).to_numpy()[:, None] != pids)
                    total += batch.column(2).to_numpy() @ linked
            yield pa.RecordBatch.from_arrays([pa.array(pids), pa.array(total)], names=["pid", "n"])

        out.append(points.select("pid", "vector", "copies").mapInArrow(compare, "pid long, n long"))
    rows = out[0] if out else points.select("pid", F.lit(0).cast("long").alias("n")).limit(0)
    for more in out[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("pid").agg(F.sum("n").alias("n"))


def recall(points: DataFrame, counts: DataFrame, threshold: float, sample: int = AUDIT) -> float:
    """Share of the links of ``sample`` points, drawn by a hash, that ``counts`` has; 1 if they have none."""
    total = max(1, points.count())
    drawn = points.where(F.pmod(F.xxhash64("pid", F.lit(7)), F.lit(1 << 30)) < min(1.0, sample / total) * (1 << 30))
    exact = exact_counts(points, drawn, threshold).withColumnRenamed("n", "exact")
    found, all_links = exact.join(counts, "pid", "left").agg(F.sum(F.coalesce("n", F.lit(0))), F.sum("exact")).first()
    return found / all_links if all_links else 1.0


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, cell: int = CELL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``rows`` (vec_id, embedding).

    Two rows are linked if the cosine of their vectors is ``threshold`` or more; ``n_links`` counts the other rows that a
    row is linked to directly, ``component_id`` is the smallest vec_id that links reach, the row's own included, and
    ``kept`` says that it is the row's own. No link below the threshold is ever counted; the share of links found is
    audited on a bounded sample.

    Null and empty vectors, vectors of zeros and vectors with a null, NaN or infinite component are linked with nothing.
    Vectors of different sizes are never compared. Rows that share an id are rows of their own; a null id is passed over
    when the smallest is looked for, and ``kept`` is false for it. Other columns are not read.
    """
    read = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    sizes = [r[0] for r in read.select(F.size("embedding").alias("size")).where("size > 0").distinct().sort("size").collect()]
    keyed = read.select("vec_id", key_of().alias("pid"))
    labels = None
    for size in sizes:
        found = _labels(read.where(F.size("embedding") == size), threshold, overlap, cell)
        labels = found if labels is None else labels.unionByName(found)
    found = keyed.where(F.col("pid").isNull() if labels is not None else F.lit(True)).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    if labels is not None:
        joined = C.join_groups(keyed.where(F.col("pid").isNotNull()), materialise(labels, "embeddings"), "pid", "copies", "left")
        found = found.unionByName(
            joined.select(
                "vec_id",
                F.coalesce(F.col("n") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
                F.coalesce("smallest", "vec_id").alias("component_id"),
            )
        )
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _labels(rows: DataFrame, threshold: float, overlap: int, cell: int) -> DataFrame:
    """``(pid, n, copies, smallest)`` of the points of vectors of one size."""
    points = points_of(rows)
    for attempt in range(ATTEMPTS):
        counts, links = searched(points, overlap + 2 * attempt, threshold, cell)
        if recall(points, counts, threshold) >= RECALL:
            break
    groups = materialise(C.components(links, "embeddings"), "embeddings")
    placed = points.select("pid", "first", "copies").join(groups.withColumnRenamed("id", "pid"), "pid", "left")
    placed = materialise(placed.withColumn("component", F.coalesce("component", "pid")), "embeddings")
    smallest = placed.groupBy("component").agg(F.min("first").alias("smallest"), F.count(F.lit(1)).alias("m"))
    labelled = C.join_groups(placed, materialise(smallest, "embeddings"), "component", "m").join(counts, "pid", "left")
    return labelled.select("pid", F.coalesce("n", F.lit(0)).alias("n"), "copies", "smallest")
