"""Approximate nearest neighbours by inner product, over balanced posting lists.

* A bounded sample is halved at its middle again and again; the centres of the parts, equally full, are the lists.
* Every vector is put into its nearest lists, and not in one alone where it lies near a boundary.
* A query finds its nearest centres along a graph kept in memory, and drops those that are
  much farther away than the nearest one.
* Lists are joined with the queries that want them, in blocks of bounded size; the product with every vector of
  a block is exact.

Centres, graph and list sizes are the only things sent to all executors; their number is bounded.
The largest product is the smallest distance once every vector is given one more component that makes all
lengths equal; lists live in that space.

Equal vectors are searched once: only the smallest ids of a group can be among the nearest of any query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.common import map_batches, sealed

K = 20

# Vectors the lists are fitted on at most, those of least hash.
FITTED_ON = 32_768

# Vectors of a list, before copies, and how many lists there may be.
LIST_SIZE = 128
LISTS = 4_096

# Lists a vector is copied to at most, and how much farther than the nearest they may be.
COPIES = 4
COPY_RATIO = 1.1

# Lists a query looks into at most: so many, or this share of all. Vectors without any structure need the share, for others the
# ratio of distances leaves few. Then candidates a query has before lists are dropped.
PROBES = 64
PROBE_SHARE = 0.2
PROBE_RATIO = 1.6
LEAST_CANDIDATES = 4_000

# Links of a centre in the graph.
LINKS = 16

# Vectors of a list that meet its queries in one task.
BLOCK = 8_192


def _halves(x: np.ndarray, at: np.ndarray, parts: int) -> Iterator[np.ndarray]:
    """Split points into ``parts`` parts of equal number, by nearness."""
    if parts <= 1 or len(at) < 2:
        yield at
        return
    points = x[at]
    a, b = points[0], points[np.argmax(((points - points[0]) ** 2).sum(1))]
    left = parts // 2
    size = len(at) * left // parts
    order = np.arange(len(at))
    for _ in range(8):
        side = ((points - a) ** 2).sum(1) - ((points - b) ** 2).sum(1)
        order = np.argsort(side, kind="stable")
        if size == 0 or size == len(at):
            break
        a, b = points[order[:size]].mean(0), points[order[size:]].mean(0)
    yield from _halves(x, at[order[:size]], left)
    yield from _halves(x, at[order[size:]], parts - left)


@dataclass
class Index:
    """Centres of lists and a graph over them."""

    centres: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    length: float

    @classmethod
    def fit(cls, sample: np.ndarray, length: float, lists: int) -> Index:
        x = lifted(sample, length)
        parts = [p for p in _halves(x, np.arange(len(x)), min(lists, max(len(x), 1))) if len(p)]
        centres = np.array([x[p].mean(0) for p in parts])
        n = len(centres)
        squares = (centres**2).sum(1)
        near = np.empty((n, min(LINKS, n)), np.int64)
        for a in range(0, n, 512):
            d = squares[None] - 2 * centres[a : a + 512] @ centres.T
            near[a : a + 512] = np.argsort(d, axis=1, kind="stable")[:, : near.shape[1]]
        # A ring keeps the graph in one piece; far links shorten the way.
        step = np.arange(n)
        more = [(step + s) % n for s in (1, n // 2, n // 3, n // 7)]
        return cls(centres, np.column_stack([near, *more]), np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int64)), length)

    def search(self, points: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` nearest centres of each point and their distances, best first.

        All points walk at once: each opens the nearest centre of its pool that is not opened yet, and stops when the pool,
        ``width`` wide, is all opened.
        """
        n, rows = len(self.centres), np.arange(len(points))[:, None]
        width = min(max(width, k), n)
        squares = (self.centres**2).sum(1)
        own = (points**2).sum(1)

        def distance(at: np.ndarray, some: np.ndarray) -> np.ndarray:
            d = squares[at] - 2 * np.einsum("bkd,bd->bk", self.centres[at], points[some]) + own[some][:, None]
            return np.sqrt(np.maximum(d, 0))

        seen = np.zeros((len(points), n), bool)
        entries = np.broadcast_to(self.entries, (len(points), len(self.entries)))
        seen[rows, entries] = True
        pool = np.full((len(points), width + len(self.entries)), -1)
        far = np.full(pool.shape, np.inf)
        opened = np.ones(pool.shape, bool)
        pool[:, : entries.shape[1]], far[:, : entries.shape[1]] = entries, distance(entries, rows[:, 0])
        opened[:, : entries.shape[1]] = False
        active = rows[:, 0]
        while len(active):
            waiting = np.where(opened[active], np.inf, far[active])
            best = waiting.argmin(1)
            going = np.isfinite(waiting[np.arange(len(active)), best])
            active, best = active[going], best[going]
            if not len(active):
                break
            opened[active, best] = True
            to = self.links[pool[active, best]]
            new = ~seen[active[:, None], to]
            for c in range(1, to.shape[1]):  # a centre linked twice counts once
                new[:, c] &= ~(to[:, :c] == to[:, c : c + 1]).any(1)
            seen[active[:, None], to] = True
            d = np.where(new, distance(to, active), np.inf)
            all_far = np.concatenate([far[active], d], 1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, : pool.shape[1]]
            pick = lambda a, b: np.take_along_axis(np.concatenate([a, b], 1), order, 1)  # noqa: E731,B023
            pool[active] = pick(pool[active], to)
            opened[active] = pick(opened[active], ~new)
            far[active] = np.take_along_axis(all_far, order, 1)
            late = np.arange(pool.shape[1]) >= width
            opened[np.ix_(active, late)] = True
        order = np.argsort(far, axis=1, kind="stable")[:, : min(k, n)]
        return np.take_along_axis(pool, order, 1), np.take_along_axis(far, order, 1)


def lifted(x: np.ndarray, length: float) -> np.ndarray:
    """Vectors with one more component that makes all lengths equal."""
    rest = np.sqrt(np.maximum(length**2 - (x**2).sum(1), 0))
    return np.column_stack([x, rest])


def _matrix(column: pa.Array) -> np.ndarray:
    rows = column.to_pylist() if not len(column) else None
    if rows == []:
        return np.empty((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows ``(vec_id, embedding)`` that take part, each once, all of the length that most have."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0)
    )
    common = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("embedding") == F.lit(common.n if common else 0)).distinct()


def _copied(nodes: DataFrame, index, length: float) -> DataFrame:
    """``(list, node, embedding)``: every vector in its nearest lists."""
    shared = nodes.sparkSession.sparkContext.broadcast(index)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = lifted(_matrix(batch.column(1)), length)
        at, far = shared.value.search(x, COPIES, 4 * COPIES)
        keep = far <= COPY_RATIO * far[:, :1]
        row, column = np.nonzero(keep)
        taken = batch.take(pa.array(row))
        return pa.RecordBatch.from_arrays([pa.array(at[row, column], pa.int64()), *taken.columns], ["list", "node", "embedding"])

    return map_batches(nodes.select("node", "embedding"), run, "list BIGINT, node BIGINT, embedding ARRAY<DOUBLE>")


def _wanted(queries: DataFrame, index, sizes: dict[int, int]) -> DataFrame:
    """``(list, query, vector)``: the lists each query looks into."""
    shared = queries.sparkSession.sparkContext.broadcast((index, sizes))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, counts = shared.value
        x = _matrix(batch.column(1))
        # A query's length changes no order; as long as all vectors it lies among them.
        x = x / np.sqrt((x**2).sum(1))[:, None] * own.length
        probes = max(PROBES, int(PROBE_SHARE * len(own.centres)))
        at, far = own.search(np.column_stack([x, np.zeros(len(x))]), probes, probes + probes // 2)
        filled = np.array([counts.get(i, 0) for i in range(len(own.centres))])
        before = np.cumsum(filled[at], axis=1) - filled[at]
        keep = (far <= PROBE_RATIO * far[:, :1]) | (before < LEAST_CANDIDATES)
        row, column = np.nonzero(keep)
        lists = at[row, column]
        short = np.flatnonzero(np.where(keep, filled[at], 0).sum(1) < LEAST_CANDIDATES)
        if len(short):  # too few candidates: every list
            other = ~np.isin(row, short)
            row = np.concatenate([row[other], np.repeat(short, len(own.centres))])
            lists = np.concatenate([lists[other], np.tile(np.arange(len(own.centres)), len(short))])
        taken = batch.take(pa.array(row))
        return pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), *taken.columns], ["list", "query", "vector"])

    schema = "list BIGINT, query BIGINT, vector ARRAY<DOUBLE>"
    return map_batches(queries.select(F.col("node").alias("query"), "embedding"), run, schema)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products added up component by component, so a pair's does not depend on what surrounds it."""
    sums = np.zeros((len(queries), len(vectors)))
    for j in range(queries.shape[1]):
        sums += queries[:, j, None] * vectors[None, :, j]
    return sums


def _best_of_block(k: int):
    def best(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out_query, out_node, out_score = [], [], []
        if len(queries) and len(vectors):
            v = _matrix(vectors["embedding"].combine_chunks())
            nodes = vectors["node"].to_numpy()
            ids, q = queries["query"].to_numpy(), _matrix(queries["vector"].combine_chunks())
            for a in range(0, len(q), 256):
                scores = products(q[a : a + 256], v)
                least = np.partition(scores, -k, axis=1)[:, -k] if len(v) > k else scores.min(1)
                row, column = np.nonzero(scores >= least[:, None])
                out_query.append(ids[a + row])
                out_node.append(nodes[column])
                out_score.append(scores[row, column])
        cat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.Table.from_arrays(
            [cat(out_query, pa.int64()), cat(out_node, pa.int64()), cat(out_score, pa.float64())], ["query", "node", "score"]
        )

    return best


def nearest(vectors: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest other rows of each row whose id ``every`` divides.

    Nearness is the largest inner product in double precision, ties go to the smaller id; with fewer than ``k`` other rows
    all are returned. Vectors that are NULL, zero, empty or hold NULL or non-finite components, rows with a NULL id, and
    vectors of another length than most take no part. Repeated rows are one row. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = sealed(usable(vectors), "neighbours-rows")
    nodes = sealed(rows.groupBy("embedding").agg(F.min("vec_id").alias("node")), "neighbours-nodes")
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    total = nodes.agg(F.count("*").alias("n"), F.max(square).alias("square")).first()
    schema = "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE"
    if not total.n:
        return spark.createDataFrame([], schema)
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(FITTED_ON).select("embedding").toArrow()
    length = float(np.sqrt(total.square)) * (1 + 1e-9)
    lists = int(np.clip(total.n // LIST_SIZE, 1, LISTS))
    index = Index.fit(_matrix(sample["embedding"].combine_chunks()), length, lists)
    postings = sealed(_copied(nodes, index, length), "neighbours-postings")
    sizes = {r.list: r.n for r in postings.groupBy("list").agg(F.count("*").alias("n")).collect()}
    # Every member of an equal group has its node; a group's smallest ids are enough for any query.
    members = sealed(
        rows.join(nodes, "embedding").select("node", "vec_id"), "neighbours-members"
    )
    by_id = Window.partitionBy("node").orderBy("vec_id")
    few = members.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1).drop("r")
    asking = members.where(F.pmod("vec_id", F.lit(every)) == 0).select("node", F.col("vec_id").alias("query_id"))
    asked = nodes.join(asking.select("node").distinct(), "node")
    wanted = _wanted(asked, index, sizes)
    # Lists that hold more than a block, from a table as bounded as the lists.
    large = {i: -(-n // BLOCK) for i, n in sizes.items() if n > BLOCK}
    n_blocks = F.lit(1)
    if large:
        n_blocks = F.coalesce(F.create_map(*[F.lit(x) for pair in large.items() for x in pair])[F.col("list")], n_blocks)
    placed = postings.withColumn("block", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
    wanted = wanted.withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    found = (
        wanted.groupBy("list", "block").cogroup(placed.groupBy("list", "block"))
        .applyInArrow(_best_of_block(k + 1), "query BIGINT, node BIGINT, score DOUBLE")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    top = sealed(
        found.distinct().withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "neighbours-top"
    )
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = top.join(few, "node").withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= k + 1)
    # Written: Spark splits a crowded key, a vector that very many queries share, only between two plain shuffles.
    ranked = sealed(ranked.select(F.col("query").alias("node"), "vec_id", "score"), "neighbours-ranked")
    answer = asking.join(ranked, "node").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answer.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
