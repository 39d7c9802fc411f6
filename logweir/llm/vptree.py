"""Nearest neighbours by largest inner product, with vantage-point trees per shard.

Inner products become distances by one more dimension: with M the largest norm, a vector x is completed by
sqrt(M^2 - |x|^2) and a query by 0, so that |q - x|^2 = |q|^2 + M^2 - 2 q.x, and the nearest is the one with the
largest inner product.

The top levels of one vantage-point tree, grown on a bounded sample, cut space into regions. Every vector belongs to a region, and of
each region the range of distances to the vantage points above it is kept. A region of more vectors than a shard
should hold is dealt to several by a hash; a shard's tree is one row of bytes. A node's vantage point splits its vectors at the
median distance and keeps the range of distances of either half. For a query at distance d with t its current k-th distance, a half
(or a region) with range [low, high] can only help if max(low - d, d - high) <= t. It is skipped if ``relax`` times
that bound exceeds t: a factor of 1 is exact, a larger one skips more.

A query first searches the region it lies nearest to, which gives its t; then those regions that t does not exclude. Queries
travel to the trees: a task holds one tree at a time and is sent the queries of its shard, many queries
in several tasks. A tree is copied only once per ``ASKED`` queries. A lost executor costs only its shards.

Defined results: vectors that are NULL, empty, zero, of another length than most, or hold NULL or non-finite
components take no part; neither do rows with a NULL id. Rows that repeat an id are separate candidates with
the same id, and none of them is a candidate of their own query. An empty table gives no rows; other columns are not read, so
their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_sample, staged

#: Vectors in a shard, queries searched together, and queries a task is sent for one tree, about.
SHARD, BLOCK, ASKED = 8192, 1024, 100_000
#: Vectors that the top of the tree is grown on, in expectation, and its levels at most.
SAMPLE, LEVELS = 20_000, 12
LEAF = 128
RELAX = 1.2


class Tree:
    """A vantage-point tree in arrays. ``order`` lists the vectors so that every node is a range of them."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, bounds: np.ndarray):
        self.points, self.order, self.nodes, self.bounds = points, order, nodes, bounds

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        """nodes: first, end, inner child, outer child (0: leaf); the vantage point is the first of the
        range. bounds: lowest and highest distance in the inner, then in the outer half."""
        order = np.arange(len(points))
        nodes, bounds, todo = [[0, len(points), 0, 0]], [[0.0] * 4], [0]
        while todo:
            at = todo.pop()
            first, end = nodes[at][:2]
            if end - first <= LEAF:
                continue
            own = order[first:end]
            # The vector farthest from the first one: a corner separates better than a middle.
            corner = int(np.argmax(((points[own] - points[own[0]]) ** 2).sum(axis=1)))
            own[[0, corner]] = own[[corner, 0]]
            rest = own[1:]
            d = np.sqrt(((points[rest] - points[own[0]]) ** 2).sum(axis=1))
            rank = np.argsort(d, kind="stable")
            rest, d = rest[rank], d[rank]
            middle = (rest.size + 1) // 2
            order[first:end] = np.concatenate([own[:1], rest])
            nodes[at][2], nodes[at][3] = len(nodes), len(nodes) + 1
            bounds[at] = [d[0], d[middle - 1], d[middle], d[-1]]
            nodes += [[first + 1, first + 1 + middle, 0, 0], [first + 1 + middle, end, 0, 0]]
            bounds += [[0.0] * 4, [0.0] * 4]
            todo += [nodes[at][2], nodes[at][3]]
        return cls(points[order], order, np.array(nodes), np.array(bounds))

    def search(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, relax: float, within: np.ndarray | None = None):
        """The k nearest of every query, as (places, distances); ``ids`` are those of ``points``, and ``own``
        the queries' ids, which are no candidates. What lies beyond ``within`` of a query is not wanted. Missing places
        are -1."""
        m = len(queries)
        best = Best(m, k, within)
        norms = (self.points**2).sum(axis=1)

        def distances(who: np.ndarray, first: int, end: int) -> np.ndarray:
            q = queries[who]
            square = (q**2).sum(axis=1)[:, None] + norms[first:end] - 2 * q @ self.points[first:end].T
            return np.sqrt(np.maximum(square, 0.0))

        def visit(at: int, who: np.ndarray) -> None:
            first, end, inner, outer = self.nodes[at]
            if not who.size or first == end:
                return
            if not inner:
                best.offer(who, distances(who, first, end), np.arange(first, end), ids, own)
                return
            d = distances(who, first, first + 1)
            best.offer(who, d, np.arange(first, first + 1), ids, own)
            d = d[:, 0]
            low_in, high_in, low_out, high_out = self.bounds[at]
            bound = {
                inner: np.maximum(low_in - d, d - high_in) * relax,
                outer: np.maximum(low_out - d, d - high_out) * relax,
            }
            near = d < (high_in + low_out) / 2
            for child, turn in ((inner, near), (outer, ~near), (outer, near), (inner, ~near)):
                visit(child, who[turn & (bound[child] <= best.worst[who] + SLACK)])

        visit(0, np.arange(m))
        return best.places, best.scores


#: Distances this close count as equal while pruning, so that ties survive rounding.
SLACK = 1e-6


class Best:
    """The k best of each query so far: by distance, ties to the smaller id."""

    def __init__(self, m: int, k: int, within: np.ndarray | None = None):
        self.k = k
        self.places = np.full((m, k), -1)
        self.scores = np.full((m, k), np.inf)
        self.ids = np.full((m, k), np.iinfo(np.int64).max)
        self.worst = np.full(m, np.inf) if within is None else within.copy()

    def offer(self, who: np.ndarray, d: np.ndarray, places: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        d = np.where(ids[places][None, :] == own[who][:, None], np.inf, d)
        better = (d <= self.worst[who][:, None] + SLACK).any(axis=1)
        who, d = who[better], d[better]
        if not who.size:
            return
        scores = np.concatenate([self.scores[who], d], axis=1)
        names = np.concatenate([self.ids[who], np.broadcast_to(ids[places], d.shape)], axis=1)
        spots = np.concatenate([self.places[who], np.broadcast_to(places, d.shape)], axis=1)
        # Rounded, so that equal vectors tie whatever the shape of the product that measured them.
        keep = np.lexsort((names, np.round(scores, 9)))[:, : self.k]
        rows = np.arange(who.size)[:, None]
        self.scores[who], self.ids[who], self.places[who] = scores[rows, keep], names[rows, keep], spots[rows, keep]
        self.worst[who] = np.minimum(self.worst[who], self.scores[who][:, -1])


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, added up in the order of the components, so that equal vectors have equal products."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, v`` of the vectors that take part, as doubles."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def packed(rows: DataFrame, group: str, build) -> DataFrame:
    """One row of bytes per group of ``rows (group, id, v)``; groups are bounded."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        ids = part.column("id").to_numpy()
        v = part.column("v").combine_chunks()
        points = np.asarray(v.flatten(), np.float64).reshape(len(ids), -1)
        order = np.argsort(ids, kind="stable")
        arrays = build(ids[order], points[order])
        return pa.table(
            {group: pa.array([key[0].as_py()], pa.int64())}
            | {n: pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for n, a in zip("abcde", arrays)}
        )

    return rows.groupBy(group).applyInArrow(run, f"{group} long, a binary, b binary, c binary, d binary, e binary")


class Regions:
    """The top of a vantage-point tree: a complete binary tree whose leaves are regions."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels = levels
        dims = points.shape[1]
        self.pivots, self.radii = np.zeros((1 << levels, dims)), np.zeros(1 << levels)
        held = {1: points}
        for node in range(1, 1 << levels):
            own = held.pop(node)
            if len(own):
                self.pivots[node] = own[np.argmax(((own - own[0]) ** 2).sum(axis=1))]
                d = np.sqrt(((own - self.pivots[node]) ** 2).sum(axis=1))
                self.radii[node] = np.median(d)
                held[2 * node], held[2 * node + 1] = own[d <= self.radii[node]], own[d > self.radii[node]]
            else:
                held[2 * node] = held[2 * node + 1] = own

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The region of each point, and its distances to the vantage points above it."""
        node, far = np.ones(len(points), np.int64), np.zeros((len(points), self.levels))
        for level in range(self.levels):
            far[:, level] = np.sqrt(((points - self.pivots[node]) ** 2).sum(axis=1))
            node = 2 * node + (far[:, level] > self.radii[node])
        return node - (1 << self.levels), far

    def bounds(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How near each region can be to each query, at least. ``low``, ``high``: a region's distances by level; a
        region without vectors has infinite ``low``."""
        square = (queries**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * queries @ self.pivots.T
        d = np.sqrt(np.maximum(square, 0.0))
        out = np.zeros((len(queries), 1 << self.levels))
        region = np.arange(1 << self.levels)
        for level in range(self.levels):
            at = d[:, (region + (1 << self.levels)) >> (self.levels - level)]
            out = np.maximum(out, np.maximum(low[:, level] - at, at - high[:, level]))
        if not self.levels:
            out += np.where(np.isinf(low[:, :1]).any(axis=1), np.inf, 0.0)
        return out


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.float64).reshape(-1, dims)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    relax: float = RELAX,
    key: str = "vec_id",
    vector: str = "embedding",
    shard: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each row of ``queries``."""
    spark = vectors.sparkSession
    rows = staged(usable(vectors, key, vector), "vectors")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], empty)
    dims = int(size["n"])
    rows = rows.where(F.size("v") == dims)
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total, most = rows.agg(F.count("*"), F.max(squares)).first()

    def completed(points: np.ndarray) -> np.ndarray:
        return np.column_stack([points, np.sqrt(np.maximum(most - (points**2).sum(axis=1), 0.0))])

    # The top of the tree, from a sample in the order of its ids.
    wanted = max(0, min(LEVELS, int(np.ceil(np.log2(max(1, total / shard))))))
    sample = hash_sample(rows, "id", SAMPLE, 5).orderBy("id", "v").select("v").toPandas()["v"] if wanted else []
    points = np.array([np.asarray(v, float) for v in sample]).reshape(-1, dims)
    regions = Regions(completed(points) if len(points) else np.zeros((0, dims + 1)), wanted)
    levels = [f"d{i}" for i in range(wanted)]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region, far = regions.place(completed(matrix(batch.column("v"), dims)))
            columns = [batch.column("id"), batch.column("v"), pa.array(region), *(pa.array(far[:, i]) for i in range(wanted))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "region", *levels])

    schema = "id long, v array<double>, region long" + "".join(f", {c} double" for c in levels)
    here = staged(rows.mapInArrow(placed, schema), "vector-regions")
    # A few figures per region, of which there are 2^LEVELS at most.
    figures = [F.count("*").alias("n")] + [x for c in levels for x in (F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"))]
    low, high = np.full((1 << wanted, max(wanted, 1)), np.inf), np.full((1 << wanted, max(wanted, 1)), -np.inf)
    parts = np.zeros(1 << wanted, np.int64)
    for r in here.groupBy("region").agg(*figures).collect():
        parts[r["region"]] = -(-r["n"] // shard)
        for i, c in enumerate(levels):
            low[r["region"], i], high[r["region"], i] = r[f"{c}_low"], r[f"{c}_high"]
        if not levels:
            low[0], high[0] = 0.0, np.inf
    first = np.concatenate([[0], np.cumsum(parts)])  # a region's first shard
    shards = int(first[-1])

    def grow(ids: np.ndarray, points: np.ndarray):
        tree = Tree.build(completed(points))
        return ids[tree.order], tree.points, tree.nodes.astype(np.int64), tree.bounds, tree.order[:0]

    table = spark.createDataFrame([(i, int(first[i]), int(parts[i])) for i in range(1 << wanted) if parts[i]], "region long, first long, parts long")
    dealt = here.join(F.broadcast(table), "region")  # 2^LEVELS rows at most
    dealt = dealt.select("id", "v", (F.col("first") + F.pmod(F.xxhash64(F.lit(1), "id", "v"), F.col("parts"))).alias("shard"))
    trees = staged(packed(dealt, "shard", grow), "vector-trees")

    asked = staged(usable(queries, key, vector).where(F.size("v") == dims), "queries")
    salts = max(1, -(-asked.count() // ASKED))
    kinds = "query long, q array<double>, within double, shard long"

    def sent(near: bool):
        """Queries for the shards of the nearest region, or of all others that can hold something nearer than ``within``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, block):
                    batch = whole.slice(start, block)
                    q = matrix(batch.column("v"), dims)
                    bound = regions.bounds(np.column_stack([q, np.zeros(len(q))]), low, high)
                    within = np.asarray(batch.column("within").to_numpy(zero_copy_only=False), float) if not near else np.full(len(q), np.inf)
                    nearest_one = bound.argmin(axis=1)
                    wanted_ = np.zeros(bound.shape, bool)
                    wanted_[np.arange(len(q)), nearest_one] = True
                    if not near:
                        wanted_ = ~wanted_ & (bound * relax <= within[:, None] + SLACK) & (parts > 0)
                    query, region = np.nonzero(wanted_)
                    each = np.repeat(np.arange(query.size), parts[region])
                    count = parts[region]
                    shard_of = first[region][each] + np.arange(each.size) - np.repeat(np.cumsum(count) - count, count)
                    picked = pa.array(query[each])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(picked), batch.column("v").take(picked), pa.array(within[query[each]]), pa.array(shard_of)],
                        ["query", "q", "within", "shard"],
                    )

        return run

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = tree = None
        for whole in batches:
            kind = whole.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero(kind == 0)).tolist(), whole.num_rows]
            for start, stop in zip(edges, edges[1:]):
                if start < stop and kind[start] == 0:
                    row = whole.slice(start, 1).to_pylist()[0]
                    ids = np.frombuffer(row["a"], np.int64)
                    nodes, bounds = np.frombuffer(row["c"], np.int64).reshape(-1, 4), np.frombuffer(row["d"], np.float64).reshape(-1, 4)
                    tree = Tree(np.frombuffer(row["b"], np.float64).reshape(-1, dims + 1), np.arange(len(ids)), nodes, bounds)
                    start += 1
                for at in range(start, stop, block):
                    part = whole.slice(at, min(block, stop - at))
                    asking, q = part.column("query").to_numpy(), matrix(part.column("q"), dims)
                    within = np.asarray(part.column("within").to_numpy(zero_copy_only=False), float)
                    places, _ = tree.search(np.column_stack([q, np.zeros(len(q))]), ids, asking, k, relax, within)
                    query, slot = np.nonzero(places >= 0)
                    found = places[query, slot]
                    score = inner_products(q[query], tree.points[found, :dims])
                    own = ids[found] != asking[query]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asking[query][own]), pa.array(ids[found][own]), pa.array(score[own])],
                        ["query_id", "vec_id", "score"],
                    )

    def searched(sent_queries: DataFrame) -> DataFrame:
        """What the shards hold for the queries sent to them: a tree comes first, then its queries."""
        salt = F.pmod(F.xxhash64(F.lit(2), "query"), F.lit(salts)).cast("int")
        none = F.lit(None)
        there = trees.select(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "a", "b", "c", "d",
            none.cast("long").alias("query"), none.cast("array<double>").alias("q"), none.cast("double").alias("within"),
        )
        asking = sent_queries.select(
            "shard", salt.alias("salt"), F.lit(1).alias("kind"), *(none.cast("binary").alias(c) for c in "abcd"), "query", "q", "within"
        )
        both = there.unionByName(asking).repartition(min(shards * salts, 100_000), "shard", "salt")
        return both.sortWithinPartitions("shard", "salt", "kind").mapInArrow(work, "query_id long, vec_id long, score double")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    one = staged(best(searched(asked.mapInArrow(sent(True), kinds))).drop("rank"), "vectors-near")
    # The k-th score as a distance, where there are k; rows that repeat a query's id share it.
    kth = one.groupBy("query_id").agg(F.min("score").alias("score"), F.count("*").alias("n")).where(F.col("n") >= k)
    square = F.greatest(squares + F.lit(float(most)) - 2 * F.col("score"), F.lit(0.0))
    ready = asked.join(kth, asked["id"] == kth["query_id"], "left")
    within = F.when(F.col("score").isNull(), F.lit(float("inf"))).otherwise(F.sqrt(square))
    ready = ready.select("id", "v", within.alias("within"))
    two = searched(ready.mapInArrow(sent(False), kinds))
    return best(one.unionByName(two)).select("query_id", "rank", "vec_id", "score")
