"""Nearest neighbours by inner product with vantage-point trees per shard.

Inner product becomes a metric by one more coordinate: with M the largest norm, x goes
to (x, sqrt(M^2 - |x|^2)) and a query to (q, 0); the larger the inner product, the
smaller the Euclidean distance, which obeys the triangle inequality.

* Equal vectors are one point with the ids that can matter (one more than asked for), so any
  number of copies is one point of the index.
* Points are dealt to shards by a hash, and a shard builds a vantage-point tree over its
  points: a node's points are split at the median distance to its vantage point, down to
  leaves of ``LEAF`` points, which are compared in one matrix product.  The queries, which go to
  every shard (the query set against all rows), stream past the tree in blocks.
* Queries walk the tree together.  A subtree whose distances to the vantage point lie in
  [lo, hi] can hold nothing nearer than max(lo - d, d - hi); it is skipped by the queries for
  which that bound exceeds ``factor`` times the distance of their worst neighbour so far.
  ``factor`` 1 is exact search; smaller factors skip more.
* Each shard gives every query its nearest, scored again on the original vectors in
  double precision, and the best of all shards are merged.

Scale.  The tree of a shard is built over a bounded number of points (``SHARD_POINTS`` on
average), once for ``QUERY_PART`` queries; behind the points in the sorted partition come the queries,
``QUERY_BLOCK`` at most in memory; what is shuffled back is k rows for each query and shard, cut to
k before the shuffle.

Defined results: vectors that are null, zero, of another length than most, or hold null
or non-finite components take no part, neither as queries nor as candidates; a query's own row
(its id) is no candidate, other rows with an equal vector are; ties go to the smaller
vec_id; with fewer candidates than asked for all are returned; rows that repeat a
vec_id and its vector count once, a vec_id with several vectors is a candidate with
each and a query with the smallest; a null vec_id takes no part; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialise

K = 20
EVERY = 20
FACTOR = 1.0
LEAF = 256
#: Distinct points of a shard, on average.
SHARD_POINTS = 16_384
#: Queries that go past one copy of a shard's tree, on average: as many as a shard has points, so that
#: points and queries are shuffled alike.
QUERY_PART = 16_384
#: Queries that are searched together.
QUERY_BLOCK = 2_048
#: Points kept beyond those asked for while distances are compared, which are rounded
#: otherwise than scores; a query whose last points lie closer than ``CLOSE`` in
#: score is compared with the whole shard.
SPARE, CLOSE = 8, 1e-9


@dataclass
class Node:
    vantage: int
    near: object  # Node or leaf (array of points)
    far: object
    bounds: tuple[float, float, float, float]  # least and largest distance to the vantage, near and far


def build(points: np.ndarray, which: np.ndarray, leaf: int, rng: np.random.Generator):
    """A tree over ``points[which]``; a leaf is an array of places."""
    if len(which) <= leaf:
        return which
    # The vantage point whose distances to a few others spread most.
    tried = rng.choice(which, min(5, len(which)), replace=False)
    probe = points[rng.choice(which, min(64, len(which)), replace=False)]
    spread = [np.linalg.norm(probe - points[t], axis=1).std() for t in tried]
    vantage = int(tried[int(np.argmax(spread))])
    rest = which[which != vantage]
    d = np.linalg.norm(points[rest] - points[vantage], axis=1)
    order = np.argsort(d, kind="stable")
    rest, d = rest[order], d[order]
    half = len(rest) // 2
    bounds = (float(d[0]), float(d[half - 1]), float(d[half]), float(d[-1]))
    return Node(vantage, build(points, rest[:half], leaf, rng), build(points, rest[half:], leaf, rng), bounds)


def grown(points: np.ndarray, leaf: int = LEAF):
    """The tree over all ``points``."""
    return build(points, np.arange(len(points)), leaf, np.random.default_rng(1))


class Search:
    """The k nearest points of each query in one tree, for all queries at once.  ``tree``
    is the one over ``points``, if it has been built."""

    def __init__(self, points: np.ndarray, queries: np.ndarray, k: int, factor: float, leaf: int = LEAF, tree=None):
        if not 0 < factor <= 1:
            raise ValueError("factor must be above 0 and at most 1")
        self.points, self.queries, self.factor = points, queries, factor
        self.k = min(k, len(points))
        self.dist = np.full((len(queries), self.k), np.inf)
        self.place = np.full((len(queries), self.k), -1, np.int64)
        self.compared = 0
        self._norms = (points ** 2).sum(axis=1)
        self._query_norms = (queries ** 2).sum(axis=1)
        if tree is None:
            tree = grown(points, leaf)
        if len(queries):
            self._walk(tree, np.arange(len(queries)))

    def _distances(self, active: np.ndarray, which: np.ndarray) -> np.ndarray:
        self.compared += len(active) * len(which)
        d2 = self._query_norms[active, None] + self._norms[which] - 2 * (self.queries[active] @ self.points[which].T)
        return np.sqrt(np.maximum(d2, 0))

    def _keep(self, active: np.ndarray, which: np.ndarray, d: np.ndarray) -> None:
        better = (d < self.dist[active, -1:]).any(axis=1)
        if not better.any():
            return
        active, d = active[better], d[better]
        if d.shape[1] > self.k:
            part = np.argpartition(d, self.k - 1, axis=1)[:, :self.k]
            d, which = np.take_along_axis(d, part, 1), which[part]
        else:
            which = np.broadcast_to(which, d.shape)
        both = np.concatenate([self.dist[active], d], axis=1)
        place = np.concatenate([self.place[active], which], axis=1)
        order = np.argsort(both, axis=1, kind="stable")[:, :self.k]
        self.dist[active] = np.take_along_axis(both, order, 1)
        self.place[active] = np.take_along_axis(place, order, 1)

    def _walk(self, node, active: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            for a in range(0, len(active), 1024):
                part = active[a:a + 1024]
                self._keep(part, node, self._distances(part, node))
            return
        d = self._distances(active, np.array([node.vantage]))
        self._keep(active, np.array([node.vantage]), d)
        d = d[:, 0]
        least = [np.maximum(node.bounds[0] - d, d - node.bounds[1]), np.maximum(node.bounds[2] - d, d - node.bounds[3])]
        near_first = least[0] <= least[1]
        # The nearer side first: it shrinks the worst distance before the other is tried.
        for side, who in ((0, near_first), (1, ~near_first), (1, near_first), (0, ~near_first)):
            go = who & (least[side] <= self.factor * self.dist[active, -1] + 1e-9)
            if go.any():
                self._walk(node.near if side == 0 else node.far, active[go])


def _dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products, added up in the order of the components."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * q[j]
    return out


def _usable(vectors: DataFrame) -> DataFrame:
    """id, v: rows that take part; v as doubles."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & some)


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, factor: float = FACTOR, leaf: int = LEAF,
            shard_points: int = SHARD_POINTS, query_block: int = QUERY_BLOCK, query_part: int = QUERY_PART) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products of each query."""
    rows = materialise(_usable(vectors), "vectors")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], empty)
    rows = rows.where(F.size("v") == common["n"])
    # Equal vectors are one point; of its ids, those that can be among a query's k.
    ids = F.slice(F.sort_array(F.collect_set("id")), 1, k + 1)
    keyed = rows.withColumn("h", F.xxhash64("v")).withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "id"), F.lit(64)))
    part = keyed.groupBy("h", "v", "salt").agg(ids.alias("ids"))
    points = materialise(part.groupBy("h", "v").agg(
        F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")), "points")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total = points.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("m")).first()
    largest = float(total["m"])
    shards = -(-total["n"] // shard_points)
    # Queries: distinct vectors, so that copies of a query are searched once.
    own = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    # No group of copies is gathered: a vector with many query ids travels as several queries.
    asked = materialise(own.groupBy("v", F.pmod(F.xxhash64(F.lit("ask"), "id"), F.lit(256)).alias("part"))
                        .agg(F.sort_array(F.collect_set("id")).alias("ask")).drop("part"), "queries")
    parts = -(-asked.count() // query_part)
    if not parts:
        return vectors.sparkSession.createDataFrame([], empty)
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # In the partition of a shard and a part its points come first, then the queries.
    left = points.select(F.pmod("h", F.lit(shards)).cast("int").alias("shard"), every_one(parts).alias("part"),
                         F.lit(0).alias("kind"), "v", "ids")
    right = asked.select(every_one(shards).alias("shard"),
                         F.pmod(F.xxhash64(F.lit("part"), "ask"), F.lit(parts)).cast("int").alias("part"),
                         F.lit(1).alias("kind"), "v", F.col("ask").alias("ids"))
    streams = (left.unionByName(right).withColumn("stream", F.col("shard").cast("long") * parts + F.col("part"))
               .select("stream", "kind", "v", "ids").repartition(shards * parts, "stream")
               .sortWithinPartitions("stream", "kind"))

    def answers(tree, x: np.ndarray, lifted: np.ndarray, ids: list, q: np.ndarray, asks: list) -> pa.RecordBatch:
        out: list[list] = [[], [], []]
        flat = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        found = Search(lifted, flat, k + 1 + SPARE, factor, leaf, tree)
        for i, ask in enumerate(asks):
            place = found.place[i][found.place[i] >= 0]
            dots = _dots(x[place], q[i])
            if k + 1 < len(place) < len(x) and np.sort(dots)[::-1][k] - dots.min() < CLOSE:
                place = np.arange(len(x))
                dots = _dots(x, q[i])
                place = place[dots >= np.sort(dots)[::-1][k]]
                dots = dots[place]
            each = sorted((-s, v) for s, p in zip(dots, place) for v in ids[p])[:k + 1]
            for a in ask:
                best = [e for e in each if e[1] != a][:k]
                out[0] += [a] * len(best)
                out[1] += [v for _, v in best]
                out[2] += [-s for s, _ in best]
        return pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                               names=["query_id", "vec_id", "score"])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, held, ids, x, lifted = None, None, [], [], None, None
        for batch in batches:
            numbers, kinds = (batch.column(c).to_numpy() for c in (0, 1))
            edges = np.flatnonzero((np.diff(numbers, prepend=-1) != 0) | (np.diff(kinds, prepend=-1) != 0)).tolist()
            for lo, hi in zip(edges, [*edges[1:], len(numbers)]):
                if numbers[lo] != shard:
                    shard, tree, held, ids = numbers[lo], None, [], []
                for at in range(lo, hi, query_block):
                    part = batch.slice(at, min(query_block, hi - at))
                    v = part.column(2).flatten().to_numpy().reshape(len(part), -1)
                    if kinds[lo] == 0:
                        held.append(v)
                        ids += part.column(3).to_pylist()
                    elif held:
                        if tree is None:
                            x = np.concatenate(held)
                            lift = np.sqrt(np.maximum(largest - (x ** 2).sum(axis=1), 0))
                            lifted = np.concatenate([x, lift[:, None]], axis=1)
                            tree = grown(lifted, leaf)
                        yield answers(tree, x, lifted, ids, v, part.column(3).to_pylist())

    bounded_batches(vectors.sparkSession)
    hits = streams.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE_SQL = """
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
