"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard of the vectors.

Equal vectors are one point that carries its smallest ids, as many as any answer can hold. Points are dealt to shards by
hash. A shard's graph grows in batches: a greedy beam search proposes neighbours, pruning drops a neighbour that is
``ALPHA`` times closer to a kept one than to the point, and edges go both ways. A query walks the graph of each shard
with a beam; what the shards find is merged by exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftlake.workspace import Scratch

NEIGHBOURS = 10
QUERY_EVERY = 100
POINTS_PER_SHARD = 2500
QUERIES_PER_BLOCK = 2048
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
# Places a point has for points that would be cut off, in each round of attaching them.
SPARE = 4
ALPHA = 1.2
BATCH = 256
_EXPAND = 4

_INDEX_SCHEMA = "dims int, shard int, position int, point long, ids array<long>, vector array<double>, edges array<int>"
_FOUND_SCHEMA = "query_id long, vec_id long, score double"


def _distances(vectors: np.ndarray, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances between each query and its rows."""
    return ((vectors[rows] - queries[:, None, :]) ** 2).sum(axis=2)


def beam_search(
    vectors: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the nearest ``beam`` points met on a greedy walk, nearest first, and their squared distances; -1 and
    infinity where fewer were met. Several points are expanded at a time."""
    n = len(queries)
    seen = np.zeros((n, len(vectors)), bool)
    seen[:, entry] = True
    ids = np.full((n, beam), -1)
    ids[:, 0] = entry
    near = np.full((n, beam), np.inf)
    near[:, 0] = _distances(vectors, np.full((n, 1), entry), queries)[:, 0]
    done = np.zeros((n, beam), bool)
    active = np.arange(n)
    while len(active):
        waiting = np.where(done[active] | (ids[active] < 0), np.inf, near[active])
        picks = np.argsort(waiting, axis=1, kind="stable")[:, :_EXPAND]
        valid = np.isfinite(np.take_along_axis(waiting, picks, axis=1))
        going = valid[:, 0]
        active, picks, valid = active[going], picks[going], valid[going]
        if not len(active):
            break
        chosen = np.where(valid, np.take_along_axis(ids[active], picks, axis=1), entry)
        marked = done[active]
        np.put_along_axis(marked, picks, np.take_along_axis(marked, picks, axis=1) | valid, axis=1)
        done[active] = marked
        found = np.where(valid[:, :, None], edges[chosen], -1).reshape(len(active), -1)
        # A point met twice in one step counts once.
        order = np.sort(found, axis=1)
        order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
        rows = np.arange(len(active))[:, None]
        fresh = (order >= 0) & ~seen[active[rows], order]
        r, c = np.nonzero(fresh)
        seen[active[r], order[r, c]] = True
        far = np.full(order.shape, np.inf)
        far[r, c] = ((vectors[order[r, c]] - queries[active[r]]) ** 2).sum(axis=1)
        all_ids = np.concatenate([ids[active], np.where(fresh, order, -1)], axis=1)
        all_near = np.concatenate([near[active], far], axis=1)
        all_done = np.concatenate([done[active], np.zeros(order.shape, bool)], axis=1)
        best = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, axis=1)
        near[active] = np.take_along_axis(all_near, best, axis=1)
        done[active] = np.take_along_axis(all_done, best, axis=1)
    return ids, near


def robust_prune(vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray, alpha: float) -> np.ndarray:
    """For each point up to ``DEGREE`` of its candidates (-1 for none), nearest first, without those that a kept one is
    ``alpha`` times closer to than the point is."""
    candidates = np.sort(candidates, axis=1)
    twice = np.zeros(candidates.shape, bool)
    twice[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    alive = (candidates >= 0) & ~twice & (candidates != points[:, None])
    own = vectors[np.maximum(candidates, 0)]
    to_point = np.where(alive, ((own - vectors[points][:, None, :]) ** 2).sum(axis=2), np.inf)
    norms = (own**2).sum(axis=2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * own @ own.transpose(0, 2, 1)
    kept = np.full((len(points), DEGREE), -1, np.int32)
    rows = np.arange(len(points))
    for k in range(DEGREE):
        nearest = to_point.argmin(axis=1)
        some = np.isfinite(to_point[rows, nearest])
        if not some.any():
            break
        kept[some, k] = candidates[rows, nearest][some]
        drop = alpha**2 * between[rows, nearest] <= to_point
        to_point[drop & some[:, None]] = np.inf
        to_point[rows[some], nearest[some]] = np.inf
    return kept


def _add_reverse(vectors: np.ndarray, edges: np.ndarray, points: np.ndarray, alpha: float) -> None:
    """Edges back from all neighbours of these points; who gets too many is pruned."""
    source = np.repeat(points, edges.shape[1])
    target = edges[points].reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    rank = np.arange(len(target)) - np.searchsorted(target, target)
    for part in range(0, int(rank.max(initial=-1)) + 1, DEGREE):
        here = (rank >= part) & (rank < part + DEGREE)
        nodes, row = np.unique(target[here], return_inverse=True)
        incoming = np.full((len(nodes), DEGREE), -1, np.int32)
        incoming[row, rank[here] - part] = source[here]
        for a in range(0, len(nodes), BATCH):
            some = nodes[a : a + BATCH]
            both = np.concatenate([edges[some], incoming[a : a + BATCH]], axis=1)
            edges[some] = robust_prune(vectors, some, both, alpha)


def medoid(vectors: np.ndarray) -> int:
    return int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())


def _reached(edges: np.ndarray, entry: int) -> np.ndarray:
    """Which points can be walked to from the entry."""
    reached = np.zeros(len(edges), bool)
    reached[entry] = True
    front = np.array([entry])
    while len(front):
        ahead = np.unique(edges[front])
        front = ahead[(ahead >= 0) & ~reached[np.maximum(ahead, 0)]]
        reached[front] = True
    return reached


def _attach(vectors: np.ndarray, edges: np.ndarray, entry: int) -> np.ndarray:
    """Edges to the points that pruning has cut off, from the nearest points that are reached, in places of their own."""
    while True:
        lost = np.flatnonzero(~_reached(edges, entry))
        if not len(lost):
            return edges
        spare = np.full((len(edges), SPARE), -1, np.int32)
        taken = np.zeros(len(edges), int)
        for a in range(0, len(lost), BATCH):
            ids, _ = beam_search(vectors, edges, entry, vectors[lost[a : a + BATCH]], BUILD_BEAM)
            for point, row in zip(lost[a : a + BATCH], ids, strict=True):
                free = row[(row >= 0) & (taken[np.maximum(row, 0)] < SPARE)]
                if len(free):
                    spare[free[0], taken[free[0]]] = point
                    taken[free[0]] += 1
        edges = np.concatenate([edges, spare], axis=1)


def build_graph(vectors: np.ndarray, seed: int = 0) -> np.ndarray:
    """A row of neighbours (-1 for none) per point; all points can be reached from the medoid."""
    n = len(vectors)
    random = np.random.default_rng(seed)
    edges = np.full((n, DEGREE), -1, np.int32)
    if n < 2:
        return edges
    start = min(DEGREE // 2, n - 1)
    edges[:, :start] = (np.arange(n)[:, None] + random.integers(1, n, size=(n, start))) % n
    entry = medoid(vectors)
    for alpha in (1.0, ALPHA):
        for batch in np.array_split(random.permutation(n), -(-n // BATCH)):
            ids, _ = beam_search(vectors, edges, entry, vectors[batch], BUILD_BEAM)
            edges[batch] = robust_prune(vectors, batch, np.concatenate([ids, edges[batch]], axis=1), alpha)
            _add_reverse(vectors, edges, batch, alpha)
    return _attach(vectors, edges, entry)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part: not null, not zero, without null or non-finite components. Of rows
    that repeat an id only the least vector takes part; rows without an id don't."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _points(rows: DataFrame, k: int) -> DataFrame:
    """``point, ids, dims, vector``: distinct vectors with their ``k + 1`` smallest ids. Ranks are cut within each task
    before rows of a vector meet."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    first = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    points = first.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return points.select(F.element_at("ids", 1).alias("point"), "ids", F.size("vector").alias("dims"), "vector")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("point", ignore_index=True)
    edges = build_graph(_matrix(frame["vector"]))
    edges = edges[:, : int(np.flatnonzero((edges >= 0).any(axis=0)).max(initial=0)) + 1]
    return frame.assign(position=np.arange(len(frame), dtype=np.int32), edges=list(edges))[
        ["dims", "shard", "position", "point", "ids", "vector", "edges"]
    ]


def build_index(vectors: DataFrame, scratch: Scratch, k: int = NEIGHBOURS) -> DataFrame:
    """The graphs of all shards, a row per distinct vector, written to the shared folder."""
    points = scratch.settle(_points(usable(vectors), k), "points")
    shards = -(-points.count() // POINTS_PER_SHARD) or 1
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("point"), F.lit(shards)).cast("int"))
    # Little to read, much to do: shards aren't to share a task because they are small.
    dealt = dealt.repartition(shards, "dims", "shard")
    return scratch.settle(dealt.groupBy("dims", "shard").applyInPandas(_build, _INDEX_SCHEMA), "index")


def _search(k: int):
    def work(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(index):
            index = index.sort_values("position", ignore_index=True)
            vectors, edges = _matrix(index["vector"]), np.stack(list(index["edges"]))
            wanted, entry = _matrix(queries["vector"]), medoid(vectors)
            for a in range(0, len(queries), BATCH):
                ids, near = beam_search(vectors, edges, entry, wanted[a : a + BATCH], SEARCH_BEAM)
                # k points of other vectors and the query's own vector hold all that can be an answer of this shard.
                for query, row, distance in zip(queries["query_id"][a : a + BATCH], ids, near, strict=True):
                    for point, squared in zip(row[: k + 1], distance[: k + 1], strict=True):
                        if point >= 0:
                            found += [(query, v, np.sqrt(squared)) for v in index["ids"][point] if v != query]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    return work


def search(queries: DataFrame, index: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query (``query_id, vector``), ties to the smaller
    id, from a beam search in every shard. Queries go in blocks, and each block meets each shard of its dimension once."""
    blocks = -(-queries.count() // QUERIES_PER_BLOCK) or 1
    shards = index.select("dims", "shard").distinct()
    asked = queries.select("query_id", "vector", F.size("vector").alias("dims")).join(shards, "dims")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    # Columns of their own, so that both sides of the cogroup can be told apart.
    held = index.select(*(F.col(c).alias(c) for c in index.columns))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dims", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(_search(k), _FOUND_SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, k: int = NEIGHBOURS, every: int = QUERY_EVERY) -> DataFrame:
    """The ``k`` nearest rows found for each row of ``vectors`` (``vec_id, embedding``) whose id is divisible by ``every``.

    Null and zero vectors and those with null or non-finite components neither ask nor are found; vectors of another
    length are never near. A query with fewer candidates gets all that are found. Equal distances go by the smaller id.
    An empty table gives no rows. Other columns are left out.
    """
    scratch = Scratch(vectors.sparkSession, "graph")
    index = build_index(vectors, scratch, k)
    asking = vectors.where(F.pmod("vec_id", F.lit(every)) == 0)
    queries = scratch.settle(usable(asking).withColumnRenamed("vec_id", "query_id"), "queries")
    return search(queries, index, k)


def recall(found: DataFrame, exact: Iterator[tuple[int, set[int]]]) -> float:
    """The share of the exact neighbours that were found."""
    got: dict[int, set[int]] = {}
    for row in found.select("query_id", "vec_id").collect():
        got.setdefault(row.query_id, set()).add(row.vec_id)
    hits = [(len(got.get(query, set()) & best), len(best)) for query, best in exact]
    return sum(h for h, _ in hits) / max(1, sum(n for _, n in hits))
