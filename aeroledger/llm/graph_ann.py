"""Nearest neighbours by largest inner product, from a robust-pruned directed graph per shard.

Distinct vectors are dealt to shards by a hash. In a shard, vectors are added in growing batches: a greedy beam search over the graph so far
proposes neighbours, and relaxed distance pruning keeps a neighbour unless one already kept is nearer to it by the factor `alpha`, so the
edges stay few and diverse. Inner products become distances by one more coordinate that gives all vectors of a shard the same length. A
query walks every shard with a beam; the shards' results are scored again in double precision and merged.

Copies of a vector are one node that names the smallest ids, as many as a result can hold; they are ranked and cut before the shuffle, so a
vector that a third of the rows share costs a few rows per task. Queries go to a shard in blocks, so neither side of a task grows with the data.

Edge cases: a vector that is null or zero, or has a null or non-finite component, takes no part, neither does a null id. Vectors are compared
with those of the same length only. Every row is a candidate but the query's own; rows equal in id and vector are one query, for which one of
them is its own. Fewer candidates than `k` give fewer rows, an empty table none. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GraphOptions:
    shard_rows: int = 16_384
    block_rows: int = 16_384  # queries that search one copy of a shard
    degree: int = 36
    alpha: float = 1.2
    build_beam: int = 44
    search_beam: int = 144
    seed: int = 5


AT_ONCE = 1_024  # vectors that search together


def usable(vector: Column) -> Column:
    """Not null, not zero, all components there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


class Graph:
    """Directed graph over the rows of a float32 matrix; squared Euclidean distance."""

    def __init__(self, points: np.ndarray, options: GraphOptions):
        self.points, self.options = points, options
        self.norms = np.einsum("ij,ij->i", points, points)
        self.edges = np.full((len(points), options.degree), -1, dtype=np.int32)
        self.start = int(((points - points.mean(0)) ** 2).sum(1).argmin()) if len(points) else -1

    def build(self) -> Graph:
        n = len(self.points)
        order = np.random.default_rng(self.options.seed).permutation(n)
        order = np.concatenate([[self.start], order[order != self.start]]).astype(np.int64)
        done = 1
        while done < n:
            batch = order[done : done + min(done, AT_ONCE)]
            seen, far = self.search(self.points[batch], self.options.build_beam, trail=True)
            self.edges[batch] = self.prune(batch, seen, far)
            self._point_back(batch)
            done += len(batch)
        return self

    def search(self, queries: np.ndarray, beam: int, trail: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (-1: none) and distances of the beam, nearest first; with `trail` also those of all nodes that were opened."""
        found = [self._search(queries[i : i + AT_ONCE], beam, trail) for i in range(0, len(queries), AT_ONCE)]
        width = max((x.shape[1] for x, _ in found), default=beam)
        pad = lambda x, fill: np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=fill)
        if not found:
            return np.zeros((0, beam), np.int64), np.zeros((0, beam), np.float32)
        return np.concatenate([pad(x, -1) for x, _ in found]), np.concatenate([pad(d, np.inf) for _, d in found])

    def _search(self, queries: np.ndarray, beam: int, trail: bool) -> tuple[np.ndarray, np.ndarray]:
        n = len(queries)
        nodes = np.full((n, beam), -1, dtype=np.int64)
        far = np.full((n, beam), np.inf, dtype=np.float32)
        closed = np.ones((n, beam), dtype=bool)
        own = np.einsum("ij,ij->i", queries, queries)
        nodes[:, 0], closed[:, 0] = self.start, False
        far[:, 0] = own + self.norms[self.start] - 2 * queries @ self.points[self.start]
        opened: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rows = np.arange(n)
        while len(rows):
            next_at = closed[rows].argmin(1)
            here = nodes[rows, next_at]
            closed[rows, next_at] = True
            if trail:
                opened.append((rows, here, far[rows, next_at]))
            near = self.edges[here].astype(np.int64)
            known = (near < 0) | (near[:, :, None] == nodes[rows][:, None, :]).any(2)
            there = np.where(known, 0, near)
            d = own[rows][:, None] + self.norms[there] - 2 * np.einsum("ijk,ik->ij", self.points[there], queries[rows], optimize=True)
            d[known] = np.inf
            all_far = np.concatenate([far[rows], d], axis=1)
            pick = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            pick = np.take_along_axis(pick, np.take_along_axis(all_far, pick, 1).argsort(1), 1)
            far[rows] = np.take_along_axis(all_far, pick, 1)
            nodes[rows] = np.take_along_axis(np.concatenate([nodes[rows], np.where(known, -1, near)], axis=1), pick, 1)
            none = np.ones(d.shape, dtype=bool)
            none[~known] = False
            closed[rows] = np.take_along_axis(np.concatenate([closed[rows], none], axis=1), pick, 1)
            rows = rows[~closed[rows].all(1)]
        if trail:
            seen = np.full((n, beam + len(opened)), -1, dtype=np.int64)
            seen_far = np.full(seen.shape, np.inf, dtype=np.float32)
            seen[:, :beam], seen_far[:, :beam] = nodes, far
            for i, (which, here, d) in enumerate(opened):
                seen[which, beam + i], seen_far[which, beam + i] = here, d
            return seen, seen_far
        return nodes, far

    def prune(self, points: np.ndarray, seen: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Of the nodes `seen` from each point, up to `degree` edges."""
        step = max(1, (1 << 22) // (seen.shape[1] ** 2))
        parts = [self._prune(points[i : i + step], seen[i : i + step], far[i : i + step]) for i in range(0, len(points), step)]
        return np.concatenate(parts)

    def _prune(self, points: np.ndarray, seen: np.ndarray, far: np.ndarray) -> np.ndarray:
        by_far = far.argsort(1, kind="stable")
        seen, far = np.take_along_axis(seen, by_far, 1), np.take_along_axis(far, by_far, 1)
        alive = np.isfinite(far) & (seen >= 0) & (seen != points[:, None])
        vectors = self.points[np.maximum(seen, 0)]
        norms = self.norms[np.maximum(seen, 0)]
        apart = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
        out = np.full((len(points), self.options.degree), -1, dtype=np.int32)
        rows = np.arange(len(points))
        for i in range(self.options.degree):
            pick = alive.argmax(1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[some, i] = seen[rows, pick][some]
            near = np.maximum(apart[rows, pick], 0) * self.options.alpha**2 <= far + 1e-9
            alive &= ~near
            alive[rows, pick] = False
        return out

    def _point_back(self, batch: np.ndarray) -> None:
        """Every new edge is offered in the other direction; a full node prunes what it has and what it is offered."""
        kept = self.edges[batch]
        target, source = kept[kept >= 0].astype(np.int64), np.repeat(batch, (kept >= 0).sum(1))
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        degree = self.options.degree
        while len(target):
            first = np.flatnonzero(np.diff(target, prepend=-1))
            at = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
            now = at < degree  # a node that is offered more takes them in several rounds
            nodes, slot = np.unique(target[now], return_inverse=True)
            offered = np.full((len(nodes), degree), -1, dtype=np.int64)
            offered[slot, at[now]] = source[now]
            both = np.concatenate([self.edges[nodes].astype(np.int64), offered], axis=1)
            d = ((self.points[np.maximum(both, 0)] - self.points[nodes][:, None, :]) ** 2).sum(2)
            d[both < 0] = np.inf
            full = (both >= 0).sum(1) > degree
            if full.any():
                self.edges[nodes[full]] = self.prune(nodes[full], both[full], d[full])
            fits = np.take_along_axis(both, d.argsort(1, kind="stable")[:, :degree], 1)
            self.edges[nodes[~full]] = fits[~full]
            target, source = target[~now], source[~now]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in column.chunks], type=column.type.value_type)
    return flat.to_numpy().reshape(len(column), -1)


def _with_length(points: np.ndarray) -> np.ndarray:
    """One more coordinate, so that all rows have the length of the longest."""
    norms = np.einsum("ij,ij->i", points, points, dtype=np.float64)
    more = np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))
    return np.concatenate([points, more[:, None]], axis=1).astype(np.float32)


def search(vectors: DataFrame, is_query: Column, k: int = 20, options: GraphOptions = GraphOptions()) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the `k` nearest found to every row of `vectors` (vec_id, embedding) with `is_query`.

    Nearest is the largest inner product of the original vectors in double precision, ties go to the smaller vec_id.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = rows.select("vec_id", F.col("embedding").alias("vector"), F.size("embedding").alias("length"), is_query.alias("asks"))
    element = rows.schema["vector"].dataType.simpleString()

    nodes = (
        rows.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id")))
        .where(F.col("at") <= k + 1)
        .groupBy("vector", "length")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    sizes = rows.agg(F.approx_count_distinct("vector").alias("nodes"), F.count_if("asks").alias("queries")).first()
    n_shards = max(1, -(-sizes.nodes // options.shard_rows))
    n_blocks = max(1, -(-sizes.queries // options.block_rows))
    node_type = f"length int, shard int, node int, start boolean, vector {element}, ids array<long>, edges array<int>"
    empty = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("vector_hash", pa.int64()), ("score", pa.float64())])

    def build(table: pa.Table) -> pa.Table:
        n = table.num_rows
        graph = Graph(_with_length(_matrix(table.column("vector"))), options).build()
        start = np.zeros(n, dtype=bool)
        start[graph.start] = True
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * options.degree)
        return pa.table(
            {
                "length": table.column("length"),
                "shard": table.column("shard"),
                "node": pa.array(np.arange(n, dtype=np.int32)),
                "start": pa.array(start),
                "vector": table.column("vector"),
                "ids": table.column("ids").cast(pa.list_(pa.int64())),
                "edges": pa.ListArray.from_arrays(ends, pa.array(graph.edges.ravel())),
            }
        )

    def beam(shard: pa.Table, asking: pa.Table) -> pa.Table:
        if not shard.num_rows or not asking.num_rows:
            return empty.empty_table()
        shard = shard.sort_by("node")
        original = _matrix(shard.column("vector")).astype(np.float64)
        graph = Graph(_with_length(original), options)
        graph.edges = _matrix(shard.column("edges"))
        graph.start = int(np.flatnonzero(shard.column("start").to_numpy())[0])
        queries = _matrix(asking.column("vector")).astype(np.float64)
        found, _ = graph.search(np.pad(queries, ((0, 0), (0, 1))).astype(np.float32), max(options.search_beam, k + 1))
        ids = shard.column("ids").to_pylist()
        out: list[tuple[int, int, int, float]] = []
        for query, mark, vector, near in zip(
            asking.column("vec_id").to_pylist(), asking.column("vector_hash").to_pylist(), queries, found, strict=True
        ):
            near = near[near >= 0]
            scores = original[near] @ vector
            hits = []
            for s, node in zip(scores.tolist(), near.tolist(), strict=True):
                others = list(ids[node])
                if query in others and np.array_equal(original[node], vector):
                    others.remove(query)  # the query's own row, and no other with its id
                hits += [(-s, i) for i in others]
            out += [(query, i, mark, -s) for s, i in sorted(hits)[:k]]
        return pa.table(list(map(list, zip(*out, strict=True))) if out else [[]] * 4, schema=empty)

    shard_of = F.pmod(F.xxhash64("vector"), F.lit(n_shards)).cast("int")
    index = nodes.withColumn("shard", shard_of).groupBy("length", "shard").applyInArrow(build, node_type)
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asking = rows.where("asks").select("vec_id", "vector", "length", F.xxhash64("vector").alias("vector_hash")).distinct()
    asking = asking.withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n_blocks)).cast("int"))
    asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    keys = ("length", "shard", "block")
    hits = index.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(beam, "query_id long, vec_id long, vector_hash long, score double")

    best = Window.partitionBy("query_id", "vector_hash").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
