"""Centroid clustering (Lloyd's rounds in whole numbers) with a vector-approximation file.

Each dimension is cut into a few cells, and a vector's cells are packed into some bits a dimension. For given centroids, lookup tables hold what
a cell adds to the squared distance at least and at most; summed over the dimensions they give an interval per centroid. A squared distance is
taken less the vector's own square, which is the same for all centroids: that makes the intervals a good deal shorter. Where one interval lies
below all others the centroid is known from the approximation alone. Only where intervals overlap the full vector is fetched: Spark hands a
Python worker the cells of all rows, and the components of those rows only that come back as open.

A round needs the sums of each cluster. The first round takes them from all vectors; each later one changes them by the vectors that move.
Since an assignment is a function of the centroids, a round judges the cells by the old and by the new centroids and fetches a vector only if
one of the two assignments is open or if they differ; no assignment is stored and nothing is joined. A round is one pass over the table without
a shuffle but for one row of sums per task and cluster; `k` times `dims` numbers reach the driver. All sums are exact, so the result does not
depend on cells, batches, or order. The cells are laid by mean, spread, least and largest value of each dimension over all vectors.

Edge cases: vectors that are null, of another length, or hold a null or non-finite component take no part and give no row. A component beyond
2^27 after scaling stops the job with an error, since distances would not fit a long. With fewer vectors than centroids there are as many
centroids as vectors. Repeated ids each give a row; as seeds, equal ids go by their components, a null id comes last. Equal distances go to the
smaller number. A centroid without vectors stays. Without vectors the result is empty. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import durable

ROWS_AT_ONCE = 4_096
LARGEST = 1 << 27


@dataclass(frozen=True)
class ClusterOptions:
    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    seed: int = 3
    bits: int = 7  # of a cell


@dataclass(frozen=True)
class Grid:
    """Cells of each dimension: cell c holds the whole numbers from lows[d, c] to highs[d, c]."""

    edges: np.ndarray  # dims x (cells - 1), first number of each cell but the first
    lows: np.ndarray
    highs: np.ndarray
    bits: int

    @staticmethod
    def fit(least: np.ndarray, largest: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int) -> Grid:
        """Even cells within three deviations of the mean; the outer ones reach to the least and largest value."""
        steps = np.linspace(-3, 3, (1 << bits) - 1)
        edges = np.rint(mean[:, None] + spread[:, None] * steps).astype(np.int64)
        edges = np.clip(edges, least[:, None], largest[:, None] + 1)
        lows = np.concatenate([least[:, None], edges], axis=1)
        highs = np.concatenate([edges - 1, largest[:, None]], axis=1)
        return Grid(edges, lows, np.maximum(lows, highs), bits)

    def cells(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, dtype=np.uint8)
        for d in range(x.shape[1]):
            out[:, d] = np.searchsorted(self.edges[d], x[:, d], side="right")
        return out

    def pack(self, cells: np.ndarray) -> np.ndarray:
        """Bytes of each row: `bits` bits a cell."""
        bits = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - self.bits :]
        return np.packbits(bits.reshape(len(cells), -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        dims = len(self.edges)
        bits = np.unpackbits(packed, axis=1)[:, : dims * self.bits].reshape(len(packed), dims, self.bits)
        return (bits << np.arange(self.bits - 1, -1, -1, dtype=np.uint8)).sum(2, dtype=np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest (x - c)^2 - x^2 by dimension, cell and centroid."""
        c = centroids.T[:, None, :]
        low, high = (c * (c - 2 * ends[:, :, None]) for ends in (self.lows, self.highs))
        return np.minimum(low, high), np.maximum(low, high)


def settled(cells: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Per row the centroid whose interval lies below all others, or -1."""
    least, largest = (np.zeros((len(cells), t.shape[2]), dtype=np.int64) for t in tables)
    for d in range(cells.shape[1]):
        least += tables[0][d][cells[:, d]]
        largest += tables[1][d][cells[:, d]]
    best = largest.argmin(1)
    alone = (least <= largest.min(1)[:, None]).sum(1) == 1
    return np.where(alone, best, -1)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the squared distance, exactly; ties go to the smaller number."""
    squared = np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)
    best = squared.argmin(1)
    return best, squared[np.arange(len(x)), best]


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(at, ROWS_AT_ONCE)


def whole_vectors(embeddings: DataFrame, options: ClusterOptions) -> DataFrame:
    """vec_id and components (array of int) of the vectors that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = embeddings.where((F.size("embedding") == options.dims) & finite)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * options.scale))
    fits = F.forall("scaled", lambda x: F.abs(x) <= LARGEST)
    checked = F.when(fits, F.col("scaled").cast("array<int>")).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST} after scaling")))
    return kept.select("vec_id", scaled.alias("scaled")).select("vec_id", checked.alias("components"))


def fit_grid(vectors: DataFrame, options: ClusterOptions) -> Grid | None:
    """Cells by least, largest, mean and spread of each dimension over all vectors; None without vectors."""
    parts = [F.col("components")[d].cast("double") for d in range(options.dims)]
    row = vectors.agg(*[f(p) for f in (F.min, F.max, F.avg, F.stddev_pop) for p in parts]).first()
    if row[0] is None:
        return None
    least, largest, mean, spread = np.array(row, dtype=float).reshape(4, -1)
    return Grid.fit(least.astype(np.int64), largest.astype(np.int64), mean, spread, options.bits)


def approximate(vectors: DataFrame, grid: Grid) -> DataFrame:
    """`vectors` with a column cells (binary), the approximation."""
    shared = vectors.sparkSession.sparkContext.broadcast(grid)
    width = -(-len(grid.edges) * grid.bits // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = shared.value
        for batch in batches:
            for part in _slices(batch):
                packed = grid.pack(grid.cells(_vectors(part.column("components"), len(grid.edges))))
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), part.num_rows, [None, pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([*part.columns, flat.cast(pa.binary())], [*part.schema.names, "cells"])

    return vectors.mapInArrow(run, vectors.schema.simpleString()[len("struct<") : -1] + ", cells binary")


def _open(frame: DataFrame, grid: Grid, old: np.ndarray, new: np.ndarray) -> Column:
    """Whether the approximation leaves the old or the new centroid of a row open, or tells that they differ."""
    shared = frame.sparkSession.sparkContext.broadcast((grid, grid.tables(old), grid.tables(new)))

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grid, *tables = shared.value
        for column in columns:
            found = [pa.array([], pa.bool_())]
            for at in range(0, len(column), ROWS_AT_ONCE):
                packed = np.array([np.frombuffer(c, np.uint8) for c in column.slice(at, ROWS_AT_ONCE).to_pylist()])
                before, after = (settled(grid.unpack(packed), t) for t in tables)
                found.append(pa.array((before != after) | (before < 0)))
            yield pa.concat_arrays(found)

    return F.arrow_udf(judge, "boolean")(F.col("cells"))


def _moves(fetched: DataFrame, old: np.ndarray | None, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Changes of the clusters' sums and sizes by the given vectors, from the old centroids (or none) to the new."""
    k, dims = new.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            for part in _slices(batch):
                x = _vectors(part.column("components"), dims)
                after = nearest(x, new)[0]
                if old is not None:
                    before = nearest(x, old)[0]
                    moved = before != after
                    x, before, after = x[moved], before[moved], after[moved]
                    np.subtract.at(sums, before, x)
                    sizes -= np.bincount(before, minlength=k)
                np.add.at(sums, after, x)
                sizes += np.bincount(after, minlength=k)
        some = np.flatnonzero(sizes.astype(bool) | sums.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(sizes[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"]
        )

    rows = fetched.select("components").mapInArrow(run, "cluster int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(dims)]
    sums, sizes = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=object)
    for r in rows.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():  # k rows at most
        sizes[r["cluster"]] = r["n"]
        sums[r["cluster"]] = [int(r[f"s{d}"]) for d in range(dims)]
    return sums, sizes


def lloyd(table: DataFrame, grid: Grid, seeds: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids after the rounds; `table` has components and cells. At a fixed point the rounds left change nothing."""
    old, new = None, seeds
    sums, sizes = np.zeros(seeds.shape, dtype=object), np.zeros(len(seeds), dtype=object)
    for _ in range(rounds):
        fetched = table if old is None else table.where(_open(table, grid, old, new))
        more, count = _moves(fetched, old, new)
        sums, sizes = sums + more, sizes + count
        moved = [[int(s) // int(n) for s in row] if n else c.tolist() for row, n, c in zip(sums, sizes, new, strict=True)]
        old, new = new, np.array(moved, dtype=np.int64)
        if np.array_equal(old, new):
            break
    return new


def seeds_of(vectors: DataFrame, options: ClusterOptions) -> np.ndarray:
    """Components of the vectors with the smallest hashes of seed and id, in that order."""
    key = F.sha2(F.concat(F.lit(f"{options.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select("components", key.alias("key")).orderBy(F.asc_nulls_last("key"), "components").limit(options.clusters).collect()
    return np.array([r["components"] for r in rows], dtype=np.int64).reshape(len(rows), options.dims)


def cluster(embeddings: DataFrame, options: ClusterOptions = ClusterOptions()) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    vectors = whole_vectors(embeddings, options)
    grid = fit_grid(vectors, options)
    if grid is None:
        columns = "cast(0 as int) cluster", "0L distance", "0L cluster_inertia", "0L inertia", "'' centroid_sha256"
        return vectors.limit(0).selectExpr("vec_id", *columns)
    table = durable(approximate(vectors, grid))
    centroids = lloyd(table, grid, seeds_of(table, options), options.rounds)

    id_type = table.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                best, squared = nearest(_vectors(part.column("components"), centroids.shape[1]), centroids)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(squared)], ["vec_id", "cluster", "distance"]
                )

    assigned = durable(table.select("vec_id", "components").mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long"))
    inertia = [0] * len(centroids)
    for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect():
        inertia[r["cluster"]] = int(r["inertia"])
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.array(*[F.lit(x).cast("long") for x in inertia])[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("long").alias("inertia"),
        F.array(*map(F.lit, digests))[F.col("cluster")].alias("centroid_sha256"),
    )
