"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are placed longest first, each into the open bin with the least room that still fits. If none fits, a bin of the size that costs least
per token it can still be expected to hold is opened. Each shard is packed once for every permitted size as the largest that is opened for pieces
it can hold (a longer piece opens the smallest size that holds it), and the cheapest result counts; in each, a bin shrinks in the end to the
smallest size that holds its contents. Mixes of sizes are thus compared as a whole, whatever the longest piece is.

Pieces are dealt evenly to shards of bounded size, and each is packed by itself; a shard loses at most its last few bins against packing all
together. A document longer than the largest size is cut into pieces of that size and a rest.

Edge cases: a document without tokens (or with a null count) has one row of no tokens and null bin columns. Repeated rows and null ids are
packed like others. Ties in length keep the order of ids, then of pieces. An empty table gives an empty result. Only the named columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import durable

SHARD_ROWS = 100_000


def training_cost(capacity: int) -> float:
    """Cost of one sequence: a fixed part, a linear part, and attention that grows with the square."""
    return 64 + capacity + capacity * capacity / 65_536


#: Permitted lengths and their costs.
CAPACITIES = {c: training_cost(c) for c in (512, 1024, 2048, 4096, 8192)}


def best_fit(lengths: np.ndarray, capacities: Mapping[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each piece (numbered from 0), place in its bin, and capacity of each bin. No length exceeds the largest capacity."""
    sizes = np.array(sorted(capacities))
    assert lengths.max(initial=0) <= sizes[-1], "a piece is longer than the largest capacity"
    best: tuple[float, tuple] | None = None
    for usual in sizes.tolist():
        bins, places, contents = _pack(lengths, capacities, usual)
        shrunk = sizes[np.searchsorted(sizes, contents)]
        cost = sum(capacities[c] for c in shrunk.tolist())
        if best is None or cost < best[0]:
            best = cost, (bins, places, shrunk)
    assert best is not None, "there is no capacity"
    return best[1]


def _pack(lengths: np.ndarray, capacities: Mapping[int, float], usual: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and place of each piece, and contents of each bin, if sizes above `usual` are opened for longer pieces only."""
    sizes = sorted(capacities)
    bins, places = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    left = int(lengths.sum())  # tokens not yet placed, this piece included
    rooms = 0  # bit r: some open bin has room for r tokens
    open_bins: dict[int, list[int]] = {}
    filled: list[int] = []
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            found = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            largest = max(usual, sizes[bisect_left(sizes, length)])
            room = min((c for c in sizes if length <= c <= largest), key=lambda c: (capacities[c] / min(c, left), c))
            found = len(filled)
            filled.append(0)
        bins[at], places[at] = found, filled[found]
        filled[found] += length
        left -= length
        rest = room - length
        if rest:
            open_bins.setdefault(rest, []).append(found)
            rooms |= 1 << rest
    return bins, places, np.array(filled, dtype=np.int64)


def pieces_of(items: DataFrame, largest: int) -> DataFrame:
    """doc_id, piece, start and n_tokens: documents cut at multiples of `largest`."""
    n = F.coalesce(F.col("n_tokens").cast("long"), F.lit(0))
    numbers = F.sequence(F.lit(0), F.greatest(F.ceil(n / largest) - 1, F.lit(0)).cast("int"))
    cut = items.select("doc_id", n.alias("all"), F.explode(numbers).alias("piece"))
    start = F.col("piece").cast("long") * largest
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(largest).cast("long"), F.col("all") - start).alias("n_tokens"))


def pack(items: DataFrame, capacities: Mapping[int, float] = CAPACITIES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Where each piece of the documents `items` (doc_id, n_tokens) goes.

    Columns: doc_id, piece, start (first token in the document), n_tokens, bin_id, bin_capacity and bin_start (first token in the bin).
    """
    pieces = durable(pieces_of(items, max(capacities)))
    placed = pieces.where(F.col("n_tokens") > 0)
    n_shards = max(1, -(-placed.count() // shard_rows))
    costs = dict(capacities)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = [b for b in batches if b.num_rows]  # of bounded size
        if not shard:
            return
        table = pa.Table.from_batches(shard).sort_by([("doc_id", "ascending"), ("piece", "ascending")]).combine_chunks()
        bins, places, sizes = best_fit(table.column("n_tokens").to_numpy(), costs)
        number = (np.int64(TaskContext.get().partitionId()) << np.int64(32)) + bins
        for name, values in (("bin_id", number), ("bin_capacity", sizes[bins].astype(np.int32)), ("bin_start", places.astype(np.int32))):
            table = table.append_column(name, pa.array(values))
        yield from table.to_batches(max_chunksize=50_000)

    schema = placed.schema.simpleString()[len("struct<") : -1] + ", bin_id long, bin_capacity int, bin_start int"
    packed = placed.repartition(n_shards).mapInArrow(run, schema)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("bin_id", "long"), ("bin_capacity", "int"), ("bin_start", "int"))]
    return packed.unionByName(pieces.where(F.col("n_tokens") <= 0).select("*", *nothing))
