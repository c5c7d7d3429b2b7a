"""Near-duplicate embeddings by hashing to cells of the E8 lattice.

Each table projects unit vectors to eight random directions, shifts them and takes the nearest E8 lattice point as the cell. A vector also
probes the neighbouring cells that are nearest to it. Two vectors meet in a table if one's cell is probed by the other; every meeting is
verified by the cosine in double precision. A pair that meets in several tables, or in both directions, counts where it meets first, which
the task that holds the pair works out from the two vectors; so no list of pairs is ever shuffled. What leaves a task are link counts per
vector and a spanning forest.

Copies (same label and vector) are one entry with a weight. A cell with many entries is cut into blocks, and pairs of blocks are dealt out,
so no task holds a whole hot cell and every pair in it is still compared.

Edge cases: vectors that are null or zero, or have a null or non-finite component, and rows without a label link with nothing: no links, own
component, kept. Vectors of other lengths are never compared. Repeated ids are rows of their own, linked like any copies. A null vec_id is
kept and has a null component if it has no links. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import durable
from aeroledger.llm.components import LocalComponents, connected_components
from aeroledger.llm.graph_ann import usable


@dataclass(frozen=True)
class LatticeOptions:
    min_cosine: float = 0.93
    tables: int = 14  # a pair at the threshold is missed by all of them about once in 100,000
    probes: int = 12
    scale: float = 1.0  # size of a unit vector's projection, in units of the lattice
    block_rows: int = 2_048
    seed: int = 11


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


SHORTEST = _shortest()


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: the nearer of those in D8 and in D8 shifted by a half."""

    def in_d8(y: np.ndarray) -> np.ndarray:
        whole = np.rint(y)
        rest = y - whole
        odd = whole.sum(1).astype(np.int64) % 2 != 0
        worst = np.abs(rest).argmax(1)
        rows = np.flatnonzero(odd)
        whole[rows, worst[rows]] += np.where(rest[rows, worst[rows]] >= 0, 1.0, -1.0)
        return whole

    a, b = in_d8(x), in_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(nearer[:, None], a, b)


@lru_cache(maxsize=64)
def _projection(length: int, table: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((seed, table, length))
    return rng.standard_normal((length, 8)), rng.uniform(0, 2, 8)


def _cell_key(points: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(points.shape[:-1], salt, dtype=np.uint64)
    for i in range(8):
        h = (h ^ (2 * points[..., i]).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def cells(units: np.ndarray, table: int, options: LatticeOptions) -> tuple[np.ndarray, np.ndarray]:
    """Key of each unit vector's cell, and keys of the cells that it probes."""
    length = units.shape[1]
    turn, shift = _projection(length, table, options.seed)
    y = units @ turn * options.scale + shift
    point = nearest_point(y)
    near = np.argpartition(-((y - point) @ SHORTEST.T), options.probes - 1, axis=1)[:, : options.probes]
    salt = (table + 1) * 1_000_003 + length
    return _cell_key(point, salt), _cell_key(point[:, None, :] + SHORTEST[near], salt)


def units_of(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    return flat / np.sqrt(np.einsum("ij,ij->i", flat, flat))[:, None]


def _meets_before(units: np.ndarray, i: np.ndarray, j: np.ndarray, table: int, options: LatticeOptions) -> np.ndarray:
    """Whether the row pairs meet in any table before `table`."""
    met = np.zeros(len(i), dtype=bool)
    rows, both = np.unique(np.concatenate([i, j]), return_inverse=True)
    x, y = both[: len(i)], both[len(i) :]
    for earlier in range(table):
        own, probed = cells(units[rows], earlier, options)
        met |= own[x] == own[y]
        open_ = np.flatnonzero(~met)
        if not len(open_):
            break
        u, v = x[open_], y[open_]
        met[open_] = (probed[u] == own[v][:, None]).any(1) | (probed[v] == own[u][:, None]).any(1)
    return met


PAIRS_AT_ONCE = 1 << 16
LARGE_CELL = 1 << 14  # pairs from which a cell is one matrix product


def _pairs(cell: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (guest, home) of each cell, some at a time; a large cell comes as an open mesh. Rows are sorted by cell."""
    n_cells = int(cell[-1]) + 1
    homes, guests = np.flatnonzero(home), np.flatnonzero(~home)
    n_homes, n_guests = np.bincount(cell[homes], minlength=n_cells), np.bincount(cell[guests], minlength=n_cells)
    first_home = np.cumsum(n_homes) - n_homes
    large = n_homes * n_guests >= LARGE_CELL
    for c in np.flatnonzero(large):
        b = homes[first_home[c] : first_home[c] + n_homes[c]]
        a = guests[cell[guests] == c]
        step = max(1, 4 * PAIRS_AT_ONCE // len(b))
        for lo in range(0, len(a), step):
            yield a[lo : lo + step, None], b[None, :]
    small = guests[~large[cell[guests]]]
    n = n_homes[cell[small]]
    slot = (np.cumsum(n) - n) // PAIRS_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(small)]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        a, m = small[lo:hi], n[lo:hi]
        at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        yield np.repeat(a, m), homes[np.repeat(first_home[cell[a]], m) + at]


def _links(
    units: np.ndarray, group: np.ndarray, cell: np.ndarray, home: np.ndarray, table: int, options: LatticeOptions
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of one table that link and meet here first."""
    for i, j in _pairs(cell, home):
        if i.ndim == 2:
            x, y = np.nonzero(units[i[:, 0]] @ units[j[0]].T >= options.min_cosine)
            i, j = i[x, 0], j[0, y]
        else:
            near = np.einsum("ij,ij->i", units[i], units[j]) >= options.min_cosine
            i, j = i[near], j[near]
        other = group[i] != group[j]
        i, j = i[other], j[other]
        if not len(i):
            continue
        rows, both = np.unique(np.concatenate([i, j]), return_inverse=True)
        own, probed = cells(units[rows], table, options)
        x, y = both[: len(i)], both[len(i) :]
        inside = own[x] == own[y]
        back = np.zeros(len(i), dtype=bool)  # also found in the cell of i, where j is a guest
        back[~inside] = (probed[y[~inside]] == own[x[~inside]][:, None]).any(1)
        here = np.where(inside, group[i] < group[j], ~back | (own[y] < own[x]))
        i, j = i[here], j[here]
        here = ~_meets_before(units, i, j, table, options)
        yield i[here], j[here]


def near_duplicates(vectors: DataFrame, options: LatticeOptions = LatticeOptions()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `vectors` (vec_id, embedding, label)."""
    valid = F.col("label").isNotNull() & usable(F.col("embedding"))
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector"), F.coalesce(valid, F.lit(False)).alias("valid"))
    labels = rows.schema["label"].dataType.simpleString()
    element = rows.schema["vector"].dataType.simpleString()

    groups = rows.where("valid").groupBy("label", "vector").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"))
    # a group is named by its content: equal names mean equal label and vector
    groups = durable(groups.withColumn("group", F.xxhash64("label", "vector")))

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("vector").offsets.to_numpy())
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                units, group = units_of(part.column("vector")), part.column("group").to_numpy()
                for table in range(options.tables):
                    own, probed = cells(units, table, options)
                    key = np.concatenate([own[:, None], probed], axis=1)
                    home = np.zeros(key.shape, dtype=bool)
                    home[:, 0] = True
                    names = np.repeat(group, key.shape[1])
                    label = part.column("label").take(pa.array(np.repeat(np.arange(len(units)), key.shape[1])))
                    yield pa.RecordBatch.from_arrays(
                        [label, pa.array(np.full(key.size, table, np.int32)), pa.array(key.ravel()), pa.array(home.ravel()), pa.array(names)],
                        ["label", "table", "key", "home", "group"],
                    )

    entry_type = f"label {labels}, `table` int, key long, home boolean, `group` long"
    entries = groups.select("label", "vector", "group").mapInArrow(enter, entry_type)
    cell = ["label", "table", "key"]
    full = entries.groupBy(*cell).agg(F.count("*").alias("n"), F.count_if("home").alias("homes"))
    full = full.where((F.col("n") > 1) & (F.col("homes") > 0))
    blocks = F.ceil(F.col("n") / options.block_rows).cast("int")
    met = entries.join(full.select(*cell, blocks.alias("blocks")), cell)
    # a row looks into every home block of its cell from its own guest block, and a home row is looked at by every guest block
    own_block = F.pmod(F.xxhash64("group"), F.col("blocks")).cast("int")
    all_blocks = F.sequence(F.lit(0), F.col("blocks") - 1)
    as_guest = F.transform(all_blocks, lambda b: F.struct(b.alias("home_block"), own_block.alias("guest_block"), F.lit(False).alias("at_home")))
    as_home = F.transform(all_blocks, lambda b: F.struct(own_block.alias("home_block"), b.alias("guest_block"), F.lit(True).alias("at_home")))
    met = met.withColumn("place", F.explode(F.when(F.col("home"), F.concat(as_guest, as_home)).otherwise(as_guest))).select(*cell, "place.*", "group")
    met = met.join(groups.select("group", "vector", "weight"), "group")

    unit = [*cell, "home_block", "guest_block"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches, unit):
            yield from _compare(rows, unit, options)

    found = met.repartition(*unit).sortWithinPartitions(*unit)
    found = found.select(*unit, "at_home", "group", "weight", F.col("vector").cast(element))
    found = durable(found.mapInArrow(compare, "`group` long, linked long, other long"))

    counts = found.where(F.col("linked") > 0).groupBy("group").agg(F.sum("linked").alias("linked"))
    roots = connected_components(found.where(F.col("other").isNotNull()).select("group", "other")).withColumnRenamed("node", "group")
    named = groups.select("group", "label", "vector", "vec_id", "weight").join(roots, "group", "left").withColumn("root", F.coalesce("root", "group"))
    # a table of its own, so that the join with the members of a large component can be split
    smallest = durable(named.groupBy("root").agg(F.min("vec_id").alias("component_id")))
    named = named.join(smallest, "root").join(counts, "group", "left")
    named = named.select("label", "vector", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    linked = rows.where("valid").drop("valid").join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("valid")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _changes(rows: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Whether each row but the first differs from the one before in a key."""
    new = np.zeros(max(0, rows.num_rows - 1), dtype=bool)
    for k in keys:
        values = rows.column(k).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(k).to_numpy()
        new |= values[1:] != values[:-1]
    return new


def _whole_cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches, cut anew so that rows with equal keys are in one."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        more = pa.Table.from_batches([batch])
        held = more if held is None else pa.concat_tables([held, more])
        cuts = np.flatnonzero(_changes(held, keys))
        if len(cuts):
            yield held.slice(0, int(cuts[-1]) + 1)
            held = held.slice(int(cuts[-1]) + 1)
    if held is not None and held.num_rows:
        yield held


def _compare(rows: pa.Table, keys: list[str], options: LatticeOptions) -> Iterator[pa.RecordBatch]:
    """Link counts and a spanning forest of the links of some cells."""
    cell = np.concatenate([[0], np.cumsum(_changes(rows, keys))])
    table, group, weight = (rows.column(c).to_numpy() for c in ("table", "group", "weight"))
    home = rows.column("at_home").to_numpy().astype(bool)
    ids, which = np.unique(group, return_inverse=True)
    linked, forest = np.zeros(len(ids), dtype=np.int64), LocalComponents(len(ids))
    vectors = rows.column("vector").combine_chunks()
    length = np.diff(vectors.offsets.to_numpy())
    for size in np.unique(length):
        for number in np.unique(table):
            part = np.flatnonzero((length == size) & (table == number))
            units = units_of(vectors.take(pa.array(part)))
            _, cells_here = np.unique(cell[part], return_inverse=True)
            for i, j in _links(units, group[part], cells_here, home[part], int(number), options):
                i, j = part[i], part[j]
                np.add.at(linked, which[i], weight[j])
                np.add.at(linked, which[j], weight[i])
                forest.link(which[i], which[j])
    some = np.flatnonzero(linked)
    if len(some):
        roots = forest.roots()[some]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[some]), pa.array(linked[some]), pa.array(ids[roots], mask=roots == some)], ["group", "linked", "other"]
        )
