"""SimHash near-duplicates by a self-join of a binary trie of fingerprints.

Pairs of trie nodes are walked together, top bit first; differing bits add up along the way and a pair whose sum exceeds the budget is left
with everything below it. `Rule` says how long shingles are, how many bits may differ, and which turns of the fingerprint are tries of their own.

`WITHIN_TWO_BITS` finds every pair of 64-bit fingerprints that differ in at most two bits: of three blocks one is equal, so the trie is built
three times, each time with another block on top, and the walk allows no difference within that block.

The upper part of the walk is done by the shuffle: a cell is a pair of nodes at some depth, with the difference so far, and holds the
fingerprints below them. A cell with too many of them is taken further down until it is small enough: at the last bit it holds two fingerprints
at most, so none is left out and none grows with the data. Inside a cell the walk is vectorised, and only a spanning forest of the links found
leaves it. Equal fingerprints are one leaf.

Edge cases: a null text is like an empty one, its fingerprint is zero and links like any other. A text of fewer words than a shingle is one
shingle. Rows with the same text share a component. Null ids take no part in the smallest id; a component of null ids only has a null
component_id. A very long text is split into words by one task; its shingles are hashed one by one and counted some thousand at a time. Only the
named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import by_bytes, durable
from aeroledger.llm.components import LocalComponents, connected_components

BITS = 64
BATCH_BYTES = 1 << 20
HASHES_AT_ONCE = 1 << 14
PAIRS_AT_ONCE = 1 << 19
CELL_ROWS = 40_000


@dataclass(frozen=True)
class Rule:
    """Which fingerprints link."""

    words: int  # of a shingle
    turns: tuple[int, ...]  # the rotations that are tries
    exact_bits: int  # on top, none of these may differ
    budget: int  # differing bits in all

    def allowed(self, depth: int) -> int:
        return 0 if depth <= self.exact_bits else self.budget


WITHIN_TWO_BITS = Rule(words=3, turns=(0, 21, 42), exact_bits=21, budget=2)


def shingles(text: str, words: int, seed: int) -> np.ndarray:
    """XXH64 of all shingles of `words` words, A-Z lower-cased, blanks collapsed."""
    found = text.encode("utf-8", "replace").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(found)
    if len(found) < words:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
    else:
        starts = [0, *accumulate(len(w) + 1 for w in found)]
        ends = [s - 1 for s in starts[words:]]
        hashes = map(xxhash.xxh64_intdigest, map(line.__getitem__, map(slice, starts, ends)), repeat(seed))
    return np.fromiter(hashes, dtype="<u8")


def majority(values: np.ndarray) -> int:
    """Bit-wise majority of hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(values), HASHES_AT_ONCE):
        part = values[i : i + HASHES_AT_ONCE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, hash of the text and fingerprint (64 bits as a long) of every row."""
    rows = docs.select("doc_id", _text_hash(F.col("text")).alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_hash long, fingerprint long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", BATCH_BYTES):
            found = np.fromiter((majority(shingles(t.as_py(), words, seed)) for t in part.column("text")), np.uint64, part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fingerprint"]
            )

    return rows.mapInArrow(run, schema)


def _mask(depth: int) -> np.uint64:
    """The `depth` top bits."""
    return np.uint64(0) if depth == 0 else np.uint64(((1 << depth) - 1) << (BITS - depth))


def walk(values: np.ndarray, n_left: int, depth: int, differing: int, rule: Rule, links: LocalComponents) -> None:
    """Link all rows that the rule links, starting from one pair of nodes.

    `values` (unsigned, turned) holds the sorted values below the left node, then, from `n_left` on, those below the right node; with
    `n_left` equal to the length, the node is paired with itself. A frontier has ranges of both nodes and the difference so far.
    """
    n = len(values)
    first = (0, n, 0, n) if n_left == n else (0, n_left, n_left, n)
    work = [(depth, *(np.array([x]) for x in (*first, differing)))]
    while work:
        depth, a0, a1, b0, b1, diff = work.pop()
        ready = (a1 - a0 == 1) & (b1 - b0 == 1) & (a0 != b0)
        i, j = a0[ready], b0[ready]
        close = np.bitwise_count(values[i] ^ values[j]) <= rule.budget
        links.link(i[close], j[close])
        a0, a1, b0, b1, diff = (x[~ready] for x in (a0, a1, b0, b1, diff))
        if not len(a0):
            continue
        if len(a0) > PAIRS_AT_ONCE:
            half = len(a0) // 2
            work += [(depth, *(x[:half] for x in (a0, a1, b0, b1, diff))), (depth, *(x[half:] for x in (a0, a1, b0, b1, diff)))]
            continue
        ones = np.concatenate([[0], np.cumsum((values >> np.uint64(BITS - 1 - depth)) & np.uint64(1), dtype=np.int64)])
        a_mid, b_mid = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        children = [(a0, a_mid, b0, b_mid, diff), (a_mid, a1, b_mid, b1, diff)]
        crossed = diff < rule.allowed(depth + 1)
        children.append(tuple(x[crossed] for x in (a0, a_mid, b_mid, b1, diff + 1)))
        crossed &= ~same  # a node with itself has this pair of children once
        children.append(tuple(x[crossed] for x in (a_mid, a1, b0, b_mid, diff + 1)))
        a0, a1, b0, b1, diff = (np.concatenate(x) for x in zip(*children, strict=True))
        alive = (a1 > a0) & (b1 > b0) & ((a0 != b0) | (a1 - a0 > 1))
        work.append((depth + 1, *(x[alive] for x in (a0, a1, b0, b1, diff))))


def _links_in_cell(table: pa.Table, rule: Rule) -> pa.Table:
    """Spanning forest of the links in one cell: pairs of fingerprints."""
    depth, differing = (table.column(c)[0].as_py() for c in ("depth", "differing"))
    left, right = (np.uint64(table.column(c)[0].as_py() & (1 << BITS) - 1) for c in ("left", "right"))
    table = table.combine_chunks()
    values, names = table.column("value").to_numpy().view(np.uint64), table.column("fingerprint").to_numpy()
    below = (values & _mask(depth)) == left
    order = np.lexsort((values, ~below)) if left != right else np.argsort(values)
    values, names = values[order], names[order]
    links = LocalComponents(len(values))
    if len(values) > 1:
        walk(values, int(below.sum()), depth, differing, rule, links)
    roots = links.roots()
    moved = np.flatnonzero(roots != np.arange(len(names)))
    return pa.table({"fingerprint": names[moved], "linked": names[roots[moved]]})


def _next_cells(cells: DataFrame, step: int, rule: Rule) -> DataFrame:
    """Take cells `step` bits further down: a value meets those whose next bits differ from its own in as many bits as are left."""
    masks = [m for m in range(1 << step) if m.bit_count() <= rule.budget]
    down = cells.withColumn("flip", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
    allowed = F.when(F.col("depth") + step <= rule.exact_bits, 0).otherwise(rule.budget)
    down = down.where(F.col("differing") + F.bit_count("flip") <= allowed)
    down = down.withColumns(
        {
            "top": F.expr("CASE WHEN depth = 0 THEN 0L ELSE shiftleft(-1L, 64 - depth) END"),
            "deeper": F.expr(f"shiftleft(-1L, 64 - depth - {step})"),
            "flipped": F.expr(f"shiftleft(flip, 64 - depth - {step})"),
        }
    )
    down = down.withColumns(
        {
            "own": F.expr("value & deeper"),
            "other": F.expr("(CASE WHEN (value & top) = left THEN right ELSE left END) | ((value & (deeper ^ top)) ^ flipped)"),
        }
    )
    return down.select(
        "trie",
        F.least("own", "other").alias("left"),
        F.greatest("own", "other").alias("right"),
        (F.col("depth") + step).alias("depth"),
        (F.col("differing") + F.bit_count("flip")).cast("int").alias("differing"),
        "value",
        "fingerprint",
    )


CELL = ["trie", "left", "right", "depth", "differing"]


def links(distinct: DataFrame, rule: Rule, n: int, **cells: int) -> DataFrame:
    """fingerprint and linked: a spanning forest, per cell, of the pairs of `n` distinct fingerprints that the rule links."""
    found = _cells(distinct, rule, n, **cells).groupBy(*CELL)
    return found.applyInArrow(lambda table: _links_in_cell(table, rule), "fingerprint long, linked long")


def _cells(distinct: DataFrame, rule: Rule, n: int, cell_rows: int = CELL_ROWS, max_cell_rows: int = 200_000) -> DataFrame:
    """Cells that hold the `n` distinct fingerprints of all tries, small enough for a task each.

    `cell_rows` is the usual size of a cell, `max_cell_rows` the size from which a cell is taken further down.
    """
    depth = min(rule.exact_bits, (n // cell_rows).bit_length())
    top = F.lit(0 if depth == 0 else -1 << (BITS - depth)).cast("long")
    turned = [
        F.struct(F.lit(i).alias("trie"), F.expr(f"shiftleft(fingerprint, {r}) | shiftrightunsigned(fingerprint, {BITS - r})" if r else "fingerprint").alias("value"))
        for i, r in enumerate(rule.turns)
    ]
    cells = distinct.select("fingerprint", F.explode(F.array(*turned)).alias("x")).select(
        "x.trie",
        F.col("x.value").bitwiseAND(top).alias("left"),
        F.col("x.value").bitwiseAND(top).alias("right"),
        F.lit(depth).alias("depth"),
        F.lit(0).alias("differing"),
        "x.value",
        "fingerprint",
    )
    done = None
    while n > max_cell_rows:  # no cell holds more than all
        open_cells = cells.where(F.col("depth") + 4 <= BITS)  # the last four bits tell few fingerprints apart
        large = durable(open_cells.groupBy(*CELL).agg(F.count("*").alias("n")).where(F.col("n") > max_cell_rows).select(*CELL))
        if large.isEmpty():
            break
        fits = cells.join(large, CELL, "left_anti")
        done = fits if done is None else done.unionByName(fits)
        cells = durable(_next_cells(cells.join(large, CELL, "left_semi"), 4, rule))
    return cells if done is None else done.unionByName(cells)


def _components(docs: DataFrame, rule: Rule, seed: int, cells: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Fingerprints of all rows, and per distinct fingerprint the first row (id, then hash of the text) of its component."""
    prints = durable(fingerprints(docs, rule.words, seed))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = durable(prints.groupBy("fingerprint").agg(F.min(row).alias("first")))
    linked = links(distinct.select("fingerprint"), rule, distinct.count(), **cells)
    roots = connected_components(linked).withColumnRenamed("node", "fingerprint")
    named = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    # a table of its own, so that the join with the members of a large component can be split
    smallest = durable(named.groupBy("root").agg(F.min("first").alias("first")))
    return prints, named.drop("first").join(smallest, "root")


def components(docs: DataFrame, rule: Rule = WITHIN_TWO_BITS, seed: int = 42, **cells: int) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row; component_id is the smallest doc_id reachable over links of the rule."""
    prints, of_print = _components(docs, rule, seed, cells)
    of_print = of_print.select("fingerprint", F.col("first.doc_id").alias("component_id"))
    return prints.join(of_print, "fingerprint").select("doc_id", "fingerprint", "component_id")


def as_hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), BITS // 4, "0"))


def keep_one(docs: DataFrame, rule: Rule = WITHIN_TWO_BITS, seed: int = 42, **cells: int) -> DataFrame:
    """One row of `docs` of each component, all columns: the one with the smallest doc_id.

    Rows without an id come last. Rows that share an id are told apart by the hash of their text; of rows that are equal in both, one stays.
    """
    prints, of_print = _components(docs, rule, seed, cells)
    first = durable(of_print.select(F.col("first.doc_id").alias("id"), F.col("first.text_hash").alias("hash")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
    often = prints.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    twice = durable(often.join(first, same, "left_semi").select("doc_id", "text_hash"))

    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), _text_hash(F.col("text")).alias("text_hash"))
    kept = rows.join(first, same, "left_semi")
    if twice.isEmpty():
        return kept.select("row.*")
    again = twice.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    one = kept.join(again, same, "left_semi").groupBy("doc_id", "text_hash").agg(F.first("row").alias("row"))
    return kept.join(again, same, "left_anti").select("row.*").unionByName(one.select("row.*"))


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))
