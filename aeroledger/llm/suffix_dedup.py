"""Removal of passages that occur more than once, by bounded interval expansion on Burrows-Wheeler transforms.

A byte goes if it is covered by a string of `length` bytes that also starts somewhere else, in the same document or another.

1. Candidates. Every string of `length` bytes takes the smallest hash of its `gram`-byte pieces as its anchor, so equal strings have equal
   anchors wherever they are. Neighbouring strings mostly share an anchor: a run of them, with all their bytes, is a context.
2. Only contexts whose anchor occurs again go on; equal ones become one with a weight, before any text is moved. A context that is alone at
   its anchor then repeats as a whole, as it has a weight of two or more and nothing to be compared with.
3. All different contexts of an anchor meet in one task, which joins those of several anchors into one text and builds its Burrows-Wheeler
   transform, ordered as far as `length` bytes need. Intervals of suffixes are extended backwards by one byte, breadth first: level l finds
   the places where neighbouring suffixes share exactly l bytes. Levels end at `length`: between two places found, suffixes share at least
   `length` bytes, and if their weights add up to two or more, their strings repeat.
4. An anchor with more contexts than fit one transform (`max_contexts`) has its strings compared by their own hashes instead, which deals
   them over the cluster; strings that are equal are added up within each task first.

Edge cases: a null text is like an empty one. Texts shorter than `length` bytes stay whole. Rows equal in all columns are different places,
so they lose what they share. Null and repeated ids are allowed; rows are told apart by id and text. Only the named columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import by_bytes, durable

LENGTH = 200
GRAM = 64
SEGMENT = 1 << 22
MAX_CONTEXTS = 8_192
BATCH_BYTES = 1 << 20
TRANSFORM_BYTES = 1 << 20
KEY = "__text_key"

_BYTE_CODES = np.random.default_rng(2024).integers(0, 1 << 64, 256, dtype=np.uint64)
_STEPS = np.random.default_rng(2025).integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _doubled(values: np.ndarray, width: int, join) -> np.ndarray:
    """`join` over all windows of `width` values, from windows of 1, 2, 4, ... ; the last step overlaps."""
    have, out, i = 1, values, 0
    while have < width:
        step = min(have, width - have)
        out = join(out[: len(out) - step], out[step:], i)
        have, i = have + step, i + 1
    return out


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the string of `length` bytes at each place of `data` (uint8), the place and the hash of its anchor.

    The first of equal pieces is the anchor, so equal strings at two places have anchors at two places. Places are told by the low bits of
    the values that are compared; strings are taken in segments so that these suffice.
    """
    n = len(data) - length + 1
    places, hashes = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    for at in range(0, n, SEGMENT):
        part = data[at : min(at + SEGMENT, n) + length - 1]
        h = _doubled(_BYTE_CODES[part], gram, lambda a, b, i: a * _STEPS[i] + b)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        least = _doubled((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1, lambda a, b, _: np.minimum(a, b))
        place = (least & low).astype(np.int64)
        places[at : at + SEGMENT], hashes[at : at + SEGMENT] = place + at, h[place]
    return places, hashes


def contexts(texts: list[bytes], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per text, the runs of strings with one anchor: first place of each run, anchor, and hash of the run's bytes."""
    none = np.zeros(0, np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < length:
        return [(none, none, none)] * len(texts)
    place, anchor = anchors(data, length, gram)
    out, at = [], 0
    for text in texts:
        n = len(text) - length + 1
        if n <= 0:
            out.append((none, none, none))
        else:
            first = np.flatnonzero(np.diff(place[at : at + n], prepend=-1))
            ends = np.append(first[1:], n) + length - 1
            digest = xxhash.xxh3_64_intdigest
            hashed = np.array([digest(text[a:e]) for a, e in zip(first.tolist(), ends.tolist(), strict=True)], dtype=np.uint64)
            out.append((first, anchor[at + first].view(np.int64), hashed.view(np.int64)))
        at += len(text)
    return out


def transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of `symbols` (0 to 256) as far as `depth` symbols tell, and the step from a rank to that of the suffix one longer.

    Ranks of the first 7 symbols are refined by those of the next 7, 14, 28, ... symbols.
    """
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(7, np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(7):
        key = key * 258 + padded[i : i + n]
    have = 7
    while True:
        order = np.argsort(key)
        new = np.diff(key[order], prepend=-1) != 0
        if have >= depth or new.all():
            break
        rank = np.empty(n + have, dtype=np.int64)
        rank[order] = np.cumsum(new)
        rank[n:] = 0
        key = rank[:n] * (n + 1) + rank[have:]
        have *= 2
    before = symbols[order - 1]  # the symbol before each suffix: the Burrows-Wheeler transform
    step = np.empty(n, dtype=np.int32)
    step[np.argsort(before, kind="stable")] = np.arange(n, dtype=np.int32)
    return order, step


def class_starts(symbols: np.ndarray, step: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffix of each rank shares fewer than `length` symbols with the one before it.

    A level holds the intervals of suffixes that begin with some string of that many symbols; only intervals whose end was found for the
    first time are extended further.
    """
    n = len(symbols)
    before = symbols[order - 1]
    found = np.zeros(n + 1, dtype=bool)
    found[0] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):
        size = hi - lo
        number = np.repeat(np.arange(len(lo), dtype=np.int32), size)
        places = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
        to = step[places]
        by_place = np.argsort(to)
        to, number, symbol = to[by_place], number[by_place], before[places[by_place]]
        new = np.ones(len(to), dtype=bool)
        new[1:] = (np.diff(to) != 1) | (np.diff(number) != 0) | (np.diff(symbol) != 0)
        first = np.flatnonzero(new)
        lo = to[first]
        hi = lo + np.diff(np.append(first, len(to)))
        fresh = ~found[hi]
        lo, hi = lo[fresh], hi[fresh]
        found[hi] = True
        if not len(lo):
            break
    return found[:n]


def repeated(strings: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """Per string, whether the piece of `length` bytes at each place occurs more than once in all strings; a string counts by its weight."""
    sizes = np.array([len(s) for s in strings])
    symbols = np.full(int(sizes.sum()) + len(strings), 256, dtype=np.int16)  # 256 ends each string
    begin = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    offset = np.arange(len(symbols)) - begin[owner]
    symbols[offset < sizes[owner]] = np.frombuffer(b"".join(strings), dtype=np.uint8)
    order, step = transform(symbols, length)
    group = np.cumsum(class_starts(symbols, step, order, length)) - 1
    whole = offset + length <= sizes[owner]
    total = np.bincount(group, weights=(weights[owner] * whole)[order])
    again = np.empty(len(symbols), dtype=bool)
    again[order] = total[group] >= 2
    return [again[b : b + max(0, n - length + 1)] for b, n in zip(begin.tolist(), sizes.tolist(), strict=True)]


def _ranges(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[0::2].tolist(), edges[1::2].tolist()


def cut(text: bytes, spans: np.ndarray) -> tuple[bytes, int, int]:
    """What is left without the spans (first byte, end), the number of bytes removed and of removed runs."""
    if not len(spans):
        return text, 0, 0
    depth = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(depth, spans[:, 0], 1)
    np.add.at(depth, spans[:, 1], -1)
    gone = np.cumsum(depth[:-1]) > 0
    runs = len(_ranges(gone)[0])
    return np.frombuffer(text, dtype=np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, text_key(F.col("text")))


def _repeated_anchors(scanned: DataFrame, per_bucket: int = 500_000) -> DataFrame:
    """anchor: those that occur twice or more in the arrays of column anchor.

    Anchors travel packed by buckets, each batch's counts added up before, and a bucket holds about `per_bucket` of them.
    """
    total = scanned.agg(F.sum(F.size("anchor"))).first()[0] or 0
    buckets = max(64, -(-total // per_bucket))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, n = np.unique(batch.column("anchor").flatten().to_numpy(), return_counts=True)
            bucket = (found.view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            own, first = np.unique(bucket[order], return_index=True)
            ends = pa.array(np.append(first, len(order)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[order])) for x in (found, n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *lists], ["bucket", "anchors", "counts"])

    def unpack(bucket: pa.Table) -> pa.Table:
        anchor, n = (np.concatenate([c.flatten().to_numpy() for c in bucket.column(x).chunks]) for x in ("anchors", "counts"))
        anchor, which = np.unique(anchor, return_inverse=True)
        return pa.table({"anchor": anchor[np.bincount(which, weights=n) > 1]})

    packed = scanned.select("anchor").mapInArrow(pack, "bucket int, anchors array<long>, counts array<int>")
    return packed.groupBy("bucket").applyInArrow(unpack, "anchor long")


def find_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """doc_id, text_key and spans (array of first byte and end) of the documents that hold repeated strings; rows are distinct."""
    keyed = docs if KEY in docs.columns else _keyed(docs)
    rows = keyed.select("doc_id", F.col(KEY).alias("text_key"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", BATCH_BYTES):
            texts = part.column("text").cast(pa.binary()).to_pylist()
            found = contexts(texts, length, gram)
            ends = pa.array(np.cumsum([0, *(len(f) for f, _, _ in found)]).astype(np.int32))
            joined = [np.concatenate([x[i] for x in found]) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array([len(t) for t in texts], pa.int32()),
                    pa.ListArray.from_arrays(ends, pa.array(joined[0].astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(joined[1])),
                    pa.ListArray.from_arrays(ends, pa.array(joined[2])),
                ],
                ["doc_id", "text_key", "n_bytes", "first", "anchor", "context"],
            )

    scanned = rows.where(F.octet_length("text") >= length).mapInArrow(
        scan, f"doc_id {id_type}, text_key long, n_bytes int, first array<int>, anchor array<long>, context array<long>"
    )
    scanned = durable(scanned.withColumn("row", F.monotonically_increasing_id()))

    # places of the contexts whose anchor occurs again: `at` holds the first string of a run and, in the low bits, their number
    again = _repeated_anchors(scanned)
    at = F.expr(f"transform(first, (x, i) -> shiftleft(bigint(x), 10) + IF(i + 1 < size(first), first[i + 1], n_bytes - {length - 1}) - x)")
    places = scanned.select("row", F.explode(F.arrays_zip(at.alias("at"), "anchor", "context")).alias("x")).select("row", "x.*")
    places = durable(places.join(again, "anchor"))
    first, n = F.expr("int(shiftright(at, 10))"), F.expr("int(at & 1023)")

    # every different context once, with its number of places and one of them
    different = places.groupBy("anchor", "context").agg(F.count("*").alias("weight"), F.min(F.struct("row", "at")).alias("one"))
    different = durable(different.select("anchor", "context", "weight", "one.*"))
    per_anchor = different.groupBy("anchor").agg(F.count("*").alias("contexts")).where(F.col("contexts") > 1)
    alone = different.join(per_anchor.select("anchor"), "anchor", "left_anti")
    alone = alone.select("anchor", "context", F.array(F.lit(0)).alias("lo"), F.array(n).alias("hi"))
    compared = different.join(per_anchor, "anchor").withColumn("large", F.col("contexts") > max_contexts)
    wanted = compared.groupBy("row").agg(
        F.collect_list(F.struct("anchor", "context", "weight", "large", first.alias("first"), n.alias("n"))).alias("__wanted")
    )
    names = scanned.select("row", "doc_id", "text_key")
    wanted = wanted.join(names, "row").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__hash"), "__wanted")
    # all columns are kept up to here, so that the texts are dealt out once for this join and for the one that removes the repeats
    sources = keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(KEY) == F.col("__hash"))).select(*keyed.columns, "__wanted")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for part in by_bytes(batches, "text", BATCH_BYTES):
            # equal rows are neighbours after the join; one of them is enough
            keys = list(zip(part.column("doc_id").to_pylist(), part.column(KEY).to_pylist(), strict=True))
            fresh = [a != b for a, b in zip(keys, [last, *keys], strict=False)]
            last = keys[-1]
            part = part.filter(pa.array(fresh))
            lists = part.column("__wanted")
            parent = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            items = lists.flatten()
            texts = part.column("text").cast(pa.binary()).to_pylist()
            first, n = items.field("first").to_pylist(), items.field("n").to_pylist()
            pieces = [texts[p][a : a + m + length - 1] for p, a, m in zip(parent.tolist(), first, n, strict=True)]
            kept = [items.field(c) for c in ("anchor", "context", "weight", "large")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pieces, pa.binary())], ["anchor", "context", "weight", "large", "bytes"])

    fetched = sources.mapInArrow(fetch, "anchor long, context long, weight long, large boolean, bytes binary")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_anchors(batches, TRANSFORM_BYTES):
            key, first = np.unique(
                np.stack([part.column("anchor").to_numpy(), part.column("context").to_numpy()], axis=1), axis=0, return_index=True
            )
            part = part.take(pa.array(first))
            flags = repeated(part.column("bytes").to_pylist(), part.column("weight").to_numpy(), length)
            spans = [_ranges(f) for f in flags]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[:, 0]),
                    pa.array(key[:, 1]),
                    pa.array([a for a, _ in spans], pa.list_(pa.int32())),
                    pa.array([b for _, b in spans], pa.list_(pa.int32())),
                ],
                ["anchor", "context", "lo", "hi"],
            )

    answer = "anchor long, context long, lo array<int>, hi array<int>"
    usual = fetched.where(~F.col("large")).select("anchor", "context", "weight", "bytes")
    usual = usual.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, answer)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "bytes", BATCH_BYTES // 8):
            texts = part.column("bytes").to_pylist()
            counts = np.array([len(t) - length + 1 for t in texts])
            source = pa.array(np.repeat(np.arange(len(texts)), counts))
            digest = xxhash.xxh3_64_intdigest
            hashed = np.array([digest(t[i : i + length]) for t in texts for i in range(len(t) - length + 1)], dtype=np.uint64)
            places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            kept = [part.column(c).take(source) for c in ("anchor", "context", "weight")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(places.astype(np.int32)), pa.array(hashed.view(np.int64))], ["anchor", "context", "weight", "place", "string"]
            )

    answers = usual
    if not compared.where("large").isEmpty():
        spelled = fetched.where("large").dropDuplicates(["anchor", "context"]).select("anchor", "context", "weight", "bytes")
        spelled = spelled.mapInArrow(spell, "anchor long, context long, weight long, place int, string long")
        common = spelled.groupBy("anchor", "string").agg(F.sum("weight").alias("n")).where(F.col("n") > 1).select("anchor", "string")
        found = spelled.join(common, ["anchor", "string"], "left_semi").groupBy("anchor", "context")
        found = found.agg(F.array_sort(F.collect_list("place")).alias("lo"))
        answers = answers.unionByName(found.withColumn("hi", F.transform("lo", lambda x: x + 1)))

    answers = alone.unionByName(answers.where(F.size("lo") > 0))
    spans = places.join(answers, ["anchor", "context"]).select("row", first.alias("first"), "lo", "hi")
    ends = f"transform(arrays_zip(lo, hi), x -> struct(first + x.lo AS lo, first + x.hi + {length - 1} AS hi))"
    spans = spans.select("row", F.expr(ends).alias("spans"))
    spans = spans.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return spans.join(names, "row").select("doc_id", "text_key", "spans").groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans"))


def _whole_anchors(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.Table]:
    """Rows sorted by anchor, cut where the anchor changes into tables of about `max_bytes`; an anchor's rows stay together."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column("anchor").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(anchor)) + 1).tolist(), batch.num_rows]
        lengths = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy(), dtype=np.int64)])
        lo = 0
        for a, b in zip(cuts, cuts[1:], strict=False):
            if anchor[a] != last and size >= max_bytes:
                if a > lo:
                    held.append(batch.slice(lo, a - lo))
                yield pa.Table.from_batches(held)
                held, size, lo = [], 0, a
            size += int(lengths[b] - lengths[a])
            last = anchor[a]
        held.append(batch.slice(lo))
    if held:
        yield pa.Table.from_batches(held)


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, max_contexts: int = MAX_CONTEXTS, as_text: bool = False
) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans and kept (binary): the text without repeated strings; columns of these names are replaced.

    With `as_text`, kept is a string without characters that a cut has broken, and null where nothing is removed.
    """
    made = ("n_bytes", "n_removed", "n_spans", "kept")
    rows = docs.drop(*made)
    names, keyed = rows.columns, _keyed(rows)
    spans = find_repeats(keyed, length, gram, max_contexts)
    spans = spans.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__hash"), F.col("spans").alias("__spans"))
    joined = keyed.join(spans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(KEY) == F.col("__hash")), "left")
    joined = joined.select(*names, "__spans")
    schema = rows.schema.simpleString()[len("struct<") : -1] + ", n_bytes long, n_removed long, n_spans long, kept " + ("string" if as_text else "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", BATCH_BYTES):
            texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
            lists = part.column("__spans")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            flat = lists.flatten()
            where = np.stack([flat.field("lo").to_numpy(), flat.field("hi").to_numpy()], axis=1)
            left = [cut(t, where[a:b]) for t, a, b in zip(texts, ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in names),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([n for _, n, _ in left], pa.int64()),
                    pa.array([n for _, _, n in left], pa.int64()),
                    pa.array([t.decode("utf-8", "ignore") if n else None for t, n, _ in left], pa.string()) if as_text else pa.array([t for t, _, _ in left], pa.binary()),
                ],
                [*names, *made],
            )

    return joined.mapInArrow(run, schema)
