"""Byte-level BPE encoding and decoding of whole texts, long ones in overlapping chunks.

A long text is cut into overlapping chunks that are pre-tokenised in parallel. The pattern looks ahead only, so two tokenisations that share
one boundary agree from there on: in each overlap the first boundary that both neighbours found is where the chunks are stitched. Every
chunk then encodes the piece between its two stitches, and the ids are joined in order. A text in which some overlap has no common
boundary (one run longer than the overlap) is pre-tokenised whole. Decoding concatenates the raw bytes of the ids.

Edge cases: a null text is encoded like an empty one, to no ids; null ids decode to no bytes. Repeated rows and null ids of documents each
give a row. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroledger.llm.common import by_bytes, durable

BATCH_BYTES = 1 << 20


class Encoder:
    """Ids by a rank file, and bytes by ids; one per Python worker."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.core = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens])
        self.place = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def ids(self, texts: list[str]) -> pa.ListArray:
        """Ids of texts that each begin and end at a pre-token boundary."""
        found = [np.array(self.core.encode_ordinary(text), dtype=np.int32) for text in texts]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one after another."""
        size = self.size[ids]
        first = np.repeat(self.place[ids] - (np.cumsum(size) - size), size)
        return self.bytes[first + np.arange(len(first))]


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(ranks_path, pattern)


def boundaries(text: str, pattern: regex.Pattern) -> list[int]:
    """Ends of the pre-tokens that the end of `text` cannot have cut: all but those that reach it."""
    return [m.end() for m in pattern.finditer(text) if m.end() < len(text)]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_column: str = "doc_id", chunk_chars: int = 32_768, overlap: int = 1_024
) -> DataFrame:
    """`id_column` and ids (array of int), one row per row of `docs` (its text column is `text`).

    Texts up to `chunk_chars` are encoded where they are read. Chunks of longer ones are dealt over the cluster; only a text's own ids meet
    in one task again.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    short = _encode_whole(rows.where(F.length("text") <= chunk_chars), id_type, ranks_path, pattern)

    long = rows.where(F.length("text") > chunk_chars).withColumn("row", F.monotonically_increasing_id())
    chunk_type = f"row long, id {id_type}, chunk int, n_chunks int, start int, text string"
    step = chunk_chars - overlap

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", BATCH_BYTES):
            for row, key, text in zip(part.column("row"), part.column("id"), part.column("text").to_pylist(), strict=True):
                n = -(-(len(text) - overlap) // step)
                starts = [step * i for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row.as_py()] * n, pa.int64()),
                        pa.array([key.as_py()] * n, key.type),
                        pa.array(range(n), pa.int32()),
                        pa.array([n] * n, pa.int32()),
                        pa.array(starts, pa.int32()),
                        pa.array([text[s : s + chunk_chars] for s in starts], pa.string()),
                    ],
                    ["row", "id", "chunk", "n_chunks", "start", "text"],
                )

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path, pattern)
        for part in by_bytes(batches, "text", BATCH_BYTES):
            heads, tails = [], []
            columns = (part.column(c).to_pylist() for c in ("text", "start", "chunk", "n_chunks"))
            for text, start, chunk, n in zip(*columns, strict=True):
                found = boundaries(text, tool.pattern)
                heads.append([start + p for p in found if p < overlap] if chunk else [])
                tails.append([start + p for p in found if p >= step] if chunk < n - 1 else [])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(heads, kind), pa.array(tails, kind)], [*part.schema.names, "heads", "tails"]
            )

    chunks = long.mapInArrow(cut, chunk_type).repartition("row", "chunk")
    # stitched chunks and texts without a common boundary both start here
    chunks = durable(chunks.mapInArrow(pretokenise, chunk_type + ", heads array<int>, tails array<int>"))
    in_text = Window.partitionBy("row").orderBy("chunk")
    whole_text = Window.partitionBy("row")
    stitched = (
        chunks.withColumn("cut", F.when(F.col("chunk") > 0, F.array_min(F.array_intersect("heads", F.lag("tails").over(in_text)))))
        .withColumn("until", F.lead("cut").over(in_text))
        .withColumn("apart", F.max(F.col("cut").isNull() & (F.col("chunk") > 0)).over(whole_text))
        .drop("heads", "tails")
    )

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path, pattern)
        for part in by_bytes(batches, "text", BATCH_BYTES):
            columns = (part.column(c).to_pylist() for c in ("text", "start", "cut", "until"))
            pieces = [
                text[0 if cut_at is None else cut_at - start : len(text) if until is None else until - start]
                for text, start, cut_at, until in zip(*columns, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("id"), part.column("chunk"), tool.ids(pieces)], ["row", "id", "chunk", "ids"]
            )

    joined = (
        stitched.where(~F.col("apart"))
        .select("row", "id", "chunk", "start", "text", "cut", "until")
        .mapInArrow(encode_chunks, f"row long, id {id_type}, chunk int, ids array<int>")
        .groupBy("row")
        .agg(F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
        .select("id", F.flatten("parts.ids").alias("ids"))
    )
    # without the overlap, the chunks give the text again
    new_part = F.when(F.col("chunk") == F.col("n_chunks") - 1, F.col("text")).otherwise(F.expr(f"substring(text, 1, {step})"))
    apart = (
        stitched.where("apart")
        .select("row", "id", "chunk", new_part.alias("text"))
        .groupBy("row")
        .agg(F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("chunk", "text"))).alias("parts"))
        .select("id", F.array_join("parts.text", "").alias("text"))
    )
    return short.unionByName(joined).unionByName(_encode_whole(apart, id_type, ranks_path, pattern)).withColumnRenamed("id", id_column)


def _encode_whole(rows: DataFrame, id_type: str, ranks_path: str, pattern: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path, pattern)
        for part in by_bytes(batches, "text", BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("id"), tool.ids(part.column("text").to_pylist())], ["id", "ids"])

    return rows.select("id", "text").mapInArrow(run, f"id {id_type}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_column: str = "ids") -> DataFrame:
    """`encoded` with a column decoded (binary); a column of that name is replaced."""
    rows = encoded.drop("decoded")
    schema = rows.schema.simpleString()[len("struct<") : -1] + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(ranks_path, pattern)
        for batch in batches:
            lists = batch.column(ids_column)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            slot = (np.cumsum(counts) - counts) // (BATCH_BYTES // 4)
            cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                ids = lists.slice(lo, hi - lo).flatten().to_numpy()
                ends = np.concatenate([[0], np.cumsum(tool.size[ids])])[np.concatenate([[0], np.cumsum(counts[lo:hi])])]
                data = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(tool.decode(ids))]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.Array.from_buffers(pa.binary(), hi - lo, data)], [*part.schema.names, "decoded"]
                )

    return rows.mapInArrow(run, schema)
