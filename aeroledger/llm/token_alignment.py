"""Alignment of the tokens of two tokenizers, byte-level BPE (A) and SentencePiece (B), with an identity-map fast path.

A encodes a blank and the text, B the text, before which it puts a blank itself. Byte offsets at which a token of both ends cut the tokens into
groups; the last tokens of a group are linked. How often a pair of ids is linked in the whole corpus says which A id fits a B id best.

Most groups are one token of each with the same bytes. An array from A ids to the B id of the same bytes, made once, recognises them; their
links are counted in vectors as long as A's vocabulary, one for each task, whose sum is all that leaves a task. Only the links of irregular
groups enter a shuffle of pairs, combined before it. The highest count of each B id is a vector as well.

For the counts of its links a document looks up the vectors. Irregular pairs that make up more than 1 / `heavy_parts` of all links, `heavy_parts`
of them at most, are looked up in the same way; the other pairs are joined with their counts, so a key of that join has no more than that share
of all links.

Texts are cut where a single blank stands between two characters that are no blanks: A's pattern begins a token there, and no piece of B spans
it (both are checked when the vocabularies are loaded). So the units in between are encoded like texts of their own, each once for as long as a
worker remembers it, and texts of about a megabyte together are aligned at once, in arrays. A very long text is worked through in parts; a run of
any length without such a blank stays whole.

Edge cases: texts that are null or empty, or whose joined tokens of A or B differ from a blank and the text, have no tokens: zeros and an empty
`groups_sha256`. Strings of special tokens inside texts are plain text. Repeated rows and null ids are rows of their own, and all count. Ties:
all links with the highest count of their B id are best. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeroledger.llm.common import by_bytes, durable

BATCH_BYTES = 1 << 20
#: Characters from which a text is cut.
PART_CHARS = 1 << 17
BLANK = "▁"
#: Units that a Python worker remembers; the memory is emptied when full.
REMEMBERED = 400_000
SAFE = re.compile(r"(?<=\S) (?=\S)")
#: A blank that is not safe.
UNSAFE = re.compile(r"\s | \s|^ | $")
B_BITS = 32

ALIGNED = "n_a long, n_b long, n_groups long, groups_sha256 string, same array<int>, same_n array<long>, pairs array<long>, pairs_n array<long>"


def byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves and the others, in order, as the characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the identity map; one per Python worker."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals the texts out
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        to_byte = byte_of_char()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace(BLANK, " ").encode())
        # of several pieces with the same bytes, B writes the one that is no single byte
        plain = lambda i: not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i))
        by_bytes = {t: i for i, t in enumerate(self.b_bytes) if self.b.is_byte(i)} | {t: i for i, t in enumerate(self.b_bytes) if plain(i)}
        self.same = np.array([by_bytes.get(t, -1) for t in self.a_bytes])
        self.a_size, self.b_size = (np.array([len(t) for t in tokens]) for tokens in (self.a_bytes, self.b_bytes))
        # of a token inside a group and at its end
        self.written = [f"{i}{c}" for i in range(len(self.a_bytes)) for c in ",|"] + [f"{i}{c}" for i in range(len(self.b_bytes)) for c in ",;"]
        self.lossless = {bytes([i]) for i in range(256)} <= set(self.a_bytes)  # A can write every byte
        self.splits = self._can_split(a_path)
        self._forget()

    def _can_split(self, a_path: str) -> bool:
        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        pattern = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        spans = any(BLANK in p.lstrip(BLANK) for p in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        # the model adds a blank, keeps all blanks, and takes the text as it is
        probe = [self.b.decode_pieces(self.b.encode(t, out_type=str)) == t for t in ("a  b", " a ", "ﬁ Ａ é")]
        return bool(pattern and spec.get("normalizer") is None and not spans and all(probe))

    def parts(self, text: str) -> Iterator[str]:
        """Parts of about PART_CHARS characters that are encoded like texts of their own."""
        at = 0
        while self.splits and len(text) - at > PART_CHARS and (cut := SAFE.search(text, at + PART_CHARS)):
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:] if at else text

    def units(self, text: str) -> list[str]:
        """The smallest parts: from one safe blank to the next."""
        if not self.splits or BLANK in text:
            return [text]
        return SAFE.split(text) if UNSAFE.search(text) else text.split(" ")

    def remember(self, units: list[str]) -> np.ndarray:
        """Numbers of the units; those not seen before are encoded."""
        if len(self.known) > REMEMBERED or len(self.ids[0]) > 8 * REMEMBERED:
            self._forget()
        known = self.known
        new = [u for u in dict.fromkeys(units) if u not in known]
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            of_a = [x.ids for x in self.a.encode_batch_fast([" " + u for u in new], add_special_tokens=False)]
            of_b = self.b.encode(new, num_threads=1)
            a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
            data = [(" " + u).encode() for u in new]
            fits = [b"".join(map(b_bytes, b)) == d for d, b in zip(data, of_b, strict=True)]
            if not self.lossless:
                fits = [ok and b"".join(map(a_bytes, a)) == d for ok, d, a in zip(fits, data, of_a, strict=True)]
            self.fits = np.concatenate([self.fits, fits])
            for side, ids in enumerate((of_a, of_b)):
                self.counts[side] = np.concatenate([self.counts[side], np.fromiter(map(len, ids), np.int64, len(ids))])
                self.ids[side] = np.concatenate([self.ids[side], np.fromiter(chain.from_iterable(ids), np.int32)])
        return np.fromiter(map(known.__getitem__, units), np.int64, len(units))

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.fits = np.zeros(0, dtype=bool)  # whether both sides have the bytes of the unit
        self.counts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]  # of the ids of a unit, by side
        self.ids = [np.zeros(0, np.int32), np.zeros(0, np.int32)]

    def align(self, parts: list[str]) -> list[Aligned | None]:
        """For each part what its tokens give; None if their bytes differ from a blank and the part."""
        units = [self.units(p) for p in parts]
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        found = self.remember(list(chain.from_iterable(units)))
        part = np.repeat(np.arange(len(parts)), sizes)
        fits = np.bincount(part[~self.fits[found]], minlength=len(parts)) == 0
        found, part = found[fits[part]], part[fits[part]]
        if not len(found):
            return [None] * len(parts)
        sides = []
        for ids, counts in zip(self.ids, self.counts, strict=True):
            n = counts[found]
            first = (np.cumsum(counts) - counts)[found] - (np.cumsum(n) - n)
            sides += ids[np.repeat(first, n) + np.arange(n.sum())].astype(np.int64), np.bincount(part, n, len(parts)).astype(np.int64)[fits]
        aligned = iter(self._align(*sides))
        return [next(aligned) if ok else None for ok in fits]

    def _align(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray) -> Iterator[Aligned]:
        """Ids of both sides, and how many each part has. Both sides of a part have the same bytes, so offsets count on from part to part."""
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        cut_a, cut_b = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a, ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        last_a, last_b = np.flatnonzero(cut_a), np.flatnonzero(cut_b)  # of each group
        equal = self.same[a[last_a]] == b[last_b]
        # the tokens of both, group by group, as places in the table of their texts
        place_a = np.arange(len(a)) + np.concatenate([[0], last_b + 1])[np.cumsum(cut_a) - cut_a]
        place_b = np.arange(len(b)) + (last_a + 1)[np.cumsum(cut_b) - cut_b]
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[place_a] = 2 * a + cut_a
        order[place_b] = 2 * (len(self.a_bytes) + b) + cut_b
        links = np.where(equal, a[last_a], a[last_a] << B_BITS | b[last_b])
        groups = np.searchsorted(last_a, np.concatenate([[0], np.cumsum(n_a)]))
        tokens = np.concatenate([[0], np.cumsum(n_a + n_b)])
        for k in range(len(n_a)):
            g = slice(groups[k], groups[k + 1])
            text = "".join(map(self.written.__getitem__, order[tokens[k] : tokens[k + 1]].tolist()))
            yield Aligned(int(n_a[k]), int(n_b[k]), text, links[g][equal[g]], links[g][~equal[g]])


@dataclass(frozen=True)
class Aligned:
    n_a: int
    n_b: int
    groups: str  # each with a semicolon behind
    equal: np.ndarray  # A ids of links to the same bytes
    other: np.ndarray  # other links, an A id and a B id in one number


class Document:
    """What the parts of one text add up to."""

    def __init__(self):
        self.n_a = self.n_b = 0
        self.digest, self.open = hashlib.sha256(), ""
        self.equal: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.other: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.fits = True

    def add(self, part: Aligned | None) -> None:
        if part is None:
            self.fits = False
            return
        self.n_a += part.n_a
        self.n_b += part.n_b
        self.digest.update((self.open + part.groups[:-1]).encode())
        self.open = ";"
        self.equal.append(part.equal)
        self.other.append(part.other)

    def columns(self) -> tuple:
        """The columns of ALIGNED."""
        if not (self.fits and self.open):
            return 0, 0, 0, "", [], [], [], []
        lists, n = [], 0
        for found in (self.equal, self.other):
            found = np.concatenate(found)
            n += len(found)
            lists += np.unique(found, return_counts=True)
        return self.n_a, self.n_b, n, self.digest.hexdigest(), *lists


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def align(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id") -> DataFrame:
    """row (a number), `id_column` and the columns of ALIGNED for every row of `docs`; no shuffle.

    same and same_n are the A ids of equal tokens with their numbers of links, pairs and pairs_n those of the other links, each an A id
    shifted by 32 bits and a B id.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    kinds = [*[pa.int64()] * 3, pa.string(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
    names = [c.split(" ")[0] for c in ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = vocabularies(a_path, b_path)
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            found = [Document() for _ in range(batch.num_rows)]
            pending: list[tuple[Document, str]] = []
            size = 0
            for document, text in zip(found, batch.column("text").to_pylist(), strict=True):
                for part in tool.parts(text) if text else ():
                    pending.append((document, part))
                    size += len(part)
                    if size >= BATCH_BYTES:
                        _add(tool, pending)
                        size = 0
            _add(tool, pending)
            columns = [pa.array(c, t) for c, t in zip(zip(*(d.columns() for d in found), strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *columns], ["row", "id", *names])

    return rows.mapInArrow(run, f"row long, id {id_type}, {ALIGNED}").withColumnRenamed("id", id_column)


def _add(tool: Vocabularies, pending: list[tuple[Document, str]]) -> None:
    for (document, _), part in zip(pending, tool.align([p for _, p in pending]) if pending else (), strict=True):
        document.add(part)
    pending.clear()


def count_equal(aligned: DataFrame, size: int) -> np.ndarray:
    """Links of equal tokens by A id: a vector per task, summed. At most `size` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            ids, n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("same", "same_n"))
            np.add.at(total, ids, n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["a", "n"])

    summed = aligned.select("same", "same_n").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[summed.column("a").to_numpy()] = summed.column("n").to_numpy()
    return out


def _by_pair(aligned: DataFrame, pairs: str, n: str) -> DataFrame:
    return aligned.select("row", F.explode(F.arrays_zip(pairs, n)).alias("x")).select("row", F.col(f"x.{pairs}").alias("pair"), F.col(f"x.{n}").alias("n"))


def score_links(aligned: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", heavy_parts: int = 1 << 16) -> DataFrame:
    """`id_column`, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of a table that `align` has made."""
    tool = vocabularies(a_path, b_path)
    aligned = durable(aligned)
    equal = count_equal(aligned, len(tool.same))
    counted = durable(_by_pair(aligned, "pairs", "pairs_n").groupBy("pair").agg(F.sum("n").alias("n_pair")))
    b_of = F.col("pair").bitwiseAND((1 << B_BITS) - 1)
    highest = counted.groupBy(b_of.alias("b")).agg(F.max("n_pair").alias("n")).toArrow()  # one row per B id at most
    best = np.zeros(len(tool.b_bytes), dtype=np.int64)
    best[highest.column("b").to_numpy()] = highest.column("n").to_numpy()
    mapped = np.flatnonzero(tool.same >= 0)
    np.maximum.at(best, tool.same[mapped], equal[mapped])

    links = int(equal.sum()) + (counted.agg(F.sum("n_pair")).first()[0] or 0)
    is_heavy = F.col("n_pair") > links // heavy_parts
    heavy = counted.where(is_heavy).orderBy("pair").toArrow()  # fewer than heavy_parts rows
    shared = aligned.sparkSession.sparkContext.broadcast(
        (tool.same, equal, best, *(np.append(heavy.column(c).to_numpy().astype(np.int64), -1) for c in ("pair", "n_pair")))
    )
    id_type = aligned.schema[id_column].dataType.simpleString()
    meta = "n_a", "n_b", "n_groups", "groups_sha256"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, equal, best, heavy, heavy_n = shared.value
        for batch in batches:
            of_row = {c: np.repeat(np.arange(batch.num_rows), np.diff(batch.column(c).offsets.to_numpy())) for c in ("same", "pairs")}
            ids, n, pairs, pairs_n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("same", "same_n", "pairs", "pairs_n"))
            at = np.searchsorted(heavy[:-1], pairs)
            known = heavy[at] == pairs
            n_best, count_sum = np.zeros((2, batch.num_rows), dtype=np.int64)
            for rows, count, top, times in (
                (of_row["same"], equal[ids], best[same[ids]], n),
                (of_row["pairs"][known], heavy_n[at[known]], best[pairs[known] & ((1 << B_BITS) - 1)], pairs_n[known]),
            ):
                np.add.at(n_best, rows, np.where(count == top, times, 0))
                np.add.at(count_sum, rows, count * times)
            left = np.concatenate([[0], np.cumsum(np.bincount(of_row["pairs"][~known], minlength=batch.num_rows))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(left), pa.array(x[~known].astype(np.int64))) for x in (pairs, pairs_n)]
            kept = [batch.column(c) for c in ("row", "id", *meta)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_best), pa.array(count_sum), *lists], ["row", "id", *meta, "n_best", "count_sum", "pairs", "pairs_n"]
            )

    rows = aligned.select("row", F.col(id_column).alias("id"), *meta, "same", "same_n", "pairs", "pairs_n")
    schema = f"row long, id {id_type}, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long, pairs array<long>, pairs_n array<long>"
    scored = durable(rows.mapInArrow(run, schema))
    tops = aligned.sparkSession.createDataFrame(pa.table({"b": np.arange(len(best)), "top": best}))  # B's vocabulary
    light = counted.where(~is_heavy).withColumn("b", b_of).join(F.broadcast(tops), "b").select("pair", "n_pair", (F.col("n_pair") == F.col("top")).alias("is_best"))
    rest = (
        _by_pair(scored, "pairs", "pairs_n")
        .join(light, "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("is_best"), F.col("n")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("n_pair")).alias("more_sum"))
    )
    zero = F.lit(0).cast("long")
    return scored.join(rest, "row", "left").select(
        F.col("id").alias(id_column),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),  # a group has one place at which both end
        (F.col("n_best") + F.coalesce("more_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
