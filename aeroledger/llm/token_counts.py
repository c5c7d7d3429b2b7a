"""Token counts with a SentencePiece model: batches balanced by bytes, texts split at safe boundaries, lengths only.

A boundary is safe if no piece of the vocabulary spans it. Here that is a blank after another character (the model writes a blank as U+2581
and no piece holds one after another character) and a line feed after another character (no piece holds one). The model puts a blank before
each text it gets, so a part that begins with one loses it first, and a part that begins with a line feed counts one token less. A batch's
distinct parts are encoded together, and a worker remembers the counts of short parts. A model or a text for which a boundary is not safe is
encoded whole.

Edge cases: a null text counts like an empty one: no bytes, no tokens. Repeated rows and null ids each give a row. Only the named columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from aeroledger.llm.common import by_bytes

BATCH_BYTES = 1 << 20
#: Parts whose counts a Python worker remembers, each of up to 64 characters; the memory is emptied when full.
REMEMBERED = 150_000
BLANK = "▁"
PARTS = re.compile(r" +(?:\n[^ \n]*|[^ \n]*)|\n[^ \n]*|[^ \n]+")


class Counter:
    """Token counts by a model file; one per Python worker."""

    def __init__(self, model_path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(model_path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        pieces = [p.piece for p in proto.pieces if p.type in (p.NORMAL, p.USER_DEFINED)]
        self.splits = (
            spec.name == "identity"
            and spec.add_dummy_prefix
            and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any("\n" in p or BLANK in p.lstrip(BLANK) for p in pieces)
            and not any(p.type == p.USER_DEFINED for p in proto.pieces)
        )
        self.known: dict[str, int] = {}

    def parts(self, text: str) -> tuple[str, list[str]]:
        """The first part, to be encoded as it is, and the others with their leading blank or line feed."""
        if not text or not self.splits or BLANK in text:
            return text, []
        if "  " not in text and " \n" not in text and text[:1] not in " \n" and text[-1:] != " ":
            first, *rest = text.replace("\n", " \n").split(" ")
            return first, rest  # here a part without a line feed has lost its blank
        first, *rest = PARTS.findall(text)
        return first, [p[1:] if p[0] == " " and p[1:2] not in ("", " ", "\n") else p for p in rest]

    def count(self, texts: list[str]) -> list[int]:
        """Of the parts after the first, `x` has lost its blank and `\\nx` had none; those that begin with a blank still have it."""
        split = [self.parts(t) for t in texts]
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        known = self.known
        new = list(set().union(*[rest for _, rest in split]).difference(known))
        known.update(zip(new, self._encoded_lengths(new), strict=True))
        firsts = self.lengths([first for first, _ in split])
        found = [n + sum(map(known.__getitem__, rest)) for n, (_, rest) in zip(firsts, split, strict=True)]
        for part in new:
            if len(part) > 64:
                del known[part]
        return found

    def _encoded_lengths(self, parts: list[str]) -> list[int]:
        bare = [p[1:] if p[0] == " " else p for p in parts]
        sizes = self.lengths(bare)
        return [1 if p == " " else n - (p[0] == "\n") for p, n in zip(parts, sizes, strict=True)]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)] if texts else []


@lru_cache(maxsize=4)
def counter(model_path: str) -> Counter:
    return Counter(model_path)


def count_tokens(docs: DataFrame, model_path: str, id_column: str = "doc_id", *keep: str) -> DataFrame:
    """`id_column`, the columns `keep`, n_bytes and n_tokens of every text; no shuffle."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(id_column, *keep, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("__text"))
    schema = rows.drop("__text").schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(model_path)
        for part in by_bytes(batches, "__text", BATCH_BYTES):
            n = pa.array(tool.count(part.column("__text").to_pylist()), pa.int64())
            kept = part.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, n], [*kept.schema.names, "n_tokens"])

    return rows.mapInArrow(run, schema + ", n_tokens long")
