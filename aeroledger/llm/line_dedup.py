"""Lines that many documents share, dropped from all of them.

Lines are exploded, normalised and hashed; the documents of each hash are counted, those of a line in one document being one; the places of
lines over the threshold come back to their documents, which are put together again from the lines left. Only built-in functions are used.

A document is a row. Rows equal in id and text have the same lines to drop, so id and a hash of the text name a row and no number has to be
invented for it. What is shuffled: 24 bytes a distinct line and task, combined before the shuffle, so a line of a third of all documents is
one row a task; the place and hash of each line, joined with the hashes over the threshold, which Spark broadcasts where they are measured to
be small, and whose hot keys adaptive execution splits otherwise; the places dropped of a document; and the lines of each document, once.

Two 64-bit hashes together stand for a line, so two different lines are never taken for one at any real size.

Edge cases: a null or empty text is one empty line; a line of fewer than `min_chars` code points after normalising stays, whatever its
count; if all lines go, the text is empty, and its row stays. Repeated rows count as documents of their own, and each has its row in the
result. Null ids are an id like others. A document of very many lines is one row of the shuffle, and is put together in time proportional to
them. An empty table gives an empty result. Only the named columns and those of `keep` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroledger.llm.common import durable

#: What is stripped from both ends of a line, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(13), key).alias("h2")]


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """h1, h2 (together the hash of a normalised line) and n_docs of all lines of at least `min_docs` documents."""
    keys = docs.select(F.explode(F.array_distinct(F.transform(_lines(F.col("text")), line_key))).alias("key"))
    counted = keys.where(F.char_length("key") >= min_chars).groupBy(*_hashes(F.col("key"))).agg(F.count("*").alias("n_docs"))
    return counted.where(F.col("n_docs") >= min_docs)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns `keep`, n_lines, n_dropped and kept (the other lines, joined by line feeds) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), "text")
    places = named.select("doc_id", "text_hash", F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    places = places.select("doc_id", "text_hash", "place", line_key(F.col("line")).alias("key"))
    places = places.where(F.char_length("key") >= min_chars).select("doc_id", "text_hash", "place", *_hashes(F.col("key")))
    # a table of its own: else the join shares the shuffle that counts the lines, and its hot keys could not be split
    frequent = durable(frequent_lines(docs, min_docs, min_chars).select("h1", "h2"))
    dropped = (
        places.join(frequent, ["h1", "h2"])
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("place").alias("dropped"))
        .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "dropped")
    )
    # the columns of `keep` travel as one, so that none can clash; lines are cut before the join, hence once
    rows = docs.select("doc_id", F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.lit(0)).alias("rest"), F.xxhash64(text).alias("text_hash"), _lines(F.col("text")).alias("lines"))
    joined = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.when(F.col("dropped").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(left, lambda place: F.get(F.col("lines"), place)), "\n")
    )
    return joined.select(
        "doc_id",
        *[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(keep)],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
