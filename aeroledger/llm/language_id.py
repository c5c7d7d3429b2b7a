"""Language identification with bit-sliced Bloom filters of character n-grams.

One table of bit masks serves all languages: a slot's bit l belongs to the Bloom filter of language l; from 65 languages on, a slot is several
64-bit words. Looking up the slots of an n-gram and and-ing them gives all languages that contain it. A document counts, per language, how many of its n-grams hit; the share that the filter's
fill predicts as false positives is taken out; the language with the largest corrected share wins.

Edge cases: a null text, or one without a letter, is `und` with score 0. A text whose n-grams hit nothing goes to the language with most
training documents, with score 0. Ties go to the language with more training documents, then by name. A very long text is one array of its
characters in one task. Training skips null texts and null
languages; without any training row every document is `und`. Only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroledger.llm.common import by_bytes

UND = "und"
GRAM = 4
HASHES = 2
BATCH_BYTES = 1 << 20


@dataclass(frozen=True)
class BloomModel:
    langs: tuple[str, ...]  # most training documents first; bit l of a slot is language l
    slots: np.ndarray  # masks, one unsigned integer per slot; with more than 64 languages a row of them
    false_rate: np.ndarray  # per language, the chance that an absent n-gram hits


def _letters() -> np.ndarray:
    """Per code point, whether it is a letter."""
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


_LETTERS: np.ndarray | None = None


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams that hold a letter, the text each is of, and per text whether it has a letter.

    Characters other than letters become blanks, of which one stays on each side of a word; no n-gram spans two texts.
    """
    gap = "\n" * GRAM
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((gap + gap.join(lowered) + gap).encode("utf-32-le", "replace"), dtype=np.uint32)
    lengths = np.fromiter((len(t) + GRAM for t in lowered), dtype=np.int64, count=len(lowered))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    letter = _letters()[codes]
    keep = letter.copy()
    keep[:-1] |= letter[1:]
    keep[1:] |= letter[:-1]
    kept = np.flatnonzero(keep)
    chars = np.where(letter[kept], codes[kept], np.uint32(0)).astype(np.uint64)
    owners = owner[np.minimum(np.maximum(kept - GRAM, 0), len(owner) - 1)] if len(owner) else owner
    n = len(chars) - GRAM + 1
    has = np.zeros(len(texts), dtype=bool)
    if len(owner):
        has[owners[letter[kept]]] = True
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), has
    h = np.zeros(n, dtype=np.uint64)
    for i in range(GRAM):
        h = (h ^ chars[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    same = owners[:n] == owners[GRAM - 1 :]
    return h[same], owners[:n][same], has


def slots_of(h: np.ndarray, k: int, n_slots: int) -> np.ndarray:
    mixed = (h ^ np.uint64(0xD6E8FEB86659FD93 * (k + 1) % (1 << 64))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed ^ (mixed >> np.uint64(31))) >> np.uint64(7)) & np.uint64(n_slots - 1)


def learn(
    docs: DataFrame, max_docs: int = 8_000, grams_per_lang: int = 60_000, n_slots: int = 1 << 19, min_share: float = 0.2, seed: int = 17
) -> BloomModel:
    """Fit the filters on about `max_docs` documents (the bound of the sample), chosen by a hash of their ids.

    An n-gram joins the filter of each language in which it occurs at least twice and at least `min_share` as often (per n-gram) as where it
    is most frequent; a language keeps its `grams_per_lang` most frequent. The driver receives at most `n_slots` masks for 64 languages.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = tuple(sorted(sizes, key=lambda x: (-sizes[x], x)))
    kind = next((t for t, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(langs) <= bits), np.uint64)
    empty = np.zeros(n_slots if len(langs) <= 64 else (n_slots, -(-len(langs) // 64)), dtype=kind)
    if not langs:
        return BloomModel((), empty, np.zeros(0))

    # each language gets the same share of the sample; a smaller language gives all it has
    rate = F.lit(0.0)
    for lang in langs:
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, max_docs / len(langs) / sizes[lang]))).otherwise(rate)
    scaled = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(1_000_000)) / 1e6
    sample = known.where(scaled < rate).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "text", BATCH_BYTES):
            names = np.array(part.column("lang").to_pylist(), dtype=object)
            h, owner, _ = grams(part.column("text").to_pylist())
            for lang in sorted(set(names)):
                found, n = np.unique(h[names[owner] == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                )

    counts = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = Window.partitionBy("gram")
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    chosen = (
        rated.withColumn("best", F.max("rate").over(best))
        .where((F.col("n") >= 2) & (F.col("rate") >= min_share * F.col("best")))
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= grams_per_lang)
    )
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    chosen = chosen.select("gram", number[F.col("lang")].alias("bit"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("gram").to_numpy().view(np.uint64)
            slots = np.concatenate([slots_of(h, k, n_slots) for k in range(HASHES)]).astype(np.int64)
            bit = batch.column("bit").to_numpy()
            masks = np.tile(np.uint64(1) << (bit % 64).astype(np.uint64), HASHES)
            words = np.tile((bit // 64).astype(np.int32), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(words), pa.array(masks.view(np.int64))], ["slot", "word", "mask"])

    masks = chosen.mapInArrow(place, "slot long, word int, mask long").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    slot, word, mask = (masks.column(c).to_numpy() for c in ("slot", "word", "mask"))
    table = empty
    table[slot if table.ndim == 1 else (slot, word)] = mask.view(np.uint64).astype(kind)
    fill = np.array([_bits(table, i).mean() for i in range(len(langs))])
    return BloomModel(langs, table, fill**HASHES)


def _bits(masks: np.ndarray, lang: int) -> np.ndarray:
    """Whether each mask has the bit of a language."""
    words = masks if masks.ndim == 1 else masks[:, lang // 64]
    return ((words >> words.dtype.type(lang % 64)) & words.dtype.type(1)).astype(bool)


def identify(texts: list[str], model: BloomModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Per text: language, score, and the corrected share of n-grams that the language contains."""
    h, owner, has = grams(texts)
    n = np.bincount(owner, minlength=len(texts)).astype(float)
    share = np.zeros((len(texts), max(1, len(model.langs))))
    if len(h):
        hit = model.slots[slots_of(h, 0, len(model.slots))]
        for k in range(1, HASHES):
            hit = hit & model.slots[slots_of(h, k, len(model.slots))]
        for i in range(len(model.langs)):
            found = np.bincount(owner[_bits(hit, i)], minlength=len(texts))
            share[:, i] = np.maximum(0, found / np.maximum(n, 1) - model.false_rate[i]) / (1 - model.false_rate[i])
    best = share.argmax(1)
    top = share[np.arange(len(texts)), best]
    total = share.sum(1)
    score = np.where(total > 0, top / np.where(total > 0, total, 1), 0.0)
    judged = has & bool(model.langs)
    names = [model.langs[b] if ok else UND for b, ok in zip(best, judged, strict=True)]
    return names, np.where(judged, score, 0.0), np.where(judged, top, 0.0)


def predict(docs: DataFrame, model: BloomModel, *keep: str | Column) -> DataFrame:
    """doc_id, text's language lang_pred, score and lang_share of every document, after the columns `keep` (default doc_id).

    The model, of bounded size, goes to the executors as a broadcast variable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(keep or ("doc_id",)), F.col("text").alias("__text"))
    schema = rows.drop("__text").schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_bytes(batches, "__text", BATCH_BYTES):
            names, score, share = identify([t or "" for t in part.column("__text").to_pylist()], shared.value)
            kept = part.drop_columns(["__text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(names, pa.string()), pa.array(score), pa.array(share)],
                [*kept.schema.names, "lang_pred", "score", "lang_share"],
            )

    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double, lang_share double")


def accepts(spark: SparkSession, model: BloomModel, min_share: float) -> Callable[[Column], Column]:
    """Function of a text column: whether the text has a letter and its language contains at least `min_share` of its n-grams.

    Only the texts go to Python, and one boolean each comes back.
    """
    shared = spark.sparkContext.broadcast(model)

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in columns:
            found = [pa.array([], pa.bool_())]
            for part in by_bytes([pa.RecordBatch.from_arrays([texts], ["text"])], "text", BATCH_BYTES):
                names, _, share = identify([t or "" for t in part.column("text").to_pylist()], shared.value)
                found.append(pa.array((np.array(names, dtype=object) != UND) & (share >= min_share), pa.bool_()))
            yield pa.concat_arrays(found)

    return F.arrow_udf(judge, "boolean")


def held_out(doc_id: Column) -> Column:
    """Whether the document is kept from training: crc32 of the id as text, modulo 4, is 2 (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))
