"""Language identification by bit-sliced Bloom filters over byte n-grams.

The filter is an array of slots; each slot holds one bit per language.  An n-gram is
entered for a language by setting that language's bit in ``PROBES`` slots, and looked up
by AND-ing its slots: the bits left are all languages that hold the n-gram.  Summed over
a text this gives one count per language.  The share of slots in which a language's bit
is set gives the rate at which an unknown n-gram hits by chance; counts are corrected
for it, and the largest decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankspark.llm.columns import SPACES, U64, chunks, mix, text_bytes

UNKNOWN = "und"
PROBES = 2
# parts in which the ids of a language are put in order
SAMPLE_PARTS = 256
# Bytes that are no letters (ASCII only; others count as letters).
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass(frozen=True)
class Model:
    """Languages, and the slots of the filter: ``masks[slot, word]`` holds 64 languages."""

    languages: tuple[str, ...]
    masks: np.ndarray
    orders: tuple[int, ...]

    def false_rates(self) -> np.ndarray:
        """Chance that an n-gram of no language hits, per language."""
        filled = [
            ((self.masks[:, i // 64] >> U64(i % 64)) & U64(1)).mean() for i in range(len(self.languages))
        ]
        return np.array(filled) ** PROBES


def ngrams(raw: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first): byte n-grams of each text, with every run of other signs as one blank.

    A blank stands before and after each text, so n-grams see where words begin and end.
    """
    n = len(offsets) - 1
    text = np.insert(raw, np.concatenate([offsets[:-1], offsets[1:]]), 0x20)
    bounds = offsets + 2 * np.arange(n + 1)
    blank = NO_LETTER[text] | SPACES[text]
    text[blank] = 0x20
    keep = np.ones(len(text), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[bounds[:-1][bounds[:-1] < len(text)]] = True
    at = np.zeros(len(text) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    text, bounds = text[keep], at[bounds]
    counts = np.maximum(np.diff(bounds) - order + 1, 0)
    codes = np.zeros(max(0, len(text) - order + 1), np.uint64)
    for k in range(order):
        codes |= text[k : k + len(codes)].astype(np.uint64) << U64(8 * k)
    before = np.cumsum(counts) - counts
    places = np.arange(int(counts.sum())) + np.repeat(bounds[:-1] - before, counts)
    return codes[places] | U64(order << 56), np.append(before, counts.sum())


def slots_of(codes: np.ndarray, n_slots: int) -> list[np.ndarray]:
    mixed = mix(codes)
    return [((mixed >> U64(32 * k)) & U64(n_slots - 1)).astype(np.int64) for k in range(PROBES)]


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Rows that models must not learn from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _count_task(orders):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in chunks(offsets):
                text, inner = raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                for order in orders:
                    codes, first = ngrams(text, inner, order)
                    owner = np.repeat(labels[a:b], np.diff(first))
                    for label in np.unique(labels[a:b]):
                        found, n = np.unique(codes[owner == label], return_counts=True)
                        columns = [np.full(len(found), label), np.full(len(found), order), found.view(np.int64), n]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                            ["language", "size", "code", "n"],
                        )

    return work


def _slot_task(n_slots):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            language = batch.column(0).to_numpy()
            codes = batch.column(1).to_numpy().view(np.uint64)
            for slots in slots_of(codes, n_slots):
                bit = (U64(1) << (language % 64).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(language // 64, pa.int32()), pa.array(slots), pa.array(bit)], ["word", "slot", "mask"]
                )

    return work


def learn(
    docs: DataFrame,
    rows_per_language: int = 2000,
    orders: tuple[int, ...] = (3, 5),
    least_rate: float = 2e-5,
    slot_bits: int = 20,
) -> Model:
    """Fits the filter on (doc_id, text, lang) rows; rows without text or lang are passed over.

    At most ``rows_per_language`` rows of each language are used, those of least hash of
    their id.  An n-gram is entered for a language if it makes up at least ``least_rate``
    of the n-grams of its length there, so a language has at most 1 / least_rate of them
    for each length.  What reaches the driver is the filter (``2**slot_bits`` slots).
    """
    spark = docs.sparkSession
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # the least of each part of a language, then of them all: no task sorts a whole language
    least, sample = ("_hash", "doc_id"), rows.select("doc_id", "lang").withColumns(
        {"_hash": F.xxhash64("doc_id"), "_part": F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(SAMPLE_PARTS))}
    )
    for group in (("lang", "_part"), ("lang",)):
        nth = F.row_number().over(Window.partitionBy(*group).orderBy(*least))
        sample = sample.withColumn("_nth", nth).filter(F.col("_nth") <= rows_per_language)
    sample = sample.select("doc_id", F.col("lang").alias("_lang")).distinct()
    picked = sample.collect()  # rows_per_language for each language
    languages = tuple(sorted({r["_lang"] for r in picked}))
    if not languages:
        return Model((), np.zeros((1 << slot_bits, 1), np.uint64), orders)
    number = {name: i for i, name in enumerate(languages)}
    ids = spark.createDataFrame(
        [(r["doc_id"], r["_lang"], number[r["_lang"]]) for r in picked], "doc_id long, lang string, language int"
    )
    texts = rows.join(F.broadcast(ids), ["doc_id", "lang"]).select("language", F.lower("text").alias("text"))
    counts = (
        texts.mapInArrow(_count_task(orders), "language int, size int, code long, n long")
        .groupBy("language", "size", "code")
        .agg(F.sum("n").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("language", "size"))
    frequent = counts.withColumn("total", total).filter(F.col("n") >= least_rate * F.col("total"))
    filled = (
        frequent.select("language", "code")
        .mapInArrow(_slot_task(1 << slot_bits), "word int, slot long, mask long")
        .groupBy("word", "slot")
        .agg(F.bit_or("mask").alias("mask"))
        .toPandas()
    )
    masks = np.zeros((1 << slot_bits, -(-len(languages) // 64)), np.uint64)
    masks[filled["slot"], filled["word"]] = filled["mask"].to_numpy(np.int64).view(np.uint64)
    return Model(languages, masks, orders)


def language_counts(model: Model, rates: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Corrected number of n-grams per text and language."""
    n_texts = len(offsets) - 1
    out = np.zeros((n_texts, len(model.languages)))
    for order in model.orders:
        codes, first = ngrams(raw, offsets, order)
        places = slots_of(codes, len(model.masks))
        for word in range(model.masks.shape[1]):
            slices = model.masks[:, word]
            mask = slices[places[0]]
            for more in places[1:]:
                mask &= slices[more]
            for i in range(64 * word, min(64 * word + 64, len(model.languages))):
                hits = np.zeros(len(mask) + 1, np.int64)
                np.cumsum((mask >> U64(i % 64)) & U64(1), out=hits[1:])
                count = np.diff(hits[first])
                out[:, i] += (count - np.diff(first) * rates[i]) / (1 - rates[i])
    return np.maximum(out, 0)


def _predict_task(sent):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        rates = model.false_rates()
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            letters = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(len(letters), len(model.languages)), np.zeros(len(letters))
            for a, b in chunks(offsets) if model.languages else ():
                counts = language_counts(model, rates, raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                first = counts.argmax(axis=1)
                top = counts[np.arange(b - a), first]
                counts[np.arange(b - a), first] = 0
                both = top + counts.max(axis=1)
                best[a:b] = first
                score[a:b] = np.divide(top, both, out=np.zeros(b - a), where=both > 0)
            best[~letters], score[~letters] = len(model.languages), 0.0
            columns = [pa.array(names[best], pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *columns], [*batch.schema.names[2:], "lang_pred", "score"])

    return work


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with lang_pred and score.

    Columns of these two names are replaced.  ``lang_pred`` is ``und`` and the score 0 where the text is null or has no letter, or
    if the model knows no language.  The score is the share of the best language among
    the two best: 0.5 is a tie (the first name in order wins), 0 means that no n-gram of
    the text is known.  Rows keep their number; an empty table gives no rows.
    """
    spark = docs.sparkSession
    kept = (docs.select(*keep) if keep else docs).drop("lang_pred", "score")
    text = F.coalesce(F.lower(F.col("text").cast("string")), F.lit(""))
    rows = docs.select(text.alias("_text"), has_letters(F.col("text")).alias("_letters"), *kept.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    sent = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict_task(sent), f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learns on the rows that are not held out, predicts all."""
    with_mark = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model = learn(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), **options)
    return predict(with_mark, model, keep=("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score")
