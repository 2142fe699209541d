"""Benchmark decontamination by spaced-seed hashing.

A seed mask is a row of ones and zeros; laid on consecutive words it hashes those under
a one and ignores those under a zero.  A test item and a text that agree but for some
replaced words still have equal hashes wherever the replaced words fall under zeros.
Hashes of all positions of the test items are joined with those of all positions of the
texts; every hit fixes a diagonal (place in the text minus place in the item), along
which the best stretch is found in which at least ``ratio`` of the words agree.

A bitmap of fixed size over the item hashes lets the scan of the texts put out only
positions that may hit; the join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.llm import bitmap
from rankspark.llm.columns import (
    BASE,
    U64,
    ascii_lower,
    chunks,
    mix,
    powers,
    segment_hashes,
    text_bytes,
    words,
)
from rankspark.session import keep, lookup_join

# Six of nine to twelve words each, so that no two replaced words hide all masks.
MASKS = ("111111", "111010011", "11010001101", "10110010011")
# Items of SHORTEST to SHORT - 1 words are cut into one block more than words may be
# replaced, so that one block is always whole; blocks are their only seeds.
SHORTEST, SHORT = 3, 14
BITMAP_BITS = 24
PROBES = 3

FOUND = (
    "doc_id long, item_id long, start_word long, end_word long, item_start long, "
    "n_matched long, similarity double"
)


def seed_hashes(hashes: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a mask at every place where it fits into one text."""
    span = len(mask)
    counts = np.maximum(np.diff(first) - span + 1, 0)
    before = np.cumsum(counts) - counts
    at = np.arange(int(counts.sum()), dtype=np.int64) + np.repeat(first[:-1] - before, counts)
    weight = powers(BASE, span)
    total = np.zeros(len(at), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            total += hashes[at + k] * weight[k]
    return mix(total + U64(int(mask, 2) * int(BASE) % 2**64)), at


def probe(hashes: np.ndarray, k: int) -> np.ndarray:
    """Bit numbers of the k-th probe; the hashes are mixed, so their parts are independent."""
    return (hashes >> U64(k * 20)) & U64((1 << BITMAP_BITS) - 1)


def text_words(batch_column, a: int, b: int, raw: np.ndarray, offsets: np.ndarray):
    text = ascii_lower(raw[offsets[a] : offsets[b]])
    starts, ends, first = words(text, offsets[a : b + 1] - offsets[a])
    return segment_hashes(text, starts, ends), first


def blocks(n: int, ratio: float) -> list[tuple[int, int]]:
    """(start, words) of the blocks of an item of ``n`` words."""
    parts = min(n, n - int(np.ceil(ratio * n - 1e-9)) + 1)
    bounds = [k * n // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _item_task(masks, ratio: float):
    starts = {(n, *block) for n in range(SHORTEST, SHORT) for block in blocks(n, ratio)}
    sizes = sorted({size for _, _, size in starts})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                hashes, first = text_words(batch.column(1), a, b, raw, offsets)
                rows = [[], [], [], []]
                for mask, size in [*((mask, 0) for mask in masks), *(("1" * size, size) for size in sizes)]:
                    seeds, at = seed_hashes(hashes, first, mask)
                    owner = np.searchsorted(first, at, side="right") - 1
                    n, place = first[owner + 1] - first[owner], at - first[owner]
                    chosen = n >= SHORT
                    if size:
                        chosen = np.zeros(len(n), bool)
                        for k in np.flatnonzero(n < SHORT):
                            chosen[k] = (int(n[k]), int(place[k]), size) in starts
                    rows[0].append(owner[chosen] + a)
                    rows[1].append(seeds[chosen].view(np.int64))
                    rows[2].append(place[chosen])
                    rows[3].append(np.full(int(chosen.sum()), size, np.int32))
                owner, seeds, at, block = map(np.concatenate, rows)
                keys = batch.column(0).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(seeds), pa.array(at), pa.array(block)], ["item_key", "seed", "item_at", "block"]
                )

    return work


def _word_task(name: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                hashes, first = text_words(batch.column(1), a, b, raw, offsets)
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], [name, "words"])

    return work


def _scan_task(masks, bitmap):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                hashes, first = text_words(batch.column(1), a, b, raw, offsets)
                found_at, found = [], []
                for mask in masks:
                    seeds, at = seed_hashes(hashes, first, mask)
                    for k in range(PROBES):
                        bit = probe(seeds, k)
                        hit = (bits[(bit >> U64(3)).astype(np.int64)] >> (bit & U64(7)).astype(np.uint8)) & 1
                        alive = np.flatnonzero(hit)
                        seeds, at = seeds[alive], at[alive]
                    found_at.append(at)
                    found.append(seeds)
                at, seeds = np.concatenate(found_at), np.concatenate(found)
                if not len(at):
                    continue
                owner = np.searchsorted(first, at, side="right") - 1
                order = np.argsort(owner, kind="stable")
                owner, at, seeds = owner[order], at[order], seeds[order]
                docs, begin = np.unique(owner, return_index=True)
                hit_bounds = pa.array(np.append(begin, len(owner)), pa.int32())
                sizes = first[docs + 1] - first[docs]
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                inside = np.arange(bounds[-1]) + np.repeat(first[docs] - bounds[:-1], sizes)
                as_list = lambda b, v: pa.ListArray.from_arrays(b, pa.array(v))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(docs + a)),
                        batch.column(2).take(pa.array(docs + a)),
                        as_list(pa.array(bounds, pa.int32()), hashes[inside].view(np.int64)),
                        as_list(hit_bounds, seeds.view(np.int64)),
                        as_list(hit_bounds, at - first[owner]),
                    ],
                    ["doc_key", "doc_id", "words", "seeds", "places"],
                )

    return work


def best_stretch(same: np.ndarray, ratio: float) -> tuple[int, int, int]:
    """(start, end, matches) of the stretch of most matches whose share is at least ``ratio``.

    A match counts 1 - ratio, a difference -ratio: a sum of zero or more is a share of
    ``ratio`` or more.  The stretch begins and ends with a match.
    """
    hits = np.flatnonzero(same)
    best = (0, 0, 0)
    if not len(hits):
        return best
    # value of the stretch from hit i to hit j: linear in both ends
    gain = np.arange(len(hits)) - ratio * hits
    low = np.minimum.accumulate(gain)
    for j in range(len(hits)):
        # the earliest i with gain[i] <= gain[j] + 1 - ratio; ``low`` falls with i
        i = int(np.searchsorted(-low, -(gain[j] + 1 - ratio + 1e-9)))
        if i <= j and j - i + 1 > best[2]:
            best = (int(hits[i]), int(hits[j]) + 1, j - i + 1)
    return best


def _verify_task(ratio: float, least: int):
    def work(frames):
        for frame in frames:
            out = []
            for key, doc_id, item_id, diagonal, text, item in zip(
                frame["doc_key"], frame["doc_id"], frame["item_id"], frame["diagonal"], frame["words"], frame["item_words"], strict=True
            ):
                a, b = max(0, diagonal), min(len(text), diagonal + len(item))
                start, end, matched = best_stretch(text[a:b] == item[a - diagonal : b - diagonal], ratio)
                # a stretch may lack its outer words: it counts by its matches
                fits = len(item) <= least or b - a >= least
                if fits and matched and matched >= ratio * min(least, len(item)) - 1e-9:
                    out.append(
                        (key, doc_id, item_id, a + start, a + end, a + start - diagonal, matched, matched / (end - start))
                    )
            names = ["doc_key", *(part.split()[0] for part in FOUND.split(", "))]
            import pandas as pd

            result = pd.DataFrame(out, columns=names)
            yield result.astype({"doc_id": "Int64", "item_id": "Int64"})

    return work


def _row_key(own: str):
    return F.xxhash64(F.col(own).cast("long"), F.col("text").cast("string"))


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    masks: tuple[str, ...] = MASKS,
    ratio: float = 0.8,
    least: int = 13,
) -> DataFrame:
    """Passages of test items in texts, replaced words tolerated (``FOUND``).

    ``docs`` needs (doc_id, text), ``items`` (item_id, text); other columns are ignored.
    Words are parted by white space, A-Z in lower case.  One row per (doc_id, item_id):
    the stretch with most equal words among those of at least ``least`` words (or the
    whole item, if it has fewer) of which ``ratio`` agree; of equal ones the earliest.
    Given are the places from its first to its last equal word.  Items of fewer than
    SHORTEST words are not searched for; those of fewer than SHORT are never missed.  Null
    or empty texts match nothing; null ids stay null; rows that repeat give one result
    per id; empty tables give no rows.
    """
    order = Window.partitionBy("doc_id", "item_id").orderBy(
        F.desc("n_matched"), F.desc("similarity"), "start_word", "item_start"
    )
    checked = _checked(docs, items, masks, ratio, least).drop("doc_key")
    return checked.withColumn("n", F.row_number().over(order)).filter("n = 1").drop("n")


def _checked(docs: DataFrame, items: DataFrame, masks: tuple[str, ...], ratio: float, least: int) -> DataFrame:
    """All verified diagonals (``FOUND``) with the key of the row they are in."""
    spark = docs.sparkSession
    key = lambda df, name, own: df.select(
        _row_key(own).alias(name),
        F.col("text").cast("string").alias("text"),
        F.col(own).cast("long").alias(own),
    )
    tests = key(items, "item_key", "item_id").dropDuplicates(["item_key"])
    seeds = keep(
        tests.mapInArrow(_item_task(masks, ratio), "item_key long, seed long, item_at long, block int"),
        "decontaminate-seeds",
    )
    # no more than SHORT lengths; most tables have no short items and need no more masks
    used = sorted(row.block for row in seeds.filter("block > 0").select("block").distinct().collect())
    seeds = seeds.drop("block")
    # at most 2**BITMAP_BITS / 64 rows, whatever the size of the test table
    word_of = lambda k: F.shiftrightunsigned(F.col("seed"), k * 20).bitwiseAND((1 << BITMAP_BITS) - 1)
    bits = seeds.select(F.explode(F.array(*[word_of(k) for k in range(PROBES)])).alias("bit"))
    filled = (
        bits.groupBy(F.shiftright("bit", 6).alias("slot"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
        .collect()
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for slot, mask in filled:
        bitmap[slot] = mask
    sent = spark.sparkContext.broadcast(bitmap.astype("<i8").tobytes())
    scanned = key(docs, "doc_key", "doc_id").mapInArrow(
        _scan_task((*masks, *("1" * size for size in used)), sent),
        "doc_key long, doc_id long, words array<long>, seeds array<long>, places array<long>",
    )
    hits = keep(scanned, "decontaminate-hits")
    each = hits.select("doc_key", F.explode(F.arrays_zip("seeds", "places")).alias("hit")).select(
        "doc_key", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("at")
    )
    diagonals = (
        lookup_join(each, seeds, ["seed"], spread="doc_key")
        .select("doc_key", "item_key", (F.col("at") - F.col("item_at")).alias("diagonal"))
        .distinct()
    )
    item_words = tests.mapInArrow(_word_task("item_key"), "item_key long, words array<long>").withColumnRenamed(
        "words", "item_words"
    )
    named = item_words.join(tests.select("item_key", "item_id"), "item_key")
    pairs = lookup_join(diagonals, named, ["item_key"], spread="doc_key", small_fits=False)
    texts = hits.select("doc_key", "doc_id", "words").dropDuplicates(["doc_key"])
    return (
        pairs.join(texts, "doc_key")
        .select("doc_key", "doc_id", "item_id", "diagonal", "words", "item_words")
        .mapInPandas(_verify_task(ratio, least), "doc_key long, " + FOUND)
    )


def without_overlaps(
    docs: DataFrame,
    items: DataFrame,
    masks: tuple[str, ...] = MASKS,
    ratio: float = 0.8,
    least: int = 13,
) -> DataFrame:
    """The rows of ``docs`` that hold no passage of a test item, all columns kept."""
    found = _checked(docs, items, masks, ratio, least).select(F.col("doc_key").alias("_key")).distinct()
    return bitmap.without(docs, keep(found, "decontaminate-found"), {"_key": _row_key("doc_id")})
