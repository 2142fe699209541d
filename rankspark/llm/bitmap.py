"""Bitmaps of bounded size that let a scan leave out most rows a later join would drop.

They never decide anything: rows let through by chance are dropped by the join.
:func:`build` and :func:`holds` go by Spark's hash of a key, :func:`value_map` and
:func:`maps` by the upper bits of values that are hashes already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 25


def place(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND((1 << BITS) - 1)


def build(keys: DataFrame, name: str) -> bytes:
    """The bitmap of a column; at most 2**BITS / 64 numbers reach the driver."""
    bit = keys.select(place(F.col(name)).alias("bit"))
    filled = (
        bit.groupBy(F.shiftright("bit", 6).alias("slot"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
        .toPandas()
    )
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[filled["slot"]] = filled["mask"]
    return words.astype("<i8").tobytes()


def holds(bitmap: bytes, places: np.ndarray) -> np.ndarray:
    bits = np.frombuffer(bitmap, np.uint8)
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def table(spark: SparkSession, bitmap: bytes) -> DataFrame:
    """The bitmap as (piece, bits) rows of 8 kB, for a broadcast of fixed size."""
    size = 1 << 13
    rows = [(k, bitmap[at : at + size]) for k, at in enumerate(range(0, len(bitmap), size))]
    return spark.createDataFrame([r for r in rows if any(r[1])], "_piece long, _bits binary")


def look_up(df: DataFrame, pieces: DataFrame, key: Column, name: str) -> DataFrame:
    """``df`` with a boolean column: false where the key is surely not in the bitmap."""
    at = place(key)
    joined = df.withColumn("_place", at).join(
        F.broadcast(pieces), F.shiftright("_place", 16) == F.col("_piece"), "left"
    )
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_place % 65536 div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("cast(shiftleft(1, cast(_place % 8 as int)) as int)")
    return joined.withColumn(name, F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False))).drop(
        "_place", "_piece", "_bits"
    )


def without(df: DataFrame, gone: DataFrame, on: dict[str, Column]) -> DataFrame:
    """The rows of ``df`` whose key is not in ``gone`` (columns ``on``, never null).

    ``on`` gives the key's columns as expressions over ``df``.  Only rows that the bitmap
    cannot clear are joined, so most of a wide table is not shuffled.
    """
    names = list(on)
    flags = table(df.sparkSession, build(gone.select(F.xxhash64(*names).alias("_at")), "_at"))
    marked = look_up(df.withColumns(on), flags, F.xxhash64(*names), "_maybe")
    rest = marked.filter("_maybe").join(gone.select(*names), names, "left_anti")
    return marked.filter("not _maybe").select(*df.columns).unionByName(rest.select(*df.columns))


# bits that a map of hash values has at most, and how many of them make one piece of it
MAP_BITS, PIECE_BITS = 28, 17
# a map is folded while one bit of so many at most is set
SPARSE = 16
# places that a task holds one by one; with more it holds the bits of all pieces
MOST_PLACES = 1 << 21
# For each byte, the four bits that say which of its pairs of bits hold one.
PAIRS = sum((((np.arange(256) >> 2 * k) & 3 > 0) << k for k in range(4)), np.zeros(256, int)).astype(np.uint8)


def _put(packed: np.ndarray, where: np.ndarray) -> None:
    """Sets the bits at the given places, which are sorted."""
    byte = where >> 3
    first = np.flatnonzero(np.diff(byte, prepend=-1))
    packed[byte[first]] |= np.bitwise_or.reduceat(np.uint8(1) << (where & 7).astype(np.uint8), first)


def _piece_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces that hold a value.

    A task may have all of them.  Few places are held as they are, many as packed bits of
    all pieces, so memory goes by the values of the task and ends at the map's size.
    """
    packed, held, n = None, [], 0
    found = np.zeros(1 << (MAP_BITS - PIECE_BITS), bool)
    for batch in batches:
        if not batch.num_rows:
            continue
        where = (batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - MAP_BITS)).astype(np.uint32)
        held.append(np.unique(where))
        found[held[-1] >> PIECE_BITS] = True
        n += len(held[-1])
        if n > MOST_PLACES:
            packed = np.zeros(1 << (MAP_BITS - 3), np.uint8) if packed is None else packed
            for places in held:
                _put(packed, places.astype(np.int64))
            held, n = [], 0
    places = np.unique(np.concatenate(held)).astype(np.int64) if held else np.zeros(0, np.int64)
    size = 1 << (PIECE_BITS - 3)
    for piece in np.flatnonzero(found).tolist():
        a, b = np.searchsorted(places, [piece << PIECE_BITS, (piece + 1) << PIECE_BITS])
        part = np.zeros(size, np.uint8) if packed is None else packed[piece * size : (piece + 1) * size]
        if b > a:
            _put(part, places[a:b] - (piece << PIECE_BITS))
        yield pa.RecordBatch.from_arrays(
            [pa.array([piece], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["piece", "bits"]
        )


def fold(bits: np.ndarray) -> np.ndarray:
    """The map by one upper bit of the values less: each two neighbouring bits become one."""
    return PAIRS[bits[0::2]] | (PAIRS[bits[1::2]] << 4)


def folded(bits: np.ndarray) -> bytes:
    """The smallest map in which one bit of SPARSE at most is set."""
    while len(bits) > 1 << 10:
        half = fold(bits)
        if int(np.bitwise_count(half).sum()) * SPARSE > 8 * len(half):
            break
        bits = half
    return bits.tobytes()


def value_map(values: DataFrame, name: str) -> bytes:
    """A bit for each 64-bit hash value, by its upper bits.

    2**MAP_BITS bits at most; of fewer values a smaller map is made, in which one bit of
    SPARSE at most is set, since every worker that asks the map holds all of it.
    """
    piece = F.shiftrightunsigned(name, 64 - MAP_BITS + PIECE_BITS)
    rows = values.select(name).repartition(piece).mapInArrow(_piece_task, "piece int, bits binary").collect()
    out = np.zeros((1 << (MAP_BITS - PIECE_BITS), 1 << (PIECE_BITS - 3)), np.uint8)
    for row in rows:
        out[row["piece"]] |= np.frombuffer(row["bits"], np.uint8)
    return folded(out.ravel())


def maps(value_bits: bytes, values: np.ndarray) -> np.ndarray:
    """Whether each value's bit is set; a map of 2**n bits goes by the upper n bits of a value."""
    n_bits = (8 * len(value_bits)).bit_length() - 1
    where = (values >> np.uint64(64 - n_bits)).astype(np.int64)
    return (np.frombuffer(value_bits, np.uint8)[where >> 3] >> (where & 7).astype(np.uint8)) & 1 == 1
