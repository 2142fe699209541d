"""Token ids in binary shards: a shared Zstandard dictionary, one frame per document.

Below the target folder stand

* ``dictionary``: a Parquet row with the dictionary and its SHA-256,
* ``shards``: binary files, each with documents in ascending order,
* ``parts``: how many ids stand before each writing task's first shard,
* ``index``: a Parquet table (doc_id, start, n_tokens, file, offset, length), sorted by
  doc_id within the files.

A shard is ``header | frame | frame ... | entries | footer | END``.  The header names the
writing task, the shard's number there and the dictionary's hash; a frame is one document's
ids as little-endian unsigned integers, compressed by itself with the dictionary; the
entries give each document's id, start, length and frame offset, so one short document is
read without the others.  END is the line end of Spark's text writer, which puts one shard
into one file: shards go through Spark's commit protocol to whatever store the folder lies
in, and a lost executor leaves no half-written shard.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankspark.llm.columns import chunks, text_bytes
from rankspark.llm.warc import train

# Fixed values of the format.
MAGIC, END = b"TOKSHARD", "ENDSHARD"
HEADER = struct.Struct("<8sHHII32s")
FOOTER = struct.Struct("<QQ")
VERSION = 1
ENTRY = np.dtype(
    [("known", "u1"), ("doc_id", "<i8"), ("start", "<u8"), ("n_tokens", "<u4"), ("offset", "<u8"), ("length", "<u4")]
)
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"

_encoders: dict = {}


def encoder(vocabulary: str):
    """The tokenizer of this Python worker; its tasks share the words it has met."""
    if vocabulary not in _encoders:
        import public_tokenizers

        from rankspark.llm.wordids import WordIds

        _encoders[vocabulary] = WordIds(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
    return _encoders[vocabulary]


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, item_bytes: int) -> Iterator[tuple]:
    """(doc_id, serialized ids) of (doc_id, text) rows, the end id behind each document's own."""
    known = encoder(vocabulary)
    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        keys = batch.column(0).to_pylist()
        for a, b in chunks(offsets):
            lo, hi = offsets[a], offsets[b]
            ids, bounds, _ = known.encode(raw[lo:hi], offsets[a : b + 1] - lo)
            ids = np.insert(ids, bounds[1:], end_id)
            if len(ids) and ids.max() >> (8 * item_bytes):
                raise ValueError(f"id {ids.max()} does not fit into {item_bytes} bytes")
            data = ids.astype(f"<u{item_bytes}")
            bounds = bounds + np.arange(len(bounds))
            for i in range(b - a):
                yield keys[a + i], data[bounds[i] : bounds[i + 1]].tobytes()


# --- dictionary -------------------------------------------------------------------


def _sample_task(vocabulary: str, end_id: int, item_bytes: int, piece: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc_id, data in encoded(batches, vocabulary, end_id, item_bytes):
            # where a long document's piece lies depends on its contents
            cut = zlib.crc32(data) % max(1, len(data) - piece + 1) // item_bytes * item_bytes
            row = data[cut : cut + piece]
            yield pa.RecordBatch.from_arrays(
                [pa.array([zlib.crc32(row)], pa.int64()), pa.array([row], pa.binary())], ["place", "piece"]
            )

    return work


def train_dictionary(
    rows: DataFrame, n_rows: int, size: int, sample_docs: int, piece: int, settings: tuple
) -> bytes:
    """A dictionary of ``size`` bytes trained on pieces of about ``sample_docs`` documents' id arrays.

    The documents are those of least id hash; of each at most ``piece`` bytes reach the driver.
    """
    share = min(1.0, 1.5 * sample_docs / max(1, n_rows))
    low = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    pieces = rows.filter(low).mapInArrow(_sample_task(*settings, piece), "place long, piece binary")
    samples = [r.piece for r in pieces.orderBy("place", "piece").limit(sample_docs).collect()]
    return train([bytes(s) for s in samples], size) if samples else b""


# --- writing ----------------------------------------------------------------------


class ShardWriter:
    """Collects one task's documents and gives out finished shards."""

    def __init__(self, part: int, dictionary: bytes, item_bytes: int, level: int):
        used = None
        if dictionary:
            used = zstandard.ZstdCompressionDict(dictionary)
            used.precompute_compress(level=level)
        self.packer = zstandard.ZstdCompressor(
            level=level, dict_data=used, write_checksum=True, write_dict_id=False
        )
        self.head = (VERSION, item_bytes, part)
        self.digest, self.item_bytes = hashlib.sha256(dictionary).digest(), item_bytes
        self.start, self.number = 0, 0
        self._empty()

    def _empty(self) -> None:
        self.frames, self.entries, self.size = [], [], HEADER.size

    def add(self, doc_id: int | None, data: bytes) -> None:
        frame, n = self.packer.compress(data), len(data) // self.item_bytes
        self.entries.append((doc_id is not None, doc_id or 0, self.start, n, self.size, len(frame)))
        self.frames.append(frame)
        self.size += len(frame)
        self.start += n

    def shard(self) -> bytes:
        head = HEADER.pack(MAGIC, *self.head, self.number, self.digest)
        entries = np.array(self.entries, ENTRY).tobytes()
        out = b"".join([head, *self.frames, entries, FOOTER.pack(self.size, len(self.entries))])
        self.number += 1
        self._empty()
        return out


def _write_task(vocabulary: str, end_id: int, item_bytes: int, dictionary: bytes, level: int, shard_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ShardWriter(TaskContext.get().partitionId(), dictionary, item_bytes, level)

        def finished() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([writer.shard()], pa.binary())], ["shard"])

        for doc_id, data in encoded(batches, vocabulary, end_id, item_bytes):
            writer.add(doc_id, data)
            if writer.size >= shard_bytes:
                yield finished()
        if writer.entries:
            yield finished()

    return work


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 2,
    item_bytes: int = 2,
    level: int = 3,
    dictionary_bytes: int = 65536,
    sample_docs: int = 2048,
    piece: int = 4096,
    shard_bytes: int = 16 << 20,
    part_bytes: int = 256 << 20,
) -> None:
    """Writes the token ids of ``docs`` (doc_id, text) below ``path`` in ascending doc_id order.

    Every document's ids are followed by ``end_id``; ``item_bytes`` (2 or 4) is the width of
    a stored id, and an id that does not fit raises.  A null text is empty, so the end id
    alone.  Null ids come first; rows of one id are documents of their own, in an order
    fixed by their texts.  A very long document is one frame in a shard of its own.  An
    empty table gives a store without documents.  Other columns are ignored.  The only
    shuffle puts texts into ranges of (doc_id, text hash) of about ``part_bytes``; the
    dictionary is fitted on pieces of ``sample_docs`` documents, all are compressed with it.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    n_rows, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    cores = spark.sparkContext.defaultParallelism
    n_parts = max(-(-size // part_bytes), min(4 * cores, -(-size // (16 << 20))), 1)
    settings = (vocabulary, end_id, item_bytes)
    dictionary = train_dictionary(rows, n_rows, dictionary_bytes, sample_docs, piece, settings)
    spark.createDataFrame(
        [(hashlib.sha256(dictionary).hexdigest(), dictionary, vocabulary, end_id, item_bytes)],
        "sha256 string, dictionary binary, vocabulary string, end_id int, item_bytes int",
    ).coalesce(1).write.parquet(f"{path}/dictionary")
    order = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(n_parts, *order).sortWithinPartitions(*order, "text")
    shards = dealt.mapInArrow(_write_task(*settings, dictionary, level, shard_bytes), "shard binary")
    # the text writer puts out the bytes of a string as they are
    (
        shards.select(F.col("shard").cast("string").alias("value"))
        .write.option("lineSep", END)
        .option("maxRecordsPerFile", 1)
        .text(f"{path}/shards")
    )
    _write_index(spark, path)


def _write_index(spark: SparkSession, path: str) -> None:
    told = _files(spark, path).mapInArrow(
        _entries_task, "part int, doc_id long, start long, n_tokens long, file string, offset long, length long"
    )
    local = f"{path}/entries"
    told.write.parquet(local)
    told = spark.read.parquet(local)
    # one row per writing task
    sizes = told.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes.select("part", before.alias("first")).coalesce(1).write.parquet(f"{path}/parts")
    parts = spark.read.parquet(f"{path}/parts")
    (
        told.join(F.broadcast(parts), "part")
        .withColumn("start", F.col("start") + F.col("first"))
        .drop("part", "first")
        .sortWithinPartitions("doc_id")
        .write.parquet(f"{path}/index")
    )


# --- reading ----------------------------------------------------------------------


def _files(spark: SparkSession, path: str, only: Sequence[str] | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").load(list(only) if only is not None else f"{path}/shards")
    return files.filter("length > 0").select("path", "content")


def entries_of(content: memoryview) -> tuple[int, int, bytes, np.ndarray]:
    """(part, bytes of an id, dictionary hash, entries) of a shard."""
    magic, version, item_bytes, part, _, digest = HEADER.unpack_from(content, 0)
    end = len(content) - len(END)
    if magic != MAGIC or version != VERSION or bytes(content[end:]) != END.encode():
        raise ValueError("not a token shard")
    at, n = FOOTER.unpack_from(content, end - FOOTER.size)
    return part, item_bytes, digest, np.frombuffer(content, ENTRY, n, at)


def _ids_column(entries: np.ndarray) -> pa.Array:
    return pa.array(entries["doc_id"].astype(np.int64), pa.int64(), mask=entries["known"] == 0)


def _entries_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0), batch.column(1), strict=True):
            part, _, _, entries = entries_of(memoryview(content.as_buffer()))
            n = len(entries)
            longs = {c: pa.array(entries[c].astype(np.int64)) for c in ("start", "n_tokens", "offset", "length")}
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(n, part, np.int32)),
                    "doc_id": _ids_column(entries),
                    "start": longs["start"],
                    "n_tokens": longs["n_tokens"],
                    "file": pa.array([name.as_py()] * n, pa.string()),
                    "offset": longs["offset"],
                    "length": longs["length"],
                }
            )


def _read_task(dictionary: bytes, wanted: frozenset | None, with_ids: bool):
    digest = hashlib.sha256(dictionary).digest()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for content in batch.column(1):
                data = memoryview(content.as_buffer())
                part, item_bytes, hashed, entries = entries_of(data)
                if hashed != digest:
                    raise ValueError("the shard was written with another dictionary")
                if wanted is not None:
                    entries = entries[np.isin(entries["doc_id"], list(wanted)) & (entries["known"] == 1)]
                for at in range(0, len(entries), 1024):
                    some, checks, lists = entries[at : at + 1024], [], []
                    for n, offset, length in some[["n_tokens", "offset", "length"]].tolist():
                        raw = reader.decompress(data[offset : offset + length])
                        ids = np.frombuffer(raw, f"<u{item_bytes}").astype("<u4")
                        if len(ids) != n:
                            raise ValueError("a document has another length than its entry says")
                        checks.append(zlib.crc32(ids.tobytes()))
                        if with_ids:
                            lists.append(ids.astype(np.int32))
                    columns = {
                        "part": pa.array(np.full(len(some), part, np.int32)),
                        "doc_id": _ids_column(some),
                        "start": pa.array(some["start"].astype(np.int64)),
                        "n_tokens": pa.array(some["n_tokens"].astype(np.int64)),
                        "ids_crc32": pa.array(checks, pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_pydict(columns)

    return work


def _read(spark: SparkSession, path: str, files: DataFrame, wanted: frozenset | None, with_ids: bool) -> DataFrame:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row.dictionary)
    if hashlib.sha256(dictionary).hexdigest() != row.sha256:
        raise ValueError("the dictionary does not match its hash")
    schema = f"part int, {RESULT}" + ", ids array<int>" * with_ids
    told = files.mapInArrow(_read_task(dictionary, wanted, with_ids), schema)
    parts = spark.read.parquet(f"{path}/parts")
    names = ["n_tokens", "ids_crc32", *["ids"] * with_ids]
    return told.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("start") + F.col("first")).alias("start"), *names
    )


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per stored document (``RESULT``, with ``ids array<int>`` if asked for).

    Every frame is decompressed and checked; a shard of another dictionary raises.
    """
    return _read(spark, path, _files(spark, path), None, with_ids)


def fetch(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The stored documents of some ids, with their ids: opens only the shards the index names,
    and decompresses only those documents' frames."""
    wanted = frozenset(doc_ids)
    index = spark.read.parquet(f"{path}/index").filter(F.col("doc_id").isin(list(wanted)))
    only = sorted(r.file for r in index.select("file").distinct().collect())
    if not only:
        return spark.createDataFrame([], f"{RESULT}, ids array<int>")
    return _read(spark, path, _files(spark, path, only), wanted, True)
