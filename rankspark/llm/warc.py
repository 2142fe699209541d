"""WARC archives: one Zstandard frame per record, with an embedded dictionary.

Layout of an archive (a ``part-*`` file of the target folder)::

    dictionary frame | gap | record frame | gap | record frame | gap ...

The dictionary frame is a skippable frame (magic 0x184D2A5D) that holds a Zstandard
dictionary trained on the archive's own first records.  Each record is a frame of its
own, so one record can be read without the others.  A gap is an empty skippable frame,
which every Zstandard reader passes over: it is the line end of Spark's text writer, so
archives go through Spark's commit protocol to whatever store the folder lies in, and a
lost executor leaves no half-written archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Magics of the frames and the empty skippable frame used as a gap.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_LOW, SKIPPABLE_HIGH = 0x184D2A50, 0x184D2A5F
FRAME_MAGIC = 0xFD2FB528
GAP = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:page:"

READ = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)


def plan_records(pages: DataFrame, least: int = 1000) -> DataFrame:
    """One row per page: payload, digest, record type and the page it refers to.

    Of the pages with equal payloads of at least ``least`` bytes the one with the
    largest ``page_id`` is a response and the others revisit it; all smaller payloads
    are responses.  A null html is an empty payload.  Pages without an id never stand
    for others: if every page of a group lacks one, all are responses.  If the largest
    id occurs on several rows, all of these are responses.  Other columns are ignored.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    large = rows.filter(F.octet_length("payload") >= least)
    # one row per payload that occurs more than once; counted before the shuffle
    leaders = (
        large.groupBy("digest")
        .agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("leader").isNotNull())
        .select("digest", "leader")
    )
    joined = rows.join(leaders, "digest", "left")
    revisit = F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    return joined.select(
        "page_id",
        "url",
        # a revisit does not carry its payload again
        F.when(revisit, F.lit(None)).otherwise(F.col("payload")).alias("payload"),
        "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("leader")).alias("refers_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )


def record_bytes(row: dict, date: str) -> bytes:
    """A WARC 1.1 record; header values never hold line ends."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += b"Content-Length: %d\r\n\r\n" % row["payload_bytes"]
    block = head + (row["payload"] or b"")
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    key = "none" if row["page_id"] is None else row["page_id"]
    fields = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", f"<{ID_PREFIX}{key}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", " ".join(row["url"].split())))
    if row["refers_to"] is not None:
        fields.append(("WARC-Profile", PROFILE))
        fields.append(("WARC-Refers-To", f"<{ID_PREFIX}{row['refers_to']}>"))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary; the samples themselves (raw content) if they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _write_task(date: str, level: int, dictionary_bytes: int, sample_records: int, sample_bytes: int):
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        packer, held, held_bytes = None, [], 0

        def start() -> tuple[bytes, zstandard.ZstdCompressor]:
            # an even spread over the records held, at most sample_bytes of them
            each = max(64, sample_bytes // max(1, len(held)))
            data = train([r[:each] for r in held], dictionary_bytes)
            packed = zstandard.ZstdCompressor(level=level).compress(data)
            used = zstandard.ZstdCompressionDict(data)
            used.precompute_compress(level=level)
            return (
                struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed,
                zstandard.ZstdCompressor(level=level, dict_data=used, write_checksum=True),
            )

        for batch in batches:
            for row in batch.to_pylist():
                record = record_bytes(row, date)
                if packer is not None:
                    yield packer.compress(record)
                    continue
                held.append(record)
                held_bytes += len(record)
                if len(held) >= sample_records or held_bytes >= 4 * sample_bytes:
                    first, packer = start()
                    yield first
                    yield from map(packer.compress, held)
                    held = []
        if packer is None and held:
            first, packer = start()
            yield first
            yield from map(packer.compress, held)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for frame in frames(batches):
            out.append(frame)
            size += len(frame)
            if size >= 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    return work


def write_archives(
    records: DataFrame,
    path: str,
    date: str = "1970-01-01T00:00:00Z",
    level: int = 3,
    dictionary_bytes: int = 65536,
    sample_records: int = 256,
    sample_bytes: int = 1 << 20,
) -> None:
    """Writes planned records as archives below ``path``, one per task.

    Each archive's dictionary is built from its own first ``sample_records`` records
    (or four times ``sample_bytes``, whichever comes first), of each of which an equal
    share of ``sample_bytes`` is used; all records are compressed with it.
    """
    work = _write_task(date, level, dictionary_bytes, sample_records, sample_bytes)
    frames = records.mapInArrow(work, "frame binary")
    # the text writer puts out the bytes of a string as they are
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", GAP).text(path)


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame that begins at ``at`` ends, from its block headers."""
    parameters = zstandard.get_frame_parameters(data[at : at + 18])
    end = at + zstandard.frame_header_size(data[at : at + 18])
    while True:
        head = int.from_bytes(data[end : end + 3], "little")
        # block type 1 is one repeated byte
        end += 3 + (1 if (head >> 1) & 3 == 1 else head >> 3)
        if head & 1:
            return end + 4 * parameters.has_checksum


def archive_records(content: bytes) -> Iterator[bytes]:
    """The records of one archive, in order."""
    data, at, reader = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at)
        if SKIPPABLE_LOW <= magic <= SKIPPABLE_HIGH:
            end = at + 8 + size
            if magic == DICTIONARY_MAGIC:
                raw = zstandard.ZstdDecompressor().decompress(data[at + 8 : end])
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        elif magic == FRAME_MAGIC:
            end = frame_end(data, at)
            yield reader.decompress(data[at:end])
        else:
            raise ValueError(f"no Zstandard frame at byte {at}")
        at = end


def parse_record(record: bytes) -> dict:
    """Fields of one record; the payload digest of a response is taken from its payload."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    told = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    length = int(http.rpartition(b"Content-Length: ")[2])
    number = lambda name: (
        None
        if fields.get(name) in (None, f"<{ID_PREFIX}none>")
        else int(fields[name][1:-1].removeprefix(ID_PREFIX))
    )
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != length or hashlib.sha1(payload).hexdigest() != told):
        raise ValueError(f"{fields['WARC-Record-ID']}: payload does not match its digest")
    return {
        "page_id": number("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": told,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload": payload if response else None,
    }


def _read_task(with_payload: bool):
    types = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        *([("payload", pa.binary())] if with_payload else []),
    ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for record in archive_records(content.as_py()):
                    row = parse_record(record)
                    rows.append({name: row[name] for name, _ in types})
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(types))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(types))

    return work


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path`` (``READ``; payload only if asked for).

    Every response's payload is hashed and held against its digest; a mismatch raises.
    """
    schema = READ if payload else READ.removesuffix(", payload binary")
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read_task(payload), schema)

