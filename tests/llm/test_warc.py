import hashlib

import pytest
import zstandard
from rankspark.llm import warc
from rankspark.session import fresh_folder


def test_round_trip(spark):
    big, other = "<p>" + "a\r\n\r\n" * 500, "<p>" + "bé" * 800
    pages = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://b\r\nX: y", other)]
    pages += [(5, "u", None), (6, "u", ""), (7, "u", ""), (8, "u", "x" * 999), (9, "u", "x" * 999)]
    pages += [(None, "u", other), (3, "again", big), (None, "u", "z" * 2000), (None, "v", "z" * 2000), (10, "u", "P*M\x18\0\0\0\0" * 90_000)]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    path = fresh_folder(spark, "warc-test")
    warc.write_archives(warc.plan_records(table).repartition(2), path)
    got = warc.read_archives(spark, path).collect()
    want = []
    for key, _, html in pages:
        data = (html or "").encode()
        same = [k for k, _, h in pages if (h or "").encode() == data and len(data) >= 1000]
        leader = max((k for k in same if k is not None), default=None) if len(same) > 1 else None
        revisit = leader is not None and key != leader
        want.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", leader if revisit else None))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == sorted(want, key=str)
    payloads = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id}
    assert payloads[3] == big.encode() and payloads[10] == pages[-1][2].encode()
    assert {r.url for r in got if r.page_id == 4} == {"http://b X: y"}


def test_any_reader_can_use_the_archives(spark):
    rows = [(i, f"http://a/{i}", f"<html>page {i} " + "common words " * 60) for i in range(300)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = fresh_folder(spark, "warc-test")
    warc.write_archives(warc.plan_records(table).coalesce(1), path)
    (row,) = [r for r in spark.read.format("binaryFile").load(path).collect() if r.length]
    size = int.from_bytes(row.content[4:8], "little")
    assert int.from_bytes(row.content[:4], "little") == warc.DICTIONARY_MAGIC
    used = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(row.content[8 : 8 + size]))
    whole = zstandard.ZstdDecompressor(dict_data=used).stream_reader(row.content[8 + size :], read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 300
    with pytest.raises(ValueError):
        list(warc.archive_records(b"not an archive"))


def test_no_pages(spark):
    table = spark.createDataFrame([], "page_id long, url string, html string")
    path = fresh_folder(spark, "warc-test")
    warc.write_archives(warc.plan_records(table), path)
    assert warc.read_archives(spark, path, payload=False).count() == 0
