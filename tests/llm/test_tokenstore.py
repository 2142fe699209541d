import zlib

import numpy as np
import pytest
import public_tokenizers
from llm_helpers import corpus, docs  # noqa: F401
from rankspark.llm import tokenstore
from rankspark.session import fresh_folder
from tokenizers import Tokenizer


def plain(rows):
    """(doc_id, start, n_tokens, ids_crc32, ids) by the tokenizer itself; rows in ascending order."""
    tokenizer, out, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), [], 0
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_bytes", [200, 1 << 20])
def test_round_trip(spark, docs, corpus, shard_bytes):
    path = fresh_folder(spark, "tokens-test")
    tokenstore.write(docs.repartition(5), path, shard_bytes=shard_bytes, sample_docs=8)
    got = tokenstore.read(spark, path, with_ids=True).collect()
    assert len(got) == len(corpus)
    # rows of one id stand side by side, in whatever order
    stored = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in stored] == sorted((k for k, _ in corpus), key=lambda k: (k is not None, k))
    assert [r.start for r in stored] == [0, *np.cumsum([r.n_tokens for r in stored]).tolist()[:-1]]
    told = sorted((r.doc_id, r.n_tokens, r.ids_crc32, tuple(r.ids)) for r in got if r.doc_id is not None)
    assert told == sorted((k, n, c, tuple(i)) for k, _, n, c, i in plain(corpus) if k is not None)
    files = spark.read.format("binaryFile").load(f"{path}/shards").filter("length > 0").collect()
    assert (len(files) > 1) == (shard_bytes == 200)
    for f in files:
        assert bytes(f.content[:8]) == tokenstore.MAGIC and f.content.endswith(tokenstore.END.encode())


def test_one_document_is_read_by_its_offset(spark):
    rows = [(i, f"text number {i} " + "of some words " * (i % 7)) for i in range(200)]
    path = fresh_folder(spark, "tokens-test")
    tokenstore.write(spark.createDataFrame(rows, "doc_id long, text string"), path, shard_bytes=2000)
    want = {r[0]: r for r in plain(rows)}
    got = tokenstore.fetch(spark, path, [3, 150, 999])
    assert sorted(map(lambda r: (*r[:4], list(r.ids)), got.collect())) == [want[3], want[150]]
    # the offset index leads to the frame without the rest of its shard
    entry = spark.read.parquet(f"{path}/index").filter("doc_id = 150").first()
    row = spark.read.parquet(f"{path}/dictionary").first()
    (shard,) = [f for f in spark.read.format("binaryFile").load(f"{path}/shards").collect() if f.path == entry.file]
    import zstandard

    frame = shard.content[entry.offset : entry.offset + entry.length]
    raw = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(row.dictionary)).decompress(frame)
    assert np.frombuffer(raw, "<u2").tolist() == want[150][4] and entry.start == want[150][1]
    assert tokenstore.fetch(spark, path, [-5]).collect() == []


def test_another_dictionary_is_refused(spark):
    one, two = fresh_folder(spark, "tokens-test"), fresh_folder(spark, "tokens-test")
    for path, word in ((one, "first"), (two, "second")):
        table = spark.createDataFrame([(i, f"{word} {i}") for i in range(50)], "doc_id long, text string")
        tokenstore.write(table, path)
    spark.read.parquet(f"{two}/dictionary").coalesce(1).write.mode("overwrite").parquet(f"{two}/other")
    mixed = tokenstore._read(spark, one, tokenstore._files(spark, two), None, False)
    with pytest.raises(Exception, match="another dictionary"):
        mixed.collect()


def test_wide_ids_and_empty_tables(spark):
    path = fresh_folder(spark, "tokens-test")
    tokenstore.write(spark.createDataFrame([], "doc_id long, text string"), path)
    assert tokenstore.read(spark, path).collect() == []
    table = spark.createDataFrame([(1, "wide")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not fit"):
        tokenstore.write(table, fresh_folder(spark, "tokens-test"), end_id=70_000)
    wide = fresh_folder(spark, "tokens-test")
    tokenstore.write(table, wide, end_id=70_000, item_bytes=4)
    assert tokenstore.read(spark, wide, with_ids=True).first().ids[-1] == 70_000
