"""Exact removal of repeated byte strings by merged Burrows-Wheeler transforms.

A byte is removed if it is covered by a string of ``length`` bytes that also starts
earlier (smaller doc_id, or same text and earlier place).

1. Every window of ``length`` bytes names the least hash among its k-grams (its anchor).
   Equal windows have equal anchors at equal offsets, so windows that may repeat share an
   anchor value; about one k-gram in 35 is an anchor.
2. Anchors that occur once are passed over.  For the others the place of the stretch of
   text that holds all windows of the anchor is put out, with its hash; all but the first
   occurrence of a stretch are repeats as a whole.
3. Where one anchor value has several different stretches, the bytes of the first
   occurrences are fetched, their suffixes are sorted shard by shard and the shards'
   transforms merged (:mod:`rankspark.llm.bwt`), which gives the intervals of equal
   windows.  The windows of a value with very many stretches are grouped by Spark instead.
4. The spans found are joined with their texts and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm import bitmap, bwt
from rankspark.llm.columns import BASE, MIX_A, MIX_B, U64, chunks, mix, powers, text_bytes
from rankspark.session import fits, keep, lookup_join

GRAM = 32
# bytes looked at together; places in them have 32 bits
CHUNK_BYTES, LAST_PLACE = 1 << 17, 2**32 - 1
# windows of one anchor value that a merge may hold, bytes of a shard, bytes merged at once
MOST_WINDOWS, SHARD_BYTES, MERGE_BYTES = 1 << 19, 1 << 17, 1 << 19
LAST_ID = 2**63 - 1


def gram_sums(raw: np.ndarray) -> np.ndarray:
    """Polynomials over all runs of GRAM bytes, by doubling; :func:`mix` makes hashes of them."""
    out, width = raw.astype(np.uint64) + U64(1), 1
    with np.errstate(over="ignore"):
        factor = BASE
        while width < GRAM:
            wider = out[:-width] * factor
            wider += out[width:]
            out, factor = wider, factor * factor
            width *= 2
    return out


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int):
    """(hash, place, first start, last start, text) of every run of windows with one anchor.

    The anchor of a window is its k-gram of least rank, the rightmost among equal ranks.
    One 64-bit word holds the rank (upper half) and the place counted from the right, so
    that a plain minimum finds both.
    """
    width = length - GRAM + 1
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    if not counts.any():
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 4
    sums = gram_sums(raw)
    low = sums * MIX_A
    low &= U64(LAST_PLACE << 32)
    low |= np.arange(LAST_PLACE, LAST_PLACE - len(low), -1, dtype=np.uint64)
    # the least word of each window, by doubling
    step = 1
    while step < width:
        hop = min(step, width - step)
        low = np.minimum(low[hop:], low[:-hop])
        step += hop
    # windows that lie in one text
    before = np.cumsum(counts) - counts
    starts = np.arange(int(counts.sum()), dtype=np.int64) + np.repeat(offsets[:-1] - before, counts)
    low = low[starts]
    fresh = np.empty(len(low), bool)
    np.not_equal(low[1:], low[:-1], out=fresh[1:])
    fresh[before[counts > 0]] = True
    begin = np.flatnonzero(fresh)
    end = np.append(begin[1:], len(low)) - 1
    at = LAST_PLACE - (low[begin] & U64(LAST_PLACE)).astype(np.int64)
    text = np.searchsorted(offsets, starts[begin], side="right") - 1
    return mix(sums[at]), at, starts[begin], starts[end], text


def _anchor_task(length: int):
    """Distinct anchors of each text; ``twice`` if one text has the value at two places."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            content = batch.column(1).to_numpy()
            for a, b in chunks(offsets, CHUNK_BYTES):
                lo = offsets[a]
                value, _, _, _, text = anchors(raw[lo : offsets[b]], offsets[a : b + 1] - lo, length)
                if not len(value):
                    continue
                order = np.lexsort((value, text))
                value, text = value[order], text[order]
                fresh = np.ones(len(value), bool)
                fresh[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(fresh)
                twice = np.diff(np.append(first, len(value))) > 1
                columns = [pa.array(value[first].view(np.int64)), pa.array(content[a + text[first]]), pa.array(twice)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "content", "twice"])

    return work


class StretchKeys:
    """Hashes of the stretches raw[begin:end], which may overlap, from sums over all bytes."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(raw)
        if len(self.up) < n:
            self.up, self.down = powers(BASE, n), powers(U64(pow(int(BASE), -1, 2**64)), n)
        terms = raw.astype(np.uint64)
        terms += U64(1)
        terms *= self.up[:n]
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=total[1:])
        return mix((total[end] - total[begin]) * self.down[begin] + (end - begin).astype(np.uint64) * MIX_B)


def identity(anchor: np.ndarray, key: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    place = mix(doc.view(np.uint64) * BASE + at.astype(np.uint64))
    return mix(key.view(np.uint64) + mix(anchor.view(np.uint64) ^ place))


def _identity_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = identity(*(batch.column(i).to_numpy() for i in range(4)))
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["value"])


def _stretch_task(sent, length: int, firsts=None):
    """The places of the stretches of repeated anchors; with ``firsts`` the bytes of those in that map."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch_keys = StretchKeys()
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            content, doc = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for a, b in chunks(offsets, CHUNK_BYTES):
                lo = offsets[a]
                part = raw[lo : offsets[b]]
                value, _, first, last, text = anchors(part, offsets[a : b + 1] - lo, length)
                hit = np.flatnonzero(bitmap.maps(sent.value, value))
                if not len(hit):
                    continue
                value, first, end, text = value[hit], first[hit], last[hit] + length, text[hit]
                key = stretch_keys(part, first, end)
                at = (first - (offsets[a + text] - lo)).astype(np.int32)
                own = doc[a + text]
                if firsts is None:
                    columns = [value.view(np.int64), key.view(np.int64), own, content[a + text], at, (end - first).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays(
                        list(map(pa.array, columns)), ["anchor", "key", "doc", "content", "at", "width"]
                    )
                    continue
                hit = np.flatnonzero(bitmap.maps(firsts.value, identity(value, key, own, at)))
                size = end[hit] - first[hit]
                bounds = np.concatenate([[0], np.cumsum(size)])
                inside = np.arange(bounds[-1]) + np.repeat(first[hit] - bounds[:-1], size)
                data = pa.Array.from_buffers(
                    pa.binary(),
                    len(hit),
                    [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(part[inside])],
                )
                columns = [pa.array(value[hit].view(np.int64)), data, *map(pa.array, (own[hit], content[a + text[hit]], at[hit]))]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "stretch", "doc", "content", "at"])

    return work


def _merge_task(length: int):
    """Spans of windows that start earlier in another stretch of the same cell; rows come sorted by cell."""

    def spans(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        text, sizes, doc, content, at = (np.concatenate(column) for column in zip(*held, strict=True))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        shards, parts = [], []
        # every shard is sorted by itself
        cut = np.flatnonzero(np.diff(bounds[1:] // SHARD_BYTES, prepend=0)).tolist()
        for a, b in zip([0, *cut], [*cut, len(sizes)], strict=True):
            if b > a:
                shards.append(bwt.build_shard(text[bounds[a] : bounds[b]], sizes[a:b]))
                parts.append(sizes[a:b])
        string, start, block = bwt.merge_repeats(shards, parts, length)
        if not len(string):
            return
        place = at[string] + start
        # blocks hold windows of one content: the earliest start is the one that stays
        order = np.lexsort((place, content[string], doc[string], block))
        string, place, block = string[order], place[order], block[order]
        first = np.ones(len(block), bool)
        first[1:] = block[1:] != block[:-1]
        head = np.maximum.accumulate(np.where(first, np.arange(len(block)), 0))
        same = (doc[string] == doc[string[head]]) & (content[string] == content[string[head]]) & (place == place[head])
        string, place = string[~same], place[~same]
        order = np.lexsort((place, string))
        string, place = string[order], place[order]
        fresh = np.ones(len(string), bool)
        fresh[1:] = (string[1:] != string[:-1]) | (np.diff(place) != 1)
        begin = np.flatnonzero(fresh)
        stop = np.append(begin[1:], len(string)) - 1
        owner = string[begin]
        columns = [doc[owner], content[owner], place[begin].astype(np.int32), (place[stop] + length).astype(np.int32)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["doc", "content", "start", "end"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(0).to_numpy()
            raw, offsets = text_bytes(batch.column(1))
            others = [batch.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4)]
            # cells may share a merge, but none is torn apart
            begin = (np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist()
            if last is not None and cell[0] != last:
                begin = [0, *begin]
            at = 0
            for cut in [*begin, len(cell)]:
                size += int(offsets[cut] - offsets[at])
                if cut > at:
                    rows = (raw[offsets[at] : offsets[cut]], np.diff(offsets[at : cut + 1]), *(c[at:cut] for c in others))
                    held.append(rows)
                if size > MERGE_BYTES and cut < len(cell):
                    yield from spans(held)
                    held, size = [], 0
                at = cut
            last = cell[-1]
        yield from spans(held)

    return work


def hot_repeats(stretches: DataFrame, length: int) -> DataFrame:
    """Repeated windows of anchor values that have too many stretches for one merge.

    Equal windows are grouped by Spark, which counts them before they are shuffled, and
    only the first place of those that repeat is joined with the others.  So a line that
    stands in any number of texts never comes together in one task.  Windows are told
    apart by 128 bits of hash, as equal stretches are.
    """
    part = F.substring("stretch", F.col("start") + 1, F.lit(length))
    windows = stretches.select(
        "anchor",
        "stretch",
        "doc",
        "content",
        "at",
        F.explode(F.sequence(F.lit(0), F.octet_length("stretch") - length)).alias("start"),
    ).select(
        F.xxhash64("anchor", part).alias("one"),
        F.xxhash64(part, "anchor").alias("two"),
        "doc",
        "content",
        (F.col("at") + F.col("start")).alias("at"),
    )
    place = F.struct("doc", "content", "at")
    firsts = keep(
        windows.groupBy("one", "two")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("one", "two", "first"),
        "suffix-hot",
    )
    return (
        lookup_join(windows, firsts, ["one", "two"], spread="doc")
        .filter(place != F.col("first"))
        .select("doc", "content", F.col("at").alias("start"), (F.col("at") + length).alias("end"))
    )


def _keyed(docs: DataFrame) -> DataFrame:
    """doc and content give the order of texts: by id (null last), then by content."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns(
        {
            "_text": text,
            "_content": F.xxhash64(text),
            "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
        }
    )


def repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc, content, start, end): spans of bytes covered by strings that start earlier.

    ``doc`` and ``content`` are the id (the largest number for null) and hash of a text.
    Spans may overlap; together they cover exactly the bytes to remove, but for texts
    that equal an earlier one as a whole, of which only parts may be listed.
    """
    if length % 2 or length < GRAM + 2:
        raise ValueError(f"length must be even and at least {GRAM + 2}")
    spark = docs.sparkSession
    texts = _keyed(docs).select("_text", "_content", "_doc").filter(F.octet_length("_text") >= length)
    values = texts.select("_text", "_content").mapInArrow(
        _anchor_task(length), "anchor long, content long, twice boolean"
    )
    repeated = (
        values.groupBy("anchor")
        .agg(F.min("content").alias("a"), F.max("content").alias("b"), F.max("twice").alias("twice"))
        .filter("a != b or twice")
        .select("anchor")
    )
    sent = spark.sparkContext.broadcast(bitmap.value_map(repeated, "anchor"))
    places = "anchor long, key long, doc long, content long, at int, width int"
    found = keep(texts.mapInArrow(_stretch_task(sent, length), places), "suffix-places")
    place = F.struct("doc", "content", "at")
    distinct = keep(
        found.groupBy("anchor", "key")
        .agg(F.min(place).alias("first"), F.first("width").alias("width"), F.count(F.lit(1)).alias("n"))
        .select("anchor", "key", "width", "n", "first.*"),
        "suffix-distinct",
    )
    firsts = distinct.filter("n > 1").select("anchor", "key", F.struct("doc", "content", "at").alias("first"))
    later = (
        found.join(firsts, ["anchor", "key"])
        .filter(place != F.col("first"))
        .select("doc", "content", F.col("at").alias("start"), (F.col("at") + F.col("width")).alias("end"))
    )
    # anchors with several stretches: the first occurrence of each goes on with its bytes
    several = keep(
        distinct.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("stretches"), F.sum(F.col("width") - (length - 1)).alias("windows"))
        .filter("stretches > 1")
        .select("anchor", "windows"),
        "suffix-several",
    )
    chosen = distinct.join(several, "anchor").select("anchor", "key", "doc", "at")
    firsts_map = bitmap.value_map(chosen.mapInArrow(_identity_task, "value long"), "value")
    bytes_of = texts.mapInArrow(
        _stretch_task(sent, length, spark.sparkContext.broadcast(firsts_map)),
        "anchor long, stretch binary, doc long, content long, at int",
    )
    found_spans = later
    hot = several.filter(F.col("windows") > MOST_WINDOWS).select("anchor")
    if not hot.isEmpty():
        bytes_of = keep(bytes_of, "suffix-bytes")
        few = fits(hot)
        found_spans = later.unionByName(hot_repeats(lookup_join(bytes_of, hot, ["anchor"], spread="doc", small_fits=few), length))
        bytes_of = bytes_of.join(F.broadcast(hot) if few else hot, "anchor", "left_anti")
    dealt = bytes_of.repartition("anchor").sortWithinPartitions("anchor", "doc", "content", "at")
    merged = dealt.mapInArrow(_merge_task(length), "doc long, content long, start int, end int")
    return found_spans.unionByName(merged)


def _cut_task(names: list[str], with_text: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[], [], [], [], []]
            text, copy = batch.column(0), batch.column(1)
            spans = batch.column(2).to_pylist()
            for i in range(batch.num_rows):
                data = text[i].as_py()
                cuts = sorted((s["start"], s["end"]) for s in spans[i] or [])
                if copy[i].as_py():
                    cuts = [(0, len(data))]
                runs: list[list[int]] = []
                for a, b in cuts:
                    if runs and a <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], b)
                    else:
                        runs.append([a, b])
                bounds = [0, *(x for run in runs for x in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                digest = hashlib.sha256(kept).hexdigest()
                for column, value in zip(rows, (len(data), len(data) - len(kept), len(runs), digest, kept), strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_text]
            extra = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 4 + with_text]
            columns = [pa.array(c, t) for c, t in zip(rows, types, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], *columns], [*names, *extra])

    return work


def strip_repeats(docs: DataFrame, length: int = 100, keep_text: bool = True) -> DataFrame:
    """All columns of ``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and ``kept`` (binary).

    Without ``keep_text`` only doc_id and the four figures come back.  Removed is every
    byte covered by a string of ``length`` bytes that also starts earlier: in a text of
    smaller doc_id (null is last; among equal ids the texts' hashes decide), or earlier in
    the same text.  Rows with equal id and text count as one text and come out alike.
    ``n_spans`` counts maximal removed runs.  A null or empty text has no bytes; texts of
    fewer than ``length`` bytes stay whole; an empty table gives no rows.  Columns named
    like the results are replaced.
    """
    results = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    out = docs.drop(*results) if keep_text else docs.select("doc_id")
    rows = _keyed(docs.drop(*results)).withColumn("_other", F.xxhash64(F.lit("second"), "_text"))
    first = (
        rows.filter(F.octet_length("_text") >= length)
        .groupBy("_content", "_other")
        .agg(F.min("_doc").alias("_first"), F.max("_doc").alias("_last"))
        .filter("_first != _last")
        .select("_content", "_other", "_first")
    )
    spans = (
        repeats(docs, length)
        .groupBy("doc", "content")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
        .select(F.col("doc").alias("_doc"), F.col("content").alias("_content"), "_spans")
    )
    copies = (
        rows.select("_content", "_other", "_doc")
        .join(first, ["_content", "_other"])
        .filter("_doc != _first")
        .select("_doc", "_content", F.lit(True).alias("_copy"))
        .distinct()
    )
    cuts = keep(spans.join(copies, ["_doc", "_content"], "full"), "suffix-spans")
    # texts without spans need no join; the bitmap tells most of them apart
    cut_places = cuts.select(F.xxhash64("_doc", "_content").alias("_at"))
    flags = bitmap.table(rows.sparkSession, bitmap.build(cut_places, "_at"))
    marked = bitmap.look_up(rows, flags, F.xxhash64("_doc", "_content"), "_maybe")
    joined = (
        marked.filter("_maybe")
        .join(cuts, ["_doc", "_content"], "left")
        .select(
            F.col("_text").cast("binary").alias("_text"),
            F.coalesce("_copy", F.lit(False)).alias("_copy"),
            "_spans",
            *out.columns,
        )
    )
    zero = F.lit(0).cast("long")
    clean = marked.filter("not _maybe").select(
        *out.columns,
        F.octet_length("_text").cast("long").alias("n_bytes"),
        zero.alias("n_removed"),
        zero.alias("n_spans"),
        F.sha2("_text", 256).alias("kept_sha256"),
        *([F.col("_text").cast("binary").alias("kept")] if keep_text else []),
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
    schema += ", n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return joined.mapInArrow(_cut_task(out.columns, keep_text), schema).unionByName(clean)
