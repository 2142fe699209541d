"""How five text filters act on each other, kept up to date by a stream that takes back.

The files of a table go through Spark's streaming engine as available-now micro-batches.
Four filters look at one text alone; the fifth asks for the least document id of the same
text, wherever in the table.  That id is state, keyed by the text's hash.  A document that
holds the least id so far is counted as first; when a later batch brings a smaller id, the
text's earlier holder is taken out of its counter and put into that of repeated texts, and
the newcomer takes its place.  What leaves the stream are signed counts by part, failure
mask and label; their sums are right after every batch.

A state row holds the texts of one slice of the hash, some dozens of them, because Spark
hands each state row to Python as frames of its own, at the price of a millisecond.  The
number of slices follows the number of rows.

From the counts of the 32 masks of a part every figure of every filter order follows.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rankspark.session import fits, fresh_folder, keep

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
# White space, the capitals of C and the signs of D.
GAP = re.compile(rb"[\x20\x09-\x0D]")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = b"#$%&*|"
GROUP = ["slice", "key", "part", "mask", "good", "toxic", "known"]
COUNTS = "part string, mask int, good boolean, toxic boolean, n long"
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # RocksDB would set aside megabytes for the log files of each partition's store
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def count_words(raw: bytes, step: int = 1 << 20) -> tuple[int, int]:
    """(words, distinct words); a long text is split by stretches that end at white space."""
    n, distinct, at = 0, set(), 0
    while at < len(raw):
        gap = GAP.search(raw, at + step)
        end = gap.start() if gap else len(raw)
        words = raw[at:end].split()
        n += len(words)
        distinct.update(words)
        at = end
    return n, len(distinct)


def own_mask(text: str) -> int:
    """Bits of the filters that one text decides: A 1, B 2, C 4, D 8."""
    raw = text.encode()
    n, distinct = count_words(raw)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    failed = (n < 50, 100 * distinct < 65 * n, 100 * capitals > 5 * len(text), any(c in raw for c in SIGNS))
    return sum(1 << i for i, f in enumerate(failed) if f)


def _judge(slices: int):
    """(slice, key, part, mask, id) of (id, text, part) rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, keys, masks = [], [], []
            for text in batch.column(1).to_pylist():
                digest = hashlib.sha256(text.encode()).digest()
                place.append(int.from_bytes(digest[:8], "big") % slices)
                keys.append(digest.hex())
                masks.append(own_mask(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(place, pa.int64()), pa.array(keys, pa.string()), batch.column(2), pa.array(masks, pa.int32()), batch.column(0)],
                ["slice", "key", "part", "mask", "id"],
            )

    return work


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic): documents with a row of quality 1 or of toxic 1, one row each."""
    either = labels.filter((F.col("quality") == 1) | (F.col("toxic") == 1)).filter(F.col("doc_id").isNotNull())
    return either.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )


def _by_text(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """(slice, sent): what a task has of a text, part and label, written as JSON.

    ``sent`` is [key, part, mask, good, toxic, known, id, rows of that id, rows]; the id is
    the least, and rows without an id are apart.
    """
    rows = pa.Table.from_batches(batches)
    per_id = rows.group_by([*GROUP, "id"], use_threads=False).aggregate([([], "count_all")])
    least = per_id.sort_by("id").group_by(GROUP, use_threads=False).aggregate(
        [("id", "first"), ("count_all", "first"), ("count_all", "sum")]
    )
    names = [*GROUP[1:], "id_first", "count_all_first", "count_all_sum"]
    sent = map(json.dumps, zip(*[least[c].to_pylist() for c in names], strict=True))
    return pa.RecordBatch.from_arrays(
        [least["slice"].combine_chunks(), pa.array(sent, pa.string())], ["slice", "sent"]
    )


def _combine(most: int = 200_000):
    """Joins a task's rows of one text, some hundred thousand rows at a time."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= most:
                yield _by_text(held)
                held, size = [], 0
        if held:
            yield _by_text(held)

    return work


def settle(rows: list[list], before: list | None) -> tuple[list[list], list | None]:
    """(signed counts, new state) of one text, whose state was ``before``.

    A state is [least id, [[part, good, toxic, rows of that id], ...]].
    """
    out, known = [], []
    for part, mask, good, toxic, has_id, key, n_least, n in rows:
        if has_id:
            known.append((part, mask, good, toxic, key, n_least, n))
        else:
            # no id is smaller than a missing one
            out.append([part, mask, good, toxic, n])
    if not known:
        return out, before
    least = min(r[4] for r in known)
    holders = {}
    if before is not None:
        holders = {tuple(h[:3]): h[3] for h in before[1]}
        if least < before[0]:
            # an earlier document has come: those counted as first are repeats after all
            mask = known[0][1]
            for (part, good, toxic), n in holders.items():
                out.append([part, mask, good, toxic, -n])
                out.append([part, mask | REPEATED, good, toxic, n])
            holders = {}
        least = min(least, before[0])
    for part, mask, good, toxic, key, n_least, n in known:
        first = n_least if key == least else 0
        if first:
            out.append([part, mask, good, toxic, first])
            holders[part, good, toxic] = holders.get((part, good, toxic), 0) + first
        if n > first:
            out.append([part, mask | REPEATED, good, toxic, n - first])
    return out, [least, [[*who, n] for who, n in holders.items()]]


def least_ids(place: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Applies :func:`settle` to each text of a slice that has new rows."""
    texts: dict[str, list] = {}
    for frame in frames:
        for sent in frame["sent"].tolist():
            key, *row = json.loads(sent)
            texts.setdefault(key, []).append(row)
    held = json.loads(state.get[0]) if state.exists else {}
    total: Counter = Counter()
    for key, rows in texts.items():
        out, after = settle(rows, held.get(key))
        if after is not None:
            held[key] = after
        for *counter, n in out:
            total[tuple(counter)] += n
    state.update((json.dumps(held),))
    yield pd.DataFrame({"deltas": [json.dumps([[*c, n] for c, n in total.items() if n])]})


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's signed counts as one row per counter, so that what is written does not grow with the texts."""
    total: Counter = Counter()
    for batch in batches:
        for deltas in batch.column(0).to_pylist():
            for *place, n in json.loads(deltas):
                total[tuple(place)] += n
    rows = [(*place, n) for place, n in total.items() if n]
    if rows:
        names = [c.split()[0] for c in COUNTS.split(", ")]
        kinds = [pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
        )


def counts_stream(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    folder: str,
    batch_bytes: int | None = None,
    slice_rows: int = 64,
) -> DataFrame:
    """(part, mask, good, toxic, n): signed counts of all micro-batches over the files at ``path``.

    ``batch_bytes`` bounds the files of one micro-batch (at least one file); by default
    32 MB for each core.  There is a slice for every ``slice_rows`` rows.  State lies in
    RocksDB on the executors' disks, checkpointed with the stream's progress below
    ``folder``; a lost executor's share is restored from there, and the sink counts every
    batch once.
    """
    table = spark.read.parquet(path).select("doc_id", "text", "source")
    slices = max(1, -(-table.count() // slice_rows))
    size = batch_bytes or (32 << 20) * spark.sparkContext.defaultParallelism
    docs = (
        spark.readStream.schema(table.schema)
        .option("maxBytesPerTrigger", size)
        # files are not left out for their age
        .option("maxFileAge", "36500d")
        # as a pattern, because the stream takes a plain path for a folder's
        .parquet(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
    )
    seen = texts.mapInArrow(_judge(slices), "slice long, key string, part string, mask int, id long")
    flags = keep(label_flags(labels), "label-flags").withColumnRenamed("doc_id", "id")
    flagged = seen.join(F.broadcast(flags) if fits(flags) else flags, "id", "left")
    no = F.lit(False)
    rows = flagged.select(
        "slice",
        "key",
        "part",
        "mask",
        F.coalesce("good", no).alias("good"),
        F.coalesce("toxic", no).alias("toxic"),
        F.col("id").isNotNull().alias("known"),
        F.coalesce("id", F.lit(0)).alias("id"),
    )
    deltas = (
        rows.mapInArrow(_combine(), "slice long, sent string")
        .groupBy("slice")
        .applyInPandasWithState(
            least_ids, "deltas string", "texts string", "append", GroupStateTimeout.NoTimeout
        )
        .mapInArrow(_add_up, COUNTS)
    )
    # there even if no batch runs
    spark.createDataFrame([], COUNTS).write.parquet(f"{folder}/counts")
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():
        spark.conf.set(key, value)
    try:
        query = (
            deltas.writeStream.format("parquet")
            .option("path", f"{folder}/counts")
            .option("checkpointLocation", f"{folder}/progress")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    return spark.read.schema(COUNTS).parquet(f"{folder}/counts")


def interactions(counts: DataFrame) -> DataFrame:
    """``RESULT`` from (part, mask, good, toxic, n): one row per part, order and step, zeros included."""
    per_mask = counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), F.lit(0)).alias("toxic"),
    )
    # at most 32 masks a part
    parts = per_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = ["".join(o) for o in itertools.permutations(FILTERS)]
    rows = parts.select("*", F.explode(F.lit(orders)).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step")
    )
    bits = [(F.instr("filter_order", f), 1 << i) for i, f in enumerate(FILTERS)]
    bit = sum((F.when(place == F.col("step"), b).otherwise(0) for place, b in bits), F.lit(0))
    before = sum((F.when(place < F.col("step"), b).otherwise(0) for place, b in bits), F.lit(0))
    rows = rows.withColumns({"bit": bit, "before": before})

    def total(condition: str, value: str = "e.n") -> Column:
        return F.expr(
            f"aggregate(filter(masks, e -> {condition}), CAST(0 AS BIGINT), (sum, e) -> sum + {value})"
        )

    here = "(e.mask & bit) <> 0 AND (e.mask & before) = 0"
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("(e.mask & (bit | before)) = 0").alias("kept"),
        total(here).alias("removed"),
        total("(e.mask & bit) <> 0 AND (e.mask & before) <> 0").alias("redundant"),
        total("e.mask = bit").alias("unique_fails"),
        total(here, "e.good").alias("good_lost"),
        total(here, "e.toxic").alias("toxic_lost"),
        # a failing filter comes first among a document's failing filters in an equal share of the orders
        total("(e.mask & bit) <> 0", f"e.n * ({len(orders)} div bit_count(e.mask))").alias("shapley"),
    )


def filter_audit(
    spark: SparkSession, path: str, labels: DataFrame, batch_bytes: int | None = None
) -> DataFrame:
    """One row per part, filter order and step (``RESULT``) for the Parquet files at ``path``.

    The files hold (doc_id, text, source); ``labels`` holds (doc_id, quality, toxic).  Other
    columns are ignored.  A null text is empty, a null source is the part of the empty
    name.  A null doc_id is neither smaller than another nor has a smaller one, so such a
    row never fails E and makes none fail; rows of one id and one text do not make each
    other fail, and count each.  A label counts if any row of the id has it; labels of
    unknown or null ids are ignored.  Ties cannot occur otherwise.  An empty table gives
    no rows.  A text's copies in one task are sent on as one row per part and label, so a
    hot text is no hot group; the state has one least id per distinct text.
    """
    counts = counts_stream(spark, path, labels, fresh_folder(spark, "filter-audit"), batch_bytes)
    return interactions(counts)
