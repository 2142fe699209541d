"""The index: documents, postings and statistics as tables.

Segments.  An index is a list of segments, named by its manifest.  A segment holds the
documents of one write.  An update adds a segment with its batch only, and a table of the
keys it withdraws from the segments before; readers leave those rows out.  Statistics are
signed sums, one folder per write.  A merge names the segments of its parts and copies
nothing.  ``compact_index`` puts the live rows of all segments into one.

Identity.  A row is a document of its own even if its ``doc_id`` occurs more than once:
``copy_no`` counts the rows of a key, and everything is grouped and joined by both.

Layout.  Documents are hash-distributed by ``doc_id`` before they are
analysed, so counting a document's words needs no second shuffle.  The written
``postings`` are bucketed by ``doc_id`` and sorted by (field, term, doc_id)
inside each bucket: a term filter skips row groups in every bucket, a frequent
term is spread over all buckets, and per-document aggregation or a join on
``doc_id`` runs without moving postings.  ``doc_len`` is carried on each
posting so that scoring needs no join with document statistics.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from rankspark.functions import analysis
from rankspark.session import BROADCAST_ROWS, fits, keep, lookup_join

FIELDS = ("contents", "top5_lines", "bottom5_lines")
IDENTITY = ("doc_id", "copy_no")
# Text of a bucket.  A task that counts words, sorts postings or scores topics holds about
# a hundred times as much.
BUCKET_BYTES = 4 << 20
# Spark's own limit, spark.sql.sources.bucketing.maxBuckets.
MOST_BUCKETS = 100_000
TERM_STATS = "field STRING, term STRING, df BIGINT, cf BIGINT, sum_tf2 BIGINT"
TERM_BOUNDS = "field STRING, term STRING, max_tf BIGINT, max_rate DOUBLE, min_len BIGINT"
FIELD_STATS = (
    "field STRING, n_docs BIGINT, n_docs_with_field BIGINT, sum_cf BIGINT, "
    "n_terms BIGINT, n_postings BIGINT"
)
MANIFEST = (
    "version INT, buckets INT, fields ARRAY<STRING>, stopwords ARRAY<STRING>, positions BOOLEAN, "
    "segments ARRAY<STRUCT<folder: STRING, buckets: INT, first_copy: BIGINT, copies: BIGINT, "
    "hidden: ARRAY<STRUCT<folder: STRING, keys: BIGINT, buckets: INT>>>>, statistics ARRAY<STRING>"
)
# String columns of documents that are looked up by value, and their distinct values in a
# row group (a filter of about ten bits each).
KEYWORDS = ("path", "source_file", "hostname", "thread")
KEYWORD_VALUES = 200_000
# Copies of a key within one segment; parts of a merge begin at multiples of it.
COPIES = 1 << 32
HEAVY_TERMS = BROADCAST_ROWS
POINT_KEYS = 2_000


@dataclass(frozen=True)
class Index:
    """Tables of an index; ``manifest`` is there if they were written."""

    docs: DataFrame
    postings: DataFrame
    doc_stats: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    term_bounds: DataFrame
    manifest: Row | None = None


def describe(docs: DataFrame) -> DataFrame:
    """Replaces ``text`` by the three text fields and a snippet."""
    others = [c for c in docs.columns if c != "text"]
    return docs.select(*others, analysis.normalized(F.col("text")).alias("contents")).select(
        *others,
        "contents",
        analysis.head_lines(F.col("contents")).alias("top5_lines"),
        analysis.tail_lines(F.col("contents")).alias("bottom5_lines"),
        analysis.snippet(F.col("contents")).alias("snippet"),
    )


def by_document(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions, "doc_id") if partitions else df.repartition("doc_id")


def identified(df: DataFrame) -> DataFrame:
    """``df`` with ``copy_no``: as it stands, or 0 where every row has a key of its own."""
    return df if "copy_no" in df.columns else df.withColumn("copy_no", F.lit(0).cast("bigint"))


def number_copies(docs: DataFrame) -> DataFrame:
    """Counts the rows of each ``doc_id`` from 0 in ``copy_no``; the numbers follow the texts."""
    text = "text" if "text" in docs.columns else "contents"
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64(text))
    return docs.withColumn("copy_no", F.row_number().over(order).cast("bigint") - 1)


def field_tokens(
    docs: DataFrame, fields: Sequence[str] = ("contents",), stopwords: Sequence[str] = ()
) -> DataFrame:
    """(field, doc_id, copy_no, tokens): one row per document and field."""
    texts = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]
    )
    return identified(docs).select(*IDENTITY, F.inline(texts)).select(
        "field", *IDENTITY, analysis.tokens(F.col("text"), stopwords).alias("tokens")
    )


def build_postings(
    docs: DataFrame,
    fields: Sequence[str] = ("contents",),
    stopwords: Sequence[str] = (),
    partitions: int | None = None,
    bucketed: bool = False,
    positions: bool = False,
) -> DataFrame:
    """(field, term, doc_id, copy_no, tf, doc_len) and, if asked for, positions.

    No ranking reads the positions, and collecting them more than doubles the
    time of this step, so they are optional.  The texts are distributed by ``doc_id`` first, unless they come from a
    table ``bucketed`` that way; the grouping then finds its rows in place.  Without
    ``partitions`` the texts are measured, so that a task has no more of them than a bucket.
    """
    texts = identified(docs).select(*IDENTITY, *fields)
    if not bucketed:
        texts = by_document(texts, partitions or _buckets_for(texts, *fields))
    counted = field_tokens(texts, fields, stopwords).withColumn(
        "doc_len", F.size("tokens").cast("bigint")
    )
    # the outer form, because for the inner one the optimizer infers a filter
    # that runs the analysis a second time
    words = counted.select(
        "field", *IDENTITY, "doc_len", F.posexplode_outer("tokens").alias("pos", "term")
    ).filter(F.col("term").isNotNull())
    columns = [F.count("*").alias("tf"), F.max("doc_len").alias("doc_len")]
    if positions:
        columns.append(F.sort_array(F.collect_list("pos")).alias("positions"))
    return words.groupBy("field", "term", *IDENTITY).agg(*columns)


def token_positions(docs: DataFrame, field: str = "contents") -> DataFrame:
    """(doc_id, pos, term, start_off, end_off), computed inside each document row."""
    spans = docs.select("doc_id", F.posexplode(analysis.token_spans(F.col(field))))
    return spans.select(
        "doc_id",
        F.col("pos").cast("bigint").alias("pos"),
        "col.term",
        F.col("col.start_off").cast("bigint").alias("start_off"),
        F.col("col.end_off").cast("bigint").alias("end_off"),
    )


def document_statistics(
    docs: DataFrame, postings: DataFrame, fields: Sequence[str]
) -> DataFrame:
    """(field, doc_id, copy_no, doc_len, n_terms), documents without words included.

    Every document comes in once with nothing counted, so no join is needed; where both
    tables are bucketed alike, nothing is shuffled.
    """
    none = F.lit(0).cast("bigint")
    every = identified(docs).select(
        *IDENTITY, F.explode(F.array(*map(F.lit, fields))).alias("field"), none.alias("tf"), none.alias("n")
    )
    words = postings.select(*IDENTITY, "field", "tf", F.lit(1).cast("bigint").alias("n"))
    counted = every.union(words).groupBy("field", *IDENTITY).agg(
        F.sum("tf").alias("doc_len"), F.sum("n").alias("n_terms")
    )
    return counted.select("field", *IDENTITY, "doc_len", "n_terms")


def _term_table(postings: DataFrame) -> DataFrame:
    """Statistics and score bounds of each (field, term).

    The per-task partial aggregation leaves at most one row per term and task,
    so a term that occurs everywhere is no hot key.
    """
    return postings.groupBy("field", "term").agg(
        F.count("*").alias("df"),
        F.sum("tf").alias("cf"),
        F.sum(F.col("tf") * F.col("tf")).alias("sum_tf2"),
        F.max("tf").alias("max_tf"),
        F.max(F.col("tf") / F.col("doc_len")).alias("max_rate"),
        F.min("doc_len").alias("min_len"),
    )


STATS_COLUMNS = [c.split()[0] for c in TERM_STATS.split(", ")]
BOUNDS_COLUMNS = [c.split()[0] for c in TERM_BOUNDS.split(", ")]


def term_statistics(postings: DataFrame) -> DataFrame:
    """(field, term, df, cf, sum_tf2)."""
    return _term_table(postings).select(*STATS_COLUMNS)


def field_statistics(doc_stats: DataFrame, term_stats: DataFrame) -> DataFrame:
    """One row per field: n_docs, n_docs_with_field, sum_cf, n_terms, n_postings."""
    per_doc = doc_stats.groupBy("field").agg(
        F.count("*").alias("n_docs"),
        F.count_if(F.col("doc_len") > 0).alias("n_docs_with_field"),
        F.sum("doc_len").alias("sum_cf"),
        F.sum("n_terms").alias("n_postings"),
    )
    per_term = term_stats.groupBy("field").agg(F.count("*").alias("n_terms"))
    return per_doc.join(per_term, "field", "left").select(
        "field",
        "n_docs",
        "n_docs_with_field",
        "sum_cf",
        F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
        "n_postings",
    )


def build_index(
    docs: DataFrame,
    fields: Sequence[str] = ("contents",),
    stopwords: Sequence[str] = (),
    partitions: int | None = None,
    positions: bool = False,
) -> Index:
    """An index over ``docs``; rows with an equal ``doc_id`` are documents of their own.

    Nothing is run yet.
    """
    docs = number_copies(by_document(docs, partitions))
    # distributed already, and the numbering keeps the distribution
    postings = build_postings(docs, fields, stopwords, partitions, True, positions)
    return _with_statistics(docs, postings, fields)


def _with_statistics(docs: DataFrame, postings: DataFrame, fields: Sequence[str]) -> Index:
    doc_stats = document_statistics(docs, postings, fields)
    terms = _term_table(postings)
    term_stats = terms.select(*STATS_COLUMNS)
    return Index(
        docs,
        postings,
        doc_stats,
        term_stats,
        field_statistics(doc_stats, term_stats),
        terms.select(*BOUNDS_COLUMNS),
    )


# --- writing, opening, updating -------------------------------------------------


def _manifest(spark: SparkSession, path: str) -> list:
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
        return rows.orderBy(F.desc("version")).limit(1).collect()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise


def _table_name(path: str, version: int, part: str) -> str:
    digest = hashlib.sha1(f"{path}/{version}".encode()).hexdigest()[:16]
    return f"rankspark_{digest}_{part}"


def _save(
    df: DataFrame, path: str, version: int, part: str, buckets: int, sort: Sequence[str]
) -> DataFrame:
    """Writes one bucketed table and returns it read back.

    ``df`` must be hash-distributed by ``doc_id`` into ``buckets`` partitions, so
    that each task writes the one file of its bucket.
    """
    name = _table_name(path, version, part)
    writer = (
        df.write.format("parquet")
        .bucketBy(buckets, "doc_id")
        .sortBy(*sort)
        .option("path", f"{path}/v{version}/{part}")
        .mode("overwrite")
    )
    if part == "docs":
        # a lookup of a keyword opens only the row groups that may hold it
        for column, kind in df.dtypes:
            if kind == "string" and column in (*KEYWORDS, "doc_id"):
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
                    f"parquet.bloom.filter.expected.ndv#{column}", KEYWORD_VALUES
                )
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def default_buckets(docs: DataFrame) -> int:
    """About ``BUCKET_BYTES`` of text per bucket, and no fewer buckets than cores.

    The texts are measured, so what they were joined with does not count.
    """
    return _buckets_for(docs, "text" if "text" in docs.columns else "contents")


def _buckets_for(docs: DataFrame, *columns: str) -> int:
    width = sum((F.coalesce(F.octet_length(c).cast("bigint"), F.lit(0)) for c in columns), F.lit(0))
    size = docs.agg(F.sum(width)).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return min(max(cores, -(-size // BUCKET_BYTES)), MOST_BUCKETS)


def _repeated_keys(docs: DataFrame) -> bool:
    """Whether a key stands twice; the table is bucketed on it, so nothing is shuffled."""
    return bool(docs.groupBy("doc_id").count().filter("count > 1").limit(1).collect())


@dataclass(frozen=True)
class Plan:
    """How an index analyses and stores: the settings its manifest keeps."""

    buckets: int
    fields: list[str]
    stopwords: list[str]
    positions: bool

    def postings(self, docs: DataFrame, bucketed: bool) -> DataFrame:
        return build_postings(docs, self.fields, self.stopwords, self.buckets, bucketed, self.positions)


def _write_rows(docs: DataFrame, plan: Plan, path: str, version: int, unique: bool) -> tuple:
    """Documents, postings and document statistics of a batch as one segment.

    ``docs`` must be hash-distributed by ``doc_id`` into the plan's buckets.  Rows with one
    key are numbered; as they are rare, documents are written as if there were none, and
    only a batch that has some is written again.
    """
    stored = _save(identified(docs), path, version, "docs", plan.buckets, ["doc_id"])
    if not unique and _repeated_keys(stored):
        stored = _save(number_copies(docs), path, version, "docs", plan.buckets, ["doc_id"])
    postings = _save(
        plan.postings(stored, True), path, version, "postings", plan.buckets, ["field", "term", "doc_id"]
    )
    return stored, postings, _write_doc_stats(stored, postings, plan, path, version)


def _write_doc_stats(docs: DataFrame, postings: DataFrame, plan: Plan, path: str, version: int) -> DataFrame:
    told = document_statistics(docs, postings, plan.fields)
    return _save(told, path, version, "doc_stats", plan.buckets, ["field", "doc_id"])


def _write_statistics(terms: DataFrame, totals: DataFrame, folder: str) -> None:
    terms.sortWithinPartitions("field", "term").write.mode("overwrite").parquet(f"{folder}/term_stats")
    totals.write.mode("overwrite").parquet(f"{folder}/field_stats")


def _first_statistics(postings: DataFrame, doc_stats: DataFrame, folder: str) -> None:
    spark = postings.sparkSession
    _term_table(postings).sortWithinPartitions("field", "term").write.mode("overwrite").parquet(
        f"{folder}/term_stats"
    )
    terms = spark.read.schema(TERM_STATS).parquet(f"{folder}/term_stats")
    field_statistics(doc_stats, terms).write.mode("overwrite").parquet(f"{folder}/field_stats")


def _publish(
    spark: SparkSession, path: str, version: int, plan: Plan, segments: list, statistics: list[str]
) -> Index:
    """The manifest row comes last: a version that failed half-way is never opened."""
    row = (version, plan.buckets, plan.fields, plan.stopwords, plan.positions, segments, statistics)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return open_index(spark, path)


def _segment(path: str, version: int, buckets: int, copies: int = 1) -> tuple:
    return (f"{path}/v{version}", buckets, 0, copies, [])


def write_index(
    docs: DataFrame,
    path: str,
    mode: str = "create",
    fields: Sequence[str] = ("contents",),
    stopwords: Sequence[str] = (),
    buckets: int | None = None,
    order_by: str | None = None,
    positions: bool = False,
) -> Index:
    """Indexes ``docs`` (``doc_id``, ``text``, any further columns) at ``path``.

    ``create`` replaces what is there and adds every row, also rows with one ``doc_id``,
    which stay documents of their own.  ``append`` (the index must exist) and
    ``create_or_append`` replace all documents that have the same ``doc_id`` and keep the
    others; of several copies inside ``docs`` the last by the column ``order_by`` wins, of
    equal ones the largest by all columns.  An index that exists keeps the fields and stop
    words it was made with, and its buckets unless ``buckets`` says otherwise.

    An update costs what its batch costs: it writes the batch as a new segment, looks up
    the documents that the batch replaces and takes their statistics off by analysing
    those alone.  No old posting is read.  Each call writes a new version folder, so a
    reader of the previous version, or a failed job, never sees a half-written table.
    """
    if mode not in ("create", "append", "create_or_append"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = docs.sparkSession
    last = _manifest(spark, path)
    if mode == "append" and not last:
        raise FileNotFoundError(f"no index at {path}")
    version = last[0].version + 1 if last else 0
    updating = bool(last) and mode != "create"
    if updating:
        kept_buckets, fields, stopwords, positions = last[0][1:5]
        buckets = buckets or kept_buckets
    buckets = buckets or default_buckets(docs)
    plan = Plan(buckets, list(fields), list(stopwords), positions)
    if mode != "create":
        docs = _last_copies(docs, order_by)
    if order_by:
        docs = docs.drop(order_by)
    if updating:
        docs = keep(docs, "batch")
    batch = describe(by_document(docs.drop("copy_no"), buckets))
    if updating:
        return _update(batch, docs.select("doc_id"), plan, path, version)
    stored, postings, doc_stats = _write_rows(batch, plan, path, version, unique=mode != "create")
    folder = f"{path}/v{version}"
    _first_statistics(postings, doc_stats, folder)
    return _publish(spark, path, version, plan, [_segment(path, version, buckets)], [folder])


def _update(batch: DataFrame, keys: DataFrame, plan: Plan, path: str, version: int) -> Index:
    """Adds ``batch`` as a segment and withdraws ``keys`` from those before."""
    spark, folder = batch.sparkSession, f"{path}/v{version}"
    old = open_index(spark, path)
    gone = keep(at_documents(old.docs.select(*IDENTITY, *plan.fields), keys), "withdrawn")
    _, postings, doc_stats = _write_rows(batch, plan, path, version, unique=True)
    lost = keep(plan.postings(gone, False), "withdrawn-postings")
    segments = [tuple(s) for s in old.manifest.segments]
    n_gone = gone.select("doc_id").distinct().count()
    if n_gone:
        hidden = by_document(gone.select("doc_id").distinct(), plan.buckets)
        _save(hidden, path, version, "hidden", plan.buckets, ["doc_id"])
        segments = [(*s[:4], [*map(tuple, s[4]), (folder, n_gone, plan.buckets)]) for s in segments]
    # signed sums: what the batch brings less what it replaces; bounds only ever widen
    signed = lambda df, sign: df.select(
        "field", "term", F.lit(sign).alias("sign"), "tf", "doc_len"
    )
    both = signed(postings, 1).unionByName(signed(lost, -1))
    added = F.col("sign") > 0
    changed = both.groupBy("field", "term").agg(
        F.sum("sign").cast("bigint").alias("df"),
        F.sum(F.col("sign") * F.col("tf")).alias("cf"),
        F.sum(F.col("sign") * F.col("tf") * F.col("tf")).alias("sum_tf2"),
        F.max(F.when(added, F.col("tf"))).alias("max_tf"),
        F.max(F.when(added, F.col("tf") / F.col("doc_len"))).alias("max_rate"),
        F.min(F.when(added, F.col("doc_len"))).alias("min_len"),
    )
    changed = keep(changed, "changed-terms")
    lost_docs = document_statistics(gone, lost, plan.fields)
    counted = doc_stats.withColumn("sign", F.lit(1)).unionByName(lost_docs.withColumn("sign", F.lit(-1)))
    per_doc = counted.groupBy("field").agg(
        F.sum("sign").cast("bigint").alias("n_docs"),
        F.sum(F.when(F.col("doc_len") > 0, F.col("sign")).otherwise(0)).cast("bigint").alias("n_docs_with_field"),
        F.sum(F.col("sign") * F.col("doc_len")).alias("sum_cf"),
        F.sum(F.col("sign") * F.col("n_terms")).alias("n_postings"),
    )
    # words that come up or die out: the changed ones held against the statistics before
    before = old.term_stats.select("field", "term", F.col("df").alias("df_before"))
    changes = changed.select("field", "term", "df")
    small = F.broadcast(changes) if fits(changes) else changes
    known = before.join(small, ["field", "term"])
    died = known.filter(F.col("df_before") + F.col("df") == 0).groupBy("field").agg((-F.count("*")).alias("n"))
    born = changes.filter(F.col("df") > 0).groupBy("field").agg(F.count("*").alias("n"))
    lived = known.filter(F.col("df") > 0).groupBy("field").agg((-F.count("*")).alias("n"))
    # at most one row per field each
    moves = died.union(born).union(lived).groupBy("field").agg(F.sum("n").alias("n_terms"))
    totals = per_doc.join(moves, "field", "left").select(
        "field", "n_docs", "n_docs_with_field", "sum_cf", F.coalesce("n_terms", F.lit(0)).alias("n_terms"), "n_postings"
    )
    _write_statistics(changed, totals, folder)
    segments.append(_segment(path, version, plan.buckets))
    return _publish(spark, path, version, plan, segments, [*old.manifest.statistics, folder])


def _last_copies(docs: DataFrame, order_by: str | None) -> DataFrame:
    """One row per doc_id: the last by ``order_by``, of equal ones the largest by all columns.

    ``max`` combines before the shuffle, so a key with a great many copies sends one
    row per task.
    """
    row = F.struct(*([order_by] if order_by else []), F.struct(*docs.columns).alias("row"))
    best = docs.groupBy("doc_id").agg(F.max(row).alias("best"))
    return best.select("best.row.*")


def _table(spark: SparkSession, folder: str, part: str, buckets: int, sort: str) -> DataFrame:
    """A bucketed table of a segment; declared again in a session that does not know it."""
    path, _, version = folder.rpartition("/v")
    name = _table_name(path, int(version), part)
    if not spark.catalog.tableExists(name):
        columns = spark.read.parquet(f"{folder}/{part}").schema.toDDL()
        place = f"{folder}/{part}".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY (doc_id) SORTED BY ({sort}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def _live(spark: SparkSession, segment: Row, part: str, sort: str) -> DataFrame:
    """One table of a segment without the rows of withdrawn keys; the rows stay where they are.

    The manifest knows how many keys were withdrawn: few are broadcast, more are joined
    in place, since they are bucketed like the rows.
    """
    rows = _table(spark, segment.folder, part, segment.buckets, sort)
    if segment.first_copy:
        rows = rows.withColumn("copy_no", F.col("copy_no") + F.lit(segment.first_copy))
    for hidden in segment.hidden:
        keys = _table(spark, hidden.folder, "hidden", hidden.buckets, "doc_id").select("doc_id")
        keys = F.broadcast(keys) if hidden["keys"] <= BROADCAST_ROWS else keys.hint("shuffle_hash")
        rows = rows.join(keys, "doc_id", "left_anti").select(*rows.columns)
    return rows


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def _summed_terms(frames: Sequence[DataFrame]) -> DataFrame:
    """Signed sums per term of several writes; words that no document holds any more are gone."""
    if len(frames) == 1:
        return frames[0].select(*STATS_COLUMNS)
    summed = _union([f.select(*STATS_COLUMNS) for f in frames]).groupBy("field", "term").agg(
        *[F.sum(c).alias(c) for c in ("df", "cf", "sum_tf2")]
    )
    return summed.filter(F.col("df") > 0)


def _widest_bounds(frames: Sequence[DataFrame]) -> DataFrame:
    """Bounds that hold for several writes; those of withdrawn rows only make them wider."""
    if len(frames) == 1:
        return frames[0].select(*BOUNDS_COLUMNS)
    return _union([f.select(*BOUNDS_COLUMNS) for f in frames]).groupBy("field", "term").agg(
        F.max("max_tf").alias("max_tf"), F.max("max_rate").alias("max_rate"), F.min("min_len").alias("min_len")
    )


def _summed_fields(frames: Sequence[DataFrame]) -> DataFrame:
    if len(frames) == 1:
        return frames[0]
    names = [c.split()[0] for c in FIELD_STATS.split(", ")][1:]
    return _union(list(frames)).groupBy("field").agg(*[F.sum(c).alias(c) for c in names])


def open_index(spark: SparkSession, path: str) -> Index:
    """The latest complete version at ``path``."""
    last = _manifest(spark, path)
    if not last:
        raise FileNotFoundError(f"no index at {path}")
    manifest = last[0]

    def table(part: str, sort: str) -> DataFrame:
        return _union([_live(spark, s, part, sort) for s in manifest.segments])

    schema = f"{TERM_STATS}, {TERM_BOUNDS.split(', ', 2)[2]}"
    terms = [spark.read.schema(schema).parquet(f"{f}/term_stats") for f in manifest.statistics]
    fields = [spark.read.schema(FIELD_STATS).parquet(f"{f}/field_stats") for f in manifest.statistics]
    return Index(
        docs=table("docs", "doc_id"),
        postings=table("postings", "field, term, doc_id"),
        doc_stats=table("doc_stats", "field, doc_id"),
        term_stats=_summed_terms(terms),
        field_stats=_summed_fields(fields),
        term_bounds=_widest_bounds(terms),
        manifest=manifest,
    )


def compact_index(spark: SparkSession, path: str, buckets: int | None = None) -> Index:
    """Writes the live rows of all segments as one segment and one set of statistics.

    No text is analysed again.  The folders of earlier versions stay for their readers.
    """
    old = open_index(spark, path)
    last = old.manifest
    plan = Plan(buckets or last.buckets, list(last.fields), list(last.stopwords), last.positions)
    return _rewrite(old, plan, path, last.version + 1, _copies(old))


def _rewrite(index: Index, plan: Plan, path: str, version: int, copies: int) -> Index:
    spark, folder = index.docs.sparkSession, f"{path}/v{version}"
    dealt = lambda df: by_document(df, plan.buckets)
    _save(dealt(index.docs), path, version, "docs", plan.buckets, ["doc_id"])
    postings = _save(dealt(index.postings), path, version, "postings", plan.buckets, ["field", "term", "doc_id"])
    doc_stats = _save(dealt(index.doc_stats), path, version, "doc_stats", plan.buckets, ["field", "doc_id"])
    _first_statistics(postings, doc_stats, folder)
    return _publish(spark, path, version, plan, [_segment(path, version, plan.buckets, copies)], [folder])


def _copies(part: Index) -> int:
    """How many numbers, in steps of ``COPIES``, the copies of one key take up in a part."""
    if part.manifest is None:
        return 1
    return max(s.first_copy // COPIES + s.copies for s in part.manifest.segments)


def _apart(parts: Sequence[Index]) -> list[int]:
    """Where the copy numbers of each part begin, so that equal keys of two parts stay apart."""
    return [COPIES * sum(map(_copies, parts[:i])) for i in range(len(parts))]


def merge_indexes(parts: Sequence[Index]) -> Index:
    """One index from separately built parts; documents with equal keys stay apart.

    Only statistics are re-aggregated (by sum); no text is analysed again.
    """
    firsts = _apart(parts)

    def union(name: str) -> DataFrame:
        return _union(
            [
                getattr(p, name).withColumn("copy_no", F.col("copy_no") + F.lit(first)) if first else getattr(p, name)
                for p, first in zip(parts, firsts, strict=True)
            ]
        )

    doc_stats = union("doc_stats")
    term_stats = _summed_terms([p.term_stats for p in parts])
    return Index(
        union("docs"),
        union("postings"),
        doc_stats,
        term_stats,
        field_statistics(doc_stats, term_stats),
        _widest_bounds([p.term_bounds for p in parts]),
    )


def write_merged(
    parts: Sequence[Index],
    path: str,
    stopwords: Sequence[str] = (),
    buckets: int | None = None,
) -> Index:
    """Writes the merge of ``parts`` at ``path``, replacing what is there.

    Parts that are written are not copied: the merge names their segments and settings,
    and only the merged statistics are written.  Their folders must then stay.  Parts that
    were built with other fields, stop words or positions raise.  Parts that are not
    written yet are; ``stopwords`` are those they were built with, for later updates.
    """
    spark = parts[0].docs.sparkSession
    last = _manifest(spark, path)
    version = last[0].version + 1 if last else 0
    merged = merge_indexes(parts)
    if any(p.manifest is None for p in parts):
        buckets = buckets or default_buckets(merged.docs)
        fields = sorted(r.field for r in merged.field_stats.select("field").collect())
        plan = Plan(buckets, fields, list(stopwords), "positions" in merged.postings.columns)
        return _rewrite(merged, plan, path, version, sum(map(_copies, parts)))
    alike = {(tuple(p.manifest.fields), tuple(p.manifest.stopwords), p.manifest.positions) for p in parts}
    if len(alike) > 1 or (stopwords and list(stopwords) != list(parts[0].manifest.stopwords)):
        raise ValueError(f"parts with different fields, stop words or positions: {sorted(map(str, alike))}")
    first = parts[0].manifest
    plan = Plan(buckets or first.buckets, list(first.fields), list(first.stopwords), first.positions)
    segments = [
        (s.folder, s.buckets, s.first_copy + begin, s.copies, [tuple(h) for h in s.hidden])
        for part, begin in zip(parts, _apart(parts), strict=True)
        for s in part.manifest.segments
    ]
    folder = f"{path}/v{version}"
    terms = merged.term_stats.join(merged.term_bounds, ["field", "term"], "left")
    _write_statistics(terms, merged.field_stats, folder)
    return _publish(spark, path, version, plan, segments, [folder])


# --- reading --------------------------------------------------------------------


def vocabulary(index: Index, field: str = "contents") -> DataFrame:
    """Terms of a field in UTF-8 byte order."""
    return index.term_stats.filter(F.col("field") == field).select("term", "df").orderBy("term")


def term_vector(index: Index, doc_id, field: str = "contents") -> DataFrame:
    """(term, tf) of one document; reads one bucket only."""
    one = (F.col("doc_id") == doc_id) & (F.col("field") == field)
    return index.postings.filter(one).select("term", "tf")


def term_vectors(index: Index, keys: DataFrame, field: str = "contents") -> DataFrame:
    """(doc_id, copy_no, term, tf) for every document named in ``keys``."""
    rows = index.postings.filter(F.col("field") == field).select(*IDENTITY, "term", "tf")
    return at_documents(rows, keys.select("doc_id").distinct())


def postings_of(index: Index, term: str, field: str = "contents") -> DataFrame:
    """(doc_id, tf) of one term; empty if the term does not occur."""
    return index.postings.filter(
        (F.col("field") == field) & (F.col("term") == term)
    ).select("doc_id", "tf")


def keyword_filter(docs: DataFrame, column: str, value: str) -> DataFrame:
    return docs.filter(F.col(column) == value)


def range_filter(docs: DataFrame, column: str, low, high) -> DataFrame:
    return docs.filter(F.col(column).between(low, high))


def _statistics(index: Index) -> tuple[DataFrame, Column]:
    """Term statistics with the totals of their field, and the heavy-term test.

    Fewer than ``HEAVY_TERMS`` terms per field can have
    df > n_postings / HEAVY_TERMS, because the df of a field add up to
    n_postings.  That bound is what makes heavy terms safe to broadcast.
    """
    totals = F.broadcast(index.field_stats)  # one row per field
    stats = index.term_stats.join(totals, "field").select(
        "field", "term", "df", "cf", "n_docs", "n_docs_with_field", "sum_cf", "n_postings"
    )
    return stats, F.col("df") > F.col("n_postings") / HEAVY_TERMS


def with_term_statistics(
    index: Index, rows: DataFrame, small_fits: bool = False, even: bool = False
) -> DataFrame:
    """Adds df, cf and the field totals to rows that have ``field`` and ``term``.

    Few rows are broadcast to the statistics, and ``even`` rows (no term holds
    a large share) are shuffled once.  Otherwise heavy terms, which cover most
    rows, are broadcast; only rows of the rarer terms are shuffled, and none of
    those terms holds a large share of them.
    """
    stats, is_heavy = _statistics(index)
    if small_fits:
        return stats.drop("n_postings").join(F.broadcast(rows), ["field", "term"])
    if even:
        return rows.join(stats.drop("n_postings"), ["field", "term"])
    heavy = F.broadcast(stats.filter(is_heavy).drop("n_postings"))
    rare = stats.filter(~is_heavy).drop("n_postings")
    names = F.broadcast(stats.filter(is_heavy).select("field", "term"))
    frequent = rows.join(heavy, ["field", "term"])
    others = rows.join(names, ["field", "term"], "left_anti").join(rare, ["field", "term"])
    return frequent.unionByName(others)


def join_postings(
    index: Index, small: DataFrame, small_fits: bool, field: str = "contents"
) -> DataFrame:
    """Postings (term, doc_id, copy_no, tf, doc_len) of a field joined with ``small`` on term.

    A small side that fits is broadcast.  Otherwise both sides are shuffled, see
    ``join_terms``.
    """
    rows = index.postings.filter(F.col("field") == field).select(
        "term", *IDENTITY, "tf", "doc_len"
    )
    if small_fits:
        return rows.join(F.broadcast(small), ["term"])
    return join_terms(index, rows, small, "doc_id", field)


def join_terms(
    index: Index, rows: DataFrame, table: DataFrame, spread: str, field: str = "contents"
) -> DataFrame:
    """``rows`` joined with ``table`` on term; both are shuffled, and no term is a hot key.

    A term of many documents has many rows.  It is dealt into as many shares as its part of
    the documents is of the shuffle's tasks, by the column ``spread`` of ``rows``, and its
    rows of ``table`` are copied as often.  Only heavy terms are (see ``_statistics``), so
    what is broadcast to tell them is bounded.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stats, is_heavy = _statistics(index)
    shares = F.ceil(F.col("df") * tasks / F.col("n_docs")).cast("int").alias("shares")
    heavy = F.broadcast(stats.filter((F.col("field") == field) & is_heavy).select("term", shares))
    n = F.coalesce("shares", F.lit(1))
    left = rows.join(heavy, ["term"], "left").withColumn("salt", F.pmod(F.xxhash64(spread), n).cast("int"))
    right = table.join(heavy, ["term"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0), n - 1)))
    return left.drop("shares").join(right.drop("shares"), ["term", "salt"]).drop("salt")


def at_documents(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of a table bucketed by ``doc_id`` joined with ``keys`` on doc_id.

    Keys that carry ``copy_no`` mean that one row of their id, others mean all.
    Up to ``POINT_KEYS`` distinct keys are also given to the scan as literals,
    so it opens only their buckets; more keys mean one pass over the table.
    """
    ids = keys.select("doc_id").distinct().limit(POINT_KEYS + 1).collect()
    if len(ids) <= POINT_KEYS:
        df = df.filter(F.col("doc_id").isin([r.doc_id for r in ids]))
    return lookup_join(df, keys, [c for c in IDENTITY if c in keys.columns])
