"""Record files: an id line, body lines, and a separator line.

Files may have any line end, each its own, or several in one file.  ``lineSep`` is the
separator's text alone, so Spark splits a large file wherever that text stands; a place
where it does not fill a line is no separator, and the pieces are joined again: inside a
split by the task that reads it, across splits through the pieces at their edges, of which
there are two a split.  A last record without its separator is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankspark.functions import analysis

# The separator lines of the three files of a collection.
DOCUMENT_END = "   /"
TOPIC_END = "/"
JUDGEMENT_END = "   /"


ENDS = ("\n", "\r")
FRAGMENTS = "file STRING, block BIGINT, place INT, opens BOOLEAN, closes BOOLEAN, text STRING"


def _fragments(end: str, edges: bool):
    """Pieces of each split joined where no separator line stands between them.

    A split's first and last fragment are its edges (``place`` 0 and 1), and only they or
    only the others are put out.  ``opens`` and ``closes`` tell whether the fragment begins
    and ends as text beside a separator line does.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        split, held, first, opens, closes = None, [], True, False, False

        def leave(last: bool) -> None:
            if edges == (first or last):
                out.append((*split, 0 if first else 1, opens, closes, end.join(held)))

        for batch in batches:
            for *place, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begins = piece.startswith(ENDS)
                if place != split:
                    if split is not None:
                        leave(last=True)
                    # before the first line of a file a separator needs no line end
                    split, held, first, opens = place, [piece], True, begins
                    closes = piece.endswith(ENDS) or (not piece and place[1] == 0)
                    continue
                if closes and begins:
                    leave(last=False)
                    held, first, opens = [piece], False, begins
                else:
                    held.append(piece)
                closes = piece.endswith(ENDS)
            if out:
                yield _batch(out)
                out = []
        if split is not None:
            leave(last=True)
        if out:
            yield _batch(out)

    return work


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string()]
    names = [c.split()[0] for c in FRAGMENTS.split(", ")]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def _whole_records(spark: SparkSession, path: str, end: str) -> DataFrame:
    """(text): records of files with any line ends; separator lines are cut out, the line ends
    beside them are not.  The files are read twice, the second time for the edges."""
    pieces = spark.read.option("lineSep", end).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    inner = pieces.mapInArrow(_fragments(end, edges=False), FRAGMENTS).select("text")
    edges = pieces.mapInArrow(_fragments(end, edges=True), FRAGMENTS)
    order = Window.partitionBy("file").orderBy("block", "place")
    # two edges of one split have a separator between them, or there is only one
    parted = (F.col("place") == 1) | (F.lag("closes").over(order) & F.col("opens"))
    told = edges.withColumn("parted", F.coalesce(parted, F.lit(True)).cast("int"))
    numbered = told.withColumn("record", F.sum("parted").over(order))
    parts = F.sort_array(F.collect_list(F.struct("block", "place", "text")))
    joined = numbered.groupBy("file", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), end).alias("text")
    )
    return inner.unionByName(joined.select("text"))


def scan_records(spark: SparkSession, path: str, end: str, newline: str | None = None) -> DataFrame:
    """(id, lines): the first line of each record as it stands, without outer blanks.

    ``newline`` promises that all files have that line end; Spark's reader then finds the
    separator lines by itself, in one pass.  Records without an id line (the blank rest of
    a file) are none.
    """
    if newline:
        raw = spark.read.option("lineSep", f"{newline}{end}{newline}").text(path).select("value")
        # the last separator of a file may lack its line end
        record = F.regexp_replace("value", rf"\r?\n\Q{end}\E\z", "")
    else:
        raw = _whole_records(spark, path, end).withColumnRenamed("text", "value")
        record = F.regexp_replace(F.regexp_replace("value", r"\A(\r\n|\r|\n)", ""), r"(\r\n|\r|\n)\z", "")
    parts = raw.select(F.split(record, analysis.LINE_END, -1).alias("parts"))
    return parts.select(
        F.trim(F.get("parts", 0)).alias("id"),
        F.slice("parts", 2, F.size("parts")).alias("lines"),
    ).filter((F.col("id") != "") | (F.size("lines") > 1))


def _typed(name: str, kind: str) -> Column:
    """``name`` as ``kind``; a value that is none raises, in ANSI mode or not."""
    value = F.col(name).try_cast(kind)
    problem = F.raise_error(F.concat(F.lit(f"not a {kind}: "), F.col(name))).cast(kind)
    return F.when(value.isNull() & F.col(name).isNotNull(), problem).otherwise(value)


def _joined() -> Column:
    return F.array_join(F.transform("lines", lambda line: F.concat(line, F.lit(" "))), "")


def scan_documents(
    spark: SparkSession, path: str, newline: str | None = None, id_type: str = "bigint"
) -> DataFrame:
    """(doc_id, text): body lines, each followed by one space.

    An id that is not of ``id_type`` raises; ``"string"`` takes every id.
    """
    records = scan_records(spark, path, DOCUMENT_END, newline)
    return records.select(_typed("id", id_type).alias("doc_id"), _joined().alias("text"))


def scan_topics(
    spark: SparkSession, path: str, newline: str | None = None, id_type: str = "bigint"
) -> DataFrame:
    """(topic_id, text): body lines, each followed by one space; ids as in ``scan_documents``."""
    records = scan_records(spark, path, TOPIC_END, newline)
    return records.select(_typed("id", id_type).alias("topic_id"), _joined().alias("text"))


def scan_qrels(
    spark: SparkSession, path: str, newline: str | None = None, id_type: str = "bigint"
) -> DataFrame:
    """(topic_id, doc_id): every number in the body; other words are ignored."""
    records = scan_records(spark, path, JUDGEMENT_END, newline)
    words = records.select(
        _typed("id", id_type).alias("topic_id"), F.explode(F.split(_joined(), r"\s+")).alias("word")
    )
    return (
        words.filter(F.col("word").rlike("^[0-9]+$"))
        .select("topic_id", F.col("word").cast("bigint").alias("doc_id"))
        .distinct()
    )


def write_records(records: DataFrame, path: str, end: str, newline: str = "\n") -> None:
    """Writes (id, body) rows as records; used to hand collections on."""
    rows = records.select(F.concat_ws(newline, F.col("id"), "body", F.lit(end)).alias("value"))
    rows.write.mode("append").option("lineSep", newline).text(path)
