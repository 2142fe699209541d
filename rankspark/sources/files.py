"""File trees: one document per file."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.functions import analysis
from rankspark.session import keep


def plain_path(uri: Column) -> Column:
    """Path of a file URI: percent escapes decoded, ``file:`` removed."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:(?://)?(?=/)", "")


def _hidden(name: str) -> bool:
    return name.startswith((".", "_")) and not (name.startswith("_") and "=" in name)


# Stores that tasks can list and read by themselves; others are listed by the driver.
TASK_SCHEMES = ("file", "hdfs", "s3", "gs", "abfs", "abfss")
LEVEL = "file_path STRING, plain STRING, hidden BOOLEAN, folder BOOLEAN, ms BIGINT, file_size BIGINT"
LISTED_ROWS = 10_000
# Tasks of Spark's own listing, which would be one per folder up to ten thousand.
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
# The characters that a file URI holds escaped.
ESCAPED = re.compile(r"[\x00-\x20\x7f\"#%<>?\[\\\]^`{|}]")


def _qualified(spark: SparkSession, root: str):
    """The store and full path of a root, as Spark's readers see them."""
    start = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = start.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(start)


def _passed_over(spark: SparkSession, roots: Sequence[str]) -> DataFrame | None:
    """(file_path, plain, ms, file_size) of files that ``spark.read`` leaves out; None if there are none.

    Tasks list the folders, one level of the trees after the other; the driver only asks
    whether a level has folders.  A level's table holds its folders and the files wanted,
    not the names of all files.
    """
    own, parts = [], []
    for root in roots:
        _, path = _qualified(spark, root)
        if path.toUri().getScheme() in TASK_SCHEMES:
            own.append((path.toUri().toString(), path.toUri().getPath(), False))
        else:
            parts += _listed_by_driver(spark, root)
    level = spark.createDataFrame(own, "file_path STRING, plain STRING, hidden BOOLEAN") if own else None
    tasks = spark.sparkContext.defaultParallelism
    while level is not None and not level.isEmpty():
        # a number of partitions of one's own is not coalesced: listing waits, it holds few bytes
        listed = keep(level.repartition(tasks, "file_path").mapInPandas(_list_folders, LEVEL), "tree-level")
        parts.append(listed.filter("not folder").select("file_path", "plain", "ms", "file_size"))
        level = listed.filter("folder").select("file_path", "plain", "hidden")
    return reduce(DataFrame.unionByName, parts) if parts else None


def _list_folders(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The folders in each folder and its passed-over files; a root may be a file itself."""
    from pyarrow import fs

    names = [field.split()[0] for field in LEVEL.split(", ")]
    rows = []
    for frame in frames:
        for uri, plain, hidden in frame.itertuples(index=False):
            store, path = _store(uri, plain)
            info = store.get_file_info(path)
            single = info.type == fs.FileType.File
            for entry in [info] if single else store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                name = entry.base_name
                # checksums are the local file system's own
                if uri.startswith("file:") and name.startswith(".") and name.endswith(".crc"):
                    continue
                folder, veiled = entry.type == fs.FileType.Directory, hidden or _hidden(name)
                if not folder and entry.size and not veiled:
                    continue
                below = "" if single else "/" + name
                rows.append(
                    (
                        uri if single else uri.rstrip("/") + ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", below),
                        plain if single else plain.rstrip("/") + below,
                        veiled,
                        folder,
                        (entry.mtime_ns or 0) // 1_000_000,
                        entry.size or 0,
                    )
                )
            # a frame for each folder would take longer than its listing
            if len(rows) >= LISTED_ROWS:
                yield pd.DataFrame(rows, columns=names)
                rows = []
    if rows:
        yield pd.DataFrame(rows, columns=names)


def _store(uri: str, plain: str):
    """The file system of a file and its path there."""
    from pyarrow import fs

    if uri.startswith(("file:", "/")):
        return fs.LocalFileSystem(), plain
    return fs.FileSystem.from_uri(uri)


def _listed_by_driver(spark: SparkSession, root: str) -> list[DataFrame]:
    """The same for stores that only Spark's readers reach: names are listed, no contents read."""
    store, path = _qualified(spark, root)
    top, rows = path.toUri().getPath(), []
    listed = store.listFiles(path, True)
    while listed.hasNext():
        status = listed.next()
        uri, size = status.getPath().toUri(), status.getLen()
        below = uri.getPath()[len(top) :] or uri.getPath().rpartition("/")[2]
        if size and not any(map(_hidden, below.split("/"))):
            continue
        rows.append((uri.toString(), uri.getPath(), status.getModificationTime(), size))
    if not rows:
        return []
    return [spark.createDataFrame(rows, "file_path STRING, plain STRING, ms BIGINT, file_size BIGINT")]


def _read_others(found: DataFrame) -> DataFrame:
    """Their contents, read in batches by the tasks."""
    read = found.mapInPandas(
        _read_batches, "value STRING, file_path STRING, ms BIGINT, file_size BIGINT"
    )
    return read.select(
        "value", "file_path", F.timestamp_millis("ms").alias("file_modification_time"), "file_size"
    )


def _read_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def content(uri: str, plain: str, size: int) -> str:
        if not size:
            return ""
        store, path = _store(uri, plain)
        with store.open_input_stream(path) as stream:
            return stream.read().decode("utf-8", "replace")

    for frame in frames:
        texts = [content(*row) for row in zip(frame["file_path"], frame["plain"], frame["file_size"], strict=True)]
        yield frame.drop(columns="plain").assign(value=texts)[["value", "file_path", "ms", "file_size"]]


def _listed_by_spark(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """Spark's reader of whole files; it lists the folders in a few tasks per core at most."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, min(int(before), 4 * spark.sparkContext.defaultParallelism))
    try:
        return spark.read.text(roots, wholetext=True, recursiveFileLookup=True)
    finally:
        spark.conf.set(LISTING, before)


def scan_tree(
    spark: SparkSession, roots: Sequence[str] | str, extensions: Sequence[str] | None = None
) -> DataFrame:
    """(doc_id, path, modified, size_kb, source_file, partition, text).

    Reads every file below one or more roots as UTF-8.  The key ``doc_id`` is
    the path.  With ``extensions`` a file is kept if its path has no dot or
    ends, from the last dot of the whole path on, in a listed extension (such
    as ``.txt``, case-sensitive); a root that is itself a file is always kept.
    Unlisted files are dropped before they are opened.  Files that Spark's readers
    pass over (of zero bytes, or below a name that begins with ``_`` or ``.``) are
    found by tasks, folder level by folder level, and read in batches.  The two provenance columns
    stand for the host and thread that read the file.
    """
    roots = [roots] if isinstance(roots, str) else list(roots)
    files = _listed_by_spark(spark, roots).select(
        "value", "_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size"
    )
    path = plain_path(F.col("file_path"))
    wanted = F.lit(True)
    if extensions is not None:
        single = [r.removeprefix("file://").removeprefix("file:") for r in roots]
        wanted = analysis.has_extension(path, extensions) | path.isin(single)
        files = files.filter(wanted)
    others = _passed_over(spark, roots)
    if others is not None:
        files = files.unionByName(_read_others(others.filter(wanted)))
    return files.select(
        path.alias("doc_id"),
        path.alias("path"),
        F.unix_millis("file_modification_time").alias("modified"),
        analysis.size_kb(F.col("file_size")).alias("size_kb"),
        F.col("file_path").alias("source_file"),
        F.spark_partition_id().alias("partition"),
        F.col("value").alias("text"),
    )


# The characters that Spark's writers escape in the name of a folder.
IN_FOLDERS = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]")
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder_name(key: str, value: str | None) -> str:
    """The folder that Spark's writers give to a value of a column."""
    plain = lambda text: IN_FOLDERS.sub(lambda m: f"%{ord(m[0]):02X}", text)
    return f"{plain(key)}={plain(value) if value else NO_VALUE}"


def _write_task(uri: str, plain: str, key: str):
    """Writes the texts of each key into the key's file; rows come sorted by key.

    A task that runs again writes the same names.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _store(uri, plain)
        last, stream, n = None, None, 0
        for frame in frames:
            for value, text in frame.itertuples(index=False):
                folder = f"{top.rstrip('/')}/{_folder_name(key, value)}"
                if folder != last:
                    if stream is not None:
                        stream.close()
                    store.create_dir(folder, recursive=True)
                    last, stream = folder, store.open_output_stream(f"{folder}/part-0.txt")
                    n += 1
                stream.write((text or "").encode() + b"\n")
        if stream is not None:
            stream.close()
        yield pd.DataFrame({"n": [n]})

    return work


def write_tree(
    docs: DataFrame, root: str, key: str = "doc_id", text: str = "text", tasks: int | None = None
) -> None:
    """Writes one text file per document, below a folder named after its key.

    Tasks write the files in place.  Spark's committer would move each of them, and its
    folder, once more on the driver, one after the other; it serves stores that tasks cannot
    write by themselves.  The marker file comes last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key), F.col(text))
    tasks = tasks or spark.sparkContext.defaultParallelism
    dealt = rows.repartition(tasks, key)
    store, path = _qualified(spark, root)
    if path.toUri().getScheme() not in TASK_SCHEMES:
        dealt.write.partitionBy(key).text(root)
        return
    if store.exists(path):
        raise FileExistsError(f"{root} exists")
    name = F.nullif(F.col(key).cast("string"), F.lit(""))
    named = dealt.select(name.alias("name"), F.col(text).cast("string").alias("text")).sortWithinPartitions("name")
    work = _write_task(path.toUri().toString(), path.toUri().getPath(), key)
    named.mapInPandas(work, "n BIGINT").agg(F.sum("n")).collect()
    store.create(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")).close()
