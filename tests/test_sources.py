import os
import random
from pathlib import Path

import pytest
from conftest import rows

from rankspark.operators import index as ix
from rankspark.session import fresh_folder
from rankspark.sources import files, records


@pytest.fixture
def tree(tmp_path):
    texts = {
        "one/a.d/noext": "dot in the folder",
        "one/x/f.sgm": "l1\r\nl2\r\nl3\r\nl4\r\nl5\r\nl6\r\n",
        "one/b.TXT": "upper case extension",
        "one/same.txt": "first root",
        "one/with space+plus%.txt": "odd name",
        "two/same.txt": "second root",
        "two/empty.txt": "",
        "two/deep/er/five.txt": "1\n2\n3\n4\n5",
    }
    for name, text in texts.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    os.utime(tmp_path / "one/same.txt", ns=(10**18, 10**18))
    return tmp_path, texts


def test_scan_tree(spark, tree):
    root, texts = tree
    got = files.scan_tree(spark, [f"{root}/one", f"{root}/two"]).collect()
    by_path = {os.path.relpath(r.path, root): r for r in got}
    assert set(by_path) == set(texts)
    for name, r in by_path.items():
        assert r.text == texts[name]
        assert r.size_kb == len(texts[name].encode()) / 1000
    assert by_path["one/same.txt"].modified == 10**12


def test_extensions_and_single_file_roots(spark, tree):
    root, _ = tree
    names = lambda df: sorted(os.path.relpath(r.path, root) for r in df.collect())
    kept = names(files.scan_tree(spark, f"{root}/one", [".txt", ".sgm"]))
    assert kept == ["one/same.txt", "one/with space+plus%.txt", "one/x/f.sgm"]
    single = files.scan_tree(spark, [f"{root}/one/b.TXT", f"{root}/two"], [".sgm"])
    assert names(single) == ["one/b.TXT"]


def test_tree_is_indexed_by_path(spark, tree):
    root, _ = tree
    docs = files.scan_tree(spark, [f"{root}/one", f"{root}/two"])
    index = ix.write_index(docs, fresh_folder(spark, "tree"), fields=ix.FIELDS, buckets=3)
    six = index.docs.filter(index.docs.path.endswith("f.sgm")).first()
    assert (six.top5_lines, six.bottom5_lines) == ("l1\nl2\nl3\nl4\nl5\n", "l2\nl3\nl4\nl5\nl6\n")
    assert {r.doc_id.split("/")[-2] for r in ix.postings_of(index, "root").collect()} == {"one", "two"}


def test_unlisted_files_are_not_opened(spark, tree):
    root, _ = tree
    df = files.scan_tree(spark, f"{root}/one", [".sgm"])
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numFiles").get().value() == 1


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_documents_file(spark, tmp_path):
    text = "1\nalpha beta\ngamma\n   /\n2\nbeta delta\n   /\n3\n   /\nx\nno number\n   /\n4\na\n\n   /\n"
    path = write(tmp_path, "doc-text", text)
    got = rows(records.scan_documents(spark, path, id_type="string").orderBy("doc_id"))
    assert got == [("1", "alpha beta gamma "), ("2", "beta delta "), ("3", ""), ("4", "a  "), ("x", "no number ")]
    whole = write(tmp_path, "numbers", text.replace("x\n", "5\n"))
    assert rows(records.scan_documents(spark, whole).orderBy("doc_id"))[-1] == (5, "no number ")


def test_last_separator_without_line_end_and_crlf(spark, tmp_path):
    open_end = write(tmp_path, "open", "1\na\n   /\n2\nb\n   /")
    assert rows(records.scan_documents(spark, open_end).orderBy("doc_id")) == [(1, "a "), (2, "b ")]
    dos = write(tmp_path, "dos", "1\r\na\r\nb\r\n   /\r\n2\r\nc\r\n   /\r\n")
    got = records.scan_documents(spark, dos, newline="\r\n").orderBy("doc_id")
    assert rows(got) == [(1, "a b "), (2, "c ")]


def test_topics_file(spark, tmp_path):
    path = write(tmp_path, "query-text", "1\nALPHA NOT\n/\n2\nDELTA or\nmore\n/\n")
    got = records.scan_topics(spark, path).orderBy("topic_id")
    assert rows(got) == [(1, "ALPHA NOT "), (2, "DELTA or more ")]


def test_judgements_file(spark, tmp_path):
    path = write(tmp_path, "rlv-ass", "1\n  1 2\n  3 x4\n   /\n2\n 2 2\n   /\n3\n   /\n")
    got = records.scan_qrels(spark, path).orderBy("topic_id", "doc_id")
    assert rows(got) == [(1, 1), (1, 2), (1, 3), (2, 2)]


def test_a_split_file_gives_whole_records(spark, tmp_path):
    text = "".join(f"{i}\nword{i} tail\n   /\n" for i in range(2000))
    path = write(tmp_path, "big", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = records.scan_documents(spark, path)
        assert got.rdd.getNumPartitions() > 4
        assert sorted(rows(got)) == sorted((i, f"word{i} tail ") for i in range(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_scan_tree_reads_every_file(spark, tmp_path):
    (tmp_path / "ok").mkdir()
    (tmp_path / "_sub").mkdir()
    (tmp_path / ".hid").mkdir()
    texts = {"a.txt": "a", "_u.txt": "ü\n", "_sub/y.txt": "y", ".h.txt": "h", ".hid/z.txt": "z", "empty.txt": "", "ok/b.txt": "b"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    got = {r.path.removeprefix(f"{tmp_path}/"): r for r in files.scan_tree(spark, str(tmp_path)).collect()}
    assert {k: r.text for k, r in got.items()} == texts
    assert got["empty.txt"].size_kb == 0 and all(r.modified > 0 for r in got.values())
    assert {r.path for r in files.scan_tree(spark, str(tmp_path), [".md"]).collect()} == set()


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
def test_records_take_every_line_end_and_id(spark, tmp_path, newline):
    text = newline.join(["A-1", "alpha beta", "   /", "2", "gamma", "", "delta", "   /", ""])
    path = write(tmp_path, "any-end", text)
    got = rows(records.scan_documents(spark, path, id_type="string").orderBy("doc_id"))
    assert got == [("2", "gamma  delta "), ("A-1", "alpha beta ")]
    with pytest.raises(Exception, match="not a bigint: A-1"):
        records.scan_documents(spark, path).collect()


def test_a_folder_may_mix_line_ends(spark, tmp_path):
    """Every file its own, or several in one file; no record is lost."""
    (tmp_path / "mix").mkdir()
    for i, newline in enumerate(("\n", "\r\n", "\r")):
        lines = [str(i), "alpha", "   /", str(10 + i), "beta", "", "   /", str(20 + i), "   /"]
        (tmp_path / f"mix/{i}.txt").write_bytes(newline.join([*lines, ""]).encode())
    both = "30\ngamma\r\n   /\r\n31\rdelta\r   /\n32\nx   /\n   / y\n    /\n   /"
    (tmp_path / "mix/both").write_bytes(both.encode())
    got = sorted(rows(records.scan_documents(spark, f"{tmp_path}/mix")))
    want = [(i, "alpha ") for i in range(3)] + [(10 + i, "beta  ") for i in range(3)] + [(20 + i, "") for i in range(3)]
    assert got == sorted([*want, (30, "gamma "), (31, "delta "), (32, "x   /    / y     / ")])


@pytest.mark.parametrize("newline", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("end", [records.DOCUMENT_END, records.TOPIC_END])
def test_false_separators_at_any_split_edge(spark, tmp_path, newline, end):
    """Splits of few bytes, records of many: every edge falls somewhere else."""
    rng = random.Random(len(newline) + len(end))
    bits = ["a", "b" * 7, end, f"x{end}", f"{end} y", "", f" {end}", f"{end}{end}"]
    made = []
    for i in range(400):
        body = [rng.choice(bits) + "." for _ in range(rng.randint(0, 6))]
        made.append((str(i), body))
    # a record longer than several splits
    made.insert(200, ("long", [f"{end}z"] * 400))
    text = "".join(newline.join([key, *body, end, ""]) for key, body in made)
    path = tmp_path / "edges"
    path.write_bytes((f"{end}{newline}" + text).encode())
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = records.scan_records(spark, str(path), end)
        assert sorted((r.id, r.lines) for r in got.collect()) == sorted(made)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tasks_list_what_the_driver_would(spark, tmp_path):
    """Passed-over files at any depth, under names that a URI escapes, below roots of both kinds."""
    names = [
        "plain.txt", "empty.txt", ".dot", "_under/deep/er/x.txt", "a b/c%20d#e?.txt", "a b/.h [1].txt",
        "k=v/_m=n/kept.txt", "umlaut \u00e4/\u00e4+{1}.txt", "umlaut \u00e4/_\u00e4+{1}.txt", "x/y/z/w/empty",
    ]
    for name in names:
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("" if "empty" in name else name, encoding="utf-8")
    (tmp_path / "tree" / ".plain.txt.crc").write_text("sum")
    (tmp_path / "tree" / "nothing").mkdir()
    (tmp_path / "_single").write_text("one file")
    roots = [str(tmp_path / "tree"), f"file://{tmp_path}/_single"]
    columns = ["file_path", "plain", "file_size"]
    ours = files._passed_over(spark, roots).select(columns).collect()
    theirs = [r for root in roots for part in files._listed_by_driver(spark, root) for r in part.select(columns).collect()]
    assert sorted(ours) == sorted(theirs) and len(ours) == 7
    texts = {r.doc_id: r.text for r in files.scan_tree(spark, roots).collect()}
    want = {f"{tmp_path}/tree/{n}": "" if "empty" in n else n for n in names} | {f"{tmp_path}/_single": "one file"}
    assert texts == want


def test_no_file_is_listed_by_the_driver(spark, tmp_path, monkeypatch):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.txt").write_text("a")
    monkeypatch.setattr(files, "_listed_by_driver", None)
    assert [r.text for r in files.scan_tree(spark, str(tmp_path)).collect()] == ["a"]


def _tree_files(root):
    top = Path(root.removeprefix("file:"))
    return {str(p.parent.relative_to(top)): p.read_bytes() for p in top.rglob("part-*")}


def test_a_tree_is_written_as_spark_writes_it(spark):
    """Odd keys, null and repeated ones, null texts; the same folders and contents."""
    data = [("a/b", "x"), ("50% {odd}", "é\nz"), ("k", "one"), ("k", "one"), (None, "n"), ("t", None), ("é ü", "")]
    docs = spark.createDataFrame(data, "doc_id STRING, text STRING")
    ours, theirs = fresh_folder(spark, "ours"), fresh_folder(spark, "theirs")
    files.write_tree(docs, ours, tasks=3)
    docs.repartition(3, "doc_id").write.partitionBy("doc_id").text(theirs)
    assert _tree_files(ours) == _tree_files(theirs)
    with pytest.raises(FileExistsError):
        files.write_tree(docs, ours)


def test_a_tree_of_many_folders_is_listed_in_few_tasks(spark):
    """Spark's reader alone starts a task for each folder."""
    root = fresh_folder(spark, "folders")
    files.write_tree(spark.range(150).selectExpr("id AS doc_id", "'text' AS text"), root)
    spark.sparkContext.setJobGroup("list-tree", "list-tree")
    try:
        scanned = files.scan_tree(spark, root)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = {s for j in status.getJobIdsForGroup("list-tree") for s in status.getJobInfo(j).stageIds}
    assert 0 < max(status.getStageInfo(s).numTasks for s in stages) < 50
    assert scanned.filter("path LIKE '%/doc_id=%'").count() == 150
