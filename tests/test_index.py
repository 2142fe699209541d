import os

import pytest
from conftest import MICRO, rows
from pyspark.sql import functions as F

from rankspark.functions.scoring import Model
from rankspark.operators import index as ix
from rankspark.operators import retrieve, similar
from rankspark.operators import weights as wt
from rankspark.session import fresh_folder

DOC = "doc_id BIGINT, text STRING"


def stats(index):
    return sorted(rows(index.term_stats))


def contents(index):
    return {r.doc_id: r.contents for r in index.docs.collect()}


def test_create_replaces(spark):
    path = fresh_folder(spark, "create")
    ix.write_index(spark.createDataFrame(MICRO, DOC), path, buckets=2)
    index = ix.write_index(spark.createDataFrame([(9, "new")], DOC), path, buckets=2)
    assert contents(index) == {9: "new\n"}
    assert contents(ix.open_index(spark, path)) == {9: "new\n"}


def test_append_needs_an_index(spark):
    path = fresh_folder(spark, "append")
    docs = spark.createDataFrame(MICRO, DOC)
    with pytest.raises(FileNotFoundError):
        ix.write_index(docs, path, mode="append")
    with pytest.raises(FileNotFoundError):
        ix.open_index(spark, path)
    with pytest.raises(ValueError):
        ix.write_index(docs, path, mode="upsert")
    assert len(contents(ix.write_index(docs, path, mode="create_or_append", buckets=2))) == 4


def test_upsert_equals_a_fresh_index_and_is_idempotent(spark):
    path = fresh_folder(spark, "upsert")
    ix.write_index(spark.createDataFrame(MICRO, DOC), path, buckets=2, positions=True)
    batch = spark.createDataFrame(
        [(2, "older copy", 1), (2, "banana split", 2), (5, "elder apple", 1)],
        DOC + ", seq INT",
    )
    want = ix.build_index(
        ix.describe(
            spark.createDataFrame(
                [MICRO[0], (2, "banana split"), MICRO[2], MICRO[3], (5, "elder apple")], DOC
            )
        ),
        positions=True,
    )
    for _ in range(2):
        index = ix.write_index(batch, path, mode="append", order_by="seq")
        assert stats(index) == stats(want)
        columns = want.postings.columns
        assert sorted(rows(index.postings.select(columns))) == sorted(rows(want.postings))
        assert sorted(rows(index.field_stats)) == sorted(rows(want.field_stats))


def test_merged_parts_equal_one_pass(spark):
    docs = ix.describe(spark.createDataFrame(MICRO, DOC))
    parts = [ix.build_index(docs.filter(F.col("doc_id") % 2 == i), ix.FIELDS) for i in (0, 1)]
    merged, whole = ix.merge_indexes(parts), ix.build_index(docs, ix.FIELDS)
    for name in ("postings", "doc_stats", "term_stats", "field_stats"):
        # a merge numbers the copies of a key part by part
        left, right = getattr(merged, name), getattr(whole, name).drop("copy_no")
        assert sorted(rows(left.select(right.columns))) == sorted(rows(right)), name


def test_written_parts_are_merged_and_written(spark):
    docs = spark.createDataFrame(MICRO, DOC)
    halves = [docs.filter("doc_id < 3"), docs.filter("doc_id > 2")]
    parts = [ix.write_index(h, fresh_folder(spark, "part"), buckets=2) for h in halves]
    target = fresh_folder(spark, "merged")
    ix.write_index(spark.createDataFrame([(9, "old")], DOC), target, buckets=2)
    merged, whole = ix.write_merged(parts, target, buckets=2), ix.build_index(ix.describe(docs))
    for name in ("postings", "doc_stats", "term_stats", "field_stats"):
        # a merge numbers the copies of a key part by part
        left, right = getattr(merged, name), getattr(whole, name).drop("copy_no")
        assert sorted(rows(left.select(right.columns))) == sorted(rows(right)), name


def test_equal_keys_are_not_merged(spark):
    docs = ix.describe(spark.createDataFrame([(1, "a b")], DOC))
    parts = [ix.build_index(docs), ix.build_index(docs)]
    for merged in (ix.merge_indexes(parts), ix.write_merged(parts, fresh_folder(spark, "twice"), buckets=2)):
        field = merged.field_stats.first()
        assert (field.n_docs, field.sum_cf, field.n_terms) == (2, 4, 2)
        assert sorted(rows(merged.doc_stats.select("doc_id", "doc_len"))) == [(1, 2), (1, 2)]


def test_empty_documents_count(spark):
    docs = ix.describe(spark.createDataFrame([(1, "a"), (2, ""), (3, " ... ")], DOC))
    field = ix.build_index(docs).field_stats.first()
    assert (field.n_docs, field.n_docs_with_field) == (3, 1)


def test_positions(spark):
    docs = ix.describe(spark.createDataFrame(MICRO, DOC))
    got = ix.build_postings(docs, positions=True).filter("doc_id = 2")
    assert {r.term: r.positions for r in got.collect()} == {"banana": [0, 2], "cherry": [1]}


def test_lookups(spark, micro):
    assert sorted(rows(ix.term_vector(micro, 1))) == [("apple", 2), ("banana", 1), ("cherry", 1)]
    assert sorted(rows(ix.postings_of(micro, "date"))) == [(3, 1), (4, 2)]
    assert rows(ix.postings_of(micro, "absent")) == []
    assert [r.term for r in ix.vocabulary(micro).collect()] == [
        "apple", "banana", "cherry", "date", "elder",
    ]
    keys = spark.createDataFrame([(3,), (99,)], "doc_id BIGINT")
    assert sorted(rows(ix.term_vectors(micro, keys))) == [(3, "apple", 1), (3, "date", 1)]


def test_open_without_the_session_table(spark, micro):
    """Another session knows nothing of the tables; opening declares them again."""
    path = fresh_folder(spark, "reopen")
    index = ix.write_index(spark.createDataFrame(MICRO, DOC), path, buckets=2)
    before = stats(index)
    for part in ("docs", "postings", "doc_stats"):
        spark.sql(f"DROP TABLE {ix._table_name(path, 0, part)}")
    again = ix.open_index(spark, path)
    assert stats(again) == before
    assert contents(again) == {i: text + "\n" for i, text in MICRO}
    for name in ("postings", "docs"):
        plan = getattr(again, name).groupBy("doc_id").count()._jdf.queryExecution().toString()
        assert "Bucketed: true" in plan and "Exchange hashpartitioning" not in plan


def hits(spark, index, word, model=None):
    topics = spark.createDataFrame([(1, word)], "topic_id BIGINT, text STRING")
    run = retrieve.search(index, retrieve.topic_terms(topics), model or Model("tfidf"), 10)
    return [(r.doc_id, r.score, r["rank"]) for r in run.orderBy("rank").collect()]


def test_repeated_keys_are_documents_of_their_own(spark):
    """Two rows with one key are two hits with the scores they would have alone."""
    docs = spark.createDataFrame([(1, "a b"), (1, "a b c a"), (2, "a a"), (1, "a b")], DOC)
    alone = spark.createDataFrame([(1, "a b"), (3, "a b c a"), (2, "a a"), (4, "a b")], DOC)
    index = ix.write_index(docs, fresh_folder(spark, "twice"), buckets=2, fields=ix.FIELDS)
    single = ix.write_index(alone, fresh_folder(spark, "once"), buckets=2, fields=ix.FIELDS)
    renamed = lambda found: sorted((1 if d in (3, 4) else d, s) for d, s, _ in found)
    assert renamed(hits(spark, index, "a c")) == renamed(hits(spark, single, "a c"))
    assert [r for *_, r in hits(spark, index, "a c")] == [1, 2, 3, 4]
    assert stats(index) == stats(single)
    assert sorted(rows(index.field_stats)) == sorted(rows(single.field_stats))
    assert sorted(r.copy_no for r in index.docs.filter("doc_id = 1").collect()) == [0, 1, 2]
    # the rows of a key are kept apart wherever documents are grouped or joined
    assert wt.best_terms(index).filter("field = 'contents'").count() == 2 + 3 + 1 + 2
    run = spark.createDataFrame([(1, 1, 1, 5.0, 1)], "topic_id BIGINT, doc_id BIGINT, copy_no BIGINT, score DOUBLE, rank INT")
    assert retrieve.stored_fields(run, index.docs, ["contents"]).count() == 1
    terms = spark.createDataFrame([("c",)], "term STRING")
    near = similar.similar_terms(index, terms, "tf", k=2).orderBy("rank").collect()
    assert [r.term for r in near] == ["a", "b"] and near[0].similarity == pytest.approx(2 / 10**0.5, abs=1e-9)
    assert similar.similar_docs(index, spark.createDataFrame([(1,)], "doc_id BIGINT"), "tf").count() == 3 * 3
    updated = ix.write_index(spark.createDataFrame([(1, "new")], DOC), index_path(index), mode="append")
    assert contents(updated) == {1: "new\n", 2: "a a\n"} and [d for d, *_ in hits(spark, updated, "a new")] == [1, 2]


def index_path(index):
    return index.manifest.segments[0].folder.rpartition("/v")[0]


def test_repeated_keys_of_merged_parts_stay_apart(spark):
    make = lambda text: ix.write_index(spark.createDataFrame([(1, text), (2, "x")], DOC), fresh_folder(spark, "part"), buckets=2)
    merged = ix.write_merged([make("a b"), make("a b a")], fresh_folder(spark, "merged"))
    path = fresh_folder(spark, "merged")
    again = ix.write_merged([merged, make("a")], path)
    compacted = ix.compact_index(spark, path)
    # copies of a compacted index still stay apart from those of further parts
    more = ix.write_merged([make("a a a"), compacted, merged], fresh_folder(spark, "merged"))
    for index, n in ((merged, 2), (again, 3), (compacted, 3), (more, 6)):
        assert len(hits(spark, index, "a")) == n and index.docs.select(*ix.IDENTITY).distinct().count() == 2 * n
    whole = spark.createDataFrame([(1, "a b"), (2, "a b a"), (3, "a"), (4, "x"), (5, "x"), (6, "x")], DOC)
    single = ix.write_index(whole, fresh_folder(spark, "once"), buckets=2)
    for index in (again, compacted):
        assert sorted(s for _, s, _ in hits(spark, index, "a")) == sorted(s for _, s, _ in hits(spark, single, "a"))


def test_a_merge_copies_nothing_and_refuses_other_settings(spark):
    docs = spark.createDataFrame(MICRO, DOC)
    one = ix.write_index(docs.filter("doc_id < 3"), fresh_folder(spark, "part"), buckets=2, stopwords=["apple"])
    two = ix.write_index(docs.filter("doc_id > 2"), fresh_folder(spark, "part"), buckets=2, stopwords=["apple"])
    path = fresh_folder(spark, "merged")
    merged = ix.write_merged([one, two], path)
    assert sorted(os.listdir(f"{path.removeprefix('file:')}/v0")) == ["field_stats", "term_stats"]
    assert {s.folder for s in merged.manifest.segments} == {s.folder for p in (one, two) for s in p.manifest.segments}
    # an update of the merge analyses like its parts, and leaves them alone
    updated = ix.write_index(spark.createDataFrame([(3, "apple pie")], DOC), path, mode="append")
    assert {r.term for r in updated.postings.filter("doc_id = 3").collect()} == {"pie"}
    assert contents(ix.open_index(spark, index_path(two)))[3] == "date apple\n"
    other = ix.write_index(docs, fresh_folder(spark, "part"), buckets=2)
    with pytest.raises(ValueError, match="different fields"):
        ix.write_merged([one, other], fresh_folder(spark, "merged"))


def everything(index):
    tables = ("docs", "postings", "doc_stats", "term_stats", "field_stats")
    return {t: sorted(rows(getattr(index, t).drop("copy_no")), key=repr) for t in tables}


def test_many_updates_equal_a_fresh_index_and_compaction_changes_nothing(spark):
    path, live = fresh_folder(spark, "updates"), dict(MICRO)
    ix.write_index(spark.createDataFrame(MICRO, DOC), path, buckets=2)
    batches = [
        [(2, "banana split"), (7, "")],
        [(1, ""), (7, "fig fig"), (8, "grape")],  # words die out
        [(1, "apple grape"), (2, "date"), (9, "fig")],  # and come up again
    ]
    for batch in batches:
        live |= dict(batch)
        index = ix.write_index(spark.createDataFrame(batch, DOC), path, mode="append")
        fresh = ix.write_index(
            spark.createDataFrame(sorted(live.items()), DOC), fresh_folder(spark, "fresh"), buckets=2
        )
        assert everything(index) == everything(fresh)
        # bounds hold for what is live
        wide = {(r.field, r.term): r for r in index.term_bounds.collect()}
        for r in fresh.term_bounds.collect():
            w = wide[r.field, r.term]
            assert w.max_tf >= r.max_tf and w.max_rate >= r.max_rate and w.min_len <= r.min_len
    assert len(index.manifest.segments) == 4
    compacted = ix.compact_index(spark, path)
    assert len(compacted.manifest.segments) == 1 and everything(compacted) == everything(fresh)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_an_update_reads_no_old_posting_and_readers_move_none(spark, monkeypatch):
    path = fresh_folder(spark, "delta")
    ix.write_index(spark.createDataFrame([(i, f"word{i} common") for i in range(300)], DOC), path, buckets=3)
    read = []
    table = ix._table
    monkeypatch.setattr(ix, "_table", lambda s, folder, part, *rest: read.append((folder[-2:], part)) or table(s, folder, part, *rest))
    index = ix.write_index(spark.createDataFrame([(5, "changed common")], DOC), path, mode="append")
    written = spark.read.parquet(f"{path}/v1/postings")
    assert written.count() == 2 and spark.read.parquet(f"{path}/v1/hidden").count() == 1
    # grouping by document finds its rows in place, few withdrawn keys or many
    for limit in (ix.BROADCAST_ROWS, -1):
        monkeypatch.setattr(ix, "BROADCAST_ROWS", limit)
        again = ix.open_index(spark, path)
        grouped = again.postings.groupBy(*ix.IDENTITY).count()
        assert exchanges(grouped) == 0 and grouped.count() == 300
        assert rows(ix.postings_of(again, "word5")) == []
    assert index.term_stats.filter("term = 'common'").first().df == 300


def test_update_takes_new_buckets_and_breaks_ties(spark):
    path = fresh_folder(spark, "rebucket")
    ix.write_index(spark.createDataFrame(MICRO, DOC), path, buckets=1)
    batch = spark.createDataFrame([(2, "copy a", 1), (2, "copy b", 1)], DOC + ", seq INT")
    index = ix.write_index(batch, path, mode="append", order_by="seq", buckets=3)
    assert contents(index)[2] == "copy b\n"
    assert ix._manifest(spark, path)[0].buckets == 3
    assert {r.term for r in index.postings.filter("doc_id = 2").collect()} == {"copy", "b"}


def test_buckets_go_by_the_text(spark):
    docs = spark.createDataFrame(MICRO, DOC)
    twice = docs.join(docs.select("doc_id", F.lit(1).alias("x")), "doc_id")
    assert ix.default_buckets(twice) == ix.default_buckets(docs)


def test_a_bucket_does_not_grow_with_the_texts(spark):
    """A task works on one bucket, so its memory follows the bucket's text."""
    docs = spark.range(48).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 1 << 18).alias("text"))
    n_bytes = 48 * 5 * (1 << 18)
    assert n_bytes / ix.default_buckets(docs) <= 8 << 20
    assert ix.default_buckets(docs.withColumn("text", F.lit("x"))) == spark.sparkContext.defaultParallelism


def scanned_rows(df):
    """Rows that the scan of a table gave."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_a_lookup_of_an_absent_keyword_reads_no_row_group(spark):
    """Also where the value lies between the least and the largest of the column."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('dir/', id * 2, '-', repeat('x', 40)) AS path", "'a b' AS text")
    index = ix.write_index(docs, fresh_folder(spark, "bloom"), buckets=2)
    value = "dir/{}-" + "x" * 40
    present = ix.keyword_filter(index.docs, "path", value.format(2468)).select("doc_id")
    absent = ix.keyword_filter(index.docs, "path", value.format(2469)).select("doc_id")
    assert [r.doc_id for r in present.collect()] == [1234] and absent.collect() == []
    assert scanned_rows(absent) == 0
    # the row groups of the other bucket are passed over as well
    assert 0 < scanned_rows(present) < 20_000


def test_postings_of_a_table_are_counted_in_tasks_of_a_buckets_text(spark, monkeypatch):
    """Spark would put 64 MB of a shuffle into one task, whose counts do not fit."""
    monkeypatch.setattr(ix, "BUCKET_BYTES", 8)
    docs = spark.createDataFrame([(i, "apple pie") for i in range(20)], "doc_id BIGINT, contents STRING")
    built = ix.build_postings(docs)
    assert "hashpartitioning(doc_id" in built._jdf.queryExecution().toString()
    assert "), REPARTITION_BY_NUM" in built._jdf.queryExecution().toString()
    assert sorted(rows(built)) == sorted(("contents", w, i, 1, 2) for i in range(20) for w in ("apple", "pie"))
