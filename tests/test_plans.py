"""Shapes that have to hold for plans to scale, and the ways past the size checks."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankspark import session
from rankspark.functions import exact
from rankspark.functions.scoring import Model
from rankspark.operators import feedback, retrieve, similar, tuning
from rankspark.operators import index as ix
from rankspark.operators import weights as wt
from rankspark.plans import corpus
from rankspark.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
JM = Model("jm", 0.5)


@pytest.fixture(scope="module")
def c(spark):
    return corpus.collection(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_moves_no_postings(c):
    text = plan(retrieve.search(c.index, c.terms, JM, 10))
    assert text.count("Exchange hashpartitioning") == 1  # the m best per task, by topic
    assert "WindowGroupLimit" in text
    assert "Bucketed: true" in text
    assert "PushedFilters: [IsNotNull(field), EqualTo(field,contents)" in text
    assert "positions" not in text and "SortMergeJoin" not in text


def test_document_lookups_read_their_buckets_only(spark, c):
    # files outside the bucket are left out either way; only this setting prints it
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of" in plan(ix.term_vector(c.index, 7))
        keys = spark.createDataFrame([(7,)], "doc_id BIGINT")
        assert "SelectedBucketsCount: 1 out of" in plan(ix.term_vectors(c.index, keys))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_term_lookup_is_pushed_down(c):
    text = plan(ix.postings_of(c.index, "the"))
    assert "EqualTo(term,the)" in text and "positions" not in text


def test_similar_terms_meet_on_the_bucket_key(c):
    rows_ = c.index.postings.filter("field = 'contents'").select("doc_id", "term", "tf")
    own = rows_.filter("term = 'the'").select(F.col("term").alias("seed"), "doc_id")
    text = plan(own.hint("merge").join(rows_, "doc_id"))
    assert "Exchange" not in text


HOT_PATHS = (
    "tokenize", "token_positions", "postings", "weights", "l1_normalize", "best_terms_text",
    "similar_docs_tf", "similar_terms_tfxidf", "search_weighted", "top_m", "total_hits",
    "run_listing", "recall_at_n", "feedback_search", "tune_jm", "wilcoxon_exact",
)


@pytest.mark.parametrize("name", HOT_PATHS)
def test_no_python_rows_and_no_cross_join(spark, name):
    text = plan(REGISTRY[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def both_ways(monkeypatch, make, **settings):
    """The result as usual, and with every size check failing."""
    usual = sorted(rows(make()), key=repr)
    monkeypatch.setattr(session, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(session, "fits", lambda df, max_rows=0: False)
    for module in (ix, retrieve, similar, feedback, tuning):
        if hasattr(module, "fits"):
            monkeypatch.setattr(module, "fits", lambda df, max_rows=0: False)
    for name, value in settings.items():
        monkeypatch.setattr(ix, name, value)
    assert sorted(rows(make()), key=repr) == usual
    assert usual


def test_search_beyond_the_broadcast_size(c, monkeypatch):
    both_ways(monkeypatch, lambda: retrieve.search(c.index, c.terms, JM, 10), HEAVY_TERMS=50)


def test_tuning_beyond_the_broadcast_size(c, monkeypatch):
    models = tuning.grid("jm")[:2]
    both_ways(monkeypatch, lambda: tuning.settings_runs(c.index, c.terms, models, 5))


def test_similar_docs_beyond_the_broadcast_size(spark, c, monkeypatch):
    seeds = spark.createDataFrame([(3,), (8,)], "doc_id BIGINT")
    both_ways(
        monkeypatch, lambda: similar.similar_docs(c.index, seeds, "tfxidf"), POINT_KEYS=0
    )


def test_similar_terms_beyond_the_broadcast_size(spark, c, monkeypatch):
    seeds = spark.createDataFrame([("the",), ("of",)], "term STRING")
    both_ways(monkeypatch, lambda: similar.similar_terms(c.index, seeds, "tf"), HEAVY_TERMS=50)


def test_best_terms_do_not_depend_on_the_heavy_split(c, monkeypatch):
    usual = sorted(rows(wt.best_terms(c.index)))
    for heavy in (1, 100, 10**9):
        monkeypatch.setattr(ix, "HEAVY_TERMS", heavy)
        assert sorted(rows(wt.best_terms(c.index))) == usual


def test_scores_do_not_depend_on_the_layout(spark, c):
    """One bucket or many, the sums are the same to the last digit."""
    docs = corpus.raw_documents(spark, SF)
    one = ix.write_index(docs, session.fresh_folder(spark, "one"), buckets=1)
    a = rows(retrieve.search(one, c.terms, JM, 50))
    assert sorted(a) == sorted(rows(retrieve.search(c.index, c.terms, JM, 50)))


def short_topics(c, spark, words=3):
    """Topics of their rarest words and a common one."""
    stats = c.index.term_stats.filter("field = 'contents'").select("term", "df")
    order = Window.partitionBy("topic_id").orderBy("df", "term")
    placed = c.terms.join(stats, "term").withColumn("r", F.row_number().over(order))
    last = F.max("r").over(Window.partitionBy("topic_id"))
    return session.keep(placed.withColumn("n", last).filter(f"r < {words} OR r = n").select("topic_id", "term", "weight"), "t")


@pytest.mark.parametrize(
    ("model", "m"), [(JM, 1), (JM, 10), (JM, 500), (Model("tfidf"), 10), (Model("dir", 100.0), 10), (Model("dir", 0.0), 10)]
)
def test_pruned_search_gives_the_same_run(spark, c, model, m):
    for terms in (c.terms, short_topics(c, spark)):
        pruned = retrieve.search(c.index, terms, model, m, prune=True)
        assert sorted(rows(pruned)) == sorted(rows(retrieve.search(c.index, terms, model, m, prune=False)))


def test_pruned_search_breaks_ties_alike(spark):
    """Many documents with one score, and scores that differ by less than rounding shows."""
    docs = [(i, "rare common") for i in range(40, 0, -1)] + [(100 + i, "common " * (i % 3 + 1)) for i in range(60)]
    index = ix.write_index(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), session.fresh_folder(spark, "ties"), buckets=2)
    for weight in (1.0, 1e-10, -1.0):
        terms = spark.createDataFrame([(1, "rare", 1.0), (1, "common", weight), (2, "common", 1.0), (2, "no", 1.0)], "topic_id BIGINT, term STRING, weight DOUBLE")
        for m in (1, 60):
            runs = [sorted(rows(retrieve.search(index, terms, JM, m, prune=p))) for p in (True, False)]
            assert runs[0] == runs[1] and runs[0]


def test_pruned_search_scores_few_documents(spark, c):
    docs = [(i, ("rare " if i % 100 == 0 else "") + "common words " + f"w{i}") for i in range(3000)]
    index = ix.write_index(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), session.fresh_folder(spark, "many"), buckets=2)
    terms = spark.createDataFrame([(1, "rare", 1.0), (1, "common", 1.0)], "topic_id BIGINT, term STRING, weight DOUBLE")
    known = retrieve.known_terms(index, terms, True, "contents")
    bounded = index.term_bounds.filter("field = 'contents'").drop("field").join(known, "term")
    dealt = retrieve.allotments(bounded, retrieve._floors(index, bounded, JM, 10, "contents"), JM)
    # no word gets more than its bound, no topic more than its floor
    told = dealt.groupBy("topic_id").agg(F.sum("allot"), F.min(F.col("bound") - F.col("allot"))).first()
    floor = retrieve._floors(index, bounded, JM, 10, "contents").first().floor
    assert 0 < told[1] < floor and told[2] >= 0
    assert retrieve.candidates(index, dealt, JM).count() == 30
    assert retrieve.match_any(index, terms).count() == 3000
    found = retrieve._pruned_scores(index, known, JM, 10, "contents")
    text = plan(found)
    assert found.count() == 30 and "ShuffledHashJoin" in text
    # neither side of the join by document is moved
    assert "Exchange hashpartitioning(topic_id" not in text and "Exchange hashpartitioning(doc_id" not in text


def test_scores_are_bounded_by_the_statistics(spark, c):
    for model in (Model("tfidf"), JM, Model("dir", 100.0)):
        named = c.index.term_bounds.filter("field = 'contents'").drop("field")
        terms = named.select("term").withColumn("topic_id", F.lit(1)).withColumn("weight", F.lit(1.0))
        rows_ = retrieve.matches(c.index, terms).join(named, "term")
        assert rows_.filter(model.contribution() > model.bound() + 1e-9).count() == 0


@pytest.mark.parametrize("kinds", [97, 1])
def test_top_m_beyond_the_window_limit(spark, monkeypatch, kinds):
    """Past Spark's own limit only rows at or above an exact floor are ranked, ties or not."""
    scored = spark.range(40_000).select(
        (F.col("id") % 2).alias("topic_id"), F.col("id").alias("doc_id"), (F.col("id") % kinds).cast("double").alias("score")
    ).union(spark.range(5).selectExpr("7L", "id", "1.0D"))
    ranked = []
    monkeypatch.setattr(retrieve, "keep", lambda df, label: ranked.append(df) or session.keep(df, label))
    got = retrieve.top_m(scored, 1500)
    window = plan(got)
    want = [(t, i, s) for t in (0, 1) for s, i in sorted(((float(i % kinds), i) for i in range(40_000) if i % 2 == t), key=lambda r: (-r[0], r[1]))[:1500]]
    assert sorted((r.topic_id, r.doc_id, r.score) for r in got.collect()) == sorted([*want, *[(7, i, 1.0) for i in range(5)]])
    assert sorted(r["rank"] for r in got.filter("topic_id = 1").collect()) == list(range(1, 1501))
    assert len(ranked) == 1 and "floor" in window
    assert "floor" not in plan(retrieve.top_m(scored, 10)) and len(ranked) == 1


def test_tuning_reads_the_postings_once(spark, c):
    """Floors and ranking read the kept scores."""
    text = plan(tuning.settings_runs(c.index, c.terms, tuning.grid("jm")[:2], 5))
    assert "postings" not in text and "settings-" in text


def test_tuning_scores_few_documents_twice(spark, monkeypatch):
    rng = random.Random(3)
    texts = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randrange(20, 60)))) for i in range(1500)]
    index = ix.write_index(spark.createDataFrame(texts, "doc_id BIGINT, text STRING"), session.fresh_folder(spark, "tuned"))
    terms = retrieve.topic_terms(spark.createDataFrame([(1, "w1 w2 w7 w30"), (2, "w1 w5 w90")], "topic_id BIGINT, text STRING"))
    scored, summed = [], tuning.summed
    monkeypatch.setattr(tuning, "summed", lambda rows_, named: scored.append(rows_) or summed(rows_, named))
    models = tuning.grid("jm")[1:6]
    run = sorted(rows(tuning.settings_runs(index, terms, models, 10)))
    first, second = (df.count() for df in scored)
    assert second < 0.15 * first
    # blocks decide what is scored twice, not the result
    monkeypatch.setattr(tuning, "BLOCKS", 1)
    assert sorted(rows(tuning.settings_runs(index, terms, models, 10))) == run


def test_best_param_scores_training_topics_only(spark, c, monkeypatch):
    asked, metrics = [], tuning.settings_metrics
    monkeypatch.setattr(tuning, "settings_metrics", lambda *args: asked.append(args) or metrics(*args))
    assert REGISTRY["best_param"](spark, SF).count() == 2
    low, high = c.topics.agg(F.min("topic_id"), F.max("topic_id")).first()
    assert all(df.agg(F.max("topic_id")).first()[0] <= (low + high) / 2 for df in asked[0][1:3])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_out_of_range_raise(spark, ansi):
    """No addend is left out silently, in ANSI mode or not."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        values = lambda *v: spark.createDataFrame([(x,) for x in v], "x DOUBLE")
        assert values(1e16, 2.0, None).agg(exact.exact_sum(F.col("x"))).first()[0] == 1e16 + 2
        with pytest.raises(Exception, match="too large for a sum"):
            values(1e18, 2.0).agg(exact.exact_sum(F.col("x"))).first()
        total = lambda df: df.agg(exact.total_units(exact.units(F.col("x"))).alias("s")).select(exact.from_units("s")).first()[0]
        assert total(values(1.5, None, 2.25)) == 3.75
        for bad in ((1e9,), (9e7, 9e7)):
            with pytest.raises(Exception, match="too large for a score|leaves the range"):
                total(values(*bad))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_term_of_every_document_is_no_hot_key(spark, c):
    """Its rows are dealt out by seed, as many shares as there are shuffle tasks."""
    docs = [(i, f"every w{i % 50} v{i % 7}") for i in range(400)]
    index = ix.write_index(spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), session.fresh_folder(spark, "hot"), buckets=2)
    seeds = [f"w{i}" for i in range(50)]
    rows_ = spark.createDataFrame([(t, s) for s in seeds for t in ("every", s)], "term STRING, seed_term STRING")
    table = index.term_stats.filter("field = 'contents'").select("term", "df")
    joined = ix.join_terms(index, rows_, table.hint("merge"), "seed_term")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # rows of the common term in each task
        held = joined.filter("term = 'every'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert joined.count() == 100 and sum(r["count"] for r in held) == 50
    assert len(held) > 1 and max(r["count"] for r in held) < 50 and tasks == 4
    asked = spark.createDataFrame([(s,) for s in seeds], "term STRING")
    near = similar.similar_terms(index, asked, "tfxidf", k=3)
    assert near.count() == 150


def test_broadcasts_are_bounded_by_real_bytes(spark, monkeypatch):
    """Few rows of long values do not fit, many of short ones do."""
    monkeypatch.setattr(session, "BROADCAST_BYTES", 100_000)
    long_ones = spark.range(20).selectExpr("id", "repeat('x', 10000) AS text")
    assert not session.fits(long_ones) and session.fits(long_ones.select("id"))
    assert session.fits(spark.range(2000).selectExpr("id", "'ab' AS text"))
    assert not session.fits(spark.range(2000).selectExpr("id", "sequence(1, 20) AS list"))
    assert not session.fits(spark.range(2000).selectExpr("id", "array(struct(repeat('y', 90) AS s)) AS nested"))
    assert session.fits(spark.range(10)) and not session.fits(spark.range(10), 9)
    assert session.fits(spark.range(0).selectExpr("id", "CAST(NULL AS STRING) AS s"))
