"""Hand-computed values on the four-document collection."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rankspark.functions.scoring import Model
from rankspark.operators import evaluate, feedback, retrieve, similar, tuning
from rankspark.operators import index as ix
from rankspark.operators import weights as wt
from rankspark.session import fresh_folder


@pytest.fixture(scope="module")
def topics(spark):
    return spark.createDataFrame([(1, "apple cherry")], "topic_id BIGINT, text STRING")


@pytest.fixture(scope="module")
def qrels(spark):
    return spark.createDataFrame([(1, 1), (1, 4)], "topic_id BIGINT, doc_id BIGINT")


def test_statistics(micro):
    stats = {r.term: (r.df, r.cf) for r in micro.term_stats.collect()}
    assert stats == {"apple": (2, 3), "banana": (2, 3), "cherry": (3, 3), "date": (2, 3), "elder": (1, 1)}
    field = micro.field_stats.first()
    assert (field.n_docs, field.n_docs_with_field, field.sum_cf, field.n_terms) == (4, 4, 13, 5)


@pytest.mark.parametrize(
    ("model", "expected"),
    [
        (Model("tfidf"), [(1, 1.679886819), (3, 1.068315044), (2, 0.706182259), (4, 0.611571776)]),
        (Model("jm", 0.5), [(1, 1.640209571), (3, 1.011600912), (2, 0.773189888), (4, 0.628608659)]),
        (Model("jm", 1.0), [(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0)]),
        (Model("dir", 10.0), [(1, 0.194156014), (3, 0.117783036), (2, 0.037740328), (4, 0.0)]),
        (Model("dir", 0.0), [(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0)]),
    ],
)
def test_search(micro, topics, model, expected):
    run = retrieve.search(micro, retrieve.topic_terms(topics), model, 10).orderBy("rank")
    got = [(r.doc_id, r.score) for r in run.collect()]
    assert [d for d, _ in got] == [d for d, _ in expected]
    assert [s for _, s in got] == pytest.approx([s for _, s in expected], abs=2e-9)


def test_models_are_checked():
    for bad in (("jm", 0.0), ("jm", 1.5), ("dir", -1.0), ("bm25", None)):
        with pytest.raises(ValueError):
            Model(*bad)


def test_best_terms(micro):
    best = wt.best_terms(micro).filter("doc_id IN (1, 4)").orderBy("doc_id", "rank").collect()
    assert [(r.doc_id, r.term) for r in best] == [
        (1, "apple"), (1, "banana"), (1, "cherry"), (4, "date"), (4, "elder"), (4, "cherry"),
    ]
    assert [r.tfidf for r in best] == pytest.approx(
        [0.602060, 0.301030, 0.124939, 0.602060, 0.602060, 0.124939], abs=1e-6
    )
    text = wt.best_terms_text(micro).filter("doc_id = 4").first().best_terms
    assert text == "date (2 2 0.602) elder (1 1 0.602) cherry (1 3 0.125) "


@pytest.mark.parametrize(
    ("scheme", "expected"),
    [
        ("tf", [(3, 0.816497), (2, 0.547723), (4, 0.408248)]),
        ("bin", [(2, 0.816497), (3, 0.577350), (4, 0.577350)]),
        ("tfxidf", []),
    ],
)
def test_similar_docs(spark, micro, scheme, expected):
    seeds = spark.createDataFrame([(1,)], "doc_id BIGINT")
    got = similar.similar_docs(micro, seeds, scheme).orderBy("rank").collect()
    assert [r.doc_id for r in got] == [d for d, _ in expected]
    assert [r.similarity for r in got] == pytest.approx([s for _, s in expected], abs=1e-6)


@pytest.mark.parametrize(
    ("scheme", "expected"),
    [
        ("tf", [("cherry", 0.516398), ("banana", 0.4), ("date", 0.2), ("elder", 0.0)]),
        ("bin", [("banana", 0.5), ("date", 0.5), ("cherry", 0.408248), ("elder", 0.0)]),
    ],
)
def test_similar_terms(spark, micro, scheme, expected):
    seeds = spark.createDataFrame([("apple",), ("missing",)], "term STRING")
    got = similar.similar_terms(micro, seeds, scheme).orderBy("rank").collect()
    assert {r.seed_term for r in got} == {"apple"}
    assert [r.term for r in got] == [t for t, _ in expected]
    assert [r.similarity for r in got] == pytest.approx([s for _, s in expected], abs=1e-6)


def test_zero_similarities_fill_up_in_term_order(spark):
    texts = [(i, f"seed{i} pair{i}") for i in range(15)]
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    index = ix.build_index(ix.describe(docs))
    seeds = spark.createDataFrame([("seed3",)], "term STRING")
    got = similar.similar_terms(index, seeds, "tf", k=4).orderBy("rank").collect()
    assert [(r.term, r.similarity) for r in got] == [
        ("pair3", 1.0), ("pair0", 0.0), ("pair1", 0.0), ("pair10", 0.0),
    ]


def metrics(run, qrels, topics, n, m=None):
    r = evaluate.topic_metrics(run, qrels, topics, n, m=m).first()
    return r.P, r.R, r.MAP


def test_evaluation(micro, topics, qrels):
    run = retrieve.search(micro, retrieve.topic_terms(topics), Model("jm", 0.5), 10)
    assert metrics(run, qrels, topics, 2) == (0.5, 0.5, 0.5)
    assert metrics(run, qrels, topics, 4)[2] == 0.75
    assert metrics(run, qrels, topics, 10)[0] == 0.2
    assert metrics(run, qrels, topics, 4, m=2) == (0.25, 0.5, 0.5)


def test_topics_without_judgements_or_hits(spark, micro, qrels):
    topics = spark.createDataFrame(
        [(1, "apple cherry"), (2, "date"), (3, "zzz")], "topic_id BIGINT, text STRING"
    )
    run = retrieve.search(micro, retrieve.topic_terms(topics), Model("jm", 0.5), 10)
    got = evaluate.topic_metrics(run, qrels, topics, 2)
    assert sorted(rows(got)) == [(1, 2, 0.5, 0.5, 0.5), (2, 0, 0.0, None, None), (3, 0, 0.0, None, None)]
    # zeros and NULLs do not enter the means
    assert rows(evaluate.mean_metrics(got)) == [(0.5, 0.5, 0.5)]
    nothing = evaluate.mean_metrics(got.filter("topic_id > 1"))
    assert rows(nothing) == [(None, None, None)]


def test_boolean_words_are_terms(spark):
    docs = spark.createDataFrame([(1, "this AND that"), (2, "neither")], "doc_id BIGINT, text STRING")
    index = ix.build_index(ix.describe(docs))
    topics = spark.createDataFrame([(1, "and"), (2, "NOT")], "topic_id BIGINT, text STRING")
    assert rows(retrieve.match_any(index, retrieve.topic_terms(topics))) == [(1, 1, 1)]


def test_topic_ranges(spark):
    topics = spark.createDataFrame([(i, "x") for i in range(1, 6)], "topic_id BIGINT, text STRING")
    ids = lambda which: [r.topic_id for r in retrieve.topic_range(topics, which).collect()]
    assert (ids("all"), ids("2"), ids("2-4")) == ([1, 2, 3, 4, 5], [2], [2, 3, 4])


def test_feedback(micro, topics, qrels):
    run = retrieve.search(micro, retrieve.topic_terms(topics), Model("jm", 0.5), 10)
    chosen = feedback.feedback_docs(run, qrels, 1)
    assert [r.doc_id for r in chosen.collect()] == [1]
    values = feedback.term_values(micro, chosen)
    got = {r.term: r.value for r in values.collect()}
    assert got == pytest.approx({"apple": 0.987505, "banana": 0.493752, "cherry": 0.204926}, abs=1e-6)
    query = feedback.expanded_query(topics, feedback.best_values(values, 2), 0.5)
    assert {r.term: r.weight for r in query.collect()} == {"apple": 0.58, "cherry": 0.25, "banana": 0.17}
    exact = feedback.expanded_query(topics, feedback.best_values(values, 2), 0.25, digits=None)
    assert exact.agg(F.sum("weight")).first()[0] == pytest.approx(1.0, abs=1e-8)


def test_residual_evaluation(micro, topics, qrels):
    terms = retrieve.topic_terms(topics)
    args = (micro, topics, terms, qrels, Model("jm", 0.5))
    _, plain = feedback.feedback_search(*args, n=4, m=4, s=1, t=2, beta=0.5)
    _, residual = feedback.feedback_search(*args, n=4, m=4, s=1, t=2, beta=0.5, residual=True)
    assert (plain.first().n_rel, residual.first().n_rel) == (2, 1)
    # document 1 keeps its rank, so document 4 is still found at rank 4
    assert residual.first().MAP == 0.25
    with pytest.raises(ValueError):
        feedback.feedback_search(*args, n=5, m=4, s=1, t=2, beta=0.5)


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_tuning_equals_one_search_per_setting(micro, topics, n):
    terms = retrieve.topic_terms(topics)
    models = tuning.grid("jm") + tuning.grid("dir")
    together = {
        (r.model, r.param, r.doc_id, r.rank)
        for r in tuning.settings_runs(micro, terms, models, n).collect()
    }
    alone = {
        (m.name, m.param, r.doc_id, r.rank)
        for m in (models[0], models[5], models[10], models[11], models[21])
        for r in retrieve.search(micro, terms, m, n).collect()
    }
    assert alone <= together
    assert len(together) == min(n, 4) * len(models)


def test_tuning_writes_no_score_of_every_document(spark, monkeypatch):
    """What is kept grows with topics and settings, not with the matching documents."""
    data = [(i, "apple " * (i % 7 + 1) + "banana") for i in range(600)]
    many = ix.write_index(spark.createDataFrame(data, "doc_id BIGINT, text STRING"), fresh_folder(spark, "many"))
    asked = spark.createDataFrame([(1, "apple banana")], "topic_id BIGINT, text STRING")
    models = tuning.grid("jm") + tuning.grid("dir")
    kept, write = [], tuning.keep
    monkeypatch.setattr(tuning, "keep", lambda df, label: kept.append(write(df, label)) or kept[-1])
    together = tuning.settings_runs(many, retrieve.topic_terms(asked), models, 3)
    ranked = {(r.model, r.param): [] for r in together.collect()}
    for r in together.orderBy("rank").collect():
        ranked[r.model, r.param].append(r.doc_id)
    assert sum(df.count() for df in kept) <= tuning.BLOCKS + 3 * len(models)
    for m in (models[1], models[10], models[11], models[15]):
        alone = retrieve.search(many, retrieve.topic_terms(asked), m, 3).orderBy("rank").collect()
        assert ranked[m.name, m.param] == [r.doc_id for r in alone]


def test_leaderboard_ties_go_to_the_smaller_parameter(spark):
    data = [("jm", p, t, v, v, v) for p, v in ((0.2, 0.5), (0.1, 0.5), (0.3, 0.0)) for t in (1, 2)]
    metrics = spark.createDataFrame(data, "model STRING, param DOUBLE, topic_id BIGINT, P DOUBLE, R DOUBLE, MAP DOUBLE")
    board = tuning.leaderboard(metrics).orderBy("place").collect()
    assert [(r.param, r.value) for r in board] == [(0.1, 0.5), (0.2, 0.5), (0.3, 0.0)]
    held = tuning.holdout(metrics, metrics.withColumn("MAP", F.lit(None).cast("double")))
    assert rows(tuning.holdout_mean(held)) == [("jm", 0.1, 0.0)]
