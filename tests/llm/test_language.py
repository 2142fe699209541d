import random

import numpy as np
from llm_helpers import corpus, docs  # noqa: F401
from pyspark.sql import functions as F
from rankspark.llm import language

SYLLABLES = {"aa": "ka ri to mu shi".split(), "bb": "sch ung ver der ein".split(), "cc": "tion ou eau les que".split()}


def table(spark, n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        name = rng.choice(sorted(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(3, 60))]
        rows.append((i, " ".join(words).title(), name, "x", "y"))
    rows += [(n, None, "aa", "x", "y"), (n + 1, "", "aa", "x", "y"), (n + 2, "123 !!", "bb", "x", "y")]
    rows += [(n + 3, "schung verein", None, "x", "y"), (None, "schung verein " * 9000, "bb", "x", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, held_out string")


def test_ngrams_see_words():
    raw = np.frombuffer(b"ab--cA", np.uint8)
    codes, first = language.ngrams(raw, np.array([0, 4, 4, 6]), 3)
    text = lambda c: int(c & np.uint64(0xFFFFFF)).to_bytes(3, "little")
    assert [text(c) for c in codes[first[0] : first[1]]] == [b" ab", b"ab "]
    assert first[1] == first[2]
    assert [text(c) for c in codes[first[2] : first[3]]] == [b" cA", b"cA "]


def test_held_out_accuracy(spark):
    rows = table(spark)
    got = language.identify(rows).collect()
    truth = {r.doc_id: r.lang for r in rows.collect()}
    assert len(got) == 245
    told = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert len(told) > 50 and np.mean([r.lang_pred == truth[r.doc_id] for r in told]) >= 0.95
    by_id = {r.doc_id: r for r in got}
    for k in (240, 241, 242):
        assert (by_id[k].lang_pred, by_id[k].score) == ("und", 0.0)
    assert by_id[243].lang_pred == by_id[None].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got)


def test_lookups_return_all_languages(spark):
    model = language.learn(table(spark).filter("doc_id < 240"), least_rate=1e-9)
    rates = model.false_rates()
    assert len(rates) == 3 and (rates < 0.01).all()
    raw = np.frombuffer(b"schung", np.uint8)
    counts = language.language_counts(model, rates, raw, np.array([0, 6]))
    assert model.languages[counts[0].argmax()] == "bb"


def test_no_rows_and_no_labels(spark, docs):
    assert language.identify(docs.limit(0)).count() == 0
    nothing = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in nothing.collect()} == {("und", 0.0)}


def test_the_sample_does_not_depend_on_its_parts(spark, monkeypatch):
    rows = [(i % 40, f"text {i} of language {i % 3} zx{i * 7919}", f"l{i % 3}") for i in range(120)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = []
    for parts in (1, 5, 256):
        monkeypatch.setattr(language, "SAMPLE_PARTS", parts)
        models.append(language.learn(table, rows_per_language=4))
    for model in models[1:]:
        assert model.languages == models[0].languages and (model.masks == models[0].masks).all()
