import random

import numpy as np
from rankspark.llm import decontaminate

from llm_helpers import corpus, docs, invent  # noqa: F401


def test_best_stretch_equals_trying_all():
    rng = random.Random(2)
    for _ in range(200):
        same = np.array([rng.random() < 0.7 for _ in range(rng.randint(1, 25))])
        best = max(
            (
                int(same[a:b].sum())
                for a in range(len(same))
                for b in range(a + 1, len(same) + 1)
                if same[a:b].mean() >= 0.8 and same[a] and same[b - 1]
            ),
            default=0,
        )
        a, b, n = decontaminate.best_stretch(same, 0.8)
        assert n == best and (n == 0 or same[a:b].mean() >= 0.8)


def test_planted_items(spark, docs):
    rng = random.Random(9)
    items = [(i, invent(rng, 30)) for i in range(5)] + [(5, "too short"), (6, None), (7, "")]
    rows = [(100 + i, invent(rng, 80)) for i in range(5)]
    for i in range(5):
        own = items[i][1].split()
        for k in rng.sample(range(len(own)), i):
            own[k] = "other"
        rows.append((i, invent(rng, 40) + "\n" + " ".join(own).upper() + " " + invent(rng, 9)))
    rows += [(200, None), (201, ""), (None, items[0][1]), (0, rows[5][1]), (202, "too short"), (203, "one " * 40)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item_id string, words int")
    tests = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, doc_id string")
    got = decontaminate.overlaps(table, tests).collect()
    assert sorted((r.doc_id, r.item_id) for r in got if r.doc_id is not None) == [(i, i) for i in range(5)]
    assert [r.item_id for r in got if r.doc_id is None] == [0]
    for r in got:
        assert r.n_matched >= 24 and r.similarity >= 0.8
    left = decontaminate.without_overlaps(table, tests)
    assert left.columns == table.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(["100", "101", "102", "103", "104", "200", "201", "202", "203"])
    assert decontaminate.overlaps(table.limit(0), tests).count() == 0
    assert decontaminate.overlaps(docs, tests.limit(0)).count() == 0


def test_short_items_with_replaced_words(spark):
    rng = random.Random(19)
    items, rows = [], []
    for n in range(3, 14):
        words = invent(rng, n).split()
        items.append((n, " ".join(words)))
        for k in range(n if n >= 5 else 0):
            own = [*words[:k], "other", *words[k + 1 :]]
            rows.append((100 * n + k, " ".join([invent(rng, 9), *own, invent(rng, 9)])))
        rows.append((100 * n + 50, " ".join(words)))
        # more words replaced than the share allows
        far = [w if k % 3 else "other" for k, w in enumerate(words)]
        rows.append((100 * n + 60, " ".join([invent(rng, 9), *far])))
    both = list(items[7][1].split())
    both[0] = both[9] = "other"
    rows.append((1070, " ".join([invent(rng, 9), *both, invent(rng, 9)])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(table, tests).collect()}
    assert got == {(i, i // 100) for i, _ in rows if i % 100 != 60}
    left = decontaminate.without_overlaps(table, tests).collect()
    assert {r.doc_id for r in left} == {100 * n + 60 for n in range(3, 14)}
