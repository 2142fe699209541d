import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import invent
from rankspark.llm import toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("abc", min_size=1, max_size=10), min_size=1, max_size=6, unique=True),
    st.lists(st.text("abcx", max_size=12), max_size=6),
    st.booleans(),
)
def test_automata_equal_edit_distance(terms, words, prefix):
    marked = [t + "*" if prefix and i % 2 else t for i, t in enumerate(terms)]
    lexicon = toxicity.FuzzyLexicon(marked)
    for word in words:
        want = {}
        for i, term in enumerate(marked):
            bare = term.rstrip("*")
            ends = range(len(word) + 1) if term.endswith("*") else [len(word)]
            errors = min(distance(word[:e], bare) for e in ends)
            if errors <= toxicity.allowed_errors(len(bare)):
                want[i] = errors
        assert lexicon.matches(word) == want


def test_windows_tell_quotation():
    lexicon = toxicity.FuzzyLexicon(["moron"])

    def quoted(text):
        bits, term, _ = np.array([toxicity.read_token(t, lexicon) for t in text.split()]).T
        at = int(np.flatnonzero(term >= 0)[0])
        return toxicity.in_quotation(bits, at, max(0, at - 6), at + 7)

    assert quoted('He put "moron" on the list')
    assert quoted("they called him a m0ron once")
    assert not quoted("you are a moron and he said so")
    assert not quoted("what a moron, really")


def test_held_out_scores(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(420):
        words, toxic = invent(rng, rng.randint(5, 40)).split(), int(rng.random() < 0.3)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["vermin", "garbage", "VERMIN!!", "garbge"]))
        rows.append((i, " ".join(words), 0.1, "x"))
        labels.append((i, toxic, 1))
    rows += [(500, None, 0.1, "x"), (501, "", 0.1, "x"), (502, "vermin " * 4000, 0.1, "x"), (None, "you vermin", 0.1, "x")]
    labels += [(500, None, 1), (None, 1, 1), (7, labels[7][1], 1), (8, 1 - labels[8][1], 1)]
    table = spark.createDataFrame(rows, "doc_id long, text string, score double, predicted string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    got = toxicity.detect(table, marks).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, t, _ in labels[:420]}
    told = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id is not None and r.doc_id < 420]
    ones, zeros = [s for s, t in told if t], [s for s, t in told if not t]
    assert np.mean([[a > b for b in zeros] for a in ones]) > 0.97
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].predicted == by_id[502].predicted == 1
    assert by_id[500].score == by_id[501].score < 0.5 and by_id[501].n_hits == 0
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    assert toxicity.detect(table.limit(0), marks).count() == 0
    assert {r.predicted for r in toxicity.detect(table, marks.limit(0)).collect()} == {0}
