import itertools
import os
import random
import tempfile
import time
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import invent
from rankspark.llm import audit
from rankspark.session import fresh_folder

DOCS = "doc_id long, text string, source string, mask int, good boolean, slice long"
LABELS = "doc_id long, quality int, toxic int, good string"


def fails(text):
    words = text.encode().split()
    upper = sum("A" <= c <= "Z" for c in text)
    return [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * upper > 5 * len(text), any(c in "#$%&*|" for c in text)]


def plain(docs, labels):
    """The contract, document by document and order by order."""
    least = {}
    for key, text, _ in docs:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    rows = [
        (source or "", [*fails(text or ""), key is not None and key > least[text or ""]], key in good, key in toxic)
        for key, text, source in docs
    ]
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left, gone = own, []
            for step, letter in enumerate(order, 1):
                i = "ABCDE".index(letter)
                here = [r for r in left if r[1][i]]
                left = [r for r in left if not r[1][i]]
                again = sum(r[1][i] for r in gone)
                gone = gone + here
                alone = sum(r[1][i] and sum(r[1]) == 1 for r in own)
                shapley[part, letter] = shapley.get((part, letter), 0) + len(here)
                out[part, "".join(order), step] = [
                    len(left), len(here), again, alone, sum(r[2] for r in here), sum(r[3] for r in here)
                ]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def corpus():
    rng = random.Random(11)
    texts = [invent(rng, n) for n in (30, 49, 50, 60, 80)]
    texts += [None, "", "AB c", "der " * 60, "Und ER SAGT " * 30, texts[3] + " 5 % $", "Straße İ ☃\x85x\x0by " * 20]
    texts += [invent(rng, 40).upper(), "x" * 3000, invent(rng, 5000)]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(120)]
    rows += [(7, texts[0], "a"), (7, texts[0], "b"), (None, texts[0], "a"), (None, "alone", "b"), (500, "alone", "b")]
    rng.shuffle(rows)
    # a third of all rows is one text, its least id last
    return [(1000 - i, texts[4], "hot") for i in range(80)] + rows


@pytest.mark.parametrize("files", [1, 7])
def test_against_the_contract(spark, files):
    rows = corpus()
    labels = [(i % 130, i % 2, i % 3 - 1) for i in range(200)] + [(None, 1, 1), (9999, 1, 1), (3, None, None)]
    path = fresh_folder(spark, "audit-test")
    table = spark.createDataFrame([(*r, 9, True, 5) for r in rows], DOCS)
    table.coalesce(1).write.option("maxRecordsPerFile", -(-len(rows) // files)).parquet(path)
    marks = spark.createDataFrame([(*r, "x") for r in labels], LABELS)
    got = audit.filter_audit(spark, path, marks, batch_bytes=1)
    want = plain(rows, labels)
    assert got.columns == [c.split()[0] for c in audit.RESULT.split(", ")]
    assert sorted(map(tuple, got.collect())) == want
    assert {r[0] for r in want} == {"", "a", "b", "hot"} and any(r[5] for r in want) and any(r[8] for r in want)


def test_an_earlier_copy_takes_back_counts(spark):
    folder, path = fresh_folder(spark, "audit-test"), fresh_folder(spark, "audit-test")
    # one file after the other, the smaller id in the second
    for key, part in ((9, "late"), (4, "early")):
        spark.createDataFrame([(key, "one two", part)], "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(path)
    marks = spark.createDataFrame([], LABELS)
    counts = audit.counts_stream(spark, path, marks, folder, batch_bytes=1).collect()
    assert sorted((r.part, r.mask, r.n) for r in counts) == [("early", 1, 1), ("late", 1, -1), ("late", 1, 1), ("late", 17, 1)]


def test_a_small_state_sets_no_disk_aside(spark):
    path, began = fresh_folder(spark, "audit-test"), time.time()
    spark.createDataFrame([(1, "one two", "a")], "doc_id long, text string, source string").write.parquet(path)
    key = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
    before = spark.conf.get(key, None)
    audit.filter_audit(spark, path, spark.createDataFrame([], LABELS)).count()
    assert spark.conf.get(key, None) == before
    local = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    logs = [f.stat() for f in Path(local).glob("spark-*/**/MANIFEST-*")]
    taken = [s.st_blocks * 512 for s in logs if s.st_mtime >= began - 1]
    assert taken and max(taken) < 1 << 20


def test_no_documents(spark):
    path = fresh_folder(spark, "audit-test")
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(path)
    marks = spark.createDataFrame([], LABELS)
    assert audit.filter_audit(spark, path, marks).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 6), st.sampled_from("ab")), min_size=1, max_size=4), min_size=1, max_size=5))
def test_any_order_of_batches_gives_the_same_counts(batches):
    total, state = {}, None
    for batch in batches:
        groups = {}
        for key, part in batch:
            groups.setdefault(part, []).append(key)
        rows = [[p, 3, False, False, True, min(k), k.count(min(k)), len(k)] for p, k in groups.items()]
        out, state = audit.settle(rows, state)
        for part, mask, *_, n in out:
            total[part, mask] = total.get((part, mask), 0) + n
    every = [r for batch in batches for r in batch]
    least = min(k for k, _ in every)
    want = {}
    for key, part in every:
        place = (part, 3 | (audit.REPEATED if key > least else 0))
        want[place] = want.get(place, 0) + 1
    assert {k: n for k, n in total.items() if n} == want


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="ab \t\n\x0b\x1f é", max_size=40), st.integers(1, 9))
def test_words_of_a_text_in_stretches(text, step):
    words = text.encode().split()
    assert audit.count_words(text.encode(), step) == (len(words), len(set(words)))
