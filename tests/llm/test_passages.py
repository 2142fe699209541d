import collections
import itertools
import random

import numpy as np
import pyarrow as pa
from rankspark.llm import passages

from llm_helpers import corpus, docs, invent, plain_words  # noqa: F401


def test_chain_value_is_best():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 8)
        p, q = (np.array([rng.randint(0, 30) for _ in range(n)]) for _ in range(2))

        def value(path, p=p, q=q):
            total = 5.0
            for i, j in itertools.pairwise(path):
                a, b = p[j] - p[i], q[j] - q[i]
                if a <= 0 or b <= 0:
                    return -1
                total += 5 - 0.05 * (a + b)
            return total

        best = max(value(c) for k in range(1, n + 1) for s in itertools.combinations(range(n), k) for c in itertools.permutations(s) if len(s) < 6)
        first = passages.chain(p, q, 5, 0.05)[0]
        assert abs(value(first.tolist()) - best) < 1e-9


def test_planted_passages_are_found(spark, docs):
    rng = random.Random(11)
    plain = [invent(rng, 200) for _ in range(12)]
    passage = invent(rng, 70).split()
    rows = [(i, t) for i, t in enumerate(plain)]
    for i in range(20, 26):
        own = list(passage)
        for _ in range(i - 20):
            own[rng.randrange(len(own))] = invent(rng, 1)
        del own[10 : 10 + i % 2]
        rows.append((i, invent(rng, 50) + " " + " ".join(own) + " " + invent(rng, 50)))
    rows += [(40, plain[3]), (41, plain[3]), (42, None), (None, ""), (43, plain[5][:200])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = passages.fuzzy_passages(table.withColumnRenamed("x", "y")).collect()
    texts = dict(rows)
    assert {r.doc_id for r in got} == {21, 22, 23, 24, 25, 40, 41}
    for r in got:
        own, source = plain_words(texts[r.doc_id]), plain_words(texts[r.source_doc_id])
        assert r.source_doc_id < r.doc_id and r.end_word - r.start_word >= 50 and r.similarity >= 0.8
        assert r.end_word <= len(own) and r.source_end <= len(source)
        if r.doc_id < 40:
            assert r.start_word <= 53 and r.end_word >= 115
    assert passages.fuzzy_passages(table.limit(0)).count() == 0
    # odd texts, ids that repeat, other columns
    assert {r.doc_id for r in passages.fuzzy_passages(docs).collect()} >= {2, 3, 5, None}


def test_a_passage_that_a_better_chain_jumps_over_is_found(spark):
    rng = random.Random(21)
    one, two, three = (invent(rng, n) for n in (80, 100, 60))
    rows = [(1, " ".join([one, two, three])), (2, " ".join([one, three, two]))]
    got = passages.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {(r.start_word, r.end_word, r.source_start, r.source_end) for r in got}
    assert spans == {(0, 80, 0, 80), (80, 140, 180, 240), (140, 240, 80, 180)}


def test_heavily_edited_passages_are_found(spark):
    rng = random.Random(22)
    rows, pairs = [], []
    for i in range(20):
        passage = invent(rng, 50).split()
        own = list(passage)
        # every fifth word, or ten words anywhere
        for k in range(2, 50, 5) if i < 10 else rng.sample(range(1, 49), 10):
            own[k] = "other" + str(k)
        rows += [(i, " ".join([invent(rng, 40), *passage, invent(rng, 30)]))]
        rows += [(100 + i, " ".join([invent(rng, 20), *own, invent(rng, 20)]))]
        pairs.append((100 + i, i))
    got = passages.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {(r.doc_id, r.source_doc_id) for r in got}
    assert found >= set(pairs[:10])
    assert len(found & set(pairs)) >= 18 and found <= set(pairs)


def test_a_passage_whose_seeds_have_other_first_texts_is_found(spark, monkeypatch):
    rng = random.Random(23)
    passage = invent(rng, 50).split()
    rows = [(1, " ".join([invent(rng, 9), *passage[:30]])), (2, " ".join([*passage[20:], invent(rng, 9)]))]
    rows += [(3, " ".join([invent(rng, 9), *passage])), (4, " ".join([*passage, invent(rng, 9)]))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for ranges in (1, 2, 32):
        monkeypatch.setattr(passages, "RANGES", ranges)
        assert (4, 3) in {(r.doc_id, r.source_doc_id) for r in passages.fuzzy_passages(table).collect()}


def test_matches_of_any_batches_are_first_and_nearest():
    rng = random.Random(31)
    for size in (1, 2, 3, 7, 1000):
        rows = set()
        for _ in range(120):
            doc = rng.randrange(12)
            # some ids have two texts, some texts two ids
            content = rng.choice([doc // 2, doc // 2 + 100]) + 1
            rows.add((rng.randrange(6), passages.HERE, doc, content, rng.randrange(4), rng.random() < 0.6))
        rows = sorted({r[:5]: r for r in rows}.values())
        # a range of a hot seed, told of the first place and of the last lead one before it
        told = [(9, passages.FIRST, 1, 7, 3, False), (9, passages.LAST, 2, 8, 4, True)]
        told += [(9, passages.HERE, 5, 8, 0, True), (9, passages.HERE, 5, 9, 1, True), (9, passages.HERE, 6, 9, 2, False)]
        want = {(5, 8, 1, 7, 0, 3), (5, 9, 1, 7, 1, 3), (6, 9, 1, 7, 2, 3), (5, 9, 5, 8, 1, 0)}
        for anchor in range(6):
            own = [r for r in rows if r[0] == anchor]
            for i, r in enumerate(own):
                before = [x for x in own[:i] if x[5]][-1:] if r[5] else []
                want |= {(r[2], r[3], s[2], s[3], r[4], s[4]) for s in own[:1] + before if s[3] != r[3]}
        every = [(*r, True) for r in sorted(rows + told)]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]
        batches = (
            pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*every[a : a + size]), kinds)], passages.PLACES)
            for a in range(0, len(every), size)
        )
        got = [tuple(r.values()) for b in passages._match_task(batches) for r in b.to_pylist()]
        assert set(got) == want


def test_hot_seeds_are_dealt_into_ranges(spark, docs, monkeypatch):
    rng = random.Random(24)
    line = invent(rng, 60)
    rows = [(i // 2, f"{invent(rng, 10)} {line if i % 3 else line[:200]}") for i in range(24)]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    want = sorted(map(tuple, passages.fuzzy_passages(table).collect()), key=repr)
    monkeypatch.setattr(passages, "HOT_TEXTS", 2)
    monkeypatch.setattr(passages, "RANGES", 4)
    assert sorted(map(tuple, passages.fuzzy_passages(table).collect()), key=repr) == want


def test_seeds_of_several_texts_take_few_bytes():
    rng = random.Random(25)
    common = invent(rng, 30)
    texts = [f"{invent(rng, 900)} {common if i < 40 else ''}" for i in range(200)]
    sent = list(passages._seed_task(4, 1)(iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])])))
    n_seeds = sum(len(t.split()) - 3 for t in texts)
    # the pieces of a large task hold thousands of seeds; here, about a hundred
    assert sum(len(x) for b in sent for x in b.column(1).to_pylist()) < 6 * n_seeds
    # more texts than a piece has seeds make none hot
    for hot_texts in (100, 150, 1 << 16):
        assert not any(r["hot"] for b in passages._several_task(hot_texts)(iter(sent)) for r in b.to_pylist())
    map_of = {r["piece"]: r for b in passages._several_task(39)(iter(sent)) for r in b.to_pylist()}
    raw, offsets = passages.text_bytes(pa.array([common]))
    want = np.unique(passages._seed_rows(None, 0, 1, raw, offsets, 4, 1)[0])
    assert sorted(h for r in map_of.values() for h in r["hot"]) == (want >> np.uint64(64 - passages.SEED_BITS)).tolist()
    assert sum(bin(int.from_bytes(r["bits"])).count("1") for r in map_of.values()) == len(want)


def test_a_passage_is_found_in_every_earlier_text(spark, monkeypatch):
    rng = random.Random(26)
    passage = invent(rng, 50).split()
    one, two = " ".join(passage[:27]), " ".join(passage[23:])
    rows = [(1, one), (2, two), (3, " ".join([invent(rng, 9), *passage])), (4, two), (5, one)]
    # the seeds of 6 and 7 lead to parts of the passage first, and to parts next
    rows += [(6, " ".join([*passage, invent(rng, 9)])), (7, one), (7, two), (8, " ".join([invent(rng, 4), *passage]))]
    rows += [(9, rows[2][1]), (None, rows[2][1])]
    table = spark.createDataFrame([(i, f"{t} {invent(rng, 3)}" if t in (one, two) else t) for i, t in rows], "doc_id long, text string")
    want = {(6, 3), (8, 3), (8, 6), (9, 3), (9, 6), (9, 8), (None, 3), (None, 6), (None, 8)}
    for hot, ranges, most in ((1 << 12, 32, 1 << 21), (1, 3, 7), (1, 1, 1)):
        monkeypatch.setattr(passages, "HOT_TEXTS", hot)
        monkeypatch.setattr(passages, "RANGES", ranges)
        monkeypatch.setattr(passages, "MATCHES", most)
        got = passages.fuzzy_passages(table).collect()
        assert {(r.doc_id, r.source_doc_id) for r in got} == want
        assert all(r.end_word - r.start_word >= 50 and r.n_matched >= 50 for r in got)


def test_matches_of_any_batches_are_all_pairs():
    rng = random.Random(32)
    names = [part.split()[0] for part in passages.SPOTS.split(", ")]
    spans = {c: (lo, lo + rng.choice([0, 0, 3])) for c in range(1, 15) for lo in [rng.randrange(12)]}
    for size in (1, 2, 5, 1000):
        rows = [(a, 0, spans[c][0], c, spans[c][1], 4 * k + (k == 0)) for a in range(5) for c in spans if rng.random() < 0.6 for k in range(2)]
        # a cell of two ranges of a hot seed: places of one side meet those of the other
        rows += [(9, 2, spans[c][0], c, spans[c][1], 4 * 7 + 2 * (c > 6) + 1) for c in spans]
        rows.sort()
        want = collections.Counter()
        for x, y in itertools.product(rows, rows):
            earlier = (y[2], y[3]) < (x[4], x[3]) and x[3] != y[3] and y[5] & 1
            if x[:2] == y[:2] and earlier and (not x[1] or (x[5] ^ y[5]) & 2):
                want[x[3], y[3], x[5] >> 2, y[5] >> 2] += 1
        batches = (pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[a : a + size])], names) for a in range(0, len(rows), size))
        got = collections.Counter()
        for batch in passages._pair_task(2, 10)(batches):
            for r in batch.to_pylist():
                for p, q in np.frombuffer(r["spots"], "<i4").reshape(-1, 2).tolist():
                    got[r["own"], r["source"], p, q] += 1
        assert got == want


def test_chains_left_out_for_want_of_matches_have_no_passage(spark):
    fewest = passages.fewest_matches(4, 1, 0.8, 50)
    assert fewest == 7 and passages.fewest_matches(4, 2, 0.8, 50) == passages.fewest_matches(4, 1, 0.7, 50) == 1
    # ten words of fifty replaced leave so many seeds: runs of three, and one of ten
    same = np.ones(50, bool)
    same[np.arange(10) * 4 + 3] = False
    assert same.sum() == 40 and sum(same[k : k + 4].all() for k in range(47)) == fewest
    rng = random.Random(27)
    passage = invent(rng, 50).split()
    own = [w if same[k] else f"other{k}" for k, w in enumerate(passage)]
    rows = [(1, " ".join([*passage, invent(rng, 20)])), (2, " ".join([invent(rng, 20), *own]))]
    got = passages.fuzzy_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.source_doc_id, r.n_matched) for r in got} == {(2, 1, 40)}
