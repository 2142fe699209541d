import hashlib
import random

import numpy as np
from llm_helpers import corpus, docs  # noqa: F401
from rankspark.llm import bwt, suffixes
from rankspark.llm.suffixes import LAST_ID


def cut(rows, length):
    """Removes every byte that a string starting earlier covers; rows in their order."""
    seen, out = set(), []
    for data in rows:
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_merged_shards_give_all_repeats():
    rng = random.Random(3)
    for _ in range(120):
        letters = rng.choice([b"ab", b"a", bytes([0, 255, 7])])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 9))]
        depth, step = rng.choice([2, 4, 8]), rng.randint(1, 4)
        parts = [strings[i : i + step] for i in range(0, len(strings), step)]
        sizes = [np.array([len(s) for s in p]) for p in parts]
        shards = [bwt.build_shard(np.frombuffer(b"".join(p), np.uint8), n) for p, n in zip(parts, sizes, strict=True)]
        got, want = {}, {}
        for s, at, block in zip(*(c.tolist() for c in bwt.merge_repeats(shards, sizes, depth)), strict=True):
            got.setdefault(block, set()).add((s, at))
        for i, s in enumerate(strings):
            for at in range(len(s) - depth + 1):
                want.setdefault(s[at : at + depth], set()).add((i, at))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def by_order(corpus):
    """Distinct (id, text) in the order of texts; the corpus has one id with two long texts."""
    return sorted({(LAST_ID if i is None else i, t or "") for i, t in corpus})


def check(spark, docs, corpus, length):
    got = {}
    keys = docs.selectExpr("doc_id", "coalesce(text, '') AS t")
    order = {
        (LAST_ID if r.doc_id is None else r.doc_id, r.t): r.h
        for r in keys.selectExpr("doc_id", "t", "xxhash64(t) AS h").collect()
    }
    rows = sorted(by_order(corpus), key=lambda r: (r[0], order[r]))
    want = dict(zip(rows, cut([t.encode() for _, t in rows], length), strict=True))
    out = suffixes.strip_repeats(docs, length)
    assert out.columns == [*docs.columns, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    for r in out.collect():
        key = (LAST_ID if r.doc_id is None else r.doc_id, r.text or "")
        got.setdefault(key, set()).add((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert got == {k: {v} for k, v in want.items()}


def test_removed_bytes(spark, docs, corpus):
    check(spark, docs, corpus, 100)
    assert suffixes.strip_repeats(docs, keep_text=False).count() == len(corpus)
    assert suffixes.strip_repeats(docs.limit(0)).count() == 0


def test_hot_values_are_split(spark, docs, corpus, monkeypatch):
    monkeypatch.setattr(suffixes, "MOST_WINDOWS", 50)
    check(spark, docs, corpus, 40)


def test_a_line_with_other_neighbours_everywhere(spark, monkeypatch):
    """One line in every text: its windows are grouped before they meet, in parts on both join paths."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    line = " ".join(word() for _ in range(19))
    texts = [" ".join([*(word() for _ in range(12)), line, *(word() for _ in range(12))]) for _ in range(150)]
    corpus = list(enumerate([*texts, texts[3], line, "", None]))
    table = spark.createDataFrame(corpus, "doc_id long, text string")
    monkeypatch.setattr(suffixes, "MOST_WINDOWS", 300)
    check(spark, table, corpus, 100)
    monkeypatch.setattr("rankspark.session.BROADCAST_ROWS", 0)
    monkeypatch.setattr(suffixes, "fits", lambda small: False)
    monkeypatch.setattr("rankspark.session.fits", lambda small: False)
    check(spark, table, corpus, 100)


def test_anchors_go_by_content():
    """Equal windows have their anchor at one offset, wherever they stand; a run of one letter as well."""
    rng = np.random.default_rng(4)
    same = rng.integers(97, 101, 160, dtype=np.uint8)
    same[60:] = 97
    texts = [np.concatenate([rng.integers(97, 123, n, dtype=np.uint8), same]) for n in (0, 7, 300)]
    offsets = np.cumsum([0, *map(len, texts)])
    value, at, first, last, text = suffixes.anchors(np.concatenate(texts), offsets, 100)
    seen = {}
    for v, a, f, e, t in zip(*(c.tolist() for c in (value, at, first, last, text)), strict=True):
        for start in range(f, e + 1):
            inner = start - (offsets[t + 1] - 160)
            if inner >= 0:
                seen.setdefault(inner, set()).add((v, a - start))
            assert 0 <= a - start <= 68
    assert sorted(seen) == list(range(61)) and all(len(s) == 1 for s in seen.values())
    assert (last - first + 1).sum() == sum(len(t) - 99 for t in texts)
