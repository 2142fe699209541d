import itertools
import sys
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import corpus, docs  # noqa: F401
from rankspark.llm import packing


def least_cost(positions, penalties, capacity):
    """Least cost over all ways to cut, the last window open."""
    best = None
    inner = list(zip(positions, penalties, strict=True))
    for k in range(len(inner) + 1):
        for chosen in itertools.combinations(inner, k):
            bounds = [0, *(p for p, _ in chosen)]
            sizes = np.diff(bounds)
            if (sizes > capacity).any() or positions[-1] - bounds[-1] > capacity:
                continue
            cost = sum(c for _, c in chosen) + sum(capacity - s for s in sizes)
            best = cost if best is None else min(best, cost)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.sampled_from([0.0, 2.0, 5.0])), min_size=1, max_size=9))
def test_cuts_cost_least(steps):
    positions = np.cumsum([s for s, _ in steps]).tolist()
    penalties = [c for _, c in steps]
    cuts = packing.cut_windows(positions, penalties, 9)
    sizes = np.diff([0, *cuts])
    assert (sizes <= 9).all() and positions[-1] - (cuts[-1] if cuts else 0) <= 9
    cost = sum(penalties[positions.index(c)] for c in cuts) + sum(9 - s for s in sizes)
    assert cost == least_cost(positions, penalties, 9)


def test_tail():
    assert packing.tail_windows(4096, 4096, 16) == [4096]
    assert packing.tail_windows(12, 4096, 16) == [8, 4]
    assert packing.tail_windows(4095, 4096, 16) == [4095]
    assert packing.tail_windows(0, 4096, 16) == []


def test_pieces_hold_all_ids(docs, corpus):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(
        ([-1 if i is None else i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in corpus)
    )
    pieces = packing.pack(docs, capacity=64, block=256, with_ids=True).toPandas()
    lengths = pieces.groupby("sequence_id").length.sum()
    assert lengths.max() <= 64
    for _, s in pieces.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]]
    got, open_docs = [], []
    # pieces of a document follow each other, so documents with one id do not mix
    for r in pieces.sort_values(["sequence_id", "offset"]).itertuples():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        if r.start == 0:
            open_docs.append([-1 if r.doc_id != r.doc_id else int(r.doc_id)])
        assert len(open_docs[-1]) - 1 == r.start
        open_docs[-1] += list(r.ids)
        if r.start + r.length == r.doc_tokens:
            got.append(open_docs[-1])
    assert sorted(got) == want
    full = np.where(lengths & (lengths - 1) == 0, lengths, 64)
    assert 1 - lengths.sum() / full.sum() < 0.05
    assert packing.pack(docs.limit(0)).count() == 0


def test_few_calls_for_each_cut():
    """The search is one plain loop: what it calls for each place decides the operator's CPU time."""
    rng = np.random.default_rng(5)
    ends = np.cumsum(rng.integers(20, 900, 300))
    stops = np.unique(rng.integers(1, ends[-1], int(ends[-1]) // 12))
    calls = [0]

    def count(_frame, event, _arg):
        calls[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        at, penalty = packing.place_cuts(stops, ends, 4096, 2.0, 16.0)
        packing.cut_windows(at.tolist(), penalty.tolist(), 4096)
    finally:
        sys.setprofile(None)
    assert calls[0] < 2 * len(at)
