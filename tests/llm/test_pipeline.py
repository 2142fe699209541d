import random

import corpus_pipeline
from llm_helpers import invent
from pyspark.sql import functions as F
from test_jaccard import groups
from test_suffixes import cut


def test_stages_on_a_small_corpus(spark, tmp_path):
    rng = random.Random(8)
    items = [(i, invent(rng, 40)) for i in range(3)]
    passage = invent(rng, 60)
    rows = [(i, invent(rng, 90)) for i in range(40)]
    rows += [(50, rows[0][1]), (51, rows[1][1].replace(rows[1][1].split()[44], "zzz", 1))]
    rows += [(60 + i, f"{invent(rng, 50)} {passage} {invent(rng, 20)}") for i in range(3)]
    rows += [(70 + i, f"{invent(rng, 50)} {t} {invent(rng, 20)}") for i, t in items]
    rows += [(80, None), (81, ""), (82, "123 456")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # brute force, stage by stage
    want = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    _, group = groups(want, 5, 80)
    want = [r for k, r in enumerate(want) if group.index(group[k]) == k]
    gone = cut([t.encode() for _, t in want], 100)
    left = [(i, g[0] - g[1]) for (i, _), g in zip(want, gone, strict=True) if g[1] < g[0]]
    left = [(i, n) for i, n in left if not 70 <= i < 80]
    table, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path))
        assert table.columns == columns, name
    got = table.select("doc_id", F.octet_length("text").alias("n")).collect()
    assert sorted(map(tuple, got)) == sorted(left)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert sorted(pieces.doc_id.unique()) == sorted(i for i, _ in left)
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_strings", "benchmark_leaks", "packing"]


CLASHES = ("score", "lang_pred", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256", "_text", "_doc", "_content", "_maybe", "key", "a.b", "carried_0")


def test_stages_leave_clashing_columns_alone(spark, tmp_path):
    """Names of results and helpers, null ids and texts, repeated rows."""
    rng = random.Random(9)
    passage = invent(rng, 60)
    texts = [f"{invent(rng, 50)} {passage} {invent(rng, 20)}" for _ in range(3)] + [invent(rng, 80) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, invent(rng, 70)), (None, invent(rng, 70)), (30, None), (6, texts[6])]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    more = ", ".join(f"`{c}` string" for c in CLASHES)
    data = [(i, t, "en", "s", len(t or ""), *[f"{c} of {i}" for c in CLASHES]) for i, t in rows]
    docs = spark.createDataFrame(data, f"{kinds}, {more}")
    spark.createDataFrame([(1, invent(rng, 40)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for empty in (False, True):
        table = docs.limit(0) if empty else docs
        counts = []
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, str(tmp_path))
            assert out.columns == docs.columns, name
            table = spark.createDataFrame(out.collect(), docs.schema)
            for r in table.collect():
                assert all(r[c] == f"{c} of {r.doc_id}" for c in CLASHES), name
                assert r.n_chars == len(r.text)
            counts.append(table.count())
        # the row without text goes first, then the repeated row; the passage is cut from two texts
        assert counts == ([0] * 4 if empty else [26, 25, 25, 25])
        pieces = corpus_pipeline.STAGES[-1][1](spark, table, str(tmp_path))
        assert pieces.select("doc_id").distinct().count() == (0 if empty else 24)
