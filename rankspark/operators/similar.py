"""Similar documents and similar terms by cosine, for many seeds in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankspark.functions.exact import rank_key
from rankspark.operators.index import (
    IDENTITY,
    Index,
    at_documents,
    join_postings,
    join_terms,
    with_term_statistics,
)
from rankspark.operators.weights import weight
from rankspark.session import fits, keep, lookup_join


def _cosine(dot: Column, norm_a: Column, norm_b: Column) -> Column:
    return rank_key(
        F.try_divide(dot.cast("double"), F.sqrt(norm_a.cast("double")) * F.sqrt(norm_b.cast("double")))
    )


def similar_docs(
    index: Index, seeds: DataFrame, scheme: str = "tf", k: int = 10, field: str = "contents"
) -> DataFrame:
    """(seed_id, seed_copy, doc_id, copy_no, similarity, rank): the k nearest documents of each seed.

    ``seeds`` names documents in ``doc_id``; every copy of a key is a seed.  The term space is the seed's own,
    so a candidate's norm counts shared terms only.  Weights are whole numbers,
    hence all sums are exact.  Candidates without a shared weight are undefined
    and dropped; ties go to the smaller doc_id.
    """
    rows = index.postings.filter(F.col("field") == field).select(*IDENTITY, "term", "tf")
    # the seeds' term vectors are read once and used three times
    vectors = keep(at_documents(rows, seeds.select("doc_id").distinct()), "seed-vectors")
    small = fits(vectors)
    # df travels on the seed side: candidates hold the same terms
    own = with_term_statistics(index, vectors.withColumn("field", F.lit(field)), small).select(
        F.col("doc_id").alias("seed_id"),
        F.col("copy_no").alias("seed_copy"),
        "term",
        "df",
        "n_docs",
        weight(scheme).alias("seed_w"),
    )
    seed = ["seed_id", "seed_copy"]
    norms = (
        own.groupBy(*seed)
        .agg(F.sum(F.col("seed_w") * F.col("seed_w")).alias("norm_a"))
        .filter(F.col("norm_a") > 0)
    )
    shared = join_postings(index, own, small, field).filter(
        (F.col("doc_id") != F.col("seed_id")) | (F.col("copy_no") != F.col("seed_copy"))
    )
    w = weight(scheme)
    pairs = shared.groupBy(*seed, *IDENTITY).agg(
        F.sum(F.col("seed_w") * w).alias("dot"), F.sum(w * w).alias("norm_b")
    )
    scored = (
        lookup_join(pairs.filter(F.col("norm_b") > 0), norms, seed, "doc_id", small)
        .select(
            *seed,
            *IDENTITY,
            _cosine(F.col("dot"), F.col("norm_a"), F.col("norm_b")).alias("similarity"),
        )
    )
    order = Window.partitionBy(*seed).orderBy(F.desc("similarity"), *IDENTITY)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _term_norms(index: Index, scheme: str, field: str) -> DataFrame:
    """(term, norm_b) over the document axis; zero vectors left out."""
    stats = index.term_stats.filter(F.col("field") == field)
    if scheme == "bin":
        return stats.select("term", F.col("df").alias("norm_b"))
    if scheme == "tf":
        return stats.select("term", F.col("sum_tf2").alias("norm_b"))
    # tf-idf is cut to whole numbers, so its norm needs the tf values; a term has
    # few distinct ones, and the partial aggregation works on those
    tf_counts = (
        index.postings.filter(F.col("field") == field)
        .groupBy("field", "term", "tf")
        .agg(F.count("*").alias("n"))
    )
    w = weight(scheme)
    return (
        with_term_statistics(index, tf_counts, even=True)
        .groupBy("term")
        .agg(F.sum(F.col("n") * w * w).alias("norm_b"))
        .filter(F.col("norm_b") > 0)
    )


def similar_terms(
    index: Index, seeds: DataFrame, scheme: str = "tf", k: int = 10, field: str = "contents"
) -> DataFrame:
    """(seed_term, term, similarity, rank): the k nearest terms of each seed.

    ``seeds`` has a ``term`` column.  Seed postings meet all postings on
    ``doc_id``, on which the written table is bucketed.  Terms that share no
    document have similarity 0 and still rank, in term order; they can only
    appear when a seed has fewer than k neighbours, and then the first 2k terms
    of the vocabulary are certain to hold enough of them.  A common term is a neighbour
    of many seeds; its rows are split by seed where it meets its statistics and its norm.
    """
    rows = index.postings.filter(F.col("field") == field).select(*IDENTITY, "term", "tf")
    names = keep(
        seeds.select("term", F.lit(field).alias("field")).distinct(), "seed-terms"
    )
    small = fits(names)
    known = with_term_statistics(index, names, small).select("term", "df", "n_docs")
    own = (
        join_postings(index, known, small, field)
        .select(
            F.col("term").alias("seed_term"),
            "doc_id",
            F.col("copy_no").alias("seed_copy"),
            weight(scheme).alias("seed_w"),
        )
        .filter(F.col("seed_w") > 0)
    )
    # the rows are bucketed by doc_id alone: a second key would shuffle them
    met = own.join(rows, "doc_id").filter(F.col("copy_no") - F.col("seed_copy") == 0)
    norms = _term_norms(index, scheme, field)
    if scheme == "tfxidf":
        norms = keep(norms, "term-norms")
    seed_norms = lookup_join(norms, names.select("term"), ["term"], None, small).select(
        F.col("term").alias("seed_term"), F.col("norm_b").alias("norm_a")
    )
    if scheme == "tfxidf":
        # df is constant per term, so products are summed per (seed, term, tf)
        # and weighted once df is known
        by_tf = (
            met.filter(F.col("term") != F.col("seed_term"))
            .groupBy("seed_term", "term", "tf")
            .agg(F.sum("seed_w").alias("seed_w"))
        )
        stats = index.term_stats.filter(F.col("field") == field).select("term", "df")
        totals = index.field_stats.filter(F.col("field") == field).select("n_docs")
        dots = (
            join_terms(index, by_tf, stats, "seed_term", field)
            .withColumn("n_docs", totals.scalar())
            .groupBy("seed_term", "term")
            .agg(F.sum(F.col("seed_w") * weight(scheme)).alias("dot"))
            .filter(F.col("dot") > 0)
        )
    else:
        dots = (
            met.filter(F.col("term") != F.col("seed_term"))
            .groupBy("seed_term", "term")
            .agg(F.sum(F.col("seed_w") * weight(scheme)).alias("dot"))
        )
    order = Window.partitionBy("seed_term").orderBy(F.desc("similarity"), "term")
    near = (
        lookup_join(join_terms(index, dots, norms, "seed_term", field), seed_norms, ["seed_term"], "term", small)
        .select(
            "seed_term",
            "term",
            _cosine(F.col("dot"), F.col("norm_a"), F.col("norm_b")).alias("similarity"),
        )
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .drop("rank")
    )
    near = keep(near, "near-terms")
    # at most k neighbours per seed: a seed that has fewer gets zero-similarity terms
    found = (
        seed_norms.join(near, "seed_term", "left")
        .groupBy("seed_term")
        .agg(F.collect_set("term").alias("found"))
        .filter(F.size("found") < k)
    )
    first_terms = norms.select("term").orderBy("term").limit(2 * k).agg(
        F.sort_array(F.collect_list("term"))
    )
    zeros = (
        found.withColumn("term", F.explode(first_terms.scalar()))
        .filter(
            (F.col("term") != F.col("seed_term"))
            & ~F.array_contains("found", F.col("term"))
        )
        .select("seed_term", "term", F.lit(0.0).alias("similarity"))
    )
    return (
        near.unionByName(zeros)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )
