"""Query expansion from judged documents, and its residual evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.functions import analysis
from rankspark.functions.exact import exact_sum, rank_key
from rankspark.functions.scoring import Model
from rankspark.operators.evaluate import judged, topic_metrics
from rankspark.operators.index import IDENTITY, Index, at_documents, with_term_statistics
from rankspark.operators.retrieve import search
from rankspark.operators.weights import tfidf
from rankspark.session import fits, keep


def feedback_docs(run: DataFrame, qrels: DataFrame, s: int) -> DataFrame:
    """(topic_id, doc_id, copy_no, score, place): the first s relevant documents of a run."""
    order = Window.partitionBy("topic_id").orderBy("rank")
    return (
        judged(run, qrels)
        .filter(F.col("relevant") == 1)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= s)
        .select("topic_id", *[c for c in IDENTITY if c in run.columns], "score", "place")
    )


def term_values(index: Index, chosen: DataFrame, field: str = "contents") -> DataFrame:
    """(topic_id, term, value): sum of tf-idf times document score over ``chosen``."""
    rows = index.postings.filter(F.col("field") == field).select(
        "field", *IDENTITY, "term", "tf"
    )
    own = [c for c in IDENTITY if c in chosen.columns]
    picked = at_documents(rows, chosen.select("topic_id", *own, "score"))
    # the chosen documents' terms are few: bring df to them
    vectors = keep(picked, "feedback-vectors")
    return (
        with_term_statistics(index, vectors, fits(vectors))
        .groupBy("topic_id", "term")
        .agg(rank_key(exact_sum(tfidf() * F.col("score"))).alias("value"))
    )


def best_values(values: DataFrame, t: int) -> DataFrame:
    """The t best terms of each topic; ties go to the smaller term."""
    order = Window.partitionBy("topic_id").orderBy(F.desc("value"), "term")
    return values.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= t)


def expanded_query(
    topics: DataFrame, best: DataFrame, beta: float, digits: int | None = 2
) -> DataFrame:
    """(topic_id, term, weight): original words and expansion terms together.

    Each occurrence of an original word weighs beta / number of words; an
    expansion term weighs its share of the kept values times 1 - beta.  Both
    are rounded to ``digits`` (None: exact) before equal terms are added up.
    """
    if not 0 <= beta <= 1:
        raise ValueError("beta must lie in [0, 1]")

    def rounded(w):
        return w if digits is None else F.round(w, digits)

    words = F.filter(F.split("text", " "), lambda w: w != "")
    original = (
        topics.select("topic_id", words.alias("words"))
        .select("topic_id", F.size("words").alias("n"), F.explode("words").alias("word"))
        .select(
            "topic_id",
            F.explode_outer(analysis.tokens(F.col("word"))).alias("term"),
            rounded(F.lit(beta) / F.col("n")).alias("weight"),
        )
        .filter(F.col("term").isNotNull())
    )
    total = F.sum("value").over(Window.partitionBy("topic_id"))
    share = F.try_divide(F.lit(1.0 - beta) * F.col("value"), total)
    expansion = best.select(
        "topic_id", "term", rounded(F.coalesce(share, F.lit(0.0))).alias("weight")
    )
    return (
        original.unionByName(expansion)
        .groupBy("topic_id", "term")
        .agg(rank_key(exact_sum(F.col("weight"))).alias("weight"))
    )


def feedback_search(
    index: Index,
    topics: DataFrame,
    terms: DataFrame,
    qrels: DataFrame,
    model: Model,
    n: int,
    m: int,
    s: int,
    t: int,
    beta: float,
    residual: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(run, metrics) of the expanded queries.

    With ``residual`` the feedback documents leave the judgements; they still
    take up ranks.
    """
    if m < n:
        raise ValueError(f"depth {m} is smaller than the cut-off {n}")
    chosen = keep(feedback_docs(search(index, terms, model, m), qrels, s), "feedback-docs")
    best = best_values(term_values(index, chosen), t)
    query = keep(expanded_query(topics, best, beta), "expanded-query")
    run = search(index, query, model, m)
    judgements = qrels
    if residual:
        judgements = qrels.join(
            chosen.select("topic_id", "doc_id"), ["topic_id", "doc_id"], "left_anti"
        )
    return run, topic_metrics(run, judgements, topics, n, m=m)
