"""Precision, recall and average precision of runs against judgements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.functions.exact import exact_sum, rank_key

METRICS = ("P", "R", "MAP")


def judged(run: DataFrame, qrels: DataFrame) -> DataFrame:
    """The run with ``relevant`` (1 or 0); ``qrels`` holds each pair once.

    Both keys are unique pairs, so the join has no hot key; judgements are
    never broadcast because they grow with the collection.
    """
    marks = qrels.select("topic_id", "doc_id", F.lit(1).alias("relevant"))
    return run.join(marks, ["topic_id", "doc_id"], "left").withColumn(
        "relevant", F.coalesce("relevant", F.lit(0))
    )


def relevant_counts(qrels: DataFrame) -> DataFrame:
    return qrels.groupBy("topic_id").agg(F.count("*").alias("n_rel"))


def relevant_list(qrels: DataFrame) -> DataFrame:
    """(topic_id, doc_id) in topic order.

    Kept as rows: one topic may hold a large share of all judgements.
    """
    return qrels.select("topic_id", "doc_id").distinct().orderBy("topic_id", "doc_id")


def topic_metrics(
    run: DataFrame,
    qrels: DataFrame,
    topics: DataFrame,
    n: int,
    by: Sequence[str] = (),
    m: int | None = None,
) -> DataFrame:
    """(by..., topic_id, n_rel, P, R, MAP) at cut-off n for every topic.

    P divides by n even when fewer documents were found; R and the average
    precision divide by the number of relevant documents and are NULL without
    any.  Only ranks up to min(n, m) count.  ``by`` names run columns that tell
    systems apart; systems without a single hit must come in through ``topics``.
    """
    depth = n if m is None else min(n, m)
    keys = [*by, "topic_id"]
    ahead = Window.partitionBy(*keys).orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    hits = judged(run.filter(F.col("rank") <= depth), qrels).withColumn(
        "found", F.sum("relevant").over(ahead)
    )
    found = hits.groupBy(*keys).agg(
        F.sum("relevant").alias("found"),
        exact_sum(F.col("relevant") * F.col("found") / F.col("rank")).alias("sum_p"),
    )
    base = topics.select(*[c for c in keys if c in topics.columns]).distinct()
    return (
        base.join(found, [c for c in keys if c in base.columns], "left")
        .join(relevant_counts(qrels), "topic_id", "left")
        .select(
            *keys,
            F.coalesce("n_rel", F.lit(0)).alias("n_rel"),
            rank_key(F.coalesce("found", F.lit(0)) / F.lit(n)).alias("P"),
            rank_key(F.try_divide(F.coalesce("found", F.lit(0)), "n_rel")).alias("R"),
            rank_key(F.try_divide(F.coalesce("sum_p", F.lit(0.0)), "n_rel")).alias("MAP"),
        )
    )


def mean_nonzero(value) -> F.Column:
    """Mean over the topics whose value is not 0; NULL if there is none."""
    some = (value != 0) & value.isNotNull()
    return rank_key(F.try_divide(exact_sum(F.when(some, value)), F.count_if(some)))


def mean_metrics(metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., P, R, MAP): means over topics whose value is not 0."""
    return metrics.groupBy(*by).agg(*[mean_nonzero(F.col(c)).alias(c) for c in METRICS])


def listing(run: DataFrame, qrels: DataFrame, docs: DataFrame) -> DataFrame:
    """(topic_id, rank, doc_id, score, relevant, snippet) in rank order."""
    from rankspark.operators.retrieve import stored_fields

    shown = stored_fields(judged(run, qrels), docs, ["snippet"])
    return shown.select(
        "topic_id", "rank", "doc_id", "score", "relevant", "snippet"
    ).orderBy("topic_id", "rank")
