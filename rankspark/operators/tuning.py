"""Smoothing parameters: tried on training topics, judged on held-out ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.functions.scoring import Model
from rankspark.operators.evaluate import METRICS, mean_nonzero, topic_metrics
from rankspark.operators.index import IDENTITY, Index
from rankspark.operators.retrieve import matches, summed, top_m
from rankspark.session import fits, keep, lookup_join

# The parameter grids.
JM_GRID = (0.001, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
DIR_GRID = (0.0, 500.0, 1000.0, 1500.0, 2000.0, 2500.0, 3000.0, 3500.0, 4000.0, 4500.0, 5000.0)

# Groups of documents whose best scores give the floor.  The more there are, the fewer
# documents share a group with one that ranks, and are scored a second time.
BLOCKS = 256


def grid(name: str) -> list[Model]:
    if name not in ("jm", "dir"):
        raise ValueError(f"no grid for model {name!r}")
    return [Model(name, p) for p in (JM_GRID if name == "jm" else DIR_GRID)]


def settings_runs(
    index: Index, terms: DataFrame, models: list[Model], n: int, field: str = "contents"
) -> DataFrame:
    """(model, param, topic_id, doc_id, copy_no, score, rank): top n of every setting.

    All settings are scored together.  Instead of sorting every (setting, topic,
    document), a first pass finds a floor: the best scores of ``BLOCKS`` groups
    of documents belong to that many different documents, hence the n-th largest
    of them is not above the n-th best score.  Only rows that reach the floor
    are ranked, and the result is exact.

    No score of the first pass is written, as there is one per topic, document and setting.
    The second pass scores again, and only the groups whose best reaches a floor.
    """
    named: Mapping[str, Model] = {f"s{i}": m for i, m in enumerate(models)}
    matched = matches(index, terms, field)
    blocks = max(BLOCKS, 4 * n)
    block = F.expr(f"pmod(xxhash64(doc_id), {blocks})")
    best = keep(
        summed(matched, named)
        .groupBy("topic_id", block.alias("block"))
        .agg(F.min("doc_id").alias("low"), *[F.max(c).alias(c) for c in named]),
        "block-bests",
    )
    floors = best.groupBy("topic_id").agg(
        F.expr(f"get(sort_array(collect_list(low)), {n - 1})").alias("ceiling"),
        *[
            F.expr(f"get(sort_array(collect_list({c}), false), {n - 1})").alias(f"floor_{c}")
            for c in named
        ],
    )
    # without a floor fewer than n groups matched, so every row may rank
    def reaching(key: str) -> dict[str, str]:
        return {
            c: f"coalesce({key} <= ceiling, true)" if m.flat else f"coalesce({c} >= floor_{c}, true)"
            for c, m in named.items()
        }

    within = reaching("doc_id")
    wanted = best.join(floors, "topic_id").filter(" OR ".join(reaching("low").values())).select("topic_id", "block")
    if fits(wanted):
        matched = matched.withColumn("block", block).join(F.broadcast(wanted), ["topic_id", "block"])
    rows = ", ".join(
        f"named_struct('model', '{m.name}', 'param', {float(m.param)}D, "
        f"'score', CASE WHEN {within[c]} THEN {c} END)"
        for c, m in named.items()
    )
    long = (
        lookup_join(summed(matched, named), floors, ["topic_id"], "doc_id", fits(floors))
        .filter(" OR ".join(within.values()))
        .selectExpr(
            "topic_id",
            *IDENTITY,
            f"inline(filter(array({rows}), x -> x.score IS NOT NULL))",
        )
    )
    # a run of n rows per setting and topic, which judging and listing read
    return keep(top_m(long, n, ("model", "param", "topic_id")), "settings")


def settings_metrics(
    index: Index,
    topics: DataFrame,
    terms: DataFrame,
    qrels: DataFrame,
    models: list[Model],
    n: int,
) -> DataFrame:
    """(model, param, topic_id, n_rel, P, R, MAP) for every setting and topic."""
    run = settings_runs(index, terms, models, n)
    settings = F.array(
        *[F.struct(F.lit(m.name).alias("model"), F.lit(float(m.param)).alias("param")) for m in models]
    )
    every = topics.select("topic_id", F.inline(settings))
    return topic_metrics(run, qrels, every, n, by=("model", "param"))


def leaderboard(metrics: DataFrame, metric: str = "MAP") -> DataFrame:
    """(model, param, value, place): settings by mean metric, best first.

    The mean skips topics with value 0 and is 0 if none is left; ties go to the
    smaller parameter.  At most one row per setting, so the window is tiny.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    means = metrics.groupBy("model", "param").agg(
        F.coalesce(mean_nonzero(F.col(metric)), F.lit(0.0)).alias("value")
    )
    order = Window.partitionBy("model").orderBy(F.desc("value"), "param")
    return means.withColumn("place", F.row_number().over(order))


def holdout(train: DataFrame, test: DataFrame, metric: str = "MAP") -> DataFrame:
    """(model, param, topic_id, value) of each model's best training setting.

    ``value`` keeps zeros, and counts a topic without judgements as 0.
    """
    best = leaderboard(train, metric).filter(F.col("place") == 1).select("model", "param")
    return test.join(F.broadcast(best), ["model", "param"]).select(
        "model", "param", "topic_id", F.coalesce(metric, F.lit(0.0)).alias("value")
    )


def holdout_mean(vectors: DataFrame) -> DataFrame:
    """(model, param, value): test mean over non-zero topics, 0 if there is none."""
    return vectors.groupBy("model", "param").agg(
        F.coalesce(mean_nonzero(F.col("value")), F.lit(0.0)).alias("value")
    )
