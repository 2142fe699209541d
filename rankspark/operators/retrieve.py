"""Ranked retrieval for whole batches of topics.

Two ways lead to the same run.  Where few postings hold a topic word, every matching
document is scored.  Where many do, most of them hold common words only and cannot come
near the top, so they are not scored:

1. The rarest words of a topic lead to m documents.  The least of their whole scores is a
   floor: what stays below it is not among the m best.
2. The floor, less a hair, is dealt out to the topic's words as allotments, most of it to
   the common ones, and never more to a word than its postings can contribute.  A document
   whose every match stays within its word's allotment stays below the floor.
3. Documents with a match above its allotment are candidates; only they are scored.

The second way reads the postings four times.  It pays for topics of few words; with many
common words nearly every document has some match above its share of the floor.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.functions import analysis
from rankspark.functions.exact import from_units, total_units, units
from rankspark.functions.scoring import Model
from rankspark.operators.index import (
    IDENTITY,
    Index,
    at_documents,
    join_postings,
    with_term_statistics,
)
from rankspark.session import fits, keep, lookup_join


def topic_terms(topics: DataFrame, stopwords: Sequence[str] = ()) -> DataFrame:
    """(topic_id, term, weight): the words of each topic, repeats added up.

    Words such as AND, OR and NOT are terms like any other.
    """
    words = topics.select(
        "topic_id", F.explode_outer(analysis.tokens(F.col("text"), stopwords)).alias("term")
    ).filter(F.col("term").isNotNull())
    return words.groupBy("topic_id", "term").agg(
        F.count("*").cast("double").alias("weight")
    )


def topic_range(topics: DataFrame, which: str = "all") -> DataFrame:
    """Topics by number: ``all``, one number, or ``first-last``."""
    if which.lower() == "all":
        return topics
    first, _, last = which.partition("-")
    return topics.filter(F.col("topic_id").between(int(first), int(last or first)))


# Matching postings from which on, and words a topic up to which, the second way is taken.
PRUNE_ROWS = 20_000_000
PRUNE_WORDS = 8
# Postings of a topic's rarest words, as a multiple of m, that lead to the floor.
LOOK = 16
# Units (see ``exact``) below the floor that rounding can lift a score, and a bound's own error.
HAIR = 200


def known_terms(index: Index, terms: DataFrame, small: bool, field: str) -> DataFrame:
    """The topic terms that the field has, with their statistics and the field's totals."""
    named = terms.withColumn("field", F.lit(field))
    return with_term_statistics(index, named, small).drop("field")


def matches(index: Index, terms: DataFrame, field: str = "contents") -> DataFrame:
    """One row per (topic term, posting), with everything a model reads."""
    small = fits(terms)
    # one statistics row per topic term, so what fits before fits after
    return join_postings(index, known_terms(index, terms, small, field), small, field)


def match_any(index: Index, terms: DataFrame, field: str = "contents") -> DataFrame:
    """(topic_id, doc_id, copy_no, n_terms): documents holding at least one topic term."""
    words = terms.select("topic_id", "term")
    return (
        join_postings(index, words, fits(words), field)
        .groupBy("topic_id", *IDENTITY)
        .agg(F.count("*").alias("n_terms"))
    )


def scores(
    index: Index, terms: DataFrame, models: Mapping[str, Model], field: str = "contents"
) -> DataFrame:
    """(topic_id, doc_id, copy_no, one score column per model) from a single pass.

    Documents that match with score 0 are kept.
    """
    return summed(matches(index, terms, field), models)


def summed(rows: DataFrame, models: Mapping[str, Model]) -> DataFrame:
    sums = [total_units(units(m.contribution())).alias(name) for name, m in models.items()]
    whole = rows.groupBy("topic_id", *IDENTITY).agg(*sums)
    return whole.select("topic_id", *IDENTITY, *[from_units(name).alias(name) for name in models])


def top_m(scored: DataFrame, m: int, by: Sequence[str] = ("topic_id",)) -> DataFrame:
    """Adds ``rank`` and keeps the m best per topic; ties go to the smaller doc_id.

    Spark drops rows before the shuffle only for m up to a thousand or so.  Beyond, a first
    pass finds a floor: of the documents dealt into 4 m blocks, the best of m blocks are m
    different documents, so nothing behind the m-th of them is among the m best.  Tasks
    send one row per block, and then little more than m rows of a topic reach the ranking.
    """
    own = [c for c in IDENTITY if c in scored.columns]
    limit = int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if m > limit:
        # the order of the ranking, as one value that ascends
        scored = keep(scored.withColumn("place", F.struct((-F.col("score")).alias("score"), *own)), "scored")
        block = F.pmod(F.xxhash64(*own), F.lit(4 * m)).alias("block")
        first = scored.groupBy(*by, block).agg(F.min("place").alias("place"))
        floors = first.groupBy(*by).agg(F.get(F.sort_array(F.collect_list("place")), m - 1).alias("floor"))
        near = scored.join(F.broadcast(floors) if fits(floors) else floors, list(by))
        # without a floor fewer than m blocks have documents, so every row may rank
        scored = near.filter(F.col("floor").isNull() | (F.col("place") <= F.col("floor"))).drop("place", "floor")
    order = Window.partitionBy(*by).orderBy(F.desc("score"), *own)
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= m)


def _floors(index: Index, known: DataFrame, model: Model, m: int, field: str) -> DataFrame:
    """(topic_id, floor): units that m documents of the topic reach.

    They are the m best by the topic's rarest words, with their whole scores.
    """
    by_df = Window.partitionBy("topic_id").orderBy("df", "term")
    before = F.coalesce(F.sum("df").over(by_df.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rare = known.withColumn("before", before).filter(F.col("before") < LOOK * m).drop("before")
    score = total_units(units(model.contribution())).alias("score")
    part = join_postings(index, rare, True, field).groupBy("topic_id", *IDENTITY).agg(score)
    best = keep(top_m(part, m).select("topic_id", *IDENTITY), "first-look")
    whole = lookup_join(join_postings(index, known, True, field), best, ["topic_id", *IDENTITY])
    found = whole.groupBy("topic_id", *IDENTITY).agg(score).groupBy("topic_id").agg(
        F.min("score").alias("floor"), F.count("*").alias("n")
    )
    return found.filter(F.col("n") >= m).select("topic_id", "floor")


def allotments(known: DataFrame, floors: DataFrame, model: Model) -> DataFrame:
    """``known`` with ``bound`` and ``allot`` in units; a topic's allotments stay below its floor.

    The floor is dealt out by df; what a word cannot use, because its bound is lower, goes
    to the others.  Topics without a floor get allotments below every contribution.
    """
    topic = Window.partitionBy("topic_id")
    low = F.greatest(F.col("floor") - HAIR, F.lit(-1))
    dealt = (
        known.join(F.broadcast(floors), "topic_id", "left")
        .withColumn("bound", units(model.bound()) + HAIR)
        .withColumn("low", F.coalesce(low, F.lit(-1)).cast("double"))
        .withColumn("even", F.col("low") * F.col("df") / F.sum("df").over(topic))
        .withColumn("left", F.sum(F.greatest(F.col("even") - F.col("bound"), F.lit(0.0))).over(topic))
        .withColumn("needs", F.when(F.col("bound") > F.col("even"), F.col("df")).otherwise(0))
    )
    more = F.col("even") + F.coalesce(F.try_divide(F.col("left") * F.col("needs"), F.sum("needs").over(topic)), F.lit(0.0))
    # shaved for what doubles lose, so that the whole numbers add up to less than the floor
    allot = F.floor(F.least(more, F.col("bound").cast("double")) * F.lit(1 - 1e-9)).cast("bigint")
    return dealt.withColumn("allot", F.when(F.col("low") <= 0, F.lit(-1)).otherwise(allot)).drop(
        "floor", "low", "even", "left", "needs"
    )


def candidates(index: Index, dealt: DataFrame, model: Model, field: str = "contents") -> DataFrame:
    """(topic_id, doc_id, copy_no) of documents with a match above its word's allotment."""
    reach = dealt.filter(F.col("bound") > F.col("allot")).drop("bound")
    above = join_postings(index, reach, True, field).filter(units(model.contribution()) > F.col("allot"))
    return above.select("topic_id", *IDENTITY).distinct()


def _pruned_scores(index: Index, known: DataFrame, model: Model, m: int, field: str) -> DataFrame:
    """(topic_id, doc_id, copy_no, score) of all documents that can be among the m best."""
    bounds = index.term_bounds.filter(F.col("field") == field).drop("field")
    bounded = keep(bounds.join(F.broadcast(known), "term"), "bounded-terms")
    dealt = keep(allotments(bounded, _floors(index, bounded, model, m, field), model), "allotments")
    chosen = candidates(index, dealt, model, field).select(
        F.col("topic_id").alias("topic"), "doc_id", F.col("copy_no").alias("copy")
    )
    rows = join_postings(index, known, True, field)
    # equal by doc_id alone, on which both sides lie already, so that neither is shuffled
    same = F.col("rows.doc_id") == F.col("chosen.doc_id")
    for left, right in (("topic_id", "topic"), ("copy_no", "copy")):
        same &= (F.col(left) <= F.col(right)) & (F.col(left) >= F.col(right))
    some = rows.alias("rows").join(chosen.alias("chosen").hint("shuffle_hash"), same, "left_semi")
    summed = some.groupBy("topic_id", *IDENTITY).agg(total_units(units(model.contribution())).alias("score"))
    return summed.withColumn("score", from_units("score"))


def search(
    index: Index,
    terms: DataFrame,
    model: Model,
    m: int,
    field: str = "contents",
    prune: bool | None = None,
) -> DataFrame:
    """(topic_id, doc_id, copy_no, score, rank): the run of one model.

    ``prune`` says whether documents that cannot reach the top are left out before they
    are scored; by default that is done from ``PRUNE_ROWS`` matching postings on, which
    the statistics tell, for topics of ``PRUNE_WORDS`` words on average at most.  It needs topics that fit a broadcast and weights that are not
    negative, and a model that tells documents apart; else every match is scored.
    """
    if prune is False or model.flat or not fits(terms):
        return top_m(scores(index, terms, {"score": model}, field), m)
    known = keep(known_terms(index, terms, True, field), "known-terms")
    told = known.agg(
        F.sum("df").alias("rows"),
        F.min("weight").alias("least"),
        (F.count("*") / F.count_distinct("topic_id")).alias("words"),
    ).first()
    worth = told.rows is not None and told.rows >= PRUNE_ROWS and told.words <= PRUNE_WORDS
    if not (worth if prune is None else prune) or told.rows is None or told.least < 0:
        return top_m(summed(join_postings(index, known, True, field), {"score": model}), m)
    return top_m(_pruned_scores(index, known, model, m, field), m)


def total_hits(index: Index, terms: DataFrame, field: str = "contents") -> DataFrame:
    """(topic_id, hits): exact number of matching documents."""
    return match_any(index, terms, field).groupBy("topic_id").agg(F.count("*").alias("hits"))


def stored_fields(run: DataFrame, docs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The run with columns of its documents; only those columns are read."""
    run = keep(run, "run")
    own = [c for c in IDENTITY if c in run.columns and c in docs.columns]
    return at_documents(docs.select(*own, *columns), run).select(*run.columns, *columns)
