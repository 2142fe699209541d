"""Term weights of documents and vector normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankspark.functions.exact import rank_key
from rankspark.operators.index import IDENTITY, Index, with_term_statistics

SCHEMES = ("bin", "tf", "tfxidf")


def tfidf(tf: str = "tf", df: str = "df", n_docs: str = "n_docs") -> Column:
    return F.col(tf) * F.log10(F.col(n_docs) / F.col(df))


def weight(scheme: str, tf: str = "tf", df: str = "df", n_docs: str = "n_docs") -> Column:
    """Whole-number weight: 1, tf, or tf-idf cut toward zero."""
    if scheme == "bin":
        return F.lit(1).cast("bigint")
    if scheme == "tf":
        return F.col(tf)
    if scheme == "tfxidf":
        return tfidf(tf, df, n_docs).cast("bigint")
    raise ValueError(f"unknown weighting {scheme!r}")


def weighted_postings(index: Index, field: str = "contents") -> DataFrame:
    """(field, doc_id, copy_no, term, tf, df, n_docs) for every posting of a field."""
    rows = index.postings.filter(F.col("field") == field).select(
        "field", *IDENTITY, "term", "tf"
    )
    return with_term_statistics(index, rows)


def l1_normalized(vectors: DataFrame, key: str = "doc_id", value: str = "w") -> DataFrame:
    """Divides each weight by the sum of absolute weights of its vector.

    A zero vector gives NULL.  A vector is one document's terms, so its window
    is bounded by the document.
    """
    keys = [key, "copy_no"] if key == "doc_id" and "copy_no" in vectors.columns else [key]
    total = F.sum(F.abs(value)).over(Window.partitionBy(*keys))
    return vectors.withColumn("w_l1", F.try_divide(F.col(value).cast("double"), total))


def best_terms(index: Index, n: int = 5) -> DataFrame:
    """(field, doc_id, copy_no, term, tf, df, tfidf, rank): top n terms by tf-idf.

    Ties go to the smaller term.  The window limit keeps at most n rows per
    document and task before anything is shuffled for ranking.
    """
    rows = index.postings.select("field", *IDENTITY, "term", "tf")
    scored = with_term_statistics(index, rows).select(
        "field", *IDENTITY, "term", "tf", "df", rank_key(tfidf()).alias("tfidf")
    )
    order = Window.partitionBy("field", *IDENTITY).orderBy(F.desc("tfidf"), "term")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def best_terms_text(index: Index, n: int = 5) -> DataFrame:
    """(field, doc_id, copy_no, best_terms): ``term (tf df tfidf) `` in rank order."""
    entry = F.format_string(
        "%s (%d %d %.3f) ", F.col("term"), F.col("tf"), F.col("df"), F.col("tfidf")
    )
    ranked = best_terms(index, n).select(
        "field", *IDENTITY, F.struct("rank", entry.alias("entry")).alias("ranked")
    )
    joined = F.array_join(
        F.transform(F.sort_array(F.collect_list("ranked")), lambda r: r["entry"]), ""
    )
    return ranked.groupBy("field", *IDENTITY).agg(joined.alias("best_terms"))


def enriched_docs(index: Index, fields: list[str], n: int = 5) -> DataFrame:
    """Documents with a ``best_terms_<field>`` column per field."""
    text = best_terms_text(index, n)
    per_doc = text.groupBy(*IDENTITY).agg(
        *[
            F.max(F.when(F.col("field") == f, F.col("best_terms"))).alias(f"best_terms_{f}")
            for f in fields
        ]
    )
    # equal by doc_id alone, on which the texts are bucketed, so that they are not shuffled
    best = per_doc.withColumnsRenamed({"doc_id": "best_doc", "copy_no": "best_copy"})
    copy, other = F.col("copy_no"), F.col("best_copy")
    same = (F.col("doc_id") == F.col("best_doc")) & (copy <= other) & (copy >= other)
    joined = index.docs.join(best, same, "left")
    return joined.select(
        *index.docs.columns,
        *[F.coalesce(f"best_terms_{f}", F.lit("")).alias(f"best_terms_{f}") for f in fields],
    )
