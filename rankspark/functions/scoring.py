"""Ranking formulas for one (topic term, document) match.

Each takes the match columns ``weight, tf, doc_len, df, cf`` and the field
totals ``n_docs_with_field, sum_cf``, and gives the contribution of one term.
None falls with ``tf`` or grows with ``doc_len`` while weights are not negative, so the
largest values that a term's postings have bound its contribution to any score.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def tfidf_score(tf: Column, doc_len: Column) -> Column:
    idf = 1 + F.ln((F.col("n_docs_with_field") + 1) / (F.col("df") + 1))
    return F.col("weight") * F.sqrt(tf) * idf / F.sqrt(doc_len)


def _collection_probability() -> Column:
    return (F.col("cf") + 1) / (F.col("sum_cf") + 1)


def jelinek_mercer_score(tf: Column, doc_len: Column, lam: float) -> Column:
    seen = F.lit(1.0 - lam) * tf / doc_len
    return F.col("weight") * F.ln(1 + seen / (F.lit(lam) * _collection_probability()))


def dirichlet_score(tf: Column, doc_len: Column, mu: float) -> Column:
    if mu == 0:
        return F.lit(0.0)
    gain = F.ln(1 + tf / (F.lit(mu) * _collection_probability()))
    length = F.ln(F.lit(mu) / (doc_len + F.lit(mu)))
    return F.col("weight") * F.greatest(F.lit(0.0), gain + length)


@dataclass(frozen=True)
class Model:
    """A retrieval model: ``tfidf``, ``jm`` with lambda, or ``dir`` with mu."""

    name: str
    param: float | None = None

    def __post_init__(self) -> None:
        if self.name not in ("tfidf", "jm", "dir"):
            raise ValueError(f"unknown model {self.name!r}")
        if self.name == "jm" and not (self.param and 0 < self.param <= 1):
            raise ValueError("jm needs a lambda in (0, 1]")
        if self.name == "dir" and (self.param is None or self.param < 0):
            raise ValueError("dir needs a mu >= 0")

    @property
    def flat(self) -> bool:
        """True if every match scores 0, so that only doc_id ranks."""
        return (self.name == "jm" and self.param == 1) or (
            self.name == "dir" and self.param == 0
        )

    def _score(self, tf: Column, doc_len: Column) -> Column:
        if self.name == "tfidf":
            return tfidf_score(tf, doc_len)
        if self.name == "jm":
            return jelinek_mercer_score(tf, doc_len, self.param)
        return dirichlet_score(tf, doc_len, self.param)

    def contribution(self) -> Column:
        return self._score(F.col("tf"), F.col("doc_len"))

    def bound(self) -> Column:
        """No less than any contribution of a term with ``max_tf``, ``max_rate`` and ``min_len``."""
        if self.name == "dir":
            return self._score(F.col("max_tf"), F.col("min_len"))
        # these read nothing but the share of the document that is the term
        return self._score(F.col("max_rate"), F.lit(1.0))
