"""From raw documents to packed training sequences, stage by stage.

Every stage but the last returns the columns of ``documents``; what it leaves out is gone
for all that follow.  Stages are written to the shared folder and read again, so each is
computed once and a lost executor costs only tasks of the running stage.

For all stages: a null text counts as empty; a null doc_id comes after all others; rows of
one id are documents of their own, rows equal in id and text count as one text; texts of
any length are worked on whole; an empty table gives an empty result.  Further columns
travel under other names inside a stage, so that none is lost or overwritten, whatever it
is called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.llm import decontaminate, jaccard, language, packing, suffixes
from rankspark.llm.ship import ship_package
from rankspark.session import keep


def _carry(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with plain names for all columns but doc_id and text, and the way back."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    plain = {c: f"carried_{i}" for i, c in enumerate(others)} | {"doc_id": "doc_id", "text": "text"}
    quoted = lambda name: F.col(f"`{name}`")
    carried = docs.select(*[quoted(c).alias(n) for c, n in plain.items()])
    return carried, lambda df: df.select(*[quoted(plain[c]).alias(c) for c in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and texts of which no n-gram belongs to a known language.

    A null or empty text has no letters.  Without a labelled text no language is known and
    all texts go.
    """
    ship_package(spark)
    model = language.learn(docs.filter(~language.held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    carried, back = _carry(docs)
    told = language.predict(carried, model)
    return back(told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") > 0)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of linked texts (five-word shingles, similarity 0.8).

    That of least doc_id stays; among equal ids the texts' hashes decide, and of rows equal
    in id and text one stays.  Texts without words link with nothing and stay.
    """
    ship_package(spark)
    carried, back = _carry(docs)
    return back(jaccard.one_per_group(carried, size=5, percent=80))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out bytes covered by 100-byte strings that start earlier; emptied documents go.

    Empty and null texts have nothing to cut and stay as they are.  ``n_chars`` follows the
    text where it is cut.
    """
    ship_package(spark)
    carried, back = _carry(docs)
    told = suffixes.strip_repeats(carried, length=100)
    left = told.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    # a cut inside a character leaves bytes that are no text
    text = F.when(F.col("n_removed") > 0, F.make_valid_utf8(F.col("kept").cast("string"))).otherwise(F.col("text"))
    cut = left.withColumn("text", text)
    if "n_chars" in docs.columns:
        n_chars = f"carried_{[c for c in docs.columns if c not in ('doc_id', 'text')].index('n_chars')}"
        cut = cut.withColumn(n_chars, F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col(n_chars)))
    return back(cut)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a passage of a benchmark item.

    Documents without text hold none; items without text are in none.
    """
    ship_package(spark)
    carried, back = _carry(docs)
    return back(decontaminate.without_overlaps(carried, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens.

    A document without text is its end token alone; a null doc_id stays null.
    """
    ship_package(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_leaks", benchmark_leaks),
    ("packing", pack_sequences),
]

# learned models, hashed anchors and tokens cannot be put in SQL; tests use brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
