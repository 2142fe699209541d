"""How the given tables become a collection.

``documents`` is the corpus, ``benchmark`` holds the topics.  No judgements
come with them, so a document counts as relevant to a topic if it holds at
least half of the topic's distinct terms.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.functions import analysis
from rankspark.operators import index as ix
from rankspark.operators import retrieve
from rankspark.session import fresh_folder, keep, lookup_join

RELEVANT_SHARE = 0.5


@dataclass(frozen=True)
class Collection:
    index: ix.Index
    topics: DataFrame
    terms: DataFrame
    qrels: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_path() -> Column:
    return F.concat_ws("", "source", F.lit("/"), "doc_id", F.lit("."), "lang")


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, modified, size_kb, source_file, lang, source, text)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        document_path().alias("path"),
        F.unix_millis("_metadata.file_modification_time").alias("modified"),
        analysis.size_kb(F.octet_length("text")).alias("size_kb"),
        F.col("_metadata.file_path").alias("source_file"),
        "lang",
        "source",
        "text",
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.describe(raw_documents(spark, sf_dir))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic_id, text): line ends become spaces, as in a topic file."""
    rows = table(spark, sf_dir, "benchmark")
    return rows.select(
        F.col("item_id").alias("topic_id"),
        F.concat(F.regexp_replace("text", analysis.LINE_END, " "), F.lit(" ")).alias("text"),
    )


def relevant_pairs(index: ix.Index, terms: DataFrame) -> DataFrame:
    """(topic_id, doc_id) with at least half of the topic's distinct terms."""
    sizes = terms.groupBy("topic_id").agg(F.count("*").alias("n_topic_terms"))
    return (
        lookup_join(retrieve.match_any(index, terms), sizes, ["topic_id"], "doc_id")
        .filter(F.col("n_terms") >= RELEVANT_SHARE * F.col("n_topic_terms"))
        .select("topic_id", "doc_id")
    )


_built: dict[tuple[str, str], Collection] = {}


def collection(spark: SparkSession, sf_dir: str) -> Collection:
    """The indexed collection, written once per application to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        docs = raw_documents(spark, sf_dir)
        index = ix.write_index(docs, fresh_folder(spark, "index"), fields=ix.FIELDS)
        asked = keep(topics(spark, sf_dir), "topics")
        terms = keep(retrieve.topic_terms(asked), "topic-terms")
        qrels = keep(relevant_pairs(index, terms), "qrels")
        _built[key] = Collection(index, asked, terms, qrels)
    return _built[key]
