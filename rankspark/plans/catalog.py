"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankspark.functions import analysis
from rankspark.functions.exact import shown
from rankspark.functions.scoring import Model
from rankspark.operators import evaluate, feedback, retrieve, significance, similar, tuning
from rankspark.operators import index as ix
from rankspark.operators import weights as wt
from rankspark.plans import corpus
from rankspark.plans.corpus import collection, raw_documents, table
from rankspark.session import fresh_folder, keep
from rankspark.sources import files, records

Query = Callable[[SparkSession, str], DataFrame]

# Settings of the registered queries, shared with the SQL that checks them.
JM = Model("jm", 0.5)
DIR = Model("dir", 1000.0)
TFIDF = Model("tfidf")
DEPTH = 20
CUT = 10
FEEDBACK_DOCS = 3
FEEDBACK_TERMS = 10
BETA = 0.5
ALPHA = 0.05
PAGE_EXTENSIONS = (".html", ".htm", ".org")
KEYWORD_PATH = "src1/1.en"
SIZE_RANGE = (1.0, 3.0)
LOOKUP_TERM = "the"

REGISTRY: dict[str, Query] = {}


def _tidy(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, doubles rounded: the types the SQL side gives.

    The given tables have one row per id, so the numbers of copies are left out.
    """

    def plain(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return shown(c).alias(field.name)
        return c

    shown_fields = [f for f in df.schema.fields if f.name not in ("copy_no", "seed_copy")]
    return df.select(*[plain(f) for f in shown_fields])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _tidy(fn(spark, sf_dir))

    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


# --- sources and sinks ------------------------------------------------------------


def _tree(docs: DataFrame, label: str) -> str:
    root = fresh_folder(docs.sparkSession, label)
    files.write_tree(docs, root)
    return root


def _documents_of(scanned):
    """Without the marker file that Spark's writer leaves in a finished folder."""
    return scanned.filter(F.contains("path", F.lit("/doc_id=")))


def _key_in_path():
    return F.regexp_extract("path", r"doc_id=(\d+)", 1).cast("bigint").alias("doc_id")


@query
def file_scan(spark, sf):
    """Writes every document as a file, most of them below a folder that Spark's own readers
    pass over, and reads the tree back."""
    docs = table(spark, sf, "documents")
    root = _tree(docs.filter(F.col("lang") == "en"), "tree")
    files.write_tree(docs.filter(~F.col("lang").eqNullSafe("en")), f"{root}/_more/.hidden")
    scanned = _documents_of(files.scan_tree(spark, root))
    return scanned.select(
        _key_in_path(), "size_kb", analysis.normalized(F.col("text")).alias("contents")
    )


@query
def multi_root_scan(spark, sf):
    docs = table(spark, sf, "documents")
    english = _tree(docs.filter(F.col("lang") == "en"), "english")
    other = _tree(docs.filter(F.col("lang") != "en"), "other")
    scanned = _documents_of(files.scan_tree(spark, [english, other]))
    root = F.when(F.contains("path", F.lit("/english-")), "english").otherwise("other")
    return scanned.select(root.alias("root"), _key_in_path(), "size_kb")


@query
def extension_filter(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.filter(analysis.has_extension(F.col("url"), PAGE_EXTENSIONS)).select(
        "page_id", "url"
    )


def _mixed_records(rows: DataFrame, path: str, end: str) -> None:
    """Records in one folder whose files have LF, CR LF and CR, dealt out by the id."""
    kind = F.pmod(F.xxhash64("id"), F.lit(3))
    for i, newline in enumerate(("\n", "\r\n", "\r")):
        records.write_records(rows.filter(kind == i), path, end, newline)


@query
def record_scan(spark, sf):
    """Documents, and benchmark items under ids that are no numbers; one has separators in
    its lines that do not fill them."""
    path = fresh_folder(spark, "doc-text")
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("body"))
    items = table(spark, sf, "benchmark").select(
        F.concat(F.lit("item-"), "item_id").alias("id"),
        F.concat("text", F.lit("   / is no end   /"), "text", F.lit("    /")).alias("body"),
    )
    _mixed_records(docs.unionByName(items), path, records.DOCUMENT_END)
    return records.scan_documents(spark, path, id_type="string").withColumnRenamed("text", "contents")


@query
def topics_scan(spark, sf):
    path = fresh_folder(spark, "query-text")
    items = table(spark, sf, "benchmark")
    _mixed_records(
        items.select(F.col("item_id").alias("id"), F.concat("text", F.lit(" and/or /")).alias("body")),
        path, records.TOPIC_END,
    )
    return records.scan_topics(spark, path)


@query
def qrels_scan(spark, sf):
    """Judgements written one number per record, then read back and joined up."""
    path = fresh_folder(spark, "rlv-ass")
    body = F.concat(F.lit("  "), "doc_id", F.lit("\n rel"))
    records.write_records(
        collection(spark, sf).qrels.select(F.col("topic_id").alias("id"), body.alias("body")),
        path, records.JUDGEMENT_END,
    )
    return records.scan_qrels(spark, path)


def _whole(index: ix.Index) -> DataFrame:
    """All that an index knows, in one relation: postings, documents, terms and totals."""

    def part(df: DataFrame, kind: str, doc_id, term, a: str, b: str) -> DataFrame:
        own = df.filter(F.col("field") == "contents")
        return own.select(
            F.lit(kind).alias("kind"), doc_id.alias("doc_id"), term.alias("term"), F.col(a).alias("a"), F.col(b).alias("b")
        )

    no_doc, no_term = F.lit(0).cast("bigint"), F.lit("")
    key, term = F.col("doc_id"), F.col("term")
    return (
        part(index.postings, "posting", key, term, "tf", "doc_len")
        .union(part(index.doc_stats, "document", key, no_term, "doc_len", "n_terms"))
        .union(part(index.term_stats, "term", no_doc, term, "df", "cf"))
        .union(part(index.field_stats, "documents", no_doc, no_term, "n_docs", "n_docs_with_field"))
        .union(part(index.field_stats, "words", no_doc, no_term, "n_terms", "sum_cf"))
    )


@query
def index_create(spark, sf):
    """Documents, and the benchmark items under keys that documents have as well."""
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    docs = raw_documents(spark, sf).unionByName(items, allowMissingColumns=True)
    return _whole(ix.write_index(docs, fresh_folder(spark, "created"), positions=True))


def _upserted(spark, sf) -> str:
    """An index after two updates: a batch that holds an earlier copy of each of its rows
    withdraws the low-quality documents and adds the benchmark items, and those are then
    replaced by themselves in lower case, so that the first batch's rows are withdrawn too."""
    docs = raw_documents(spark, sf)
    path = fresh_folder(spark, "upserted")
    ix.write_index(docs, path)
    low = table(spark, sf, "labels").filter(F.col("quality") == 0).select("doc_id")
    poor = docs.join(low.distinct(), "doc_id")
    earlier = poor.withColumn("text", F.upper("text")).withColumn("seq", F.lit(1))
    later = poor.withColumn("text", F.concat(F.lit("withdrawn: "), "source")).withColumn(
        "seq", F.lit(2)
    )
    items = table(spark, sf, "benchmark").select((-F.col("item_id") - 1).alias("doc_id"), "text")
    new = items.withColumn("seq", F.lit(1))
    doubled = new.withColumn("text", F.concat("text", F.lit(" once more "), "text"))
    batch = earlier.unionByName(later).unionByName(doubled, allowMissingColumns=True)
    ix.write_index(batch, path, mode="append", order_by="seq")
    ix.write_index(items, path, mode="append")
    return path


@query
def index_upsert(spark, sf):
    """Read from three segments, two of them with withdrawn keys."""
    return _whole(ix.open_index(spark, _upserted(spark, sf)))


@query
def index_compact(spark, sf):
    """The same index with all segments put into one."""
    return _whole(ix.compact_index(spark, _upserted(spark, sf)))


@query
def partial_merge(spark, sf):
    """Documents of each language group indexed apart, then merged by naming the parts."""
    docs = raw_documents(spark, sf)
    parts = [
        ix.write_index(docs.filter(c), fresh_folder(spark, "partial"))
        for c in (F.col("lang") == "en", F.col("lang") != "en", F.col("lang").isNull())
    ]
    return _whole(ix.write_merged(parts, fresh_folder(spark, "merged")))


@query
def stored_fields(spark, sf):
    c = collection(spark, sf)
    run = retrieve.search(c.index, c.terms, JM, CUT)
    return retrieve.stored_fields(run, c.index.docs, ["path", "size_kb"]).drop("score")


@query
def index_enrich(spark, sf):
    """Enriched documents written out and read back."""
    c = collection(spark, sf)
    path = fresh_folder(spark, "enriched")
    wt.enriched_docs(c.index, list(ix.FIELDS)).write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.select("doc_id", "path", *[f"best_terms_{f}" for f in ix.FIELDS])


# --- projections and filters ------------------------------------------------------


@query
def head_lines(spark, sf):
    return corpus.documents(spark, sf).select("doc_id", "top5_lines")


@query
def tail_lines(spark, sf):
    return corpus.documents(spark, sf).select("doc_id", "bottom5_lines")


@query
def normalize_lines(spark, sf):
    return corpus.documents(spark, sf).select("doc_id", "contents")


@query
def size_kb(spark, sf):
    return raw_documents(spark, sf).select("doc_id", "size_kb")


@query
def provenance(spark, sf):
    """Name of each document's source file, and whether its time stamp and partition are known."""
    return raw_documents(spark, sf).select(
        "doc_id",
        F.regexp_extract("source_file", "[^/]+$", 0).alias("source_name"),
        (F.col("modified") > 0).alias("dated"),
        (F.spark_partition_id() >= 0).alias("placed"),
    )


@query
def keyword_filter(spark, sf):
    docs = collection(spark, sf).index.docs
    return ix.keyword_filter(docs, "path", KEYWORD_PATH).select("doc_id", "path", "contents")


@query
def range_filter(spark, sf):
    docs = collection(spark, sf).index.docs
    return ix.range_filter(docs, "size_kb", *SIZE_RANGE).select("doc_id", "size_kb")


@query
def best_terms_text(spark, sf):
    return wt.best_terms_text(collection(spark, sf).index)


@query
def topic_terms(spark, sf):
    return retrieve.topic_terms(corpus.topics(spark, sf))


# --- analysis, postings, statistics -----------------------------------------------


@query
def tokenize(spark, sf):
    rows = ix.field_tokens(corpus.documents(spark, sf))
    return rows.select("doc_id", F.posexplode("tokens").alias("pos", "term"))


@query
def token_positions(spark, sf):
    return ix.token_positions(corpus.documents(spark, sf))


@query
def postings(spark, sf):
    built = ix.build_postings(corpus.documents(spark, sf), positions=True)
    return built.select(
        "doc_id", "term", "tf", F.array_join(F.col("positions").cast("array<string>"), " ").alias("positions")
    )


@query
def field_postings(spark, sf):
    return collection(spark, sf).index.postings.select("field", "doc_id", "term", "tf")


@query
def doc_freq(spark, sf):
    return _contents(collection(spark, sf).index.term_stats).select("term", "df")


@query
def term_stats(spark, sf):
    return collection(spark, sf).index.term_stats.select("field", "term", "df", "cf")


@query
def doc_length(spark, sf):
    return collection(spark, sf).index.doc_stats


@query
def field_stats(spark, sf):
    return collection(spark, sf).index.field_stats


@query
def vocabulary(spark, sf):
    return ix.vocabulary(collection(spark, sf).index)


@query
def term_vector(spark, sf):
    """Term vectors of every document labelled toxic."""
    toxic = table(spark, sf, "labels").filter(F.col("toxic") == 1)
    return ix.term_vectors(collection(spark, sf).index, toxic)


@query
def postings_lookup(spark, sf):
    return ix.postings_of(collection(spark, sf).index, LOOKUP_TERM)


def _contents(df: DataFrame) -> DataFrame:
    return df.filter(F.col("field") == "contents")


# --- weights, similarity, best terms ----------------------------------------------


@query
def weights(spark, sf):
    rows = wt.weighted_postings(collection(spark, sf).index)
    return rows.select(
        "doc_id", "term", *[wt.weight(s).alias(f"w_{s}") for s in wt.SCHEMES]
    )


@query
def tfidf_weights(spark, sf):
    rows = wt.weighted_postings(collection(spark, sf).index)
    return rows.select("doc_id", "term", wt.tfidf().alias("tfidf"))


@query
def l1_normalize(spark, sf):
    rows = wt.weighted_postings(collection(spark, sf).index)
    vectors = rows.select("doc_id", "term", wt.weight("tfxidf").alias("w"))
    return wt.l1_normalized(vectors).select("doc_id", "term", "w_l1")


@query
def best_terms(spark, sf):
    return wt.best_terms(collection(spark, sf).index)


def _seed_docs(spark, sf):
    """The longest document of each source; ties go to the smaller doc_id."""
    longest = F.max_by(F.col("doc_id"), F.struct("n_chars", -F.col("doc_id")))
    return table(spark, sf, "documents").groupBy("source").agg(longest.alias("doc_id"))


def _seed_terms(c):
    """The rarest term of each topic that at least two documents hold."""
    stats = _contents(c.index.term_stats).filter(F.col("df") > 1).select("term", "df")
    known = c.terms.join(stats, "term")
    rarest = F.min(F.struct("df", "term"))["term"]
    return known.groupBy("topic_id").agg(rarest.alias("term"))


def _similar(scheme: str) -> None:
    def docs(spark, sf):
        return similar.similar_docs(
            collection(spark, sf).index, _seed_docs(spark, sf), scheme
        )

    def terms(spark, sf):
        c = collection(spark, sf)
        return similar.similar_terms(c.index, _seed_terms(c), scheme)

    docs.__name__ = f"similar_docs_{scheme}"
    terms.__name__ = f"similar_terms_{scheme}"
    query(docs)
    query(terms)


for _scheme in wt.SCHEMES:
    _similar(_scheme)


# --- retrieval ----------------------------------------------------------------------


@query
def match_any(spark, sf):
    c = collection(spark, sf)
    return retrieve.match_any(c.index, c.terms)


def _search(model: Model):
    def run(spark, sf):
        c = collection(spark, sf)
        return retrieve.search(c.index, c.terms, model, CUT)

    run.__name__ = f"search_{model.name}"
    query(run)


for _model in (TFIDF, JM, DIR):
    _search(_model)


@query
def search_pruned(spark, sf):
    """Short topics, of their two rarest words and their commonest, without scoring what
    cannot reach the top."""
    c = collection(spark, sf)
    stats = _contents(c.index.term_stats).select("term", "df")
    known = c.terms.join(stats, "term")
    place = F.row_number().over(Window.partitionBy("topic_id").orderBy("df", "term"))
    n = F.count("*").over(Window.partitionBy("topic_id"))
    short = known.withColumn("place", place).withColumn("n", n).filter("place <= 2 OR place = n")
    terms = keep(short.select("topic_id", "term", "weight"), "short-topics")
    return retrieve.search(c.index, terms, TFIDF, CUT, prune=True)


@query
def search_weighted(spark, sf):
    """Topic words weighted by the inverse of how many topics use them."""
    c = collection(spark, sf)
    use = c.terms.groupBy("term").agg(F.count("*").alias("n_topics"))
    boosted = c.terms.join(use, "term").select(
        "topic_id", "term", F.round(F.col("weight") / F.col("n_topics"), 6).alias("weight")
    )
    return retrieve.search(c.index, boosted, JM, CUT)


@query
def top_m(spark, sf):
    c = collection(spark, sf)
    scored = retrieve.scores(c.index, c.terms, {"score": TFIDF})
    return retrieve.top_m(scored, DEPTH)


@query
def total_hits(spark, sf):
    c = collection(spark, sf)
    return retrieve.total_hits(c.index, c.terms)


@query
def run_listing(spark, sf):
    c = collection(spark, sf)
    run = retrieve.search(c.index, c.terms, JM, DEPTH)
    return evaluate.listing(run, c.qrels, c.index.docs)


def _middle(c, share: float = 0.5) -> int:
    """Topic number that ends the first ``share`` of the topic range."""
    low, high = c.topics.agg(F.min("topic_id"), F.max("topic_id")).first()
    return int(low + (high - low) * share // 1)


@query
def topic_range(spark, sf):
    """The first half of the topic numbers, given as a range."""
    c = collection(spark, sf)
    low = c.topics.agg(F.min("topic_id")).first()[0]
    chosen = retrieve.topic_range(c.topics, f"{low}-{_middle(c)}")
    return retrieve.search(c.index, retrieve.topic_terms(chosen), JM, CUT)


# --- evaluation ---------------------------------------------------------------------


def _metrics(spark, sf):
    c = collection(spark, sf)
    run = retrieve.search(c.index, c.terms, JM, DEPTH)
    return evaluate.topic_metrics(run, c.qrels, c.topics, CUT, m=DEPTH)


@query
def precision_at_n(spark, sf):
    return _metrics(spark, sf).select("topic_id", "P")


@query
def recall_at_n(spark, sf):
    return _metrics(spark, sf).select("topic_id", "n_rel", "R")


@query
def average_precision(spark, sf):
    return _metrics(spark, sf).select("topic_id", F.col("MAP").alias("AP"))


@query
def mean_metric(spark, sf):
    return evaluate.mean_metrics(_metrics(spark, sf))


@query
def relevant_list(spark, sf):
    return evaluate.relevant_list(collection(spark, sf).qrels)


# --- relevance feedback ---------------------------------------------------------------


def _chosen(c):
    run = retrieve.search(c.index, c.terms, JM, DEPTH)
    return feedback.feedback_docs(run, c.qrels, FEEDBACK_DOCS)


def _values(c):
    return feedback.term_values(c.index, keep(_chosen(c), "feedback-docs"))


@query
def feedback_docs(spark, sf):
    return _chosen(collection(spark, sf))


@query
def feedback_term_values(spark, sf):
    return _values(collection(spark, sf))


@query
def feedback_terms(spark, sf):
    return feedback.best_values(_values(collection(spark, sf)), FEEDBACK_TERMS)


@query
def expanded_query(spark, sf):
    c = collection(spark, sf)
    best = feedback.best_values(_values(c), FEEDBACK_TERMS)
    return feedback.expanded_query(c.topics, best, BETA)


def _feedback(spark, sf, residual: bool):
    c = collection(spark, sf)
    return feedback.feedback_search(
        c.index, c.topics, c.terms, c.qrels, JM,
        n=CUT, m=DEPTH, s=FEEDBACK_DOCS, t=FEEDBACK_TERMS, beta=BETA, residual=residual,
    )


@query
def feedback_search(spark, sf):
    return _feedback(spark, sf, residual=False)[0]


@query
def feedback_residual(spark, sf):
    return _feedback(spark, sf, residual=True)[1]


# --- tuning and significance ------------------------------------------------------------


def _tuned(spark, sf, *names: str, share: float = 0.5):
    """(training metrics, test metrics) of every setting of the named models."""
    c = collection(spark, sf)
    models = [m for name in names for m in tuning.grid(name)]
    metrics = keep(
        tuning.settings_metrics(c.index, c.topics, c.terms, c.qrels, models, CUT), "tuned"
    )
    training = F.col("topic_id") <= _middle(c, share)
    return metrics.filter(training), metrics.filter(~training)


def _trained(c, *names: str):
    """Training metrics of every setting of the named models."""
    training = F.col("topic_id") <= _middle(c)
    models = [m for name in names for m in tuning.grid(name)]
    return tuning.settings_metrics(c.index, c.topics.filter(training), c.terms.filter(training), c.qrels, models, CUT)


def _tune(name: str):
    def run(spark, sf):
        return tuning.leaderboard(_trained(collection(spark, sf), name))

    run.__name__ = f"tune_{name}"
    query(run)


for _name in ("jm", "dir"):
    _tune(_name)


@query
def best_param(spark, sf):
    """Only training topics are scored: no other has a say."""
    train = _trained(collection(spark, sf), "jm", "dir")
    return tuning.leaderboard(train).filter(F.col("place") == 1).drop("place")


@query
def holdout_metrics(spark, sf):
    return tuning.holdout(*_tuned(spark, sf, "jm", "dir"))


@query
def holdout_mean(spark, sf):
    return tuning.holdout_mean(tuning.holdout(*_tuned(spark, sf, "jm", "dir")))


def _pairs(spark, sf, share: float = 0.5):
    train, test = _tuned(spark, sf, "jm", "dir", share=share)
    by_metric = [
        tuning.holdout(train, test, metric).withColumn("metric", F.lit(metric))
        for metric in evaluate.METRICS
    ]
    vectors = by_metric[0].unionByName(by_metric[1]).unionByName(by_metric[2])
    return significance.paired(vectors, by=["metric"])


@query
def paired_t_test(spark, sf):
    return significance.paired_t_test(_pairs(spark, sf), ALPHA, by=["metric"])


@query
def wilcoxon_exact(spark, sf):
    return significance.wilcoxon_test(_pairs(spark, sf), ALPHA, "exact", by=["metric"])


@query
def wilcoxon_normal(spark, sf):
    """Three quarters of the topics held out, which is past the exact range."""
    return significance.wilcoxon_test(
        _pairs(spark, sf, share=0.25), ALPHA, "normal", by=["metric"]
    )


@query
def compare_systems(spark, sf):
    """Both models tuned, tested and compared, per metric, with both tests."""
    pairs = keep(_pairs(spark, sf), "pairs")
    t = significance.paired_t_test(pairs, ALPHA, by=["metric"])
    w = significance.wilcoxon_test(pairs, ALPHA, "auto", by=["metric"])
    return t.select("metric", "n", F.col("p").alias("p_t"), F.col("significant").alias("t_significant")).join(
        w.select("metric", F.col("p").alias("p_w"), F.col("significant").alias("w_significant")),
        "metric",
    )


@query
def compare_all_pairs(spark, sf):
    """Three systems, both tuned models and tf-idf, compared two by two, per metric, in one job."""
    c = collection(spark, sf)
    train, test = _tuned(spark, sf, "jm", "dir")
    run = retrieve.search(c.index, c.terms, TFIDF, CUT)
    untuned = evaluate.topic_metrics(run, c.qrels, c.topics, CUT).filter(F.col("topic_id") > _middle(c))
    columns = ("model", "topic_id", "value", "metric")
    by_metric = [
        tuning.holdout(train, test, metric).withColumn("metric", F.lit(metric)).select(*columns)
        for metric in evaluate.METRICS
    ] + [
        untuned.select(F.lit("tfidf"), "topic_id", F.coalesce(metric, F.lit(0.0)), F.lit(metric)).toDF(*columns)
        for metric in evaluate.METRICS
    ]
    vectors = by_metric[0]
    for more in by_metric[1:]:
        vectors = vectors.unionByName(more)
    keys = ["metric", "system_a", "system_b"]
    vectors = keep(vectors, "system-vectors")
    pairs = keep(significance.all_pairs(vectors, by=["metric"]), "all-pairs")
    t = significance.paired_t_test(pairs, ALPHA, by=keys)
    w = significance.wilcoxon_test(pairs, ALPHA, "auto", by=keys)
    return t.select(*keys, "n", F.col("p").alias("p_t"), F.col("significant").alias("t_significant")).join(
        w.select(*keys, F.col("p").alias("p_w"), F.col("significant").alias("w_significant")), keys
    )
