"""SQL that checks the registered queries, built from named common tables.

Each query states its result over the named tables below; ``_sql`` puts the
needed ones in front.  The word rule is the one of the analysis module, written
for a regex dialect without look-around: every inner joiner is marked first.
"""

from __future__ import annotations

import re

from rankspark.operators import tuning
from rankspark.plans import catalog as cat

MARK = "chr(57344)"
LETTERS = r"([\p{L}\p{M}_])([.:·''’])([\p{L}_])"
DIGITS = r"(\p{N})([.,;''’])(\p{N})"
WORD = r"_*[\p{L}\p{N}](?:[\p{L}\p{N}\p{M}_]|\x{E000}.)*"
NL = "chr(10)"


def _marked(text: str) -> str:
    out = text
    for pattern in (LETTERS, LETTERS, DIGITS, DIGITS):
        out = f"regexp_replace({out}, '{pattern}', '\\1' || {MARK} || '\\2\\3', 'g')"
    return out


def _tokens(text: str) -> str:
    words = f"regexp_extract_all({_marked(f'lower({text})')}, '{WORD}')"
    return f"list_transform({words}, lambda w: replace(w, {MARK}, ''))"


def _unix(text: str) -> str:
    return (
        f"replace(replace({text}, chr(13) || {NL}, {NL}), chr(13), {NL})"
    )


def _lines(text: str) -> str:
    """Lines of normalized text, as a list."""
    parts = f"string_split({text}, {NL})"
    return f"list_slice({parts}, 1, len({parts}) - 1)"


def _closed(lines: str) -> str:
    return f"array_to_string(list_transform({lines}, lambda x: x || {NL}), '')"


def _units(x: str) -> str:
    """The order-independent sum of a double."""
    return f"(sum(CAST(floor(({x}) * 1e11 + 0.5) AS BIGINT))::DOUBLE / 1e11)"


def _score(x: str) -> str:
    """The same sum in whole steps of 1e-9, as a score."""
    return f"((sum(CAST(floor(({x}) * 1e11 + 0.5) AS BIGINT)) + 50) // 100)::DOUBLE / 1e9"


TABLES: dict[str, str] = {
    "raw": f"SELECT *, source || '/' || doc_id || '.' || lang AS path, "
    f"strlen(text) / 1000::DOUBLE AS size_kb, {_unix('text')} AS u FROM documents",
    "docs": f"SELECT *, CASE WHEN u = '' OR suffix(u, {NL}) THEN u ELSE u || {NL} END "
    "AS contents FROM raw",
    "d3": "SELECT doc_id, path, contents, "
    f"{_closed(f'list_slice({_lines(chr(99) + "ontents")}, 1, 5)')} AS top5_lines, "
    f"{_closed(f'list_slice({_lines("contents")}, greatest(len({_lines("contents")}) - 4, 1), len({_lines("contents")}))')} "
    "AS bottom5_lines FROM docs",
    "texts": "SELECT 'contents' AS field, doc_id, contents AS text FROM d3 UNION ALL "
    "SELECT 'top5_lines', doc_id, top5_lines FROM d3 UNION ALL "
    "SELECT 'bottom5_lines', doc_id, bottom5_lines FROM d3",
    "lists": f"SELECT field, doc_id, {_tokens('text')} AS toks FROM texts",
    "tok": "SELECT field, doc_id, unnest(toks) AS term, "
    "generate_subscripts(toks, 1) - 1 AS pos FROM lists",
    "p3": "SELECT field, doc_id, term, count(*) AS tf FROM tok GROUP BY ALL",
    "dl3": "SELECT field, doc_id, len(toks) AS doc_len FROM lists",
    "ts3": "SELECT field, term, count(*) AS df, sum(tf)::BIGINT AS cf FROM p3 GROUP BY ALL",
    "fs3": "SELECT field, count(*) AS n_docs, count(*) FILTER (doc_len > 0) AS n_docs_with_field, "
    "sum(doc_len)::BIGINT AS sum_cf FROM dl3 GROUP BY ALL",
    "p": "SELECT doc_id, term, tf, doc_len, df, cf, n_docs, n_docs_with_field, sum_cf "
    "FROM p3 JOIN dl3 USING (field, doc_id) JOIN ts3 USING (field, term) JOIN fs3 USING (field) "
    "WHERE field = 'contents'",
    "ts": "SELECT term, df, cf FROM ts3 WHERE field = 'contents'",
    "topics": r"SELECT item_id AS topic_id, regexp_replace(text, '\r\n|\r|\n', ' ', 'g') || ' ' "
    "AS text FROM benchmark",
    "tt": f"SELECT topic_id, term, count(*)::DOUBLE AS weight FROM (SELECT topic_id, "
    f"unnest({_tokens('text')}) AS term FROM topics) GROUP BY ALL",
    "m": "SELECT topic_id, weight, p.* FROM tt JOIN p USING (term)",
    "qrels": "SELECT topic_id, doc_id FROM m JOIN (SELECT topic_id, count(*) AS n FROM tt "
    "GROUP BY ALL) USING (topic_id) GROUP BY topic_id, doc_id, n HAVING count(*) >= 0.5 * n",
    "n_rel": "SELECT topic_id, count(*) AS n_rel FROM qrels GROUP BY ALL",
}


def _jm(lam: str) -> str:
    return (
        f"weight * ln(1 + (1 - {lam}) * tf / doc_len / "
        f"({lam} * ((cf + 1) / (sum_cf + 1))))"
    )


def _dir(mu: str) -> str:
    gain = f"ln(1 + tf / ({mu} * ((cf + 1) / (sum_cf + 1))))"
    return f"weight * greatest(0, {gain} + ln({mu} / (doc_len + {mu})))"


TFIDF = "weight * sqrt(tf) * (1 + ln((n_docs_with_field + 1) / (df + 1))) / sqrt(doc_len)"
JM = _jm(f"{cat.JM.param}::DOUBLE")
DIR = _dir(f"{cat.DIR.param}::DOUBLE")
TFIDF_W = "tf * log10(n_docs / df)"


def _run(model: str, m: int, matches: str = "m") -> str:
    return (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic_id "
        "ORDER BY score DESC, doc_id) AS rank FROM (SELECT topic_id, doc_id, "
        f"{_score(model)} AS score FROM {matches} GROUP BY topic_id, doc_id)) "
        f"WHERE rank <= {m}"
    )


def _metrics(run: str, qrels: str, topics: str, n: int, by: str = "") -> str:
    keys = f"{by}topic_id"
    return f"""
    SELECT {keys}, coalesce(n_rel, 0) AS n_rel,
      round(coalesce(found, 0) / {n}, 9) AS P,
      round(coalesce(found, 0) / n_rel, 9) AS R,
      round(coalesce(sum_p, 0) / n_rel, 9) AS MAP
    FROM {topics}
    LEFT JOIN (SELECT {keys}, sum(rel) AS found, {_units('rel * found / rank')} AS sum_p
      FROM (SELECT *, sum(rel) OVER (PARTITION BY {keys} ORDER BY rank) AS found
        FROM (SELECT r.*, CASE WHEN q.doc_id IS NULL THEN 0 ELSE 1 END AS rel
          FROM {run} r LEFT JOIN {qrels} q ON r.topic_id = q.topic_id AND r.doc_id = q.doc_id
          WHERE rank <= {n}))
      GROUP BY {keys}) USING ({keys})
    LEFT JOIN (SELECT topic_id, count(*) AS n_rel FROM {qrels} GROUP BY ALL) USING (topic_id)
    """


def _mean(v: str) -> str:
    return (
        f"round({_units(f'CASE WHEN {v} <> 0 THEN {v} END')} / "
        f"nullif(count(*) FILTER ({v} <> 0), 0), 9)"
    )


TABLES |= {
    "run": _run(JM, cat.DEPTH),
    "met": _metrics("run", "qrels", "topics", cat.CUT),
    # relevance feedback
    "rs": "SELECT * FROM (SELECT topic_id, doc_id, score, row_number() OVER (PARTITION BY "
    "topic_id ORDER BY rank) AS place FROM run JOIN qrels USING (topic_id, doc_id)) "
    f"WHERE place <= {cat.FEEDBACK_DOCS}",
    "vals": f"SELECT topic_id, term, round({_units(TFIDF_W + ' * score')}, 9) AS value "
    "FROM rs JOIN p USING (doc_id) GROUP BY topic_id, term",
    "bestv": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY "
    f"value DESC, term) AS rank FROM vals) WHERE rank <= {cat.FEEDBACK_TERMS}",
    "words": "SELECT topic_id, len(ws) AS n, unnest(ws) AS word FROM (SELECT topic_id, "
    "list_filter(string_split(text, ' '), lambda w: w <> '') AS ws FROM topics)",
    "exq": f"SELECT topic_id, term, round(sum(w), 9)::DOUBLE AS weight FROM (SELECT topic_id, unnest({_tokens('word')}) "
    f"AS term, round(({cat.BETA}::DOUBLE / n)::DECIMAL(18, 9), 2) AS w FROM words UNION ALL "
    f"SELECT topic_id, term, round(({1 - cat.BETA}::DOUBLE * value / sum(value) OVER (PARTITION BY "
    "topic_id))::DECIMAL(18, 9), 2) FROM bestv) GROUP BY topic_id, term",
    "xm": "SELECT topic_id, weight, p.* FROM exq JOIN p USING (term)",
    "xrun": _run(JM, cat.DEPTH, "xm"),
    "resid": "SELECT * FROM qrels ANTI JOIN rs USING (topic_id, doc_id)",
    # tuning: one row per (setting, topic, document)
    "settings": "SELECT * FROM (VALUES "
    + ", ".join(f"('jm', {p}::DOUBLE)" for p in tuning.JM_GRID)
    + ", "
    + ", ".join(f"('dir', {p}::DOUBLE)" for p in tuning.DIR_GRID)
    + ") AS s(model, param)",
    "every": "SELECT model, param, topic_id FROM settings, topics",
    "allruns": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model, param, topic_id "
    "ORDER BY score DESC, doc_id) AS rank FROM (SELECT model, param, topic_id, doc_id, "
    f"{_score(f'''CASE WHEN model = 'jm' THEN {_jm('param')} WHEN param = 0 THEN 0 ELSE {_dir('param')} END''')} "
    f"AS score FROM m, settings GROUP BY ALL)) WHERE rank <= {cat.CUT}",
    "allmet": _metrics("allruns", "qrels", "every", cat.CUT, "model, param, "),
    "longmet": "SELECT model, param, topic_id, metric, value FROM (SELECT model, param, topic_id, "
    "'P' AS metric, P AS value FROM allmet UNION ALL SELECT model, param, topic_id, 'R', R "
    "FROM allmet UNION ALL SELECT model, param, topic_id, 'MAP', MAP FROM allmet)",
}


def _split(share: float) -> str:
    """The topic number that ends the training range."""
    return f"(SELECT min(item_id) + floor((max(item_id) - min(item_id)) * {share}) FROM benchmark)"


def _board(share: float) -> str:
    return (
        "SELECT *, row_number() OVER (PARTITION BY metric, model ORDER BY value DESC, param) AS place "
        f"FROM (SELECT metric, model, param, coalesce({_mean('value')}, 0) AS value FROM longmet "
        f"WHERE topic_id <= {_split(share)} GROUP BY metric, model, param)"
    )


def _held(share: float, board: str) -> str:
    return (
        "SELECT l.metric, l.model, l.param, l.topic_id, coalesce(l.value, 0) AS value FROM longmet l "
        f"JOIN {board} b ON b.metric = l.metric AND b.model = l.model AND b.param = l.param AND b.place = 1 "
        f"WHERE l.topic_id > {_split(share)}"
    )


def _pairs(held: str) -> str:
    return (
        "SELECT metric, topic_id, max(value) FILTER (model = 'dir') AS a, "
        f"max(value) FILTER (model = 'jm') AS b FROM {held} GROUP BY ALL"
    )


def _ttest(pairs: str) -> str:
    """The finite series, each term as exp of a sum of logarithms."""
    return f"""
    SELECT metric, n, t, CASE WHEN t IS NULL THEN NULL
        WHEN n = 2 THEN 1 - 2 / pi() * theta
        WHEN n % 2 = 0 THEN 1 - 2 / pi() * (theta + sin(theta) * (SELECT sum(cos(theta) ^ (2 * k + 1)
          * coalesce((SELECT exp(sum(ln(2 * j / (2 * j + 1)))) FROM range(1, k + 1) r(j)), 1))
          FROM range(0, (n - 2) // 2) s(k)))
        ELSE 1 - sin(theta) * (SELECT sum(cos(theta) ^ (2 * k)
          * coalesce((SELECT exp(sum(ln((2 * j - 1) / (2 * j)))) FROM range(1, k + 1) r(j)), 1))
          FROM range(0, (n - 1) // 2) s(k)) END AS p
    FROM (SELECT *, atan(abs(t) / sqrt(n - 1)) AS theta FROM (
      SELECT metric, count(*) AS n,
        CASE WHEN var_samp(a - b) > 0 THEN avg(a - b) / sqrt(var_samp(a - b) / count(*)) END AS t
      FROM {pairs} GROUP BY metric))
    """


def _signed_ranks(pairs: str) -> str:
    return f"""
    SELECT metric, n, w_plus, greatest(w_plus, n * (n + 1) / 2 - w_plus) AS w,
      (n * (n + 1) / 2 - greatest(w_plus, n * (n + 1) / 2 - w_plus) - n * (n + 1) / 4 - 0.5::DOUBLE)
        / sqrt(n * (n + 1) / 4 * (2 * n + 1) / 6) AS z
    FROM (SELECT metric, count(*) AS n, sum(CASE WHEN d > 0 THEN mid ELSE 0 END)::DOUBLE AS w_plus
      FROM (SELECT metric, d, rank() OVER (PARTITION BY metric ORDER BY abs(d))
          + (count(*) OVER (PARTITION BY metric, abs(d)) - 1) / 2 AS mid
        FROM (SELECT metric, round(b - a, 9) AS d FROM {pairs}))
      GROUP BY metric)
    """


TABLES |= {
    "board": _board(0.5),
    "held": _held(0.5, "board"),
    "pairs": _pairs("held"),
    "tt2": _ttest("pairs"),
    "sr": _signed_ranks("pairs"),
    # every subset of the ranks, as bits
    "subsets": "SELECT n, (SELECT sum(CASE WHEN (i >> (r - 1)) & 1 = 1 THEN r ELSE 0 END) FROM "
    "range(1, n + 1) t(r)) AS s FROM (SELECT DISTINCT n FROM sr), range(0, 1 << 20) u(i) WHERE i < (1 << n)",
    "sw": "SELECT sr.*, 2 * (SELECT count(*) FROM subsets u WHERE u.n = sr.n AND u.s >= sr.w) "
    "/ (1 << sr.n) AS p FROM sr",
    "board4": _board(0.25),
    "held4": _held(0.25, "board4"),
    "pairs4": _pairs("held4"),
    "sr4": _signed_ranks("pairs4"),
    # normal tail by the alternating power series of the error function
    "sw4": "SELECT sr4.*, 2 * (0.5 + (SELECT sum(CASE WHEN k % 2 = 0 THEN 1 ELSE -1 END * z ^ (2 * k + 1) "
    "/ (2 ^ k * (2 * k + 1) * gamma(k + 1::DOUBLE))) FROM range(0, 80) t(k)) / sqrt(2 * pi())) AS p FROM sr4",
}


TABLES |= {
    "tfrun": _run(TFIDF, cat.CUT),
    "tfmet": _metrics("tfrun", "qrels", "topics", cat.CUT),
    "heldtf": "SELECT metric, model, topic_id, value FROM held UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{name}', 'tfidf', topic_id, coalesce({name}, 0) FROM tfmet WHERE topic_id > {_split(0.5)}"
        for name in ("P", "R", "MAP")
    ),
    # the metric and the two systems in one name
    "pairs3": "SELECT x.metric || '|' || x.model || '|' || y.model AS metric, x.topic_id, x.value AS a, y.value AS b "
    "FROM heldtf x JOIN heldtf y ON x.metric = y.metric AND x.topic_id = y.topic_id AND x.model < y.model",
    "tt3": _ttest("pairs3"),
    "sr3": _signed_ranks("pairs3"),
    "subsets3": "SELECT n, (SELECT sum(CASE WHEN (i >> (r - 1)) & 1 = 1 THEN r ELSE 0 END) FROM "
    "range(1, n + 1) t(r)) AS s FROM (SELECT DISTINCT n FROM sr3), range(0, 1 << 20) u(i) WHERE i < (1 << n)",
    "sw3": "SELECT sr3.*, 2 * (SELECT count(*) FROM subsets3 u WHERE u.n = sr3.n AND u.s >= sr3.w) "
    "/ (1 << sr3.n) AS p FROM sr3",
}


def _sql(body: str, given: dict[str, str] | None = None) -> str:
    """``body`` preceded by the named tables it needs."""
    known = TABLES | (given or {})
    order: list[str] = []

    def need(text: str) -> None:
        # a table is meant only where rows are read from it
        for name in re.findall(r"(?:FROM|JOIN|,)\s+(\w+)", text):
            if name in known and name not in order:
                need(known[name])
                order.append(name)

    need(body)
    ctes = ", ".join(f"{n} AS MATERIALIZED ({known[n]})" for n in order)
    return f"WITH {ctes} {body}" if ctes else body


def _weight(scheme: str, tf: str = "tf", df: str = "df") -> str:
    return {
        "bin": "1::BIGINT",
        "tf": tf,
        "tfxidf": f"CAST(trunc({tf} * log10(n_docs / {df})) AS BIGINT)",
    }[scheme]


def _similar_docs(scheme: str) -> str:
    seeds = (
        "SELECT doc_id AS seed_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY source "
        "ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r = 1"
    )
    given = {
        "seeds": seeds,
        "w": f"SELECT doc_id, term, {_weight(scheme)} AS w FROM p",
        "own": "SELECT seed_id, term, w AS seed_w FROM seeds JOIN w ON seed_id = doc_id",
        "norms": "SELECT seed_id, sum(seed_w * seed_w) AS na FROM own GROUP BY ALL",
        "sims": "SELECT seed_id, doc_id, round(sum(seed_w * w) / nullif(sqrt(any_value(na)) * "
        "sqrt(sum(w * w)), 0), 9) AS similarity FROM own JOIN w USING (term) JOIN norms USING (seed_id) "
        "WHERE doc_id <> seed_id GROUP BY seed_id, doc_id",
    }
    return _sql(
        "SELECT seed_id, doc_id, round(similarity, 6) AS similarity, rank FROM (SELECT *, row_number() "
        "OVER (PARTITION BY seed_id ORDER BY similarity DESC, doc_id) AS rank FROM sims "
        "WHERE similarity IS NOT NULL) WHERE rank <= 10",
        given,
    )


def _similar_terms(scheme: str) -> str:
    given = {
        "seeds": "SELECT DISTINCT term AS seed_term FROM (SELECT topic_id, term, row_number() OVER ("
        "PARTITION BY topic_id ORDER BY df, term) AS r FROM tt JOIN ts USING (term) WHERE df > 1) WHERE r = 1",
        "w": f"SELECT doc_id, term, {_weight(scheme)} AS w FROM p",
        "tnorm": "SELECT term, sum(w * w) AS n2 FROM w GROUP BY ALL HAVING sum(w * w) > 0",
        "dots": "SELECT s.term AS seed_term, o.term, sum(s.w * o.w) AS dot FROM seeds JOIN w s "
        "ON s.term = seed_term JOIN w o ON o.doc_id = s.doc_id GROUP BY ALL",
        "sims": "SELECT a.term AS seed_term, b.term, round(coalesce(dot, 0) / (sqrt(a.n2) * sqrt(b.n2)), 9) "
        "AS similarity FROM seeds JOIN tnorm a ON a.term = seed_term JOIN tnorm b ON b.term <> seed_term "
        "LEFT JOIN dots ON dots.seed_term = a.term AND dots.term = b.term",
    }
    return _sql(
        "SELECT seed_term, term, round(similarity, 6) AS similarity, rank FROM (SELECT *, row_number() "
        "OVER (PARTITION BY seed_term ORDER BY similarity DESC, term) AS rank FROM sims) WHERE rank <= 10",
        given,
    )


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


BEST = (
    "SELECT *, row_number() OVER (PARTITION BY field, doc_id ORDER BY tfidf DESC, term) AS rank FROM "
    f"(SELECT field, doc_id, term, tf, df, round({TFIDF_W}, 9) AS tfidf FROM p3 "
    "JOIN ts3 USING (field, term) JOIN fs3 USING (field)) QUALIFY rank <= 5"
)
TABLES |= {
    "best": BEST,
    "btext": "SELECT field, doc_id, string_agg(printf('%s (%d %d %.3f) ', term, tf, df, tfidf), '' "
    "ORDER BY rank) AS best_terms FROM best GROUP BY ALL",
}

UPSERT = {
    "docs": "SELECT doc_id, text AS contents FROM documents WHERE doc_id NOT IN "
    "(SELECT doc_id FROM labels WHERE quality = 0) UNION ALL SELECT doc_id, 'withdrawn: ' || source "
    "FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) UNION ALL "
    "SELECT -item_id - 1, text FROM benchmark",
    "texts": "SELECT 'contents' AS field, doc_id, contents AS text FROM docs",
}

# rows with one key are numbered, so that they stay documents of their own
CREATED = {
    "docs": "SELECT row_number() OVER () AS doc_id, key, contents FROM (SELECT doc_id AS key, text AS contents "
    "FROM documents UNION ALL SELECT item_id, text FROM benchmark)",
    "texts": "SELECT 'contents' AS field, doc_id, contents AS text FROM docs",
}


def _whole(key: str = "doc_id", given: dict[str, str] | None = None) -> str:
    keyed = f"(SELECT doc_id, {key} AS key FROM docs)"
    return _sql(
        f"SELECT 'posting' AS kind, key AS doc_id, term, tf AS a, doc_len::BIGINT AS b FROM p JOIN {keyed} USING (doc_id) "
        f"UNION ALL SELECT 'document', key, '', len(toks), len(list_distinct(toks)) FROM lists JOIN {keyed} USING (doc_id) "
        "WHERE field = 'contents' "
        "UNION ALL SELECT 'term', 0, term, df, cf FROM ts "
        "UNION ALL SELECT 'documents', 0, '', n_docs, n_docs_with_field FROM fs3 WHERE field = 'contents' "
        "UNION ALL SELECT 'words', 0, '', (SELECT count(*) FROM ts), sum_cf FROM fs3 WHERE field = 'contents'",
        given,
    )


RUN_OUT = "topic_id, doc_id, round(score, 6) AS score, rank"

ORACLE: dict[str, str] = {
    "file_scan": _sql(
        "SELECT doc_id, (strlen(text) + 1) / 1000::DOUBLE AS size_kb, CASE WHEN suffix(u, chr(10)) "
        "THEN u || chr(10) ELSE contents END AS contents FROM docs"
    ),
    "multi_root_scan": "SELECT CASE WHEN lang = 'en' THEN 'english' ELSE 'other' END AS root, doc_id, "
    "(strlen(text) + 1) / 1000::DOUBLE AS size_kb FROM documents",
    "extension_filter": "SELECT page_id, url FROM pages WHERE NOT contains(url, '.') OR "
    rf"regexp_extract(url, '\.[^.]*$') IN ({_list(cat.PAGE_EXTENSIONS)})",
    "record_scan": r"SELECT doc_id, regexp_replace(t, '\r\n|\r|\n', ' ', 'g') || ' ' AS contents FROM ("
    "SELECT doc_id::VARCHAR AS doc_id, text AS t FROM documents UNION ALL SELECT 'item-' || item_id, "
    "text || '   / is no end   /' || text || '    /' FROM benchmark)",
    "topics_scan": _sql("SELECT topic_id, text[:-2] || ' and/or / ' AS text FROM topics"),
    "qrels_scan": _sql("SELECT topic_id, doc_id FROM qrels"),
    "index_create": _whole("key", CREATED),
    "index_upsert": _whole("doc_id", UPSERT),
    "index_compact": _whole("doc_id", UPSERT),
    "partial_merge": _whole(),
    "stored_fields": _sql(
        f"SELECT topic_id, doc_id, rank, path, round(size_kb, 6) AS size_kb FROM run JOIN docs "
        f"USING (doc_id) WHERE rank <= {cat.CUT}"
    ),
    "index_enrich": _sql(
        "SELECT doc_id, path, coalesce(max(best_terms) FILTER (field = 'contents'), '') AS best_terms_contents, "
        "coalesce(max(best_terms) FILTER (field = 'top5_lines'), '') AS best_terms_top5_lines, "
        "coalesce(max(best_terms) FILTER (field = 'bottom5_lines'), '') AS best_terms_bottom5_lines "
        "FROM docs LEFT JOIN btext USING (doc_id) GROUP BY doc_id, path"
    ),
    "head_lines": _sql("SELECT doc_id, top5_lines FROM d3"),
    "tail_lines": _sql("SELECT doc_id, bottom5_lines FROM d3"),
    "normalize_lines": _sql("SELECT doc_id, contents FROM docs"),
    "provenance": "SELECT doc_id, 'documents.parquet' AS source_name, true AS dated, true AS placed FROM documents",
    "size_kb": _sql("SELECT doc_id, round(size_kb, 6) AS size_kb FROM docs"),
    "keyword_filter": _sql(
        f"SELECT doc_id, path, contents FROM docs WHERE path = '{cat.KEYWORD_PATH}'"
    ),
    "range_filter": _sql(
        "SELECT doc_id, round(size_kb, 6) AS size_kb FROM docs WHERE size_kb BETWEEN "
        f"{cat.SIZE_RANGE[0]} AND {cat.SIZE_RANGE[1]}"
    ),
    "best_terms_text": _sql("SELECT field, doc_id, best_terms FROM btext"),
    "topic_terms": _sql("SELECT topic_id, term, weight FROM tt"),
    "tokenize": _sql("SELECT doc_id, pos, term FROM tok WHERE field = 'contents'"),
    "token_positions": _sql(
        f"SELECT doc_id, pos, lower(word) AS term, stop - length(word) AS start_off, stop AS end_off FROM ("
        f"SELECT doc_id, pos, replace(regexp_extract(piece, '(?s)^.*?({WORD})$', 1), {MARK}, '') AS word, "
        f"CAST(sum(length(replace(piece, {MARK}, ''))) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS stop "
        "FROM (SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) - 1 AS pos FROM ("
        f"SELECT doc_id, regexp_extract_all({_marked('contents')}, '(?s).*?{WORD}') AS pieces FROM docs)))"
    ),
    "postings": _sql(
        "SELECT doc_id, term, count(*) AS tf, string_agg(pos::VARCHAR, ' ' ORDER BY pos) AS positions "
        "FROM tok WHERE field = 'contents' GROUP BY ALL"
    ),
    "field_postings": _sql("SELECT field, doc_id, term, tf FROM p3"),
    "doc_freq": _sql("SELECT term, df FROM ts"),
    "term_stats": _sql("SELECT field, term, df, cf FROM ts3"),
    "doc_length": _sql(
        "SELECT field, doc_id, doc_len::BIGINT AS doc_len, len(list_distinct(toks))::BIGINT AS n_terms "
        "FROM lists JOIN dl3 USING (field, doc_id)"
    ),
    "field_stats": _sql(
        "SELECT fs3.*, n_terms, n_postings FROM fs3 JOIN (SELECT field, count(*) AS n_terms, "
        "sum(df)::BIGINT AS n_postings FROM ts3 GROUP BY ALL) USING (field)"
    ),
    "vocabulary": _sql("SELECT term, df FROM ts"),
    "term_vector": _sql(
        "SELECT doc_id, term, tf FROM p WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)"
    ),
    "postings_lookup": _sql(f"SELECT doc_id, tf FROM p WHERE term = '{cat.LOOKUP_TERM}'"),
    "weights": _sql(
        "SELECT doc_id, term, "
        + ", ".join(f"{_weight(s)} AS w_{s}" for s in ("bin", "tf", "tfxidf"))
        + " FROM p"
    ),
    "tfidf_weights": _sql(f"SELECT doc_id, term, round({TFIDF_W}, 6) AS tfidf FROM p"),
    "l1_normalize": _sql(
        "SELECT doc_id, term, round(w::DOUBLE / nullif(sum(w) OVER (PARTITION BY doc_id), 0), 6) AS w_l1 "
        f"FROM (SELECT doc_id, term, {_weight('tfxidf')} AS w FROM p)"
    ),
    "best_terms": _sql(
        "SELECT field, doc_id, term, tf, df, round(tfidf, 6) AS tfidf, rank FROM best"
    ),
    **{f"similar_docs_{s}": _similar_docs(s) for s in ("bin", "tf", "tfxidf")},
    **{f"similar_terms_{s}": _similar_terms(s) for s in ("bin", "tf", "tfxidf")},
    "match_any": _sql("SELECT topic_id, doc_id, count(*) AS n_terms FROM m GROUP BY ALL"),
    **{
        f"search_{name}": _sql(f"SELECT {RUN_OUT} FROM r", {"r": _run(model, cat.CUT)})
        for name, model in (("tfidf", TFIDF), ("jm", JM), ("dir", DIR))
    },
    "search_pruned": _sql(
        f"SELECT {RUN_OUT} FROM r",
        {
            "short": "SELECT * FROM (SELECT topic_id, term, weight, row_number() OVER (PARTITION BY topic_id "
            "ORDER BY df, term) AS place, count(*) OVER (PARTITION BY topic_id) AS n FROM tt JOIN ts USING (term)) "
            "WHERE place <= 2 OR place = n",
            "sm": "SELECT topic_id, weight, p.* FROM short JOIN p USING (term)",
            "r": _run(TFIDF, cat.CUT, "sm"),
        },
    ),
    "search_weighted": _sql(
        f"SELECT {RUN_OUT} FROM r",
        {
            "bt": "SELECT topic_id, term, round(weight / count(*) OVER (PARTITION BY term), 6) AS weight FROM tt",
            "bm": "SELECT topic_id, weight, p.* FROM bt JOIN p USING (term)",
            "r": _run(JM, cat.CUT, "bm"),
        },
    ),
    "top_m": _sql(f"SELECT {RUN_OUT} FROM r", {"r": _run(TFIDF, cat.DEPTH)}),
    "total_hits": _sql("SELECT topic_id, count(DISTINCT doc_id) AS hits FROM m GROUP BY ALL"),
    "run_listing": _sql(
        "SELECT r.topic_id, r.rank, r.doc_id, round(r.score, 6) AS score, (CASE WHEN q.doc_id IS NULL THEN 0 "
        "ELSE 1 END)::BIGINT AS relevant, substr(contents, 1, 30) AS snippet FROM run r JOIN docs "
        "ON docs.doc_id = r.doc_id LEFT JOIN qrels q ON q.topic_id = r.topic_id AND q.doc_id = r.doc_id"
    ),
    "topic_range": _sql(
        f"SELECT {RUN_OUT} FROM run WHERE rank <= {cat.CUT} AND topic_id <= {_split(0.5)}"
    ),
    "precision_at_n": _sql("SELECT topic_id, round(P, 6) AS P FROM met"),
    "recall_at_n": _sql("SELECT topic_id, n_rel, round(R, 6) AS R FROM met"),
    "average_precision": _sql("SELECT topic_id, round(MAP, 6) AS AP FROM met"),
    "mean_metric": _sql(
        "SELECT "
        + ", ".join(f"round({_mean(v)}, 6) AS {v}" for v in ("P", "R", "MAP"))
        + " FROM met"
    ),
    "relevant_list": _sql("SELECT topic_id, doc_id FROM qrels"),
    "feedback_docs": _sql("SELECT topic_id, doc_id, round(score, 6) AS score, place FROM rs"),
    "feedback_term_values": _sql("SELECT topic_id, term, round(value, 6) AS value FROM vals"),
    "feedback_terms": _sql("SELECT topic_id, term, round(value, 6) AS value, rank FROM bestv"),
    "expanded_query": _sql("SELECT topic_id, term, round(weight, 6) AS weight FROM exq"),
    "feedback_search": _sql(f"SELECT {RUN_OUT} FROM xrun"),
    "feedback_residual": _sql(
        "SELECT topic_id, n_rel, round(P, 6) AS P, round(R, 6) AS R, round(MAP, 6) AS MAP FROM xmet",
        {"xmet": _metrics("xrun", "resid", "topics", cat.CUT)},
    ),
    **{
        f"tune_{name}": _sql(
            "SELECT model, param, round(value, 6) AS value, place FROM board WHERE metric = 'MAP' "
            f"AND model = '{name}'"
        )
        for name in ("jm", "dir")
    },
    "best_param": _sql(
        "SELECT model, param, round(value, 6) AS value FROM board WHERE metric = 'MAP' AND place = 1"
    ),
    "holdout_metrics": _sql(
        "SELECT model, param, topic_id, round(value, 6) AS value FROM held WHERE metric = 'MAP'"
    ),
    "holdout_mean": _sql(
        f"SELECT model, param, round(coalesce({_mean('value')}, 0), 6) AS value FROM held "
        "WHERE metric = 'MAP' GROUP BY model, param"
    ),
    "paired_t_test": _sql(
        f"SELECT metric, n, round(t, 6) AS t, round(p, 6) AS p, p <= {cat.ALPHA} AS significant FROM tt2"
    ),
    "wilcoxon_exact": _sql(
        "SELECT metric, n, w_plus, w, round(z, 6) AS z, round(p, 6) AS p, "
        f"p <= {cat.ALPHA} AS significant FROM sw"
    ),
    "wilcoxon_normal": _sql(
        "SELECT metric, n, w_plus, w, round(z, 6) AS z, round(p, 6) AS p, "
        f"p <= {cat.ALPHA} AS significant FROM sw4"
    ),
    "compare_systems": _sql(
        f"SELECT metric, tt2.n, round(tt2.p, 6) AS p_t, tt2.p <= {cat.ALPHA} AS t_significant, "
        f"round(sw.p, 6) AS p_w, sw.p <= {cat.ALPHA} AS w_significant FROM tt2 JOIN sw USING (metric)"
    ),
    "compare_all_pairs": _sql(
        "SELECT split_part(metric, '|', 1) AS metric, split_part(metric, '|', 2) AS system_a, "
        "split_part(metric, '|', 3) AS system_b, tt3.n, round(tt3.p, 6) AS p_t, "
        f"tt3.p <= {cat.ALPHA} AS t_significant, round(sw3.p, 6) AS p_w, sw3.p <= {cat.ALPHA} AS w_significant "
        "FROM tt3 JOIN sw3 USING (metric)"
    ),
}
