"""Toxicity scores: a learned lexicon, Levenshtein automata on its trie, context windows.

1. A lexicon of words and word beginnings is learned from labelled rows: terms that
   occur in a much larger share of toxic texts.
2. A word of a text is run through the Levenshtein automata of all terms at once: the
   states are the trie nodes reachable with so many errors, so automata and trie are
   intersected while reading the word.  Sets of states become states of a deterministic
   automaton when first met, and each distinct word is read once per task.
3. Every hit is judged in a window of neighbouring words: quotation marks around it and
   reporting verbs speak for quotation, address and other hits for abuse.
4. Hits by term, errors and context, with weights from the labelled rows, give a few
   features per text; a logistic model on them gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankspark.llm.language import held_out

# Signs and words that the context window looks at.
QUOTES_OPEN = "\"'`„“«‘‹「"
QUOTES_CLOSE = "\"'`”“»’›」"
REPORTING = frozenset(
    "said says say wrote writes called calls calling quote quoted quoting reported reports "
    "sagte schrieb nannte zitat dit écrit appelé cite dijo escribió llamó cita word term".split()
)
ADDRESS = frozenset("you your youre you're u ur du dich dein ihr tu te toi ton vous votre tú ti usted eres".split())
PREFIX = "*"


def allowed_errors(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class FuzzyLexicon:
    """All terms within their allowed number of errors of a word.

    Terms that end in ``*`` match any word that begins so.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.goto: list[dict[str, int]] = [{}]
        self.ends: list[dict[int, bool]] = [{}]  # node -> {term: is a beginning}
        self.limit = [0]
        for i, term in enumerate(terms):
            word, node = term.rstrip(PREFIX), 0
            errors = allowed_errors(len(word))
            self.limit[0] = max(self.limit[0], errors)
            for c in word:
                if c not in self.goto[node]:
                    self.goto[node][c] = len(self.goto)
                    self.goto.append({})
                    self.ends.append({})
                    self.limit.append(0)
                node = self.goto[node][c]
                self.limit[node] = max(self.limit[node], errors)
            self.ends[node][i] = term.endswith(PREFIX)
        self.alphabet = {c for edges in self.goto for c in edges}
        self.numbers: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.accept: list[dict[int, int]] = []
        self.start = self._number(self._close({0: 0}), {})

    def _close(self, nodes: dict[int, int]) -> dict[int, int]:
        """Adds nodes reached by leaving out characters of a term."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            errors = nodes[node] + 1
            for child in self.goto[node].values():
                if errors <= self.limit[child] and errors < nodes.get(child, 99):
                    nodes[child] = errors
                    todo.append(child)
        return nodes

    def _number(self, nodes: dict[int, int], done: dict[int, int]) -> int:
        """State of a set of (node, errors) and of beginnings already matched."""
        done = dict(done)
        for node, errors in nodes.items():
            for term, prefix in self.ends[node].items():
                if prefix and errors <= allowed_errors(len(self.terms[term]) - 1):
                    done[term] = min(errors, done.get(term, 99))
        key = (tuple(sorted(nodes.items())), tuple(sorted(done.items())))
        state = self.numbers.get(key)
        if state is None:
            state = self.numbers[key] = len(self.sets)
            self.sets.append((nodes, done))
            self.moves.append({})
            whole = dict(done)
            for node, errors in nodes.items():
                for term, prefix in self.ends[node].items():
                    if not prefix and errors <= allowed_errors(len(self.terms[term])):
                        whole[term] = min(errors, whole.get(term, 99))
            self.accept.append(whole)
        return state

    def _move(self, state: int, c: str) -> int:
        nodes, done = self.sets[state]
        after: dict[int, int] = {}
        for node, errors in nodes.items():
            # an extra character, a replaced one, the right one
            if errors + 1 <= self.limit[node] and errors + 1 < after.get(node, 99):
                after[node] = errors + 1
            for own, child in self.goto[node].items():
                cost = errors + (own != c)
                if cost <= self.limit[child] and cost < after.get(child, 99):
                    after[child] = cost
        return self._number(self._close(after), done)

    def matches(self, word: str) -> dict[int, int]:
        """{term number: errors} of all terms that match."""
        state = self.start
        for c in word:
            c = c if c in self.alphabet else "\0"
            found = self.moves[state].get(c)
            if found is None:
                found = self.moves[state][c] = self._move(state, c)
            state = found
        return self.accept[state]


# what a token is, as bits
OPENS, CLOSES, REPORTS, ADDRESSES = 1, 2, 4, 8


def read_token(token: str, lexicon: FuzzyLexicon) -> tuple[int, int, int]:
    """(bits, term or -1, errors) of one token; the best match of its parts."""
    low = token.lower()
    bare = low.strip("".join({*QUOTES_OPEN, *QUOTES_CLOSE, *".,;:!?()[]{}*#$%&|-_<>…/\\"}))
    bits = OPENS * (low[:1] in QUOTES_OPEN) | CLOSES * (low.rstrip(".,;:!?)")[-1:] in QUOTES_CLOSE)
    bits |= REPORTS * (bare in REPORTING) | ADDRESSES * (bare in ADDRESS)
    parts = {bare, *re.split(r"[\W_]+", low), re.sub(r"[\W_]+", "", low)}
    best = (99, 0, -1)
    for part in parts:
        if part:
            for term, errors in lexicon.matches(part).items():
                best = min(best, (errors, -len(lexicon.terms[term]), term))
    return bits, best[2], best[0] if best[2] >= 0 else 0


def in_quotation(bits: np.ndarray, at: int, left: int, right: int) -> bool:
    """A quotation opens before and closes behind the hit, or a reporting verb stands near."""
    before, behind = bits[left : at + 1], bits[at:right]
    opened = np.flatnonzero(before & OPENS)
    if len(opened) and (behind & CLOSES).any():
        closed = np.flatnonzero(before[:-1] & CLOSES)
        if not len(closed) or closed[-1] < opened[-1]:
            return True
    return bool((before & REPORTS).any() and not (bits[left:right] & ADDRESSES).any())


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    coefficients: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0, 0, 0, 0, 0]))
    window: int = 6
    quoted: float = 0.3
    address: float = 1.25


def features(found: list[tuple[int, int, float]], n_words: int, model: Model) -> list[float]:
    """Features of a text from its hits (term, errors, context factor)."""
    worth = [max(0.0, model.weights.get((t, e), 0.0)) * f for t, e, f in found]
    total = sum(worth)
    size = np.log1p(n_words)
    return [1.0, max(worth, default=0.0), np.log1p(total), total / (1.0 + n_words) ** 0.5, size, float(total > 0) * size]


def _hits_task(terms: list[str], window: int, quoted: float, address: float, most_words: int):
    """Yields per batch the texts' word counts and hits."""
    lexicon = FuzzyLexicon(terms)

    def read(batches: Iterator[pa.RecordBatch]):
        from rankspark.llm.columns import chunks, text_bytes, words
        from rankspark.llm.memo import WordMemo

        known = [np.zeros((0, 3), np.int32)]

        def learn(new: list[bytes]) -> None:
            rows = [read_token(w.decode(), lexicon) for w in new]
            known[0] = np.concatenate([known[0], np.array(rows, np.int32)])

        memo = WordMemo(learn)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            counts, hits = [], []
            for a, b in chunks(offsets):
                if memo.size > most_words:
                    memo.clear()
                    known[0] = known[0][:0]
                text = raw[offsets[a] : offsets[b]]
                starts, ends, first = words(text, offsets[a : b + 1] - offsets[a])
                counts += np.diff(first).tolist()
                if not len(starts):
                    hits += [[] for _ in range(b - a)]
                    continue
                numbers = memo.numbers(text, starts, ends)
                bits, term, errors = known[0][numbers].T
                at = np.flatnonzero(term >= 0)
                own: list[list] = [[] for _ in range(b - a)]
                owner = np.searchsorted(first, at, side="right") - 1
                for p, i in zip(at.tolist(), owner.tolist(), strict=True):
                    left, right = max(int(first[i]), p - window), min(int(first[i + 1]), p + window + 1)
                    if in_quotation(bits, p, left, right):
                        factor = quoted
                    elif (bits[left:right] & ADDRESSES).any():
                        factor = address
                    else:
                        factor = 1.0
                    own[i].append((int(term[p]), int(errors[p]), factor))
                hits += own
            yield batch, counts, hits

    return read


def _sample_task(*args):
    read = _hits_task(*args)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts, hits in read(batches):
            grouped = [Counter(h) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array([[t for t, _, _ in g] for g in grouped], pa.list_(pa.int32())),
                    pa.array([[e for _, e, _ in g] for g in grouped], pa.list_(pa.int32())),
                    pa.array([[f for _, _, f in g] for g in grouped], pa.list_(pa.float64())),
                    pa.array([list(g.values()) for g in grouped], pa.list_(pa.int64())),
                ],
                ["toxic", "n_words", "terms", "errors", "factors", "times"],
            )

    return work


def _score_task(sent, most_words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        read = _hits_task(model.terms, model.window, model.quoted, model.address, most_words)
        for batch, counts, hits in read(batches):
            x = np.array([features(h, n, model) for h, n in zip(hits, counts, strict=True)]).reshape(len(counts), -1)
            score = 1 / (1 + np.exp(-np.clip(x @ model.coefficients, -30, 30))) if len(x) else np.zeros(0)
            columns = [
                pa.array(score, pa.float64()),
                pa.array([len(h) for h in hits], pa.int64()),
                pa.array([sum(f == model.quoted for _, _, f in h) for h in hits], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *columns], [*batch.schema.names[1:], "score", "n_hits", "n_quoted"]
            )

    return work


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01, steps: int = 50) -> np.ndarray:
    """Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    ridge = penalty * len(x) / 100 * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def evidence(a, b, toxic: float, clean: float):
    """Log-likelihood ratio of a in ``toxic`` and b in ``clean`` texts, as a normal score; numbers or columns."""
    both = (a + b) / (toxic + clean)
    log = np.log if isinstance(a, int) else F.log
    # x * log(x / expected), 0 for x = 0
    part = lambda x, n: x * log((x + 1e-9) / (both * n))
    root = np.sqrt if isinstance(a, int) else F.sqrt
    return root(2 * (part(a, toxic) + part(b, clean)) + 1e-6)


def choose_terms(sample: DataFrame, most: int, least_docs: int = 4, lift: float = 4.0, z: float = 4.5) -> list[str]:
    """Words and word beginnings (3 to 8 characters, marked ``*``) that mark toxic texts."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{M}\p{N}'@$]+"), lambda w: F.length(w).between(3, 40))
    begin = [
        F.transform(F.filter(F.array_distinct(words), lambda w, n=n: F.length(w) > n), lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit(PREFIX)))
        for n in range(3, 9)
    ]
    terms = F.explode(F.array_distinct(F.concat(words, *begin)))
    totals = sample.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    toxic, clean = totals["t"] or 0, totals["c"] or 0
    if not toxic or not clean:
        return []
    a, b = F.sum("toxic"), F.sum(1 - F.col("toxic"))
    counts = sample.select(terms.alias("term"), "toxic").groupBy("term").agg(a.alias("a"), b.alias("b"))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (clean + 1.0))
    ranked = (
        counts.filter(F.col("a") >= least_docs)
        .withColumn("odds", odds)
        .withColumn("z", evidence(F.col("a"), F.col("b"), toxic, clean))
        .filter((F.col("odds") >= float(np.log(lift))) & (F.col("z") >= z))
        .orderBy(F.desc("z"), F.desc(F.length("term")), "term")
        .limit(20 * most)
        .collect()
    )
    chosen: list[str] = []
    for row in ranked:
        bare = row["term"].rstrip(PREFIX)
        # a term says nothing new if one chosen before is a beginning of it, or it of one
        if not any(bare.startswith(c.rstrip(PREFIX)) or c.startswith(bare) for c in chosen):
            chosen.append(row["term"])
        if len(chosen) == most:
            break
    return chosen


def learn(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, most_terms: int = 200, window: int = 6
) -> Model:
    """Fits lexicon, weights and logistic model on labelled rows.

    At most ``sample_rows`` labels are used, those of least hash of their doc_id, so what
    reaches the driver does not grow with the corpus.  Labels without id or value, and
    ids with both values, are passed over.  Without both classes the model scores all
    texts alike.
    """
    clear = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .filter("toxic = most")
        .select("_id", F.col("toxic").cast("int").alias("toxic"))
    )
    picked = clear.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(picked), texts["doc_id"] == picked["_id"]).select("text", "toxic")
    terms = choose_terms(sample, most_terms)
    if not terms:
        return Model()
    model = Model(terms=terms, window=window)
    rows = sample.mapInArrow(
        _sample_task(terms, window, model.quoted, model.address, 500_000),
        "toxic int, n_words long, terms array<int>, errors array<int>, factors array<double>, times array<long>",
    ).collect()
    y = np.array([r["toxic"] for r in rows], float)
    n_toxic, n_clean = y.sum(), (1 - y).sum()
    seen = [Counter(), Counter()]
    for r in rows:
        seen[r["toxic"]].update(set(zip(r["terms"], r["errors"], strict=True)))
    for code in {*seen[0], *seen[1]}:
        a, b = seen[1][code], seen[0][code]
        odds = np.log((a + 0.5) / (n_toxic + 1)) - np.log((b + 0.5) / (n_clean + 1))
        if evidence(a, b, n_toxic, n_clean) >= 2.5:
            model.weights[code] = float(np.clip(odds, 0, 6)) * (a + b) / (a + b + 2)
        elif b >= 3:
            model.weights[code] = 0.0
    for i, term in enumerate(terms):
        # an unseen misspelling of a whole word counts for two thirds of the word
        if not term.endswith(PREFIX):
            for errors in range(1, allowed_errors(len(term)) + 1):
                model.weights.setdefault((i, errors), model.weights.get((i, 0), 0.0) * 2 / 3)
    x = np.array([
        features(
            [(t, e, f) for t, e, f, k in zip(r["terms"], r["errors"], r["factors"], r["times"], strict=True) for _ in range(k)],
            r["n_words"],
            model,
        )
        for r in rows
    ])
    model.coefficients = fit_logistic(x, y)
    return model


def score(
    docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None, most_words: int = 1_000_000
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with score, n_hits and n_quoted.

    Columns of these three names are replaced.  A null or empty text has no hits and gets the score of such texts.  ``most_words``
    bounds the words a task remembers.
    """
    kept = (docs.select(*keep) if keep else docs).drop("score", "n_hits", "n_quoted")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(text.alias("_text"), *kept.columns).mapInArrow(
        _score_task(sent, most_words), f"{schema}, score double, n_hits long, n_quoted long"
    )


def detect(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits, n_quoted): learns on rows that are not held out."""
    train = docs.filter(~held_out(F.col("doc_id")))
    model = learn(train, labels.filter(~held_out(F.col("doc_id"))), **options)
    marked = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return score(marked, model, keep=("doc_id", "held_out")).select("doc_id", "held_out", "score", predicted, "n_hits", "n_quoted")
