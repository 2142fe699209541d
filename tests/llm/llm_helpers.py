import random
import re

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def invent(rng, n):
    """n invented words in sentences."""
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 8))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) rows: copies, near copies, shared passages, nulls, empty, long and repeated rows."""
    rng = random.Random(7)
    base, passage = invent(rng, 120), invent(rng, 60)
    rows = [(1, base), (2, base), (3, base.replace(base.split()[50], "zzz")), (4, invent(rng, 40) + " " + passage)]
    rows += [(5, passage + " " + invent(rng, 30)), (6, None), (7, ""), (8, "one two"), (9, "one two"), (10, " \n\t ")]
    rows += [(11, "der " * 80), (12, "und der " + "der " * 60), (13, invent(rng, 3000)), (14, "Straße, İ ☃ 日本 it's"), (15, "x" * 5000)]
    for i in range(16, 22):
        words = base.split()
        for _ in range(i - 15):
            words[rng.randrange(len(words))] = invent(rng, 1)
        rows.append((i, " ".join(words)))
    rows += [(8, "one two"), (8, "eight again " + passage.upper()), (None, base), (None, "no id here")]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus as a table whose other columns have the names of results."""
    rows = [(i, t, "en", "x", len(t or ""), "key", 0.5) for i, t in corpus]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, key string, score double"
    )


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)
