import random
import time

import pytest
import regex
from pyspark.sql import functions as F

from rankspark.functions import analysis
from rankspark.functions.exact import exact_sum, total_units, units

# an independent statement of the word rule, character by character


def is_word_char(c):
    return regex.match(r"[\p{L}\p{N}\p{M}_]", c) is not None and not ideograph(c)


def ideograph(c):
    return regex.match("[぀-ゟ㐀-䶿一-鿿豈-﫿]", c) is not None


def spans(text):
    out, i = [], 0
    while i < len(text):
        if ideograph(text[i]):
            out.append((text[i], i, i + 1))
            i += 1
            continue
        j = i
        while j < len(text) and text[j] == "_":
            j += 1
        starts = j < len(text) and regex.match(r"[\p{L}\p{N}]", text[j]) and not ideograph(text[j])
        if not starts:
            i = max(j, i + 1)
            continue
        end, length = j + 1, 0
        while end < len(text) and length < 254:
            c, before = text[end], text[end - 1]
            after = text[end + 1] if end + 1 < len(text) else " "
            letters = c in ".:·'’" and regex.match(r"[\p{L}\p{M}_]", before) and regex.match(r"[\p{L}_]", after)
            digits = c in ".,;'’" and regex.match(r"\p{N}", before) and regex.match(r"\p{N}", after)
            if not (is_word_char(c) or letters or digits):
                break
            end, length = end + 1, length + 1
        out.append((text[i:end].lower(), i, end))
        i = end
    return out


CASES = [
    "",
    " ",
    "Don't stop: it's 3.14 and 1,000; a.b.c x:y 1.a _x __ _1_ e.g.",
    "l’été naïve café 12'5 'quoted' end.",
    "日本語 text ひらがな カタカナ",
    "x" * 600,
    "a" + "." * 5 + "b",
]


def sample_texts():
    rng = random.Random(7)
    alphabet = "ab1_.,:;'’ é-\n日"
    return CASES + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(200)]


def test_tokens_and_spans_match_character_walk(spark):
    texts = sample_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    got = df.select(
        "i", analysis.tokens(F.col("text")).alias("t"), analysis.token_spans(F.col("text")).alias("s")
    ).collect()
    for row in got:
        want = spans(texts[row.i])
        assert row.t == [w for w, _, _ in want], texts[row.i]
        assert [tuple(s) for s in row.s] == want, texts[row.i]


def test_spans_of_a_long_text(spark):
    text = " ".join(f"w{i}" for i in range(3000))
    df = spark.createDataFrame([(text,)], "text STRING")
    got = df.select(analysis.token_spans(F.col("text")).alias("s")).first().s
    assert [tuple(s) for s in got] == spans(text)


def test_stopwords_are_optional(spark):
    df = spark.createDataFrame([("The cat AND the dog",)], "text STRING")
    assert df.select(analysis.tokens(F.col("text"))).first()[0] == ["the", "cat", "and", "the", "dog"]
    assert df.select(analysis.tokens(F.col("text"), ["THE"])).first()[0] == ["cat", "and", "dog"]


@pytest.mark.parametrize(
    "text", ["", "a", "a\n", "a\r\nb\rc\n", "\n\n", "1\n2\n3\n4\n5", "1\n2\n3\n4\n5\n6\n7\n", "\n\n\n\n\n\nx"]
)
def test_line_fields(spark, text):
    lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    lines = lines[:-1] if lines[-1] == "" else lines
    closed = lambda part: "".join(line + "\n" for line in part)
    df = spark.createDataFrame([(text,)], "text STRING").select(
        analysis.normalized(F.col("text")).alias("c")
    )
    row = df.select("c", analysis.head_lines(F.col("c")), analysis.tail_lines(F.col("c"))).first()
    assert tuple(row) == (closed(lines), closed(lines[:5]), closed(lines[-5:]))


def test_extension_rule(spark):
    paths = ["a.d/noext", "plain/noext", "x/f.sgm", "b.TXT", "c.txt"]
    df = spark.createDataFrame([(p,) for p in paths], "path STRING")
    kept = df.filter(analysis.has_extension(F.col("path"), [".txt", ".sgm"])).collect()
    assert [r.path for r in kept] == ["plain/noext", "x/f.sgm", "c.txt"]


def test_emoji_are_words(spark):
    text = "ok ☃ 👍🏽👩‍👩‍👧 🇩🇪🇫🇷x ©"
    got = spark.createDataFrame([(text,)], "t STRING").select(analysis.tokens(F.col("t"))).first()[0]
    assert got == ["ok", "☃", "👍🏽", "👩‍👩‍👧", "🇩🇪", "🇫🇷", "x"]


def test_offsets_of_a_long_tail_are_quick(spark):
    text = "word " + "-" * 200_000
    start = time.time()
    spans = spark.createDataFrame([(text,)], "t STRING").select(analysis.token_spans(F.col("t"))).first()[0]
    assert [tuple(s) for s in spans] == [("word", 0, 4)] and time.time() - start < 20


def test_exact_sums_of_large_numbers(spark):
    df = spark.createDataFrame([(1e8,), (3e8,), (0.25,)] + [(8e7,)] * 3, "x DOUBLE")
    assert df.select(exact_sum(F.col("x"))).first()[0] == 6.4e8 + 0.25
    with pytest.raises(Exception, match="too large"):
        df.select(total_units(units(F.col("x")))).first()
    near = df.filter("x < 9e7")
    with pytest.raises(Exception, match="range of BIGINT|verflow"):
        near.select(total_units(units(F.col("x")))).first()
