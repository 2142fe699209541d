"""Text analysis as Column expressions (no UDF anywhere)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word-break classes.  A word is a run of letters, digits,
# marks and underscores holding at least one letter or digit; a joiner stays
# inside a word only between letters, or between digits; ideographs and
# hiragana stand alone; a word longer than 255 characters is cut every 255; an
# emoji is a word, with its modifiers and with what a zero-width joiner ties to it.
IDEOGRAPHS = r"぀-ゟ㐀-䶿一-鿿豈-﫿\x{20000}-\x{3FFFF}"
WORD_CHAR = rf"[\p{{L}}\p{{N}}\p{{M}}_&&[^{IDEOGRAPHS}]]"
WORD_START = rf"_*+[\p{{L}}\p{{N}}&&[^{IDEOGRAPHS}]]"
LETTER_JOINER = r"[.:·'’](?<=[\p{L}\p{M}_].)(?=[\p{L}_])"
DIGIT_JOINER = r"[.,;'’](?<=\p{N}.)(?=\p{N})"
FLAG = r"[\x{1F1E6}-\x{1F1FF}]{2}"
PICTURE = (
    r"[\x{1F000}-\x{1F1E5}\x{1F200}-\x{1F3FA}\x{1F400}-\x{1FAFF}"
    r"\x{231A}\x{231B}\x{23E9}-\x{23F3}\x{2600}-\x{27BF}\x{2B50}\x{2B55}]"
    r"[\x{FE0E}\x{FE0F}\x{1F3FB}-\x{1F3FF}]*+"
)
WORD = (
    rf"{WORD_START}(?:{WORD_CHAR}|{LETTER_JOINER}|{DIGIT_JOINER}){{0,254}}+"
    rf"|[{IDEOGRAPHS}]\p{{M}}*+"
    rf"|{FLAG}|{PICTURE}(?:\x{{200D}}{PICTURE})*+"
)
LINE_END = r"\r\n|\r|\n"


def tokens(text: Column, stopwords: Sequence[str] = ()) -> Column:
    """Lower-cased words of ``text`` in order, as ARRAY<STRING>.

    Without ``stopwords`` nothing is removed.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    if stopwords:
        drop = [w.lower() for w in stopwords]
        words = F.filter(words, lambda w: ~w.isin(drop))
    return words


def let(value: Column, body) -> Column:
    """Bind ``value`` so that ``body`` evaluates it once."""
    return F.transform(F.array(value), body)[0]


def _running_sum(lengths: Column) -> Column:
    """Running sums of an INT array, in two levels of about sqrt(n) each.

    One ``aggregate`` that appends to its array copies it at every step; the
    two levels keep a very long document near n**1.5 and inside its own row,
    where a window would shuffle every token.
    """

    def prefix(values: Column) -> Column:
        empty = F.array().cast("array<int>")
        start = F.struct(F.lit(0).alias("total"), empty.alias("sums"))

        def step(acc: Column, v: Column) -> Column:
            total = acc["total"] + v
            return F.struct(
                total.alias("total"), F.concat(acc["sums"], F.array(total)).alias("sums")
            )

        return F.aggregate(values, start, step)["sums"]

    def two_levels(values: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(values))).cast("int")

        def blocks(width: Column) -> Column:
            starts = F.sequence(F.lit(1), F.size(values), width)
            inner = F.transform(starts, lambda s: prefix(F.slice(values, s, width)))

            def shifted(parts: Column) -> Column:
                ends = prefix(F.transform(parts, lambda p: F.element_at(p, -1)))
                return let(
                    ends,
                    lambda e: F.flatten(
                        F.transform(
                            parts,
                            lambda p, i: F.transform(
                                p, lambda x: x + F.coalesce(F.get(e, i - 1), F.lit(0))
                            ),
                        )
                    ),
                )

            return let(inner, shifted)

        return let(width, blocks)

    return let(
        lengths,
        lambda v: F.when(F.size(v) > 0, two_levels(v)).otherwise(
            F.array().cast("array<int>")
        ),
    )


def token_spans(text: Column) -> Column:
    """ARRAY<STRUCT<term, start_off, end_off>> with offsets into ``text``.

    The text is cut into (gap, word) pieces, so the end of a word is the
    running sum of the piece lengths.
    """
    # anchored to the piece before: behind the last word the search ends at once
    piece = rf"\G((?s:.*?))({WORD})"
    words = F.regexp_extract_all(text, F.lit(piece), F.lit(2))
    lengths = F.transform(
        F.regexp_extract_all(text, F.lit(piece), F.lit(0)), lambda p: F.length(p)
    )
    return F.zip_with(
        words,
        _running_sum(lengths),
        lambda w, end: F.struct(
            F.lower(w).alias("term"),
            (end - F.length(w)).alias("start_off"),
            end.alias("end_off"),
        ),
    )


def normalized(text: Column) -> Column:
    """Every line of ``text`` followed by one ``\\n``, whatever its line ends were."""
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return let(
        unix,
        lambda t: F.when((t == "") | F.endswith(t, F.lit("\n")), t).otherwise(
            F.concat(t, F.lit("\n"))
        ),
    )


def head_lines(contents: Column, n: int = 5) -> Column:
    """First n lines of normalized text."""
    head = F.substring_index(contents, "\n", n)
    return F.when(head == contents, contents).otherwise(F.concat(head, F.lit("\n")))


def tail_lines(contents: Column, n: int = 5) -> Column:
    """Last n lines of normalized text."""
    return F.substring_index(contents, "\n", -(n + 1))


def size_kb(n_bytes: Column) -> Column:
    """Size in units of 1000 bytes."""
    return n_bytes / F.lit(1000.0)


def snippet(text: Column, n: int = 30) -> Column:
    return F.substring(text, 1, n)


def path_extension(path: Column) -> Column:
    """From the last dot of the whole path string, dot included; NULL if no dot."""
    return F.when(
        F.contains(path, F.lit(".")), F.concat(F.lit("."), F.substring_index(path, ".", -1))
    )


def has_extension(path: Column, extensions: Sequence[str]) -> Column:
    """True for a listed extension (case-sensitive) and for a path without a dot."""
    return ~F.contains(path, F.lit(".")) | path_extension(path).isin(list(extensions))
