from hypothesis import given, settings
from hypothesis import strategies as st
from rankspark.llm import greedy


def by_pieces(word, vocabulary):
    """Greedy longest match by trying every length."""
    n, at = 0, 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if word[at:end] in vocabulary:
                n, at = n + 1, end
                break
        else:
            n, at = n + len(word[at].encode()), at + 1
    return n


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("abcé", min_size=1, max_size=6), max_size=12),
    st.lists(st.text("abcéx", max_size=14), max_size=10),
)
def test_counts_equal_greedy_matching(vocabulary, words):
    automaton = greedy.Automaton(vocabulary)
    for word in words:
        assert automaton.count(word) == by_pieces(word, set(vocabulary))


def test_real_vocabulary(spark):
    import public_tokenizers

    pieces = set(greedy.load_pieces(public_tokenizers.path("piece_bpe_32k.model")))
    texts = ["the cat sat on the mat", "Straße, été!  日本\tх\nfoo", "", None, "   ", "a" * 30_000, "☃ snow"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "one two", "x"), (0, texts[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, greedy.token_counts(docs).collect()), key=str)
    want = []
    for key, text, _ in rows:
        words = (text or "").split()
        want.append((key, len(words), sum(by_pieces("▁" + w, pieces) for w in words if len(w) < 99)))
        if "a" * 99 in (text or ""):
            want[-1] = (key, 1, greedy.Automaton(pieces).count("▁" + text))
    assert got == sorted(want, key=str)
    assert greedy.token_counts(docs.limit(0)).count() == 0
