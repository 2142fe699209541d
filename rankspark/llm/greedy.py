"""Greedy longest-match token counts by a linear automaton over a vocabulary trie.

Matching never goes back in the text.  Every trie node knows what happens if the next
character does not fit: how many pieces are then complete (its popped-token count) and
which node stands for the characters left over (its failure link).  The count of a word
is the sum of the counts on the links taken; no piece is ever built.

A word is matched with the word mark in front.  A character that begins no piece costs
its UTF-8 bytes, as in vocabularies with byte pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = "doc_id long, n_words long, n_tokens long"
# code points fit into so many bits of a transition's key
CODE_BITS = 21


class Automaton:
    """Trie with failure links; nodes are numbers, the root is 0."""

    def __init__(self, pieces: Iterable[str]):
        self.goto: dict[int, int] = {}
        self.fail, self.pops = [0], [0]
        whole, depth, edges = [False], [0], []
        for piece in pieces:
            node = 0
            for c in piece:
                key = node << CODE_BITS | ord(c)
                child = self.goto.get(key)
                if child is None:
                    child = self.goto[key] = len(whole)
                    whole.append(False)
                    depth.append(depth[node] + 1)
                    edges.append((node, c))
                    self.fail.append(0)
                    self.pops.append(0)
                node = child
            whole[node] = bool(node)
        # links of a node need those of all shorter nodes
        for child in sorted(range(1, len(whole)), key=depth.__getitem__):
            node, c = edges[child - 1]
            if whole[child]:
                self.fail[child], self.pops[child] = 0, 1
            elif node:
                self.fail[child], self.pops[child] = self._after(self.fail[node], c, self.pops[node])
            else:
                self.fail[child], self.pops[child] = 0, len(c.encode())

    def _after(self, node: int, c: str, count: int) -> tuple[int, int]:
        """Node and popped pieces once ``c`` is read at ``node``."""
        code = ord(c)
        while (child := self.goto.get(node << CODE_BITS | code)) is None:
            if not node:
                return 0, count + len(c.encode())
            count += self.pops[node]
            node = self.fail[node]
        return child, count

    def count(self, word: str) -> int:
        goto, fail, pops = self.goto, self.fail, self.pops
        node = total = 0
        for c in word:
            code = ord(c)
            while (child := goto.get(node << CODE_BITS | code)) is None:
                if not node:
                    total += len(c.encode())
                    child = 0
                    break
                total += pops[node]
                node = fail[node]
            node = child
        while node:
            total += pops[node]
            node = fail[node]
        return total


def load_pieces(path: str) -> list[str]:
    """The text pieces of a sentencepiece file: no control, unknown or byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


_automata: dict[str, Automaton] = {}


def _count_task(vocabulary: str, mark: str, most_words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        from rankspark.llm.columns import chunks, text_bytes, words
        from rankspark.llm.memo import WordMemo

        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        if path not in _automata:
            _automata[path] = Automaton(load_pieces(path))
        automaton, known = _automata[path], [np.zeros(0, np.int64)]

        def learn(new: list[bytes]) -> None:
            counts = [automaton.count(mark + w.decode()) for w in new]
            known[0] = np.concatenate([known[0], np.array(counts, np.int64)])

        memo = WordMemo(learn)
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            n_words, n_tokens = [], []
            for a, b in chunks(offsets):
                if memo.size > most_words:
                    memo.clear()
                    known[0] = known[0][:0]
                text = raw[offsets[a] : offsets[b]]
                starts, ends, first = words(text, offsets[a : b + 1] - offsets[a])
                total = np.zeros(len(starts) + 1, np.int64)
                if len(starts):
                    numbers = memo.numbers(text, starts, ends)
                    np.cumsum(known[0][numbers], out=total[1:])
                n_words.append(np.diff(first))
                n_tokens.append(np.diff(total[first]))
            if n_words:
                columns = [pa.array(np.concatenate(c)) for c in (n_words, n_tokens)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_words", "n_tokens"])

    return work


def token_counts(
    docs: DataFrame,
    vocabulary: str = "piece_bpe_32k.model",
    mark: str = "▁",
    most_words: int = 1_000_000,
) -> DataFrame:
    """(doc_id, n_words, n_tokens): length of each text in greedy longest-match pieces.

    ``docs`` needs (doc_id, text); other columns are ignored.  Words are what white space
    (blank, tab to carriage return) parts.  A null or empty text has no words and no
    tokens; a null doc_id stays null; repeated rows are counted each; an empty table gives
    no rows.  ``most_words`` bounds the words a task remembers, not what it counts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count_task(vocabulary, mark, most_words), COUNTS)
