"""Token ids of a word-based BPE file, with every distinct word encoded once.

The tokenizer splits a normalised text at fixed places and encodes each word by
itself, so ids of a text are its words' ids one after the other.  Words are found
by numpy over the bytes of many texts and looked up by hash; only words not met
before go through the tokenizer.  Texts with characters for which that shortcut is
not certain (see ``plain``) are handed to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
import unicodedata

import numpy as np

from rankspark.llm.memo import WordMemo

SPACE, LETTER, NUMBER, OTHER, UNSURE = range(5)
# The file's contractions, and its white space up to U+024F.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0)
SENTENCE_END = re.compile(r"[.!?]+")


def _code_classes(upto: int = 0x250) -> tuple[np.ndarray, np.ndarray]:
    """(class, lower case) of each code point; UNSURE where lower case changes the UTF-8 length."""
    kinds, lower = np.full(upto, UNSURE, np.uint8), np.arange(upto, dtype=np.int32)
    for c in range(upto):
        s = chr(c)
        small, group = s.lower(), unicodedata.category(s)[0]
        if c in WHITE:
            kinds[c] = SPACE
        elif group == "C" or len(small) != 1 or len(small.encode()) != len(s.encode()) or ord(small) >= upto:
            continue
        else:
            lower[c] = ord(small)
            kinds[c] = {"L": LETTER, "N": NUMBER}.get(group, OTHER)
    return kinds, lower


class WordIds:
    """Encodes chunks of texts; keeps up to ``most_words`` words between chunks."""

    def __init__(self, path: str, most_words: int = 1_000_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kinds, self.lower = _code_classes()
        self.most_words, self.memo = most_words, WordMemo(self.learn)
        self.forget()

    def forget(self) -> None:
        self.memo.clear()
        self.flat = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)
        self.stops = np.zeros(0, bool)

    def plain(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes in lower case, class of each byte, which texts are certain).

        Certain are texts of code points below U+0250 whose lower case has the same
        length, without control characters and without the start of a special token.
        """
        kinds, out = self.kinds[:128][np.minimum(raw, 127)], raw.copy()
        out[(raw >= 65) & (raw <= 90)] += 32
        high = np.flatnonzero(raw >= 0x80)
        unsure = kinds == UNSURE
        if len(high):
            lead = high[(raw[high] >= 0xC2) & (raw[high] <= 0xC9)]
            code = ((raw[lead].astype(np.int32) & 31) << 6) | (raw[np.minimum(lead + 1, len(raw) - 1)] & 63)
            known = code < len(self.kinds)
            lead, code = lead[known], code[known]
            unsure[high] = True
            kinds[lead] = kinds[lead + 1] = self.kinds[code]
            unsure[lead] = unsure[lead + 1] = self.kinds[code] == UNSURE
            small = self.lower[code]
            out[lead], out[lead + 1] = 0xC0 | (small >> 6), 0x80 | (small & 63)
        special = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))
        unsure[special] = True
        count = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(unsure, out=count[1:])
        return out, kinds, count[offsets[1:]] == count[offsets[:-1]]

    def spans(self, text: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the words of lower-case texts."""
        n = len(text)
        fresh = np.ones(n, bool)
        fresh[1:] = kinds[1:] != kinds[:-1]
        fresh[(kinds == NUMBER) & ((text & 0xC0) != 0x80)] = True
        begins = offsets[:-1][offsets[:-1] < n]
        fresh[begins] = True
        mark = np.flatnonzero((text == 0x27) & fresh)
        if len(mark):
            ends = np.append(begins[1:], n)
            limit = ends[np.searchsorted(begins, mark, side="right") - 1]
            at = lambda k: np.where(mark + k < limit, text[np.minimum(mark + k, n - 1)], 0)
            one, two = at(1), at(2)
            for tail in CONTRACTIONS:
                hit = one == ord(tail[0])
                if len(tail) == 2:
                    hit &= two == ord(tail[1])
                found = mark[hit]
                fresh[found + 1] = False
                rest = found + 1 + len(tail)
                stop = limit[hit]
                fresh[rest[rest < stop]] = True
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], n)
        keep = kinds[starts] != SPACE
        return starts[keep], ends[keep]

    def learn(self, words: list[bytes]) -> None:
        """Adds distinct words, some thousands to a call of the tokenizer."""
        for at in range(0, len(words), 10_000):
            self._learn_some(words[at : at + 10_000])

    def _learn_some(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        owner = np.array(found.word_ids, np.int64)
        if len(owner) == 0 or owner[-1] != len(words) - 1 or np.any(np.diff(owner) < 0):
            raise ValueError("the tokenizer splits words in another way")
        sizes = np.bincount(owner, minlength=len(words))
        self.flat = np.concatenate([self.flat, np.array(found.ids, np.int32)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        self.stops = np.concatenate([self.stops, [bool(SENTENCE_END.fullmatch(w)) for w in texts]])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, stops): text i has ids[first[i]:first[i + 1]]; stops are positions after a sentence end."""
        n = len(offsets) - 1
        if len(self.stops) > self.most_words:
            self.forget()
        text, kinds, sure = self.plain(raw, offsets)
        kinds[np.repeat(~sure, np.diff(offsets))] = SPACE
        ids, counts, stop_at = np.zeros(0, np.int32), np.zeros(n, np.int64), np.zeros(0, np.int64)
        starts, ends = self.spans(text, kinds, offsets) if len(text) else (np.zeros(0, np.int64),) * 2
        if len(starts):
            number = self.memo.numbers(text, starts, ends)
            sizes = self.offsets[number + 1] - self.offsets[number]
            total = np.cumsum(sizes)
            before = total - sizes
            ids = self.flat[np.arange(total[-1]) + np.repeat(self.offsets[number] - before, sizes)]
            cum = np.zeros(len(total) + 1, np.int64)
            cum[1:] = total
            bound = cum[np.searchsorted(starts, offsets)]
            counts = np.diff(bound)
            stop_at = total[self.stops[number]]
        if sure.all():
            return ids, np.concatenate([[0], np.cumsum(counts)]), stop_at
        # merge in the texts that the tokenizer got whole
        begin = np.concatenate([[0], np.cumsum(counts)])
        data, parts, stops, first = raw.tobytes(), [], [], [0]
        for i in range(n):
            if sure[i]:
                part = ids[begin[i] : begin[i + 1]]
                a, b = np.searchsorted(stop_at, [begin[i] + 1, begin[i + 1] + 1])
                stops.append(stop_at[a:b] - begin[i] + first[-1])
            else:
                whole = data[offsets[i] : offsets[i + 1]].decode()
                part = np.array(self.tokenizer.encode(whole, add_special_tokens=False).ids, np.int32)
            parts.append(part)
            first.append(first[-1] + len(part))
        return np.concatenate(parts), np.array(first, np.int64), np.concatenate([np.zeros(0, np.int64), *stops])
