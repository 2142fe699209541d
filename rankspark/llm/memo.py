"""Numbers for distinct words, so that costly work is done once per word and task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from rankspark.llm.columns import segment_hashes

SLOTS = 1 << 20


class WordMemo:
    """Gives each distinct word (by 64-bit hash) a number, counting from 0.

    ``learn`` is called with the new words of each call, in the order of their numbers.
    A table addressed by hash answers for most words; a sorted list answers for the rest.
    """

    def __init__(self, learn: Callable[[list[bytes]], None]):
        self.learn = learn
        self.clear()

    def clear(self) -> None:
        self.size = 0
        self.keys = np.zeros(0, np.uint64)
        self.values = np.zeros(0, np.int64)
        self.slot_keys = np.zeros(SLOTS, np.uint64)
        self.slot_values = np.full(SLOTS, -1, np.int32)

    def numbers(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = segment_hashes(text, starts, ends)
        slot = (hashes >> np.uint64(44)).astype(np.int64)
        out = self.slot_values[slot].astype(np.int64)
        out[self.slot_keys[slot] != hashes] = -1
        missed = np.flatnonzero(out < 0)
        if not len(missed):
            return out
        distinct, first, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(distinct))
        if len(new):
            at, data = missed[first[new]], text.tobytes()
            spans = zip(starts[at].tolist(), ends[at].tolist(), strict=True)
            self.learn([data[a:b] for a, b in spans])
            self._insert(distinct[new])
        numbers = self.values[np.searchsorted(self.keys, distinct)]
        out[missed] = numbers[back]
        slot = (distinct >> np.uint64(44)).astype(np.int64)
        self.slot_keys[slot], self.slot_values[slot] = distinct, numbers
        return out

    def _known(self, distinct: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == distinct[inside]
        return known

    def _insert(self, hashes: np.ndarray) -> None:
        keys = np.concatenate([self.keys, hashes])
        values = np.concatenate([self.values, self.size + np.arange(len(hashes))])
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]
        self.size += len(hashes)
