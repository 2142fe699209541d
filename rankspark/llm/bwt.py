"""Burrows-Wheeler transforms of short strings and their merge by interleave refinement.

A shard holds the suffixes of some strings in sorted order; its transform gives for each
of them the bytes in front of it (``codes``) and where the suffix that begins with those
bytes stands (``back``).  Merging shards needs no comparison of suffixes: the interleave
starts as one shard after the other, and each round moves every entry behind its preceding
bytes by one stable sort of the codes, after which entries are in the order of two more
bytes.  Entries that agree so far form a block; blocks only ever split, so after d / 2
rounds they are the intervals of suffixes with a common prefix of d bytes.  A block of one
is no repeat and leaves the interleave, and only entries that still lead to a window of
d bytes inside its string are followed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Shard:
    """Sorted suffixes of some strings, each closed by an end sign that sorts first."""

    place: np.ndarray  # of each suffix, counted over all strings with their end signs
    codes: np.ndarray  # the two bytes in front of it
    back: np.ndarray  # rank of the suffix two bytes earlier


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks."""
    order = np.argsort(keys)
    fresh = np.ones(len(keys), np.int64)
    fresh[0] = 0
    fresh[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(fresh)
    return out


def build_shard(text: np.ndarray, sizes: np.ndarray) -> Shard:
    """Shard of the strings of ``sizes`` bytes that ``text`` holds end to end.

    Suffixes are ordered by prefix doubling; past its end sign a string goes on with
    nothing, so equal rests of two strings rank alike.
    """
    n = int(sizes.sum() + len(sizes))
    signs = np.zeros(n + 8, np.int64)
    limit = np.cumsum(sizes + 1)
    inside = np.ones(n, bool)
    inside[limit - 1] = False
    signs[:n][inside] = text.astype(np.int64) + 1
    end = np.repeat(limit, sizes + 1)
    at = np.arange(n, dtype=np.int64)
    # nine bits a sign: seven signs to a word
    keys, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(7):
        alive &= at + k < end
        keys = keys << 9 | np.where(alive, signs[k : k + n], 0)
    rank, step, longest = ranks(keys), 7, int(sizes.max(initial=0)) + 1
    while step < longest and rank.max(initial=0) < n - 1:
        later = at + step
        follow = np.where(later < end, rank[np.minimum(later, n - 1)] + 1, 0)
        rank = ranks(rank * (n + 2) + follow)
        step *= 2
    place = np.argsort(rank)
    where = np.empty(n, np.int64)
    where[place] = at
    begin = end - np.repeat(sizes + 1, sizes + 1)
    lead = np.maximum(place - 2, 0)
    codes = ((signs[lead] - 1) & 255) << 8 | ((signs[np.maximum(place - 1, 0)] - 1) & 255)
    # the first two suffixes of a string have no two bytes in front and are never followed
    back = np.where(place - 2 >= begin[place], where[lead], -1)
    return Shard(place, codes.astype(np.uint16), back)


def merge_repeats(shards: list[Shard], sizes: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, block): all windows of ``depth`` bytes that occur more than once.

    Strings are counted through all shards.  ``depth`` is even.
    """
    base = np.cumsum([0, *(len(s.place) for s in shards)])
    codes = np.concatenate([s.codes for s in shards])
    back = np.concatenate([np.where(s.back >= 0, s.back + b, -1) for s, b in zip(shards, base, strict=False)])
    length = np.concatenate(sizes)
    begin = np.concatenate([[0], np.cumsum(length + 1)])
    # places counted through all shards, like the strings
    place = np.concatenate([s.place + b for s, b in zip(shards, base, strict=False)])
    owner = np.searchsorted(begin, place, side="right") - 1
    offset = place - begin[owner]
    # a window starts at s if s + depth is still in the string: follow those ends only
    entry = np.flatnonzero(offset >= depth)
    block = np.zeros(len(entry), np.int64)
    for _ in range(depth // 2):
        if not len(entry):
            break
        code = codes[entry]
        order = np.argsort(code, kind="stable")
        code, entry, block = code[order], back[entry[order]], block[order]
        fresh = np.ones(len(entry), bool)
        fresh[1:] = (code[1:] != code[:-1]) | (block[1:] != block[:-1])
        last = np.ones(len(entry), bool)
        last[:-1] = fresh[1:]
        keep = ~(fresh & last)
        block = np.cumsum(fresh)[keep]
        entry = entry[keep]
    return owner[entry], offset[entry], block
