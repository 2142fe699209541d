"""Arrow text columns as flat byte arrays, and words, hashes and windows over them.

A batch is looked at as one long ``uint8`` array (the UTF-8 of all its texts, null
counts as empty) with the offset at which each text begins.  Everything here is
numpy over that array: no loop over texts or words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd multipliers of the hash functions.
BASE = U64(0x9E3779B97F4A7C15)
MIX_A = U64(0xBF58476D1CE4E5B9)
MIX_B = U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (one-to-one)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U64(30)
    x *= MIX_A
    x ^= x >> U64(27)
    x *= MIX_B
    x ^= x >> U64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(out, out=out)
    return out


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text i is ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def ascii_lower(raw: np.ndarray) -> np.ndarray:
    """A-Z become a-z, all other bytes stay."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[raw]


# The bytes that part words.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): words ``[^\\x20\\x09-\\x0D]+``; text i has words first[i]:first[i+1]."""
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = ~SPACES[raw]
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside[:-1]
    begins = offsets[:-1]
    before[begins] = False  # a word never runs on from the text before
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(raw) + 1, bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def segment_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the stretches ``raw[starts:ends]`` (not empty, ascending, disjoint)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.zeros(len(starts), np.int64)
    np.cumsum(sizes[:-1], out=first[1:])
    total = int(first[-1] + sizes[-1])
    place = np.arange(total, dtype=np.int64)
    inner = place - np.repeat(first, sizes)
    values = (raw[inner + np.repeat(starts, sizes)].astype(np.uint64) + U64(1)) * powers(
        BASE, int(sizes.max())
    )[inner]
    return mix(np.add.reduceat(values, first) + sizes.astype(np.uint64) * MIX_B)


def shingle_hashes(
    hashes: np.ndarray, first: np.ndarray, size: int, whole: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) of all runs of ``size`` consecutive words in each text.

    With ``whole`` a text of fewer words (one at least) counts as one run.
    """
    counts = np.diff(first)
    n = np.maximum(counts - size + 1, 0)
    short = (counts > 0) & (n == 0) if whole else np.zeros(len(counts), bool)
    out_first = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n + short, out=out_first[1:])
    owner = np.repeat(np.arange(len(counts)), n)
    at = np.arange(int(n.sum()), dtype=np.int64)
    before = np.zeros(len(counts), np.int64)
    np.cumsum(n[:-1], out=before[1:])
    at += (first[:-1] - before)[owner]
    weight = powers(BASE, size)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out += hashes[at + k] * weight[k]
    out = mix(out + U64(size * int(MIX_A) % 2**64))
    if not short.any():
        return out, out_first
    full = np.zeros(int(out_first[-1]), np.uint64)
    slot = np.arange(len(at)) + (out_first[:-1] - before)[owner]
    full[slot] = out
    for i in np.flatnonzero(short):
        own = hashes[first[i] : first[i + 1]]
        full[out_first[i]] = mix((own * weight[: len(own)]).sum(keepdims=True) + U64(len(own) * int(MIX_A) % 2**64))[0]
    return full, out_first


def window_minima(values: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the (rightmost) least of some window of ``width`` values of one text.

    Texts with fewer values than ``width`` use one window over all they have.
    ``first`` bounds the values of each text.
    """
    if not len(values):
        return np.zeros(0, np.int64)
    # pad every text so that no window reaches into the next one
    counts = np.diff(first)
    step = 1
    best = np.arange(len(values), dtype=np.int64)
    limit = np.repeat(first[1:], counts)
    key = values
    while step < width:
        hop = min(step, width - step)
        other = np.arange(len(values), dtype=np.int64) + hop
        inside = other < limit
        rival = best[np.where(inside, other, 0)]
        better = inside & (key[rival] <= key[best])
        best = np.where(better, rival, best)
        step += hop
    starts = np.arange(len(values), dtype=np.int64)
    lead = np.repeat(first[:-1], counts)
    complete = (starts + width <= limit) | (starts == lead)
    chosen = np.zeros(len(values), bool)
    chosen[best[complete]] = True
    return np.flatnonzero(chosen)


def chunks(offsets: np.ndarray, most: int = 1 << 19):
    """(from, to) ranges of texts that together hold about ``most`` bytes (one text at least)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end
