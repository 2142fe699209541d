"""Packing of token streams into sequences of fixed capacity by dynamic programming.

Documents keep their order and are laid end to end; a sequence is a window of that
stream.  Windows may be cut after a document (free), after a sentence (``sentence_cost``)
or, where no such place is near, inside a sentence (``inside_cost``); padding costs one
per token.  With ``best[j]`` the least cost of all windows up to cut j at position p(j),

    best[j] = capacity - p(j) + penalty(j) + min over i of (best[i] + p(i)),

where p(j) - capacity <= p(i) < p(j).  The minimum over that moving range comes from a
monotone queue, so the work is linear in the number of cuts.  A stream is solved block
by block; the last, unfinished window of a block begins the next one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def place_cuts(
    stops: np.ndarray, ends: np.ndarray, capacity: int, sentence_cost: float, inside_cost: float
) -> tuple[np.ndarray, np.ndarray]:
    """(positions, penalties) of all cuts of a stream: document ends, sentence ends, and
    places inside stretches of more than a 128th of the capacity that have neither."""
    ends = np.asarray(ends, np.int64)
    near = np.sort(np.concatenate([stops, ends]))
    near = near[np.diff(near, prepend=-1) > 0]
    gaps = np.diff(near, prepend=0)
    step = max(1, capacity // 128)
    # a stretch of n tokens has places after each step, but none at its end
    extra = (gaps - 1) // step
    first = np.cumsum(extra) - extra
    nth = np.arange(int(extra.sum()), dtype=np.int64) - np.repeat(first, extra)
    inside = np.repeat(near - gaps, extra) + step * (nth + 1)
    at_end = np.zeros(len(near), bool)
    at_end[np.searchsorted(near, ends)] = True
    at = np.concatenate([near, inside])
    penalty = np.concatenate([np.where(at_end, 0.0, sentence_cost), np.full(len(inside), inside_cost)])
    order = np.argsort(at, kind="stable")
    return at[order], penalty[order]


def cut_windows(positions: list[int], penalties: list[float], capacity: int) -> list[int]:
    """Positions of the best cuts of a stream that ends at ``positions[-1]``.

    The last window is open: it holds what is left over and costs nothing, so of equal
    ways the one that leaves least is taken.
    """
    points = [0, *positions]
    keys, back = [0.0] * len(points), [-1] * len(points)
    queue, head = [0], 0  # indices into points, keys ascending from ``head``
    # the least key serves all cuts that its window reaches
    front, low, reach = 0, 0.0, capacity
    for j, (p, penalty) in enumerate(zip(positions, penalties, strict=True), 1):
        if p > reach:
            while points[queue[head]] < p - capacity:
                head += 1
            front = queue[head]
            low, reach = keys[front], points[front] + capacity
        keys[j] = key = capacity - p + penalty + low + p
        back[j] = front
        if key <= low:
            queue, head = [j], 0
            front, low, reach = j, key, p + capacity
        elif keys[queue[-1]] < key:
            queue.append(j)
        else:
            while keys[queue[-2]] >= key:
                queue.pop()
            queue[-1] = j
    end = points[-1]
    cost = lambda i: capacity - points[i] + penalties[i - 1] + keys[back[i]] if i else 0.0
    open_from = min(
        (i for i in range(len(points) - 1, -1, -1) if points[i] >= end - capacity), key=lambda i: (cost(i), -i)
    )
    cuts, i = [], open_from
    while i > 0:
        cuts.append(points[i])
        i = back[i]
    return cuts[::-1]


def tail_windows(length: int, capacity: int, inside_cost: float) -> list[int]:
    """Lengths of the windows of the last stretch: whole and padded, or in powers of two without padding."""
    bits = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    if length == capacity or (len(bits) - 1) * inside_cost >= capacity - length:
        return [length]
    return bits


class Packer:
    """Takes documents in order, gives out finished sequences as rows of pieces."""

    def __init__(self, capacity, sentence_cost, inside_cost, block, first_sequence, with_ids):
        self.capacity, self.sentence_cost, self.inside_cost = capacity, sentence_cost, inside_cost
        self.block, self.sequence, self.with_ids = block, first_sequence, with_ids
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple] = []  # (doc_id, tokens, tokens of it that already went out)
        self.sizes: list[int] = []
        self.stops: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id, ids: np.ndarray, stops: np.ndarray) -> None:
        self.stops.append(stops + self.held)
        self.ids.append(ids)
        self.docs.append((doc_id, len(ids), 0))
        self.sizes.append(len(ids))
        self.held += len(ids)

    def solve(self, last: bool) -> Iterator[tuple]:
        if not self.held:
            return
        ids = np.concatenate(self.ids)
        ends = np.cumsum(self.sizes)
        stops = np.concatenate(self.stops)
        at, penalty = place_cuts(
            stops[(stops > 0) & (stops < self.held)], ends, self.capacity, self.sentence_cost, self.inside_cost
        )
        bounds = [0, *cut_windows(at.tolist(), penalty.tolist(), self.capacity)]
        if last:
            for size in tail_windows(self.held - bounds[-1], self.capacity, self.inside_cost):
                bounds.append(bounds[-1] + size)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b > a:
                yield from self.pieces(ids, ends, a, b)
        done = bounds[-1]
        k = int(np.searchsorted(ends, done, side="right"))
        rest = [(self.docs[k], int(ends[k]) - done)] if k < len(ends) and done > ends[k] - self.sizes[k] else []
        docs, sizes = self.docs[k:], self.sizes[k:]
        if rest:
            (doc_id, tokens, _), left = rest[0]
            docs[0], sizes[0] = (doc_id, tokens, tokens - left), left
        self.docs, self.sizes = docs, sizes
        self.ids, self.stops = [ids[done:]], [stops[stops > done] - done]
        self.held -= done

    def pieces(self, ids, ends, a: int, b: int) -> Iterator[tuple]:
        k = int(np.searchsorted(ends, a, side="right"))
        at = a
        while at < b:
            doc_id, tokens, gone = self.docs[k]
            begin = int(ends[k]) - self.sizes[k]
            stop = min(b, int(ends[k]))
            part = ids[at:stop]
            row = (
                doc_id,
                gone + at - begin,
                stop - at,
                zlib.crc32(part.astype("<u4").tobytes()),
                tokens,
                self.sequence,
                at - a,
            )
            yield (*row, part) if self.with_ids else row
            at, k = stop, k + 1
        self.sequence += 1


def _pack_task(vocabulary, end_id, capacity, sentence_cost, inside_cost, block, with_ids):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(7)]
        if not with_ids:
            return pa.RecordBatch.from_arrays(columns, names)
        lists = pa.array([r[7] for r in rows], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*columns, lists], [*names, "ids"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        from rankspark.llm.columns import chunks, text_bytes
        from rankspark.llm.wordids import WordIds

        encoder = WordIds(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary))
        first = TaskContext.get().partitionId() << 40
        packer = Packer(capacity, sentence_cost, inside_cost, block, first, with_ids)
        rows: list[tuple] = []
        for batch in batches:
            raw, offsets = text_bytes(batch.column(1))
            keys = batch.column(0).to_pylist()
            for a, b in chunks(offsets):
                lo, hi = offsets[a], offsets[b]
                ids, bounds, stops = encoder.encode(raw[lo:hi], offsets[a : b + 1] - lo)
                # the end id goes behind each document's own ids
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                shift = np.searchsorted(bounds[1:] - np.arange(1, len(bounds)), stops)
                stops = stops + shift
                which = np.searchsorted(stops, bounds)
                for i in range(b - a):
                    own = stops[which[i] : which[i + 1]] - bounds[i]
                    packer.add(keys[a + i], ids[bounds[i] : bounds[i + 1]], own)
                    if packer.held >= block:
                        rows += packer.solve(False)
                if len(rows) >= 10_000:
                    yield batch_of(rows)
                    rows = []
        rows += packer.solve(True)
        if rows:
            yield batch_of(rows)

    return work


def pack(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 2,
    capacity: int = 4096,
    sentence_cost: float = 2.0,
    inside_cost: float = 16.0,
    block: int = 1 << 20,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document in a sequence (``PIECES``, with ``ids array<int>`` if asked for).

    ``docs`` needs (doc_id, text); other columns are ignored.  ``vocabulary`` names a file
    of the public tokenizers or gives a path that every executor has.  A null or empty
    text is the end id alone; a null doc_id stays null; repeated rows are documents of
    their own; an empty table gives no rows.  Documents keep the order of their
    partition.  Each partition fills sequences of its own, whose last stretch is cut
    into powers of two where that is cheaper than padding; nothing is shuffled.  Memory
    is bounded by ``block`` tokens and the longest document.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    work = _pack_task(vocabulary, end_id, capacity, sentence_cost, inside_cost, block, with_ids)
    return rows.mapInArrow(work, PIECES + ", ids array<int>" * with_ids)
