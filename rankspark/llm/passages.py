"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

1. Every text gives seeds: hashes of k words, the least of each ``gap`` neighbours, so that
   any run of k + gap - 1 equal words shares a seed.  With four words and every run a seed,
   no choice of replaced words up to a share of 0.2 can hide a passage.
2. Every two texts that have a seed are matched at it, whatever other texts have it.  Equal
   texts count as one here.  A seed of very many texts is dealt into a grid of ranges of ids.
3. The matches of a text with one source are chained: a chain goes forward in both texts,
   each seed is worth its words, and every word gone forward on either side has a cost.
   Sorted by place in the text, the best chain that ends before a place in the source is
   a prefix maximum, kept in a Fenwick tree.
4. Chains are aligned word by word: stretches between seeds are compared, the ends are
   grown, and the parts in which at least ``ratio`` of the words agree are passages.  Texts
   are dealt into blocks, and the chains of two blocks meet their texts in one cell.
5. Passages of equal texts are reported for each of their ids.

Pairs of texts grow with the square of a group of texts that share passages, and so does
the result; what a task holds does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankspark.llm import bitmap
from rankspark.llm.columns import (
    MIX_A,
    ascii_lower,
    chunks,
    mix,
    segment_hashes,
    shingle_hashes,
    text_bytes,
    window_minima,
    words,
)
from rankspark.llm.suffixes import LAST_ID
from rankspark.session import keep

FOUND = (
    "doc_id long, start_word long, end_word long, source_doc_id long, source_start long, "
    "source_end long, n_matched long, similarity double"
)
# words looked at beyond both ends of a chain
MARGIN = 64
# upper bits of a seed by which seeds of several texts are looked for
SEED_BITS = 36
# a seed of more texts than this is hot; its texts are dealt into so many ranges of ids
HOT_TEXTS = 1 << 12
RANGES = 32
# matches that a task groups by pair of texts at once
MATCHES = 1 << 21
# text of a block; a cell aligns the texts of two blocks
BLOCK_BYTES = 16 << 20
SPOTS = "anchor long, cell int, first long, content long, last long, at long"
CHAINS = "own long, source long, p array<array<int>>, q array<array<int>>"
CELL = f"i int, j int, chain boolean, {CHAINS}, text string, first long, copied boolean"
PLACES = ["anchor", "lot", "doc", "content", "at", "lead", "shared"]
# kinds of a place: what a range is told of earlier ranges, and its own
FIRST, LAST, HERE = 0, 1, 2


class Fenwick:
    """Prefix maxima: (value, item) of the best item at a place before a given one."""

    def __init__(self, n: int):
        self.tree = [(-np.inf, -1)] * (n + 1)

    def put(self, place: int, entry: tuple[float, int]) -> None:
        place += 1
        while place < len(self.tree):
            if entry > self.tree[place]:
                self.tree[place] = entry
            place += place & -place

    def best(self, place: int) -> tuple[float, int]:
        """Over all places less than ``place``."""
        best = (-np.inf, -1)
        while place > 0:
            if self.tree[place] > best:
                best = self.tree[place]
            place -= place & -place
        return best


def chain(p: np.ndarray, q: np.ndarray, size: int, gap_cost: float) -> list[np.ndarray]:
    """Chains of matches (p[i], q[i]), best first; each is a list of indices.

    A match belongs to one chain at most.

    A chain's value is ``size`` for each seed minus ``gap_cost`` for each word that it goes
    forward in either text; a seed whose best predecessor costs more than it is worth
    begins a chain of its own.
    """
    order = np.lexsort((q, p))
    ahead = np.diff(p[order])
    if (np.diff(q[order]) == ahead).all() and (ahead > 0).all() and (2 * gap_cost * ahead < size).all():
        # one diagonal without a far jump: every match is worth more than the way to it
        return [order] if len(order) else []
    rank = np.unique(q, return_inverse=True)[1]
    tree = Fenwick(int(rank.max(initial=-1)) + 1)
    value, back = np.zeros(len(p)), np.full(len(p), -1, np.int64)
    at = 0
    while at < len(order):
        # matches at one place in the text do not follow each other
        end = at
        while end < len(order) and p[order[end]] == p[order[at]]:
            i = order[end]
            reach, j = tree.best(int(rank[i]))
            value[i] = size
            if j >= 0:
                gain = reach - gap_cost * float(p[i] + q[i])
                if gain > 0:
                    value[i], back[i] = size + gain, j
            end += 1
        for i in order[at:end]:
            tree.put(int(rank[i]), (float(value[i] + gap_cost * (p[i] + q[i])), int(i)))
        at = end
    used, out = np.zeros(len(p), bool), []
    for i in np.lexsort((np.arange(len(p)), -value)):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = back[i]
        if path:
            out.append(np.array(path[::-1]))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Words that an alignment of two stretches can pair (longest common subsequence)."""
    if len(a) == len(b) > 0 and (a == b).mean() >= 0.5 or min(len(a), len(b)) == 0:
        return int((a == b).sum()) if len(a) == len(b) else 0
    if len(a) > len(b):
        a, b = b, a
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        step = np.maximum(row[1:], row[:-1] + (b == x))
        row[1:] = np.maximum.accumulate(step)
    return int(row[-1])


def grow(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words, matches) by which a chain's end grows: equal places, best count against differences."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    value = np.cumsum(np.where(same, 1, -2))
    if value.max() <= 0:
        return 0, 0
    k = int(value.argmax()) + 1
    return k, int(same[:k].sum())


def between(a: np.ndarray, b: np.ndarray, at: int, source_at: int, ratio: float) -> list[tuple]:
    """Parts of a stretch between two pieces; what agrees at its ends is parted from a jump."""
    hits = common(a, b)
    whole = [(at, source_at, len(a), len(b), hits)]
    if hits >= ratio * max(len(a), len(b)):
        return whole
    k, first = grow(a, b)
    m, last = grow(a[k:][::-1], b[k:][::-1])
    e, f = len(a) - m, len(b) - m
    inner = common(a[k:e], b[k:f])
    if first + inner + last < hits:
        return whole
    parts = [(at, source_at, k, k, first), (at + k, source_at + k, e - k, f - k, inner), (at + e, source_at + f, m, m, last)]
    return [part for part in parts if part[2] or part[3]]


def align(text: np.ndarray, source: np.ndarray, p: np.ndarray, q: np.ndarray, size: int, ratio: float):
    """(start, end, source start, source end, matches) of the good parts of one chain."""
    # runs of seeds on one diagonal that touch are one exact piece
    pieces = []
    for a, b in zip(p.tolist(), q.tolist(), strict=True):
        if pieces and pieces[-1][0] - pieces[-1][2] == a - b and a <= pieces[-1][1]:
            pieces[-1][1], pieces[-1][3] = a + size, b + size
            continue
        if pieces and (a < pieces[-1][1] or b < pieces[-1][3]):
            cut = max(pieces[-1][1] - a, pieces[-1][3] - b)
            if cut >= size:
                continue
            a, b = a + cut, b + cut
            pieces.append([a, a + size - cut, b, b + size - cut])
            continue
        pieces.append([a, a + size, b, b + size])
    left, hits = grow(text[: pieces[0][0]][::-1], source[: pieces[0][2]][::-1])
    parts = [(pieces[0][0] - left, pieces[0][2] - left, left, left, hits)] if left else []
    for k, (a, b, c, d) in enumerate(pieces):
        parts.append((a, c, b - a, d - c, b - a))
        if k + 1 < len(pieces):
            e, f = pieces[k + 1][0], pieces[k + 1][2]
            parts += between(text[b:e], source[d:f], b, d, ratio)
    a, c = pieces[-1][1], pieces[-1][3]
    right, hits = grow(text[a:], source[c:])
    if right:
        parts.append((a, c, right, right, hits))
    todo = [(0, len(parts))]
    while todo:
        low, high = todo.pop()
        if low >= high:
            continue
        # the longest stretch of parts of which ``ratio`` agrees
        reach = np.cumsum([0.0] + [h - ratio * max(x, y) for _, _, x, y, h in parts[low:high]])
        words = np.cumsum([0] + [part[2] for part in parts[low:high]])
        begin = np.searchsorted(-np.minimum.accumulate(reach), -(reach[1:] + 1e-9))
        size = np.where(begin < np.arange(1, len(reach)), words[1:] - words[np.minimum(begin, len(reach) - 1)], 0)
        end = int(size.argmax())
        if size[end] <= 0:
            continue
        i, j = int(begin[end]), end + 1
        # a part that does not agree is no end of a passage
        while i < j and reach[i + 1] < reach[i]:
            i += 1
        while i < j and reach[j] < reach[j - 1]:
            j -= 1
        if i >= j:
            continue
        i, j = low + i, low + j
        first, last = parts[i], parts[j - 1]
        yield first[0], last[0] + last[2], first[1], last[1] + last[3], sum(x[4] for x in parts[i:j])
        todo += [(low, i), (j, high)]


def _seed_rows(column, a, b, raw, offsets, size, gap):
    text = ascii_lower(raw[offsets[a] : offsets[b]])
    starts, ends, first = words(text, offsets[a : b + 1] - offsets[a])
    grams, bounds = shingle_hashes(segment_hashes(text, starts, ends), first, size)
    chosen = window_minima(grams, bounds, gap)
    owner = np.searchsorted(bounds, chosen, side="right") - 1
    seeds, at = grams[chosen], chosen - bounds[owner]
    # where a text has a seed again, the n-th place also matches the n-th place of others:
    # stretches that repeat a few words for long would otherwise give no order
    order = np.lexsort((at, seeds, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (seeds[order[1:]] != seeds[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    place = np.arange(len(order))
    nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
    again = order[nth > 0]
    counted = mix(seeds[again] + nth[nth > 0].astype(np.uint64) * MIX_A)
    lead = np.ones(len(seeds) + len(again), bool)
    lead[again] = False
    return np.concatenate([seeds, counted]), np.append(owner, owner[again]), np.append(at, at[again]), lead


def _packed(values: np.ndarray, codec: pa.Codec) -> bytes:
    """Sorted numbers below 2**32 as differences, byte by byte, compressed."""
    steps = np.diff(values, prepend=values[:1] * 0).astype("<u4")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(values).to_bytes(4, "little") + codec.compress(planes, asbytes=True)


def _unpacked(packed: bytes, codec: pa.Codec) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    planes = np.frombuffer(codec.decompress(packed[4:], 4 * n, asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel(), dtype=np.int64)


def packed_pieces(held: list[np.ndarray], codec: pa.Codec) -> pa.RecordBatch:
    """(piece, seeds): SEED_BITS of each hash value, by piece of the map of hash values, sorted and packed."""
    values = np.sort(np.concatenate(held) >> np.uint64(64 - SEED_BITS)).astype(np.int64)
    low = SEED_BITS - (bitmap.MAP_BITS - bitmap.PIECE_BITS)
    piece = values >> low
    cut = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)]
    rest = values & ((1 << low) - 1)
    packed = [_packed(rest[a:b], codec) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(piece[cut[:-1]], pa.int32()), pa.array(packed, pa.binary())], ["piece", "seeds"]
    )


def _seed_task(size: int, gap: int, most: int = 1 << 22):
    """Distinct seeds of each text, by piece of the map of hash values: SEED_BITS of each, packed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        held, n = [], 0
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            for a, b in chunks(offsets):
                seeds, _, _, lead = _seed_rows(batch.column(0), a, b, raw, offsets, size, gap)
                if lead.any():
                    held.append(seeds[lead])
                    n += len(held[-1])
                if n >= most:
                    yield packed_pieces(held, codec)
                    held.clear()
                    n = 0
        if held:
            yield packed_pieces(held, codec)

    return work


def _several_task(hot_texts: int):
    """Bits of the map for seeds that come more than once, and the hot ones; rows come sorted by piece."""
    wide = SEED_BITS - bitmap.MAP_BITS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        now, held = None, []

        def table() -> pa.RecordBatch:
            values = np.sort(np.concatenate(held))
            bits = np.zeros(1 << bitmap.PIECE_BITS, bool)
            bits[values[1:][values[1:] == values[:-1]] >> wide] = True
            packed = np.packbits(bits, bitorder="little").tobytes()
            hot = np.unique(values[hot_texts:][values[hot_texts:] == values[:-hot_texts]])
            hot += now << (bitmap.PIECE_BITS + wide)
            columns = [pa.array([now], pa.int32()), pa.array([packed], pa.binary()), pa.array([hot.tolist()], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["piece", "bits", "hot"])

        for batch in batches:
            for piece, seeds in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if held and piece != now:
                    yield table()
                    held.clear()
                now = piece
                held.append(_unpacked(seeds.as_py(), codec))
        if held:
            yield table()

    return work


def each_once(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text, content, first, last): every different text once, with its least and its largest id; and those on several rows, without the text."""
    spans = texts.groupBy("content").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
    copied = keep(spans.filter("n > 1").drop("n"), "passage-copied")
    flags = bitmap.table(texts.sparkSession, bitmap.build(copied, "content"))
    marked = bitmap.look_up(texts, flags, F.col("content"), "_maybe")
    names = ["text", "content", "first", "last"]
    alone = marked.filter("not _maybe").select("text", "content", F.col("doc").alias("first"), F.col("doc").alias("last"))
    # only texts that may have copies are shuffled
    one = marked.filter("_maybe").dropDuplicates(["content"]).join(copied, "content", "left")
    some = one.select("text", "content", *[F.coalesce(n, "doc").alias(n) for n in names[2:]])
    return alone.unionByName(keep(some, "passage-once")), copied


def several(packed: DataFrame, hot_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The map of values that rows (piece, seeds) hold more than once, and SEED_BITS of those held more than ``hot_texts`` times, sorted."""
    pieces = (
        packed.repartition("piece")
        .sortWithinPartitions("piece")
        .mapInArrow(_several_task(hot_texts), "piece int, bits binary, hot array<long>")
    )
    hot: list[int] = []
    out = np.zeros((1 << (bitmap.MAP_BITS - bitmap.PIECE_BITS), 1 << (bitmap.PIECE_BITS - 3)), np.uint8)
    for row in pieces.collect():
        out[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
        hot += row["hot"]
    return out.ravel(), np.array(sorted(hot), np.uint64)


def seeds_of_several(once: DataFrame, size: int, gap: int) -> tuple[bytes, np.ndarray]:
    """The map of seeds that two different texts have, and the upper bits of those of more than HOT_TEXTS, sorted."""
    bits, hot = several(once.select("text").mapInArrow(_seed_task(size, gap), "piece int, seeds binary"), HOT_TEXTS)
    return bits.tobytes(), hot


def _spot_task(sent, hot: np.ndarray, cuts: list[int], size: int, gap: int):
    """Places (``SPOTS``) of the seeds that different texts have.

    ``at`` is four times the place, 2 more on the upper side of a cell of two ranges, and 1 more
    for a seed's first place in its text.  ``cell`` is 0, or tells the two ranges of a hot
    seed's texts that meet there; a place goes to all cells of its range.
    """
    ranges = len(cuts) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SPOTS.split(", ")]
        for batch in batches:
            raw, offsets = text_bytes(batch.column(0))
            content, first, last = (batch.column(i).to_numpy() for i in (1, 2, 3))
            part = np.searchsorted(np.array(cuts, np.int64), first, side="left")
            for a, b in chunks(offsets):
                seeds, owner, at, lead = _seed_rows(batch.column(0), a, b, raw, offsets, size, gap)
                hit = np.flatnonzero(bitmap.maps(sent.value, seeds))
                split = np.isin(seeds[hit] >> np.uint64(64 - SEED_BITS), hot) if cuts else np.zeros(len(hit), bool)

                def table(hit, cell, upper):
                    row = a + owner[hit]
                    place = 4 * at[hit].astype(np.int64) + 2 * upper + lead[hit]
                    columns = [seeds[hit].view(np.int64), cell.astype(np.int32), first[row], content[row], last[row], place]
                    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

                yield table(hit[~split], np.zeros(int((~split).sum())), np.zeros(int((~split).sum()), bool))
                dealt = hit[split]
                own = part[a + owner[dealt]]
                for other in range(ranges) if len(dealt) else ():
                    low, high = np.minimum(own, other), np.maximum(own, other)
                    yield table(dealt, 1 + low * ranges + high, own > other)

    return work


def seed_spots(once: DataFrame, size: int, gap: int) -> tuple[DataFrame, int]:
    """``SPOTS`` of the seeds that different texts have, and the number of ranges of hot ones."""
    several, hot = seeds_of_several(once, size, gap)
    sent = once.sparkSession.sparkContext.broadcast(several)
    cuts: list[int] = []
    if len(hot) and RANGES > 1:
        shares = [k / RANGES for k in range(1, RANGES)]
        # only how evenly the ranges are filled depends on the error; as a double the largest
        # number is one too many, and no id lies beyond it
        cuts = sorted({int(cut) for cut in once.stat.approxQuantile("first", shares, 0.01) if cut < 2**63})
    return once.mapInArrow(_spot_task(sent, hot, cuts, size, gap), SPOTS), len(cuts) + 1


def meetings(table: np.ndarray, ranges: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(own row, source row) of places (``SPOTS``, sorted, whole groups) of one seed in two texts, the source's the earlier.

    A source gives its first place of the seed.  Of a text with copies the last id counts as its
    own and the first as a source's, so two texts may be sources of each other.
    """
    anchor, cell, first, content, last, at = table.T
    row = np.arange(len(table))
    opens = np.ones(len(table), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (cell[1:] != cell[:-1])
    begin = np.maximum.accumulate(np.where(opens, row, 0))
    bounds = np.append(np.flatnonzero(opens), len(table))
    high = row.copy()
    # ids ascend within a group
    for r in np.flatnonzero(first != last).tolist():
        end = bounds[np.searchsorted(bounds, r, side="right")]
        high[r] = begin[r] + np.searchsorted(first[begin[r] : end], last[r], side="right")
    n = high - begin
    total = np.append(0, np.cumsum(n))
    across = (cell > 0) & ((cell - 1) // ranges != (cell - 1) % ranges)
    a = 0
    while a < len(table):
        b = max(a + 1, int(np.searchsorted(total, total[a] + most, side="right")) - 1)
        own = np.repeat(row[a:b], n[a:b])
        source = np.arange(total[b] - total[a]) + np.repeat(begin[a:b] - (total[a:b] - total[a]), n[a:b])
        good = (at[source] & 1 == 1) & (content[source] != content[own])
        good &= (first[source] < last[own]) | ((first[source] == last[own]) & (content[source] < content[own]))
        good &= ~across[own] | ((at[source] ^ at[own]) & 2 == 2)
        if good.any():
            yield own[good], source[good]
        a = b


def _pair_task(ranges: int, most: int):
    """(own, source, spots): matches of two texts, those near each other in the task's rows in one row.

    Rows (``SPOTS``) come sorted by seed, cell, first id and content.  The places of one cell of
    a seed are held, and ``most`` matches.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = [], []

        def rows() -> Iterator[pa.RecordBatch]:
            own, source, p, q = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.argsort(mix(own.view(np.uint64)) + source.view(np.uint64), kind="stable")
            own, source = own[order], source[order]
            fresh = np.append(True, (own[1:] != own[:-1]) | (source[1:] != source[:-1]))
            bounds = np.append(np.flatnonzero(fresh), len(own))
            spots = np.stack([p[order], q[order]], axis=1).astype("<i4")
            for a in range(0, len(bounds) - 1, 50_000):
                cut = bounds[a : a + 50_001]
                ends = pa.py_buffer((8 * (cut - cut[0])).astype(np.int32))
                data = pa.py_buffer(np.ascontiguousarray(spots[cut[0] : cut[-1]]))
                packed = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, ends, data])
                columns = [pa.array(own[cut[:-1]]), pa.array(source[cut[:-1]]), packed]
                yield pa.RecordBatch.from_arrays(columns, ["own", "source", "spots"])

        def matched(table: np.ndarray) -> Iterator[pa.RecordBatch]:
            for own, source in meetings(table, ranges, most):
                held.append((table[own, 3], table[source, 3], table[own, 5] >> 2, table[source, 5] >> 2))
                if sum(len(x[0]) for x in held) >= most:
                    yield from rows()

        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(6)], axis=1)
            ends = np.flatnonzero((table[1:, :2] != table[:-1, :2]).any(axis=1)) + 1
            if group and (group[-1][-1, :2] != table[0, :2]).any():
                yield from matched(np.concatenate(group))
                group = []
            if len(ends):
                yield from matched(np.concatenate([*group, table[: ends[-1]]]))
                group, table = [], table[ends[-1] :]
            group.append(table)
        if group:
            yield from matched(np.concatenate(group))
        if held:
            yield from rows()

    return work


def _match_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches of each place of a seed with the seed's first place, and of a lead place with the lead one before.

    No query calls this any more, since it passes over all other earlier texts; its test stays.

    Rows (``PLACES``) come sorted by all columns.  From batch to batch three places of the last
    seed are held, however often it occurs: its first, its last lead one and its last.  Of the
    matches only texts of shared ids have a version (their content), which would not compress.
    """
    names = ["doc", "version", "source", "source_version", "p", "q"]
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 3, 4, 6)]
        table = np.stack(columns, axis=1)
        kind, lead = table[:, 1] & 3, batch.column(5).to_numpy(zero_copy_only=False)
        table[:, 1] >>= 2
        if held is not None and (held[0][0, :2] == table[0, :2]).all():
            table = np.concatenate([held[0], table])
            kind = np.concatenate([held[1], kind])
            lead = np.append(np.zeros(len(held[1]), bool), lead)
        row = np.arange(len(table))
        opens = np.ones(len(table), bool)
        opens[1:] = (table[1:, :2] != table[:-1, :2]).any(axis=1)
        first = np.maximum.accumulate(np.where(opens, row, 0))
        fresh = np.ones(len(table), bool)
        fresh[1:] = (table[1:] != table[:-1]).any(axis=1)
        fresh &= kind == HERE
        lead = lead & fresh
        last = np.maximum.accumulate(np.where(lead | (kind == LAST), row, -1))
        before = np.append(-1, last[:-1])
        far = fresh & (table[:, 3] != table[first, 3])
        near = lead & (before >= first) & (table[:, 3] != table[before, 3]) & (table[before] != table[first]).any(axis=1)
        own, of = np.append(row[far], row[near]), np.append(first[far], before[near])
        end = len(table) - 1
        keeps = [first[end], last[end], end] if last[end] >= first[end] else [first[end], end]
        held = table[keeps], np.array([FIRST, LAST, FIRST] if len(keeps) == 3 else [FIRST, FIRST])
        if len(own):
            columns = [table[own, 2], table[own, 3] * table[own, 5], table[of, 2], table[of, 3] * table[of, 5]]
            columns += [table[own, 4].astype(np.int32), table[of, 4].astype(np.int32)]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)


def neighbours(ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Groups of ranges that overlap when both ends are moved out by MARGIN, each in the order given."""
    groups, reach = [], -1
    for k in sorted(range(len(ranges)), key=ranges.__getitem__):
        low, high = ranges[k]
        if not groups or low - MARGIN > reach:
            groups.append([])
            reach = high + MARGIN
        groups[-1].append(k)
        reach = max(reach, high + MARGIN)
    return [sorted(group) for group in groups]


def fewest_matches(size: int, gap: int, ratio: float, least: int) -> int:
    """Words at which seeds begin in every passage of ``least`` words that lies on one diagonal.

    Of n words, ratio * n agree, in one run more than there are others at most; a run of k
    words has k - size + 1 seeds.
    """
    if gap > 1 or size * ratio <= size - 1:
        return 1
    return max(1, int(np.ceil((size * ratio - size + 1) * least - size + 1 - 1e-6)))


def _vain_pairs(spots: np.ndarray, bounds: np.ndarray, size: int, fewest: int) -> np.ndarray:
    """Pairs (of the numbers between two bounds) whose matches all touch on one diagonal and lie at fewer than ``fewest`` words."""
    spots = spots[bounds[0] : bounds[-1]].reshape(-1, 2)
    n = np.diff(bounds) // 2
    pair = np.repeat(np.arange(len(n)), n)
    small = n[pair] < fewest
    spots, pair = spots[small], pair[small]
    order = np.lexsort((spots[:, 1], spots[:, 0], pair))
    p, q, pair = spots[order, 0], spots[order, 1], pair[order]
    ahead = p[1:] - p[:-1]
    off = (pair[1:] == pair[:-1]) & ((q[1:] - q[:-1] != ahead) | (ahead > size))
    vain = n < fewest
    vain[pair[1:][off]] = False
    return vain


def _chain_task(size: int, gap_cost: float, least_seeds: int, fewest: int):
    """Chains (``CHAINS``) of each pair of texts, best first, those near each other in the text in one row.

    Rows come sorted by both texts.  A chain of touching seeds on one diagonal has only this
    diagonal for its passage, so it is left out if within its reach, MARGIN words on both
    sides, the pair has matches at fewer than ``fewest`` words.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 2 + [pa.list_(pa.list_(pa.int32()))] * 2
        names = ["own", "source", "p", "q"]
        carry, out = None, []

        def one_piece(p, q) -> bool:
            ahead = np.diff(p)
            return bool((ahead == np.diff(q)).all() and (ahead <= size).all())

        def close(key, parts):
            spots = np.concatenate([np.frombuffer(part, "<i4") for part in parts]).reshape(-1, 2).astype(np.int64)
            both = np.unique((spots[:, 0] << 32) | spots[:, 1])
            p, q = both >> 32, both & 0xFFFFFFFF
            at = p[np.append(True, p[1:] != p[:-1])]

            def vain(path) -> bool:
                low, high = np.searchsorted(at, [p[path[0]] - MARGIN, p[path[-1]] + MARGIN])
                return high - low < fewest and one_piece(p[path], q[path])

            paths = [path for path in chain(p, q, size, gap_cost) if len(path) >= least_seeds and not vain(path)]
            for near in neighbours([(int(p[path[0]]), int(p[path[-1]])) for path in paths]):
                out.append((*key, [p[paths[k]].tolist() for k in near], [q[paths[k]].tolist() for k in near]))

        def table() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(i).to_numpy() for i in (0, 1)], axis=1)
            packed = batch.column(2)
            # the matches of a pair lie after each other
            ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
            data = packed.buffers()[2]
            bounds = np.append(np.append(0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1), len(keys))
            wanted = ~_vain_pairs(np.frombuffer(data, "<i4"), ends[bounds] // 4, size, fewest)
            # a pair may go on from one batch to the next
            wanted[[0, -1]] = True
            for g in np.flatnonzero(wanted).tolist():
                key = tuple(keys[bounds[g]].tolist())
                part = data[int(ends[bounds[g]]) : int(ends[bounds[g + 1]])].to_pybytes()
                if carry is not None and carry[0] != key:
                    close(*carry)
                    carry = None
                carry = (key, [*(carry[1] if carry else []), part])
                if len(out) >= 5000:
                    yield table()
                    out.clear()
        if carry is not None:
            close(*carry)
        if out:
            yield table()

    return work


def _text_task(sent):
    """Texts whose content's place is in the bitmap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(bitmap.holds(sent.value, batch.column(0).to_numpy())))
            if part.num_rows:
                yield pa.RecordBatch.from_arrays(part.columns[1:], ["content", "first", "copied", "text"])

    return work


def word_hashes(text: str) -> np.ndarray:
    raw = ascii_lower(np.frombuffer(text.encode(), np.uint8))
    starts, ends, _ = words(raw, np.array([0, len(raw)]))
    return segment_hashes(raw, starts, ends)


def widen(text, source, a: int, b: int, c: int, d: int, hits: int, ratio: float, least: int) -> tuple:
    """A stretch of fewer than ``least`` words, moved out on both diagonals to the longest whose share is ``ratio``."""
    left, right = min(a, c, least), min(len(text) - b, len(source) - d, least)
    before = (text[a - left : a] == source[c - left : c])[::-1]
    after = text[b : b + right] == source[d : d + right]
    if hits + before.sum() + after.sum() < ratio * least - 1e-9:
        return a, b, c, d, hits
    x, y = np.append(0, np.flatnonzero(before) + 1), np.append(0, np.flatnonzero(after) + 1)
    matched = hits + np.arange(len(x))[:, None] + np.arange(len(y))
    size = max(b - a, d - c) + x[:, None] + y
    good = matched >= ratio * size - 1e-9
    if not good.any():
        return a, b, c, d, hits
    i, j = np.unravel_index(np.where(good, size, 0).argmax(), size.shape)
    m, n = int(x[i]), int(y[j])
    return a - m, b + n, c - m, d + n, int(matched[i, j])


def onward(a: np.ndarray, b: np.ndarray, hits: int, size: int, ratio: float) -> tuple[int, int, int]:
    """(words, source words, matches) by which a passage's end moves out, past up to two words put in or left out.

    Half of the words moved over agree, and ``ratio`` of the whole.
    """
    best = (0, 0, 0)
    for skip, other in ((0, 0), (1, 0), (0, 1), (2, 0), (0, 2)):
        n = min(len(a) - skip, len(b) - other, MARGIN)
        if n <= 0:
            continue
        same = a[skip : skip + n] == b[other : other + n]
        matched, moved = np.cumsum(same), np.arange(1, n + 1) + max(skip, other)
        good = np.flatnonzero(same & (2 * matched >= moved) & (hits + matched >= ratio * (size + moved)))
        if len(good) and int(matched[good[-1]]) > best[2]:
            k = int(good[-1])
            best = (skip + k + 1, other + k + 1, int(matched[k]))
    return best


def passages_of(own, source, ps, qs, low: int, size: int, ratio: float, least: int) -> list[tuple]:
    """(start, end, source start, source end, matches) of a text's passages along chains, best first.

    ``own`` are the text's words from ``low`` on.  A chain or passage is left out only if a
    passage reported before holds its range in the text and its range in the source.
    """
    out: list[tuple] = []

    def reported(a, b, c, d):
        return any(e <= a and b <= f and g <= c and d <= h for e, f, g, h, _ in out)

    for p, q in zip(ps, qs, strict=True):
        if reported(p[0], p[-1] + size, q[0], q[-1] + size):
            continue
        begin, shift = max(0, p[0] - MARGIN), max(0, q[0] - MARGIN)
        text, part = own[begin - low : p[-1] + MARGIN - low], source[shift : q[-1] + MARGIN]
        for a, b, c, d, hits in align(text, part, np.array(p) - begin, np.array(q) - shift, size, ratio):
            if b - a < least:
                a, b, c, d, hits = widen(text, part, a, b, c, d, hits, ratio, least)
            if b - a >= least:
                m, n, more = onward(text[:a][::-1], part[:c][::-1], hits, max(b - a, d - c), ratio)
                a, c, hits = a - m, c - n, hits + more
                m, n, more = onward(text[b:], part[d:], hits, max(b - a, d - c), ratio)
                b, d, hits = b + m, d + n, hits + more
            a, b, c, d = a + begin, b + begin, c + shift, d + shift
            if b - a >= least and hits >= ratio * max(b - a, d - c) - 1e-9 and not reported(a, b, c, d):
                out.append((a, b, c, d, hits))
    return out


def _align_task(size: int, ratio: float, least: int):
    """Passages (``FOUND``, ids by the first of equal texts) with both texts and whether one has other ids.

    Rows (``CELL``) come sorted by cell, texts before chains; the words of one cell are held.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in FOUND.split(", ")] + ["own", "source", "copied"]
        types = [pa.int64()] * 7 + [pa.float64()] + [pa.int64()] * 2 + [pa.bool_()]
        cell, known = None, {}
        for batch in batches:
            out = []
            i, j, is_chain, own, source = (batch.column(c).to_pylist() for c in range(5))
            for r in range(batch.num_rows):
                if (i[r], j[r]) != cell:
                    cell, known = (i[r], j[r]), {}
                if not is_chain[r]:
                    known[own[r]] = word_hashes(batch.column(7)[r].as_py()), batch.column(8)[r].as_py(), batch.column(9)[r].as_py()
                    continue
                text, doc, copied = known[own[r]]
                other, source_doc, source_copied = known[source[r]]
                p, q = batch.column(5)[r].as_py(), batch.column(6)[r].as_py()
                for a, b, c, d, hits in passages_of(text, other, p, q, 0, size, ratio, least):
                    found = (doc, a, b, source_doc, c, d, hits, hits / max(b - a, d - c))
                    out.append((*found, own[r], source[r], copied or source_copied))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names
                )

    return work


def for_all_ids(found: DataFrame, members: DataFrame) -> DataFrame:
    """Passages of texts with several ids (``members``: content, doc), for each id of the text and each earlier one of the source."""
    own = members.select(F.col("content").alias("own"), F.col("doc").alias("own_doc"))
    source = members.select(F.col("content").alias("source"), F.col("doc").alias("other_doc"))
    named = {"doc_id": F.coalesce("own_doc", "doc_id"), "source_doc_id": F.coalesce("other_doc", "source_doc_id")}
    every = found.join(own, "own", "left").join(source, "source", "left").withColumns(named)
    return every.filter("source_doc_id < doc_id or source_doc_id = doc_id and source < own")


def fuzzy_passages(
    docs: DataFrame,
    size: int = 4,
    gap: int = 1,
    ratio: float = 0.8,
    least: int = 50,
    gap_cost: float = 0.05,
    least_seeds: int = 1,
) -> DataFrame:
    """Passages of texts that an earlier text has as well, words replaced, left out or put in (``FOUND``).

    ``docs`` needs (doc_id, text); other columns are ignored.  Words are parted by white
    space, A-Z in lower case; places are counted in words.  A passage has at least
    ``least`` words, of which ``ratio`` agree with the source in order.  Sources are all
    earlier texts (smaller doc_id, null last, among equal ids by content) that share a seed
    with the text, so a group of n texts with one passage gives n * (n - 1) / 2 rows.  Texts
    equal to an earlier one as a whole are one passage with the first of them, if they have
    ``least`` words.  Repeats within one text are not passages.  Null, empty and short texts
    have none; rows with equal id and text count as one; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(
        text.alias("text"),
        F.xxhash64(text).alias("content"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
    )
    once, copied = each_once(texts)
    spots, ranges = seed_spots(once, size, gap)
    pairs = (
        spots.repartition("anchor", "cell")
        .sortWithinPartitions("anchor", "cell", "first", "content", "at")
        .mapInArrow(_pair_task(ranges, MATCHES), "own long, source long, spots binary")
    )
    fewest = fewest_matches(size, gap, ratio, least)
    chains = keep(
        pairs.repartition("own", "source")
        .sortWithinPartitions("own", "source")
        .mapInArrow(_chain_task(size, gap_cost, least_seeds, fewest), CHAINS),
        "passage-chains",
    )
    wanted = chains.select(F.col("own").alias("content")).union(chains.select("source"))
    has = spark.sparkContext.broadcast(bitmap.build(wanted, "content"))
    full = once.select(
        bitmap.place(F.col("content")).alias("place"), "content", "first", F.expr("first != last").alias("copied"), "text"
    ).mapInArrow(_text_task(has), "content long, first long, copied boolean, text string")
    n_bytes = full.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(int(np.ceil(np.sqrt(4 * spark.sparkContext.defaultParallelism))), -(-n_bytes // BLOCK_BYTES))
    cells = chains.withColumns({n: F.pmod(F.col(of), F.lit(blocks)).cast("int") for n, of in (("i", "own"), ("j", "source"))})
    asked = cells.select("i", "j", F.col("own").alias("content")).union(cells.select("i", "j", "source")).distinct()
    of_cell = asked.join(full, "content").withColumns({"own": F.col("content"), "chain": F.lit(False)})
    met = cells.withColumn("chain", F.lit(True)).unionByName(of_cell, allowMissingColumns=True)
    aligned = keep(
        met.select(*[part.split()[0] for part in CELL.split(", ")])
        .repartition("i", "j")
        .sortWithinPartitions("i", "j", "chain")
        .mapInArrow(_align_task(size, ratio, least), f"{FOUND}, own long, source long, copied boolean"),
        "passages-of-first-ids",
    )
    several = copied.filter("first != last").select("content")
    members = texts.select("content", "doc").join(several, "content").distinct()
    names = [part.split()[0] for part in FOUND.split(", ")]
    found = aligned.filter("not copied").select(*names).unionByName(
        for_all_ids(aligned.filter("copied"), members).select(*names)
    )
    # whole copies, without their texts
    n_words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")
    lengths = texts.select("doc", "content", F.octet_length("text").alias("bytes"), n_words.alias("n"))
    first = (
        lengths.filter(F.col("n") >= least)
        .groupBy("content", "bytes")
        .agg(F.min("doc").alias("source"), F.max("doc").alias("last"))
        .filter("source != last")
    )
    real = lambda name: F.when(F.col(name) != LAST_ID, F.col(name))
    zero = F.lit(0).cast("long")
    copies = (
        lengths.join(first, ["content", "bytes"])
        .filter("doc != source")
        .distinct()
        .select(
            real("doc").alias("doc_id"),
            zero.alias("start_word"),
            F.col("n").alias("end_word"),
            real("source").alias("source_doc_id"),
            zero.alias("source_start"),
            F.col("n").alias("source_end"),
            F.col("n").alias("n_matched"),
            F.lit(1.0).alias("similarity"),
        )
    )
    return found.withColumns({n: real(n) for n in ("doc_id", "source_doc_id")}).unionByName(copies)
