"""Pairs of lines that meet under a shared key, found in packed arrays.

Keys are dealt out by their value in two steps. First only (key, line, size) moves, which shows the
keys that two lines of like size share; a bit array of these keys comes back. Then the lines are
dealt out under such keys alone, with the parities of their shingle sets, and are compared where
they meet. Of a key that many lines share by chance nothing goes on: its lines are parted into
groups connected by pairs that may link, and small groups are listed pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldgauge.llm.tables import stored
from fieldgauge.session import shuffle_partitions

#: Postings dealt out at once by a task, and bytes of them in the second step.
DEALT, DEALT_BYTES = 1 << 19, 16 << 20
#: Postings of a partition, about; partitions are as many as the session shuffles into, at least.
PART_POSTINGS = 1_000_000
#: Least and most bits of the array of shared keys; where more keys are shared, more lines move in vain.
LEAST_BITS, MOST_BITS = 16, 28
#: Postings with sketches that are on disk at once, for each line.
HELD = 2
#: Lines of a crowded key that are compared with the others at once, and words of sketches.
ROWS, COMPARED_WORDS = 16, 1 << 20
#: Shingles for each bucket of a sketch, at most, where lines meet.
LOAD = 1.4
_SIZE_MAX = 65_535


def spared(total: np.ndarray) -> np.ndarray:
    """Places spared for colliding hashes: one, and twice as many as two sets are expected to have."""
    return 1 + np.floor(total.astype(np.float64) * total / 2.0**32).astype(np.int64)


def sizes_alike(less: np.ndarray, more: np.ndarray, percent: int) -> np.ndarray:
    """Sizes such as two linked lines may have."""
    return 100 * less >= percent * more - 100 * spared(less + more)


def places_alike(n: np.ndarray, other: np.ndarray, distance: np.ndarray, percent: int) -> np.ndarray:
    """Sizes, and the places in which parities differ, are such as two linked lines may have."""
    total = n + other
    need = -(-percent * total // (100 + percent))
    return sizes_alike(np.minimum(n, other), np.maximum(n, other), percent) & (distance <= total - 2 * need + spared(total))


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (a row each) at fewer words; folding parities never adds a place."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of keys, of equal width."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _postings(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, id, size and row in the batch of every posting."""
    bands = batch.column("bands")
    lengths = np.diff(bands.offsets.to_numpy())
    row = np.repeat(np.arange(batch.num_rows), lengths)
    keys = bands.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return keys, batch.column("id").to_numpy()[row], batch.column("n").to_numpy()[row], row


def _cut(part: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The order by part, and (part, start, end) of each."""
    order = np.argsort(part, kind="stable")
    ranked = part[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    return order, list(zip(ranked[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True))


def _deal_keys(parts: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def dealt() -> pa.RecordBatch:
            keys, ids, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
            order, cuts = _cut(_part(keys, parts))
            keys, ids, sizes = keys[order], ids[order], sizes[order]
            data = [keys[s:e].tobytes() + ids[s:e].tobytes() + sizes[s:e].tobytes() for _, s, e in cuts]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _, _ in cuts], pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])

        for batch in batches:
            keys, ids, n, _ = _postings(batch)
            held.append((keys, ids, np.minimum(n, _SIZE_MAX).astype(np.uint16)))
            count += len(keys)
            if count >= DEALT:
                yield dealt()
                held, count = [], 0
        if count:
            yield dealt()

    return deal


def _recurring(keys: np.ndarray) -> np.ndarray:
    """Places of the keys that are there more than once."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    return order[np.r_[same, False] | np.r_[False, same]] if len(keys) else order


def _ordered(keys: np.ndarray, n: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The order by key, size and id, each line once a key."""
    order = np.lexsort((ids, n, keys))
    k, i = keys[order], ids[order]
    return order[np.r_[True, (k[1:] != k[:-1]) | (i[1:] != i[:-1])]] if len(order) else order


def _find_shared(percent: int, bits: int):
    """The stretch of the bit array that these keys lie in, with the bits of shared keys."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for data in batch.column("data"):
                raw = data.as_py()
                m = len(raw) // 18
                held.append((np.frombuffer(raw, np.uint64, m), np.frombuffer(raw, np.int64, m, 8 * m), np.frombuffer(raw, np.uint16, m, 16 * m)))
        if not held:
            return
        keys, ids, n = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        some = _recurring(keys)
        keys, ids, n = keys[some], ids[some], n[some].astype(np.int64)
        order = _ordered(keys, n, ids)
        keys, n = keys[order], n[order]
        alike = (keys[1:] == keys[:-1]) & (sizes_alike(n[:-1], n[1:], percent) | (n[1:] == _SIZE_MAX))
        shared = np.r_[alike, False] | np.r_[False, alike]
        if not shared.any():
            return
        places = np.unique(keys[shared] >> np.uint64(64 - bits)).astype(np.int64)
        start = int(places[0]) // 8
        marks = np.zeros((int(places[-1]) // 8 - start + 1) * 8, dtype=np.uint8)
        marks[places - start * 8] = 1
        yield pa.RecordBatch.from_arrays([pa.array([start]), pa.array([int(shared.sum())]), pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())], names=["start", "n", "marks"])

    return find


def _deal_sketched(parts: int, marked: np.ndarray, bits: int, share: int, shares: int):
    """Postings of marked keys with the sketch of their line, at the size that ``LOAD`` allows."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        size = 0

        def dealt() -> pa.RecordBatch:
            part, words, data = [], [], []
            for w, rows in held.items():
                keys, ids, n, sketches = (np.concatenate(x) for x in zip(*rows, strict=True))
                order, cuts = _cut(_part(keys, parts))
                keys, ids, n, sketches = keys[order], ids[order], n[order], sketches[order]
                for p, s, e in cuts:
                    part.append(p)
                    words.append(w)
                    data.append(keys[s:e].tobytes() + ids[s:e].tobytes() + n[s:e].tobytes() + sketches[s:e].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(words, pa.int32()), pa.array(data, pa.binary())], names=["part", "words", "data"])

        for batch in batches:
            keys, ids, n, row = _postings(batch)
            place = keys >> np.uint64(64 - bits)
            wanted = (marked[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            if shares > 1:
                wanted &= keys % np.uint64(shares) == share
            wanted = np.flatnonzero(wanted)
            row = row[wanted]
            sketch = batch.column("sketch")
            ends, flat = sketch.offsets.to_numpy(), sketch.values.to_numpy(zero_copy_only=False).view(np.uint64)
            width = np.diff(ends)
            # as many words, of a power of two, as the size asks for and the line has
            asked = np.maximum(np.ceil(batch.column("n").to_numpy() / (64 * LOAD)), 1)
            target = np.minimum(width, 1 << np.ceil(np.log2(asked)).astype(np.int64))
            for w, t in {*zip(width[row].tolist(), target[row].tolist(), strict=True)}:
                at = (width[row] == w) & (target[row] == t)
                take = wanted[at]
                sketches = folded(flat[ends[:-1][row[at]][:, None] + np.arange(w)], t)
                held.setdefault(t, []).append((keys[take], ids[take], n[take].astype(np.int32), sketches))
                size += len(take) * (20 + 8 * t)
            if size >= DEALT_BYTES:
                yield dealt()
                held.clear()
                size = 0
        if held:
            yield dealt()

    return deal


class _Lines:
    """Lines under keys, ordered by key and size, and comparison of their sketches."""

    def __init__(self, held: dict[int, list[tuple]], percent: int):
        keys, ids, n, words, rows, self.sketches = [], [], [], [], [], {}
        for w, found in held.items():
            k, i, m, s = (np.concatenate(x) for x in zip(*found, strict=True))
            keys.append(k), ids.append(i), n.append(m.astype(np.int64)), words.append(np.full(len(k), w)), rows.append(np.arange(len(k)))
            self.sketches[w] = s
        keys, ids, n, words, rows = (np.concatenate(x) for x in (keys, ids, n, words, rows))
        some = _recurring(keys)
        order = some[_ordered(keys[some], n[some], ids[some])]
        self.keys, self.ids, self.n, self.words, self.rows = keys[order], ids[order], n[order], words[order], rows[order]
        self.percent = percent

    def taken(self, places: np.ndarray, words: int) -> np.ndarray:
        """The sketches of lines at so many words; none has fewer."""
        result = np.empty((len(places), words), dtype=np.uint64)
        width = self.words[places]
        for w in np.unique(width).tolist():
            at = np.flatnonzero(width == w)
            result[at] = folded(self.sketches[w][self.rows[places[at]]], words)
        return result

    def alike(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Which of the pairs (places) may link."""
        result = np.zeros(len(one), dtype=bool)
        least = np.minimum(self.words[one], self.words[two])
        for w in np.unique(least).tolist():
            at = np.flatnonzero(least == w)
            for some in np.array_split(at, max(1, len(at) * w // COMPARED_WORDS)):
                differ = np.bitwise_count(self.taken(one[some], w) ^ self.taken(two[some], w)).sum(axis=1, dtype=np.int64)
                result[some] = places_alike(self.n[one[some]], self.n[two[some]], differ, self.percent)
        return result

    def groups(self, places: np.ndarray) -> np.ndarray:
        """A number for each of these lines, ordered by size, that is equal for lines connected by
        pairs that may link. Lines in one group already are not compared again."""
        n, group = self.n[places], np.arange(len(places))
        start = 0
        while start < len(places):
            w = int(self.words[places[start]])
            rows = np.arange(start, min(start + ROWS, len(places)))
            rows = rows[self.words[places[rows]] == w]  # sizes rise, and so do words
            end = int(rows[-1]) + 1
            # sizes rise: the first that is too large for the last row ends the stretch
            reach = end + np.searchsorted(~sizes_alike(n[end - 1], n[end:], self.percent), True)
            others = np.arange(start + 1, reach)
            if (group[rows] == group[start]).all():
                others = others[group[others] != group[start]]
            own = self.taken(places[rows], w)
            for some in np.array_split(others, max(1, len(others) * len(rows) * w // COMPARED_WORDS)):
                if not len(some):
                    continue
                theirs = self.taken(places[some], w)
                differ = np.zeros((len(rows), len(some)), dtype=np.int64)
                for word in range(w):
                    differ += np.bitwise_count(own[:, word, None] ^ theirs[None, :, word])
                near = places_alike(n[rows][:, None], n[some][None, :], differ, self.percent) & (some[None, :] > rows[:, None])
                for r in np.flatnonzero(near.any(axis=1)).tolist():
                    met = np.unique(np.r_[group[rows[r]], group[some[near[r]]]])
                    if len(met) > 1:
                        group[np.isin(group, met)] = met[0]
            start = end
        return group


def _pairs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places within small stretches, by how far apart they lie."""
    for apart in range(1, int(sizes.max(initial=0))):
        fits = np.flatnonzero(sizes > apart)
        count = sizes[fits] - apart
        ends = np.cumsum(count)
        one = np.repeat(starts[fits], count) + np.arange(ends[-1]) - np.repeat(ends - count, count)
        yield one, one + apart


def _meet(percent: int, listed: int):
    """Rows (key, a, b): pairs of few lines that may link, without key; of groups of more lines, the
    key of the group and the line ``a``."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for w, data in zip(batch.column("words").to_pylist(), batch.column("data"), strict=True):
                raw = data.as_py()
                m = len(raw) // (20 + 8 * w)
                arrays = [np.frombuffer(raw, kind, m, at * m) for kind, at in ((np.uint64, 0), (np.int64, 8), (np.int32, 16))]
                held.setdefault(w, []).append((*arrays, np.frombuffer(raw, np.uint64, m * w, 20 * m).reshape(m, w)))
        if not held:
            return
        lines = _Lines(held, percent)
        del held
        starts = np.flatnonzero(np.r_[True, lines.keys[1:] != lines.keys[:-1]]) if len(lines.keys) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[starts, len(lines.keys)])
        places, few_starts, few_sizes, filled = [], [], [], 0
        for s, c in zip(starts[sizes > listed].tolist(), sizes[sizes > listed].tolist(), strict=True):
            group = lines.groups(np.arange(s, s + c))
            order = np.argsort(group, kind="stable")
            ranked = group[order]
            first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            for g, (f, size) in enumerate(zip(first.tolist(), np.diff(np.r_[first, c]).tolist(), strict=True)):
                if size > listed:
                    # a key of its own for each group but the first
                    key = np.uint64(int(lines.keys[s]) ^ (g * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
                    yield _rows(np.full(size, key).view(np.int64), lines.ids[s + order[f : f + size]], None)
                elif size > 1:
                    places.append(s + order[f : f + size])
                    few_starts.append(filled)
                    few_sizes.append(size)
                    filled += size
        few = sizes <= listed
        for at, (b, c) in ((None, (starts[few], sizes[few])), (places, (np.array(few_starts, dtype=np.int64), np.array(few_sizes, dtype=np.int64)))):
            own = None if at is None else np.concatenate([np.zeros(0, dtype=np.int64), *at])
            for one, two in _pairs(b, c):
                one, two = (one, two) if own is None else (own[one], own[two])
                keep = lines.alike(one, two)
                x, y = lines.ids[one[keep]], lines.ids[two[keep]]
                yield _rows(None, np.minimum(x, y), np.maximum(x, y))

    def _rows(keys: np.ndarray | None, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        blank = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([blank if keys is None else pa.array(keys), pa.array(a), blank if b is None else pa.array(b)], names=["key", "a", "b"])

    return meet


def meet(descriptions: DataFrame, percent: int, listed: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of lines that share a key and may link, and (key, gid) of lines in groups of more
    than ``listed`` that share a key and are connected by such pairs.

    ``descriptions`` has id, n, bands and sketch; a line may be there more than once.
    """
    spark = descriptions.sparkSession
    lines, count = descriptions.agg(F.count("*"), F.coalesce(F.sum(F.size("bands")), F.lit(0))).first()
    parts = max(shuffle_partitions(spark), count // PART_POSTINGS)
    bits = min(MOST_BITS, max(LEAST_BITS, (2 * count).bit_length()))
    dealt = descriptions.select("id", "n", "bands").mapInArrow(_deal_keys(parts), "part int, data binary").repartitionById(parts, "part")
    shared = stored(dealt.mapInArrow(_find_shared(percent, bits), "start long, n long, marks binary"), "shared")
    marked, postings = np.zeros(1 << (bits - 3), dtype=np.uint8), 0
    for row in shared.toLocalIterator():  # 2 ** MOST_BITS bits at most
        marked[row["start"] : row["start"] + len(row["marks"])] |= np.frombuffer(row["marks"], np.uint8)
        postings += row["n"]
    shares = max(1, -(-postings // max(1, HELD * lines)))
    met = None
    for share in range(shares):
        dealt = descriptions.select("id", "n", "bands", "sketch").mapInArrow(_deal_sketched(parts, marked, bits, share, shares), "part int, words int, data binary")
        found = dealt.repartitionById(parts, "part").mapInArrow(_meet(percent, listed), "key long, a long, b long")
        found = stored(found, "met")
        met = found if met is None else met.unionByName(found)
    return met.filter("key is null").select("a", "b").distinct(), met.filter("key is not null").select("key", F.col("a").alias("gid"))
