"""Runs of repeated word sequences by a suffix automaton with link-cut access.

The states of a text's suffix automaton form a tree by their suffix links. Words are appended one
by one: the path from the state of the text so far to the root is accessed, and its segments,
each of one last end, take the new end. Between two ends that lie no further apart than the words
of a segment, but further than those of the state above it, a square of just that period ends;
squares are extended to runs, a run once.

Only words that can be in a run reach the automaton. In a run of n words, n at least 12 and twice
the period, the first n - q words stand again q words later; both copies together are the run and
hold six words at least. So each word of a run lies in a sequence of six words that occurs twice
within it. Stretches of such words are found by hashes for many texts at once, narrowed until
nothing changes, and searched one by one; a false match of hashes only makes a stretch longer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from fieldgauge.llm.batches import parts, utf8

LEAST_WORDS = 12
RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix links, longest lengths, and the state of each prefix."""
    link, longest, moves, prefixes = [-1], [0], [{}], []
    last = 0
    for word in words:
        state = len(link)
        longest.append(longest[last] + 1)
        moves.append({})
        link.append(0)
        p = last
        while p >= 0 and word not in moves[p]:
            moves[p][word] = state
            p = link[p]
        if p >= 0:
            q = moves[p][word]
            if longest[q] == longest[p] + 1:
                link[state] = q
            else:
                copy = len(link)
                longest.append(longest[p] + 1)
                moves.append(moves[q].copy())
                link.append(link[q])
                while p >= 0 and moves[p].get(word) == q:
                    moves[p][word] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
        prefixes.append(state)
    return link, longest, prefixes


class Paths:
    """Link-cut access to the link tree; a preferred path is a splay tree with one last end at its root."""

    def __init__(self, link: list[int]) -> None:
        self.up = [p if p > 0 else -1 for p in link]  # the empty text is left out
        self.above, self.below = [-1] * len(link), [-1] * len(link)
        self.end = [-1] * len(link)

    def _inner(self, x: int) -> bool:
        """Whether x hangs below another node of its splay tree."""
        p = self.up[x]
        return p >= 0 and (self.above[p] == x or self.below[p] == x)

    def _rotate(self, x: int) -> None:
        up, above, below = self.up, self.above, self.below
        p = up[x]
        g = up[p]
        if g >= 0:
            if above[g] == p:
                above[g] = x
            elif below[g] == p:
                below[g] = x
        if above[p] == x:
            moved = above[p] = below[x]
            below[x] = p
        else:
            moved = below[p] = above[x]
            above[x] = p
        if moved >= 0:
            up[moved] = p
        up[x], up[p] = g, x

    def _splay(self, x: int) -> None:
        root = x
        while self._inner(root):
            root = self.up[root]
        self.end[x] = self.end[root]
        while self._inner(x):
            p = self.up[x]
            if self._inner(p):
                same = (self.above[self.up[p]] == p) == (self.above[p] == x)
                self._rotate(p if same else x)
            self._rotate(x)

    def access(self, state: int, at: int) -> Iterator[tuple[int, int, int]]:
        """Recolour the path above ``state`` to the end ``at``; yields (deepest state, state above, old end) by segment."""
        lower, x = -1, state
        while x >= 0:
            self._splay(x)
            cut = self.below[x]
            if cut >= 0:
                self.end[cut] = self.end[x]
            if self.end[x] >= 0:
                yield x, self.up[x], self.end[x]
            self.below[x] = lower
            lower, x = x, self.up[x]
        self.end[lower] = at


def runs_of(words: list[int], least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words, by start and period."""
    link, longest, prefixes = automaton(words)
    paths, n = Paths(link), len(words)
    covered: dict[int, int] = {}  # last word of the latest run of a period
    found = []
    for i, state in enumerate(prefixes):
        for deepest, above, end in paths.access(state, i):
            period = i - end
            if period > longest[deepest] or period <= (longest[above] if above >= 0 else 0) or covered.get(period, -1) >= i:
                continue
            first, last = i - 2 * period + 1, i
            while first > 0 and words[first - 1] == words[first - 1 + period]:
                first -= 1
            while last + 1 < n and words[last + 1] == words[last + 1 - period]:
                last += 1
            covered[period] = last
            if last - first + 1 >= least:
                found.append((first, last - first + 1, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit hash of whole numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stretches(ids: np.ndarray, owner: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int]]:
    """[first, end) of the stretches that can hold a run; ``owner`` tells texts apart, in ascending order."""
    half = max(1, least // 2)
    if len(ids) < least:
        return []
    hashed, grams = _mixed(ids), np.zeros(len(ids) - half + 1, dtype=np.uint64)
    for k in range(half):
        grams = grams * np.uint64(0x100000001B3) + hashed[k : k + len(grams)]
    marked, count = np.ones(len(ids), dtype=bool), len(ids)
    while True:
        # a window counts if it lies in one stretch and occurs there again
        inside = np.flatnonzero((owner[: len(grams)] == owner[half - 1 :]) & (np.convolve(marked, np.ones(half, dtype=np.int64), "valid") == half))
        keys = _mixed(grams[inside] ^ _mixed(owner[inside]))
        _, where, times = np.unique(keys, return_inverse=True, return_counts=True)
        again = inside[times[where] > 1]
        change = np.bincount(again, minlength=len(ids) + 1) - np.bincount(again + half, minlength=len(ids) + 1)
        marked = np.cumsum(change)[:-1] > 0
        starts = marked & ~np.concatenate([[False], marked[:-1] & (owner[1:] == owner[:-1])])
        owner = np.cumsum(starts)
        firsts = np.flatnonzero(starts)
        lengths = np.bincount(owner[marked] - 1, minlength=len(firsts))
        long = lengths >= least
        marked &= np.concatenate([[False], long])[owner]
        if int(marked.sum()) == count:
            return [(int(s), int(s + n)) for s, n in zip(firsts[long], lengths[long], strict=True)]
        count = int(marked.sum())


def folded(ids: np.ndarray, doc_id: int | str) -> np.ndarray:
    """The words with a period written into those of every tenth id (by its CRC), as a test corpus has it."""
    h, n = zlib.crc32(str(doc_id).encode()), len(ids)
    if h % 10 or not n:
        return ids
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([ids[:a], ids[a + np.arange(n - a) % period]])


def periodic_runs(documents: DataFrame, least: int = LEAST_WORDS, fold: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of each text in words, and the text without their repeats.

    A run is a stretch of at least ``least`` words, and twice its smallest period, that cannot be
    extended. ``collapsed`` joins by one space the words that no run holds after its first period.
    With ``fold`` the words are first folded (:func:`folded`).

    NULL and empty texts have no runs and collapse to nothing; a NULL id is not folded; repeated
    rows are kept; an empty table gives no rows; other columns are ignored. A stretch that may hold
    runs needs about 1 kB a word in its task, other words a few bytes.
    """
    source = documents.select("doc_id", "text")
    schema = StructType([source.schema["doc_id"], StructField("runs", ArrayType(RUN)), StructField("collapsed", BinaryType())])
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in RUN.names]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            texts, doc_ids = [t.split() for t in utf8(batch)], batch.column("doc_id").to_pylist()
            distinct = list({w for t in texts for w in t})
            number = dict(zip(distinct, range(len(distinct)), strict=True))
            ids = [np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts]
            changed = [i if not fold or d is None else folded(i, d) for i, d in zip(ids, doc_ids, strict=True)]
            n = np.array([len(i) for i in ids], dtype=np.int64)
            firsts = np.cumsum(n) - n
            flat, owner = np.concatenate(changed), np.repeat(np.arange(len(n)), n)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for start, end in stretches(flat, owner, least):
                doc = owner[start]
                runs[doc] += [(start - int(firsts[doc]) + s, length, p) for s, length, p in runs_of(flat[start:end].tolist(), least)]
            kept = []
            for text, before, after, found in zip(texts, ids, changed, runs, strict=True):
                if before is not after or found:
                    held = np.zeros(len(after) + 1, dtype=np.int64)
                    for s, length, p in found:
                        held[s + p] += 1
                        held[s + length] -= 1
                    text = [distinct[w] for w in after[np.cumsum(held)[:-1] == 0]]
                kept.append(b" ".join(text))
            told = [[{"start": s, "length": length, "period": p} for s, length, p in sorted(r, key=lambda x: (x[0], x[2]))] for r in runs]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(told, kind), pa.array(kept, pa.binary())], names=schema.names)

    return source.mapInArrow(search, schema).withColumn("collapsed", F.col("collapsed").cast("string"))
