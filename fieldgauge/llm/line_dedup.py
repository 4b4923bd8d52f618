"""Fuzzy line deduplication by MinHash.

Equal lines (up to blanks and case) collapse first. A line is a set of character shingles; its
one-permutation MinHash has ``BINS`` values, empty bins borrow from others, and bands of
``ROWS`` values are the candidate keys. Candidates are verified on their exact shingle sets and
joined by distributed union-find; of each component only the first line of the corpus stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge.llm.components import link
from fieldgauge.llm.decontamination import KEY, row_key
from fieldgauge.llm.key_meeting import meet
from fieldgauge.llm.tables import discard, stored

CHARACTERS, PERCENT = 5, 80
BINS, ROWS = 48, 4
BANDS = BINS // ROWS
BORROWINGS = 32
SKETCH_BITS = 256  # at least; a longer line has as many as shingles, up to the next power of two
SEEN = 1_000_000  # lines that a task remembers
CHUNK = 50_000  # characters handled at once, so that the arrays stay in a core's cache
#: All pairs of a key that at most so many lines share are listed; lines of other keys meet hubs.
LISTED = 16
#: Rows that may be broadcast: places of lines to be verified (24 bytes), shared keys and ids (8).
BROADCAST_LINES, BROADCAST_KEYS = 500_000, 1_000_000
#: Numbers of dropped lines (4 bytes, and 24 for each document) that may be broadcast.
BROADCAST_DROPPED = 1_000_000
_PRIME32, _M1, _M2 = np.uint32(0x01000193), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
_PRIME, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint32(0xFFFFFFFF)


def normal(line: str) -> str:
    """The form in which lines are compared."""
    return " ".join(line.split()).lower()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all lines in a row, and their lengths; short lines are filled up."""
    padded = [x if len(x) >= CHARACTERS else x + "\0" * (CHARACTERS - len(x)) for x in lines]
    lengths = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    return np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), lengths


def exact_set(line: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the character shingles of one line."""
    return exact_sets([line])[0]


def exact_sets(lines: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the character shingles of each line."""
    points, lengths = _points(lines)
    points = points.astype(np.uint64)
    size = len(points) - CHARACTERS + 1
    code = points[:size].copy()
    for i in range(1, CHARACTERS):
        code *= _PRIME
        code += points[i : i + size]
    code, ends, sets = _mixed(code), np.cumsum(lengths), []
    for end, length in zip(ends.tolist(), lengths.tolist(), strict=True):
        own = code[end - length : end - CHARACTERS + 1]
        own.sort()
        sets.append(own[np.r_[True, own[1:] != own[:-1]]])
    return sets


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of the distinct 32-bit shingle hashes of each line, sorted."""
    points, lengths = _points(lines)
    size = len(points) - CHARACTERS + 1
    code = points[:size] * _PRIME32
    for i in range(1, CHARACTERS - 1):
        code += points[i : i + size]
        code *= _PRIME32
    code += points[CHARACTERS - 1 :]
    crossing = (np.cumsum(lengths)[:-1, None] - np.arange(1, CHARACTERS)).ravel()
    code = np.delete(code, crossing[crossing < size])
    for shift, factor in ((16, _M1), (13, _M2)):
        code ^= code >> np.uint32(shift)
        code *= factor
    code ^= code >> np.uint32(16)
    both = (np.repeat(np.arange(len(lines), dtype=np.uint64), lengths - CHARACTERS + 1) << np.uint64(32)) | code
    both.sort()
    both = both[np.r_[True, both[1:] != both[:-1]]]
    return (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)


def described(lines: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each line: set size, MinHash values by bin, and the parities of its shingles by bucket.

    The buckets are a power of two that follows the size, because parities of many more shingles
    than buckets tell nothing; the halves of the longer of two sketches fold onto each other.
    """
    line, hashes = shingles(lines)
    sizes = np.bincount(line, minlength=len(lines)).astype(np.int32)
    # sorted hashes, and bins that rise with the hash: the first of a bin is its least
    place = line * BINS + ((hashes.astype(np.uint64) * np.uint64(BINS)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    table = np.full(len(lines) * BINS, _EMPTY, dtype=np.uint32)
    table[place[first]] = hashes[first]
    buckets = np.maximum(SKETCH_BITS, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    ends = np.cumsum(buckets)
    bucket = hashes.astype(np.int64) & (buckets[line] - 1)
    odd = np.bincount((ends - buckets)[line] + bucket, minlength=ends[-1]) & 1
    words = np.packbits(odd.astype(np.uint8)).view(np.int64)
    sketch = pa.ListArray.from_arrays(pa.array(np.r_[0, ends // 64], pa.int32()), pa.array(words))
    return sizes, _densified(table.reshape(len(lines), BINS)), sketch


def _densified(table: np.ndarray) -> np.ndarray:
    """Fill empty bins from others of the same line."""
    filled, result = table != _EMPTY, table.copy()
    line, bin_ = np.nonzero(~filled)
    for attempt in range(1, BORROWINGS + 1):
        if not len(line):
            break
        # each empty bin asks the same bins in the same order in every line
        donor = (_mixed(bin_.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt)) % np.uint64(BINS)).astype(np.int64)
        found = filled[line, donor]
        result[line[found], bin_[found]] = table[line[found], donor[found]]
        line, bin_ = line[~found], bin_[~found]
    if len(line):  # lines with very few shingles: the next filled bin to the right
        order = (bin_[:, None] + np.arange(1, BINS)) % BINS
        nearest = np.argmax(filled[line[:, None], order], axis=1)
        result[line, bin_] = table[line, order[np.arange(len(line)), nearest]]
    return result


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each line."""
    parts = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    code = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(ROWS):
        code = _mixed(code * _PRIME + parts[:, :, i])
    return code


def _compared(text: str | None) -> Iterator[tuple[int, str]]:
    """Number and normal form of the lines of a text that are not blank."""
    for n, line in enumerate((text or "").split("\n")):
        compared = normal(line)
        if compared:
            yield n, compared


def _names(lines: list[str]) -> pa.Array:
    """The 64-bit id of each line."""
    return pa.array(np.fromiter(map(xxhash.xxh3_64_intdigest, lines), dtype=np.uint64, count=len(lines)).view(np.int64))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line by its id, ``CHUNK`` characters at a time; a line that the task has not seen before
    with its description. A task that has seen many lines forgets them, and describes some again."""

    def rows(docs: pa.RecordBatch, at: list[int], numbers: list[int], lines: list[str]) -> pa.RecordBatch:
        names = _names(lines)
        new = []
        for i, name in enumerate(names.to_pylist()):
            if name not in seen:
                seen.add(name)
                new.append(i)
        take = pa.array(at, pa.int64())
        columns = [docs.column("doc_id").take(take), docs.column(KEY).take(take), pa.array(numbers, pa.int32()), names]
        if new:
            sizes, signature, sketch = described([lines[i] for i in new])
            place = np.full(len(lines), -1)
            place[new] = np.arange(len(new))
            place = pa.array(place, pa.int64(), mask=place < 0)
            columns += [x.take(place) for x in (pa.array(sizes), _lists(band_keys(signature).view(np.int64)), sketch)]
        else:
            columns += [pa.nulls(len(lines), pa.int32()), *[pa.nulls(len(lines), pa.list_(pa.int64()))] * 2]
        if len(seen) > SEEN:
            seen.clear()
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", KEY, "line_no", "id", "n", "bands", "sketch"])

    seen: set[int] = set()
    for batch in batches:
        at, numbers, lines, size = [], [], [], 0
        for d, text in enumerate(batch.column("text")):
            for n, line in _compared(text.as_py()):
                at.append(d)
                numbers.append(n)
                lines.append(line)
                size += len(line)
                if size >= CHUNK:
                    yield rows(batch, at, numbers, lines)
                    at, numbers, lines, size = [], [], [], 0
        if lines:
            yield rows(batch, at, numbers, lines)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def _small(df: DataFrame, bound: int) -> DataFrame:
    """A stored table, marked for broadcast if it has at most ``bound`` rows."""
    return F.broadcast(df) if df.count() <= bound else df


def _folded(sketch: str, other: str) -> Column:
    """A sketch at the size of the other one, where that has half as many buckets. Sizes of linked
    lines never lie farther apart; of others the places have no number, which drops the pair."""
    half = F.floor(F.size(sketch) / 2).cast("int")
    halves = F.zip_with(F.slice(sketch, 1, half), F.slice(sketch, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(sketch) > F.size(other), halves).otherwise(F.col(sketch))


def _sketches(descriptions: DataFrame, members: DataFrame) -> DataFrame:
    """(id, n, sketch) of each member, stored."""
    known = descriptions.join(_small(members.select("id"), BROADCAST_KEYS), "id").select("id", "n", "sketch")
    return stored(known.dropDuplicates(["id"]), "sketches")


def _pruner(descriptions: DataFrame, members: DataFrame, percent: int):
    """Drops pairs whose parities differ in more places than the sets of linked lines may, and
    adds the number of places as ``distance``."""
    known = _sketches(descriptions, members)
    return lambda pairs: _near(pairs, known, percent)


def _near(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sketches may link, with their ``distance``."""
    one = known.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    two = known.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
    differ = F.aggregate(F.zip_with(_folded("ka", "kb"), _folded("kb", "ka"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    near = pairs.join(one, "a").join(two, "b").withColumn("distance", differ)
    return near.filter(_alike(F.col("na"), F.col("nb"), F.col("distance"), percent)).drop("na", "nb", "ka", "kb")


def _spared(total: Column) -> Column:
    """Places spared for colliding hashes: one, and twice as many as two sets are expected to have."""
    return 1 + F.floor(total.cast("double") * total / 2.0**32)


def _alike(na: Column, nb: Column, distance: Column, percent: int) -> Column:
    """Sizes, and the places in which parities differ, are such as two linked lines may have."""
    total = na + nb
    need = F.ceil(F.lit(percent) * total / F.lit(100 + percent))
    sizes = 100 * F.least(na, nb) >= percent * F.greatest(na, nb) - 100 * _spared(total)
    return sizes & (distance <= total - 2 * need + _spared(total))


def _short_sketch() -> list[Column]:
    """The sketch folded to ``SKETCH_BITS`` buckets, a column for each word: folding parities never
    adds a place, so a pair that the short sketches part is parted by the whole ones."""
    words = SKETCH_BITS // 64

    def word(w: int) -> Column:
        same = F.filter("sketch", lambda _, i: i % words == w)
        return F.aggregate(same, F.lit(0).cast("long"), lambda s, v: s.bitwiseXOR(v))

    return [word(w).alias(f"s{w}") for w in range(words)]


def _may_match(percent: int):
    """Sizes and short sketches allow a link; asked where keys meet, before a pair moves."""

    def passes(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
        differ = [F.bit_count(a(f"s{w}").bitwiseXOR(b(f"s{w}"))) for w in range(SKETCH_BITS // 64)]
        return _alike(a("n"), b("n"), sum(differ[1:], differ[0]), percent)

    return passes


def _verifier(documents: DataFrame, places: DataFrame, percent: int):
    """Keeps the pairs (a, b) of lines whose shingle sets reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            while done < batch.num_rows:
                one, two, size = [], [], 0
                while done + len(one) < batch.num_rows and size < CHUNK:
                    one.append(normal(batch.column("ta")[done + len(one)].as_py()))
                    two.append(normal(batch.column("tb")[done + len(two)].as_py()))
                    size += len(one[-1]) + len(two[-1])
                keep = []
                for x, y in zip(exact_sets(one), exact_sets(two), strict=True):
                    both = np.concatenate([x, y])
                    both.sort()
                    common = np.count_nonzero(both[1:] == both[:-1])
                    keep.append(100 * common >= percent * (len(x) + len(y) - common))
                yield batch.select(["a", "b"]).slice(done, len(keep)).filter(pa.array(keep, pa.bool_()))
                done += len(keep)

    def verified(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        at = places.join(ids, "id").groupBy(KEY).agg(F.collect_list(F.struct("id", "line_no")).alias("wanted"))  # no more than a document's own lines
        wanted = _small(stored(at, "wanted"), BROADCAST_LINES)
        # the generator keeps the split out of the loop over the wanted lines: a text is split once
        parted = documents.join(wanted, KEY).select(F.inline(F.array(F.struct(F.split("text", "\n").alias("parts"), "wanted"))))
        texts = parted.select(F.inline(F.transform("wanted", lambda w: F.struct(w["id"].alias("id"), F.get("parts", w["line_no"]).alias("line")))))
        texts = stored(texts, "texts")
        both = pairs.join(texts.select(F.col("id").alias("b"), F.col("line").alias("tb")), "b").join(texts.select(F.col("id").alias("a"), F.col("line").alias("ta")), "a")
        links = stored(both.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long").distinct(), "links")
        discard(texts)
        return links

    return verified


def _met(descriptions: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of lines that share a key and may link, and (key, gid) of lines in larger groups."""
    return meet(descriptions, percent, LISTED)


def dedup_lines(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text, n_lines, n_kept): every document with only the lines that stay.

    Lines end at \\n. Two lines are alike where their sets of 5 characters (blanks joined, case
    folded) have a Jaccard similarity of ``percent`` / 100 or more; of the lines connected that
    way only the first by (doc_id, line) stays, blank lines always do. Candidates come from
    bands, so a pair at the threshold is met with a chance of 0.998. A NULL text stays NULL with
    no lines; equal rows (id and text) are one document and get the same result; other columns
    are ignored.
    """
    rows = documents.select("doc_id", "text", row_key().alias(KEY))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {KEY} long, line_no int, id long, n int, bands array<long>, sketch array<long>"
    every = stored(rows.mapInArrow(_describe, schema), "described")
    lines = stored(every.select("doc_id", KEY, "line_no", "id"), "lines")
    first = F.min(F.struct("doc_id", KEY, "line_no")).alias("place")
    classes = stored(lines.groupBy("id").agg(first, F.count("*").alias("c")), "classes")
    descriptions = every.filter("n is not null").select("id", "n", "bands", "sketch")
    listed, crowded = _met(descriptions, percent)
    verified = _verifier(rows, classes.select(f"place.{KEY}", "place.line_no", "id"), percent)
    links = verified(stored(listed, "pairs"))
    crowded = stored(crowded, "crowded")
    grouped = stored(crowded.select(F.col("gid").alias("id")).distinct(), "grouped")
    known = _sketches(descriptions, grouped)
    discard(every)
    ends = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
    members = stored(grouped.unionByName(ends).distinct().withColumn("gid", F.col("id")), "members")
    postings = crowded.join(known.select(F.col("id").alias("gid"), "n", *_short_sketch()), "gid").withColumn("band", F.lit(0))
    labels = link(postings, members, _may_match(percent), lambda pairs: _near(pairs, known, percent), verified, links=links)
    # of a line that occurs once and has no link nothing is dropped
    labelled = classes.join(_small(labels, BROADCAST_LINES), "id", "left").filter("c > 1 or label is not null")
    labelled = stored(labelled.select("id", "c", "place", F.coalesce("label", "id").alias("label")), "labelled")
    kept_at = labelled.join(labelled.groupBy("label").agg(F.min("place").alias("keep")), "label")
    losing = stored(
        kept_at.filter((F.col("c") > 1) | (F.col("place") != F.col("keep"))).select("id", F.col(f"keep.{KEY}").alias("kk"), F.col("keep.line_no").alias("kn")), "keepers"
    )
    dropped = (
        lines.select(KEY, "line_no", "id")
        .join(_small(losing, BROADCAST_LINES), "id")
        .filter((F.col(KEY) != F.col("kk")) | (F.col("line_no") != F.col("kn")))
        .groupBy(KEY)
        .agg(F.collect_set("line_no").alias("gone"))  # no more than the document's own lines
    )
    dropped = stored(dropped, "dropped")
    if (dropped.agg(F.sum(F.size("gone")).alias("n")).first()["n"] or 0) <= BROADCAST_DROPPED:
        dropped = F.broadcast(dropped)
    parts = F.split("text", "\n")
    # a document that loses nothing is not put together again
    stay = F.when(F.col("gone").isNotNull(), F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "gone")))
    built = rows.join(dropped, KEY, "left").select("doc_id", "text", F.inline(F.array(F.struct(parts.alias("parts"), stay.alias("stay")))))
    text = F.array_join(F.transform("stay", lambda i: F.get("parts", i)), "\n")
    return built.select(
        "doc_id",
        F.when(F.col("stay").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("parts")).cast("long").alias("n_lines"),
        F.when(F.col("text").isNull(), 0).otherwise(F.coalesce(F.when(F.col("stay").isNotNull(), F.size("stay")), F.size("parts"))).cast("long").alias("n_kept"),
    )
