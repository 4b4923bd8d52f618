"""Exact Jaccard self-join on word shingles by a grouped prefix join.

Every document is a set of hashed word shingles. Sets are ordered by how frequent a shingle is
(by counts over hash buckets, so that the order table is small whatever the vocabulary) and two
sets can only reach the threshold if their prefixes share a shingle. Documents with the same set
collapse to one; those with the same prefix and size form one group. Group pairs from shared
prefix shingles pass a size and a positional bound, are expanded to members, pass a bound on the
symmetric difference (parities of hash buckets, which never differ in more places than the sets
do) and are verified on the full sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge.llm.components import link
from fieldgauge.llm.tables import stored

WORDS, PERCENT = 4, 85
#: Hash buckets of the frequency table (8 bytes each on the driver and in every task).
FREQUENCY_BUCKETS = 1 << 18
SKETCH_BITS = 1024
#: Ids that may be broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 500_000
_PRIME, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle.

    ``bytes.lower`` changes A to Z only and ``bytes.split`` cuts at blank and 0x09 to 0x0D only.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    size = min(words, len(found))
    code = np.full(len(found) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        code = _mixed(code * _PRIME + hashed[i : len(found) - size + 1 + i])
    return np.unique(code)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


def bucket_frequencies(documents: DataFrame, words: int, buckets: int) -> np.ndarray:
    """How many shingles fall in each bucket, a shingle once for each document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                np.add.at(sums, _bucket(shingle_set(text.as_py(), words), buckets), 1)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["bucket", "n"])

    summed = documents.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row for each bucket
    table = np.zeros(buckets, dtype=np.int64)
    table[summed["bucket"].to_numpy()] = summed["n"].to_numpy()
    return table


def profiles(documents: DataFrame, words: int, percent: int, frequencies: np.ndarray) -> DataFrame:
    """Per document the set size n, a 128-bit digest of the set (s1, s2), its rarest shingles
    (prefix), a digest of those (p) and the parities of the set (sketch)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, prefixes, digests, sketches = [], [], [], [], [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), words)
                n = len(found)
                digest = xxhash.xxh3_128_digest(found.tobytes())
                order = np.lexsort((found, frequencies[_bucket(found, len(frequencies))]))
                prefix = found[order[: n - -(-percent * n // 100) + 1 if n else 0]]
                odd = np.bincount((found >> np.uint64(54)).astype(np.int64), minlength=SKETCH_BITS) & 1
                sizes.append(n)
                first.append(int.from_bytes(digest[:8], "big", signed=True))
                second.append(int.from_bytes(digest[8:], "big", signed=True))
                prefixes.append(prefix.view(np.int64))
                digests.append(xxhash.xxh3_64_intdigest(prefix.tobytes()) - 2**63)
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            columns = [
                batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(digests, pa.int64()),
                pa.array(prefixes, pa.list_(pa.int64())), pa.array(sketches, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "s1", "s2", "p", "prefix", "sketch"])

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(describe, "doc_id long, n int, s1 long, s2 long, p long, prefix array<long>, sketch array<long>")


def _may_match(percent: int):
    """Size bound, and positional bound from one shared prefix shingle."""

    def passes(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
        need = F.ceil(F.lit(percent) * (a("n") + b("n")) / F.lit(100 + percent))
        rest = 1 + F.least(a("n") - a("pos"), b("n") - b("pos")) - 1
        return (100 * F.least(a("n"), b("n")) >= percent * F.greatest(a("n"), b("n"))) & (rest >= need)

    return passes


def _pruner(profiled: DataFrame, percent: int):
    """Drops pairs whose parities differ in more places than the sets of a linked pair may, and
    adds the number of places as ``distance``."""
    one = profiled.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    two = profiled.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))

    def pruned(pairs: DataFrame) -> DataFrame:
        differ = F.aggregate(F.zip_with("ka", "kb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
        total = F.col("na") + F.col("nb")
        need = F.ceil(F.lit(percent) * total / F.lit(100 + percent))
        near = pairs.join(one, "a").join(two, "b").withColumn("distance", differ).filter(F.col("distance") <= total - 2 * need)
        return near.drop("na", "nb", "ka", "kb")

    return pruned


def _verifier(documents: DataFrame, words: int, percent: int):
    """Keeps the pairs (a, b) whose full sets reach the threshold. Texts move, not sets: they are
    a third of the size."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist(), strict=True):
                if x != last or last_set is None:
                    last, last_set = x, shingle_set(x, words)
                other = shingle_set(y, words)
                common = len(np.intersect1d(last_set, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(last_set) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verified(pairs: DataFrame) -> DataFrame:
        ids = stored(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
        few = ids.count() <= BROADCAST_IDS
        texts = documents.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids) if few else ids, "id")
        both = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        return both.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long").distinct()

    return verified


def similar_documents(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, buckets: int = FREQUENCY_BUCKETS) -> DataFrame:
    """(doc_id, n_shingles, component_id): the least id reachable by links, itself included.

    Two documents link where their shingle sets have a Jaccard similarity of ``percent`` / 100 or
    more, compared in whole numbers on whole texts (shingles as 64-bit hashes). A NULL, empty or
    wordless text has no shingles and is linked with nothing. Rows that share an id are one node;
    a NULL id has no component; other columns are ignored; an empty table gives no rows.
    """
    table = bucket_frequencies(documents, words, buckets)
    every = stored(profiles(documents, words, percent, table), "profiles")
    full = every.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = stored(full.groupBy("n", "s1", "s2", "p").agg(F.min("doc_id").alias("id")), "classes")
    groups = classes.groupBy("n", "p").agg(F.min("id").alias("gid"))
    members = stored(classes.join(groups, ["n", "p"]).select("gid", "id").distinct(), "members")
    leaders = members.select(F.col("gid").alias("doc_id")).distinct()
    leaders = F.broadcast(leaders) if leaders.count() <= BROADCAST_IDS else leaders
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent))).cast("int")
    leading = full.join(leaders, "doc_id", "left_semi")
    shared = leading.select(F.explode("prefix").alias("key")).groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    placed = leading.select(F.col("doc_id").alias("gid"), "n", band.alias("band"), F.posexplode("prefix").alias("pos", "key"))
    postings = stored(placed.join(shared, "key"), "postings")
    labels = link(postings, members, _may_match(percent), _pruner(full, percent), _verifier(documents, words, percent))
    named = classes.join(labels, "id").select("n", "s1", "s2", "label").groupBy("n", "s1", "s2").agg(F.min("label").alias("label"))
    joined = every.select("doc_id", "n", "s1", "s2").join(named, ["n", "s1", "s2"], "left")
    return joined.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"))
