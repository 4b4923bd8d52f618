"""Importance resampling towards a target distribution over hashed features.

Features are runs of words; a feature's bucket is the CRC-32 of its bytes. The CRCs of many
features are taken together: distinct features of equal length form a matrix of bytes, one row
a feature, and all rows are advanced by one column at a time. Buckets then go back to the places
of the features. Counts of all documents and of the target give each bucket a gain, a document's
weight is its mean gain, and the sample are the documents with the highest weight plus Gumbel
noise that depends on seed and id alone, which is a draw without replacement.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldgauge.llm.batches import parts, utf8
from fieldgauge.llm.tables import stored
from fieldgauge.operators.ordering import number_rows

BUCKETS, MAX_WORDS, MIN_WORDS, DRAW_PERCENT, SEED = 10_000, 1, 20, 10, 2024
#: Distinct features a task remembers with their buckets before it starts anew.
REMEMBERED = 300_000
#: Above so many bytes a feature goes alone: a matrix of one row gains nothing.
MATRIX_BYTES = 1024
POLYNOMIAL = 0xEDB88320
#: A-Z lower-cased, other ASCII marks as blanks, everything from 0x80 on as it is.
_WORDS = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _table() -> np.ndarray:
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(POLYNOMIAL), crc >> 1)
    return crc


def crc32_of(features: list[bytes]) -> np.ndarray:
    """CRC-32 of every feature, by one byte matrix for each length."""
    table, found = _table(), np.zeros(len(features), dtype=np.uint32)
    lengths = np.fromiter(map(len, features), dtype=np.int64, count=len(features))
    order = np.argsort(lengths, kind="stable")
    firsts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for rows in np.split(order, firsts[1:]) if len(order) else []:
        width = int(lengths[rows[0]])
        if width > MATRIX_BYTES:
            found[rows] = [zlib.crc32(features[i]) for i in rows]
            continue
        matrix = np.frombuffer(b"".join([features[i] for i in rows]), dtype=np.uint8).reshape(len(rows), width)
        crc = np.full(len(rows), 0xFFFFFFFF, dtype=np.uint32)
        for column in matrix.T:
            crc = table[(crc ^ column) & 255] ^ (crc >> 8)
        found[rows] = ~crc
    return found


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def features(tokens: list[bytes], max_words: int) -> list[bytes]:
    """Runs of 1 to ``max_words`` consecutive words, joined by one space."""
    runs = list(tokens)
    for n in range(2, max_words + 1):
        runs += [b" ".join(tokens[i : i + n]) for i in range(len(tokens) - n + 1)]
    return runs


class Bucketer:
    """Buckets of features; what a task has seen before is looked up."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.known = buckets, {}

    def __call__(self, found: list[bytes]) -> np.ndarray:
        new = set(found).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, new = {}, set(found)
        distinct = list(new)
        self.known.update(zip(distinct, (crc32_of(distinct) % self.buckets).tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> DataFrame:
    """(bucket, n) of the column ``text``; a task sends one sum for each bucket it met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, total = Bucketer(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in parts(batches):
            found = [f for t in utf8(batch) for f in features(words(t), max_words)]
            total += np.bincount(bucket(found), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket in thousandths, from (bucket, n) of both; ``buckets`` sums reach the driver."""
    s, t = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    for counts, into in ((source, s), (target, t)):
        for r in counts.collect():
            into[r["bucket"]] = r["n"]
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((float(b + 1) * all_s) / (float(a + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], dtype=np.int64)


def weigh(documents: DataFrame, gain: np.ndarray, max_words: int = MAX_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of a document's features."""
    source = documents.select("doc_id", "text")
    schema = StructType([source.schema["doc_id"], *[StructField(n, LongType()) for n in ("n_words", "n_features", "weight")]])

    def weigh_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Bucketer(len(gain))
        for batch in parts(batches):
            tokens = [words(t) for t in utf8(batch)]
            found = [features(t, max_words) for t in tokens]
            n = np.array([len(f) for f in found], dtype=np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[bucket([f for one in found for f in one])])])
            ends = np.cumsum(n)
            weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
            columns = [batch.column("doc_id"), pa.array([len(t) for t in tokens], pa.int64()), pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return source.mapInArrow(weigh_batches, schema)


def gumbel(seed: int, id_column: Column) -> Column:
    """Gumbel noise in thousandths from the seed and the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = DRAW_PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of ``documents``.

    Of the N rows with at least ``min_words`` words, floor(``percent`` * N / 100) are drawn and
    ranked from 1; the others have no rank. NULL and empty texts have no features and weight 0; a
    NULL id draws its noise as an empty one and is ordered first; ties go to the smaller id, rows
    with the same id and score are drawn one by one; empty tables give no rows, an empty target
    weighs all features by their rarity; other columns are ignored.
    """
    gain = gains(bucket_counts(documents, buckets, max_words), bucket_counts(target, buckets, max_words), buckets)
    weighed = weigh(documents, gain, max_words)
    scored = stored(
        weighed.withColumns({"score": F.col("weight") + gumbel(seed, F.col("doc_id")), "__place": F.monotonically_increasing_id()}), "scored"
    ).withColumn("__down", -F.col("score"))
    # narrow rows: the texts stay behind
    ranked = number_rows(scored.filter(F.col("n_words") >= min_words), ["__down", "doc_id", "__place"], "rank")
    drawn = F.col("rank") <= F.floor(F.col("total_rank") * percent / 100)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    short = scored.filter(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, F.when(drawn, F.col("rank")).cast("long").alias("rank")).unionByName(short)
