"""Which days of a table may hold a key: bit arrays of the stored keys, kept in a table beside it.

Every append adds, for each of its days, an array of 64-bit words: a key sets ``len(SHIFTS)`` bits of
one word. A key that is stored always finds its bits set, so the days that are not named hold none of
the keys asked for; a day named by chance costs a read and changes no result.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldgauge.operators.groups import with_group_stats

SUFFIX, WORDS, WORD, BITS, HASH = "_key_filter", "filter_words", "word", "bits", "__hash"
KEY_BITS = 16  # bits of the array for each key
SHIFTS = (34, 40, 46, 52, 58)  # where the hash names the bits; what lies below names the word
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def filter_table(name: str) -> str:
    return name + SUFFIX


def _hashes(rows: DataFrame, stored: DataFrame, keys: list[str]) -> Column:
    """Hash of the key as the table stores it: other types of a delivery are cast first, and a NULL counts."""
    typed = [F.col(k).cast(stored.schema[k].dataType) for k in keys]
    return F.xxhash64(*[x for t in typed for x in (t.isNull(), t)]).alias(HASH)


def _word() -> Column:
    return F.col(HASH).bitwiseAND(F.col(WORDS) - 1).alias(WORD)


def _mask() -> Column:
    set_bits = [f"shiftleft(1L, cast(shiftrightunsigned({HASH}, {s}) & 63 as int))" for s in SHIFTS]
    return F.expr(" | ".join(set_bits))


def key_filters(rows: DataFrame, stored: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """(word, bits, filter_words, partition): the arrays of the rows' keys, words without a bit left out.

    An array has a power of two of words that follows the number of its day's keys.
    """
    hashed = rows.select(partition, _hashes(rows, stored, keys))
    room = F.ceil(F.log2(F.greatest(F.approx_count_distinct(HASH) * KEY_BITS / 64, F.lit(1.0))))
    sizes = hashed.groupBy(partition).agg(F.pow(F.lit(2.0), F.least(room, F.lit(SHIFTS[0]))).cast("long").alias(WORDS))
    sized = with_group_stats(hashed, sizes, [partition])
    placed = sized.select(partition, WORDS, _word(), _mask().alias(BITS))
    return placed.groupBy(partition, WORDS, WORD).agg(F.bit_or(BITS).alias(BITS)).select(WORD, BITS, WORDS, partition)


def add_filters(filters: DataFrame, name: str, partition: str) -> None:
    """Append to the arrays of a table. They go before the rows they tell of, so that a job that dies
    in between leaves a day named too often, never one that is missed."""
    filters.write.mode("append").format("parquet").partitionBy(WORDS, partition).saveAsTable(filter_table(name))


def _listed(spark: SparkSession, name: str) -> list[dict[str, str]]:
    """The partitions of a table by their names in the catalog, no data read."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()  # one row a partition
    return [dict(unquote(part).split("=", 1) for part in r[0].split("/")) for r in rows]


def complete_filters(spark: SparkSession, name: str, keys: list[str], partition: str) -> None:
    """Build the arrays of stored days that have none, as those of a table older than its filters."""
    known = set()
    if spark.catalog.tableExists(filter_table(name)):
        known = {x[partition] for x in _listed(spark, filter_table(name))}
    missing = sorted({x[partition] for x in _listed(spark, name)} - known - {NO_VALUE})
    if missing:
        stored = spark.read.table(name)
        rows = stored.where(F.col(partition).cast("string").isin(missing))
        add_filters(key_filters(rows, stored, keys, partition), name, partition)


def days_that_may_hold(batch: DataFrame, name: str, keys: list[str], partition: str) -> list:
    """The stored partitions that may hold a key of the batch; what comes to the driver is one value a day."""
    spark = batch.sparkSession
    complete_filters(spark, name, keys, partition)
    if not spark.catalog.tableExists(filter_table(name)):
        return []  # only rows without a day, which are always read
    sizes = sorted({int(x[WORDS]) for x in _listed(spark, filter_table(name))})  # powers of two
    if not sizes:
        return []
    stored = spark.read.table(name)
    asked = batch.select(_hashes(batch, stored, keys)).distinct()
    asked = asked.select(HASH, F.explode(F.array(*[F.lit(x).cast("long") for x in sizes])).alias(WORDS))
    asked = asked.select(F.col(WORDS), _word(), _mask().alias("mask"))
    arrays = spark.read.table(filter_table(name)).withColumn(WORDS, F.col(WORDS).cast("long"))
    met = arrays.join(asked, [WORDS, WORD]).where(F.col(BITS).bitwiseAND(F.col("mask")) == F.col("mask"))
    return [r[0] for r in met.select(partition).distinct().collect() if r[0] is not None]
