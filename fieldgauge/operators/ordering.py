"""Order-dependent work (row numbers, running sums) without one task holding the whole order.

Rows are range-partitioned by the full order, sorted within partitions and stored once, each
with its partition and its place in it. A range partition ends anywhere in the order, whatever
the types of the columns and however many rows share leading values or NULLs; storing it fixes
the boundaries, which a recomputed sample would move. What comes before a partition is then a
sum over one row for each partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.operators.groups import matching_keys
from fieldgauge.session import fresh_path, shuffle_partitions

PART, ROW = "__part", "__row"
ROW_BITS = 33  # of monotonically_increasing_id that count rows within a partition


def ordered_parts(df: DataFrame, order_by: list[str], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned, sorted and stored, with partition (PART) and place in it (ROW).

    There are as many partitions as the session has shuffle partitions, at every size.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    parts = (
        df.repartitionByRange(partitions or shuffle_partitions(spark), *order_by)
        .sortWithinPartitions(*order_by)
        .withColumns({PART: F.shiftright(place, ROW_BITS), ROW: place.bitwiseAND(F.lit(2**ROW_BITS - 1))})
    )
    folder = fresh_path(spark, "ordered")
    parts.write.parquet(folder)
    return spark.read.schema(parts.schema).parquet(folder)


def _before(parts: DataFrame, partition: list[str], sums: dict[str, Column], extra: dict[str, Column]) -> DataFrame:
    """Sums before each part and over the whole of each ``partition``; a row for each part of it."""
    totals = parts.groupBy(*partition, PART).agg(*[c.alias(n) for n, c in {**sums, **extra}.items()])
    whole = Window.partitionBy(*partition)
    earlier = whole.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *[F.col(c).alias(f"__b_{c}") for c in [*partition, PART]],
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"__before_{n}") for n in sums],
        *[F.sum(n).over(whole).alias(f"total_{n}") for n in sums],
        *[F.col(n).alias(f"__b_{n}") for n in extra],
    )


def _joined(parts: DataFrame, before: DataFrame, partition: list[str]) -> DataFrame:
    return parts.join(before, matching_keys(parts, [*partition, PART], "__b_"))


def running_sums(
    df: DataFrame,
    sums: dict[str, str],
    order_by: list[str],
    partition: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums ``{name: column}`` over ``order_by`` within ``partition``.

    Each sum ``x`` comes with ``total_x``, its total over the partition.
    """
    partition = partition or []
    parts = ordered_parts(df, [*partition, *order_by], partitions)
    before = _before(parts, partition, {n: F.sum(c) for n, c in sums.items()}, {})
    inside = Window.partitionBy(*partition, PART).orderBy(ROW).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = _joined(parts, before, partition).withColumns(
        {n: F.col(f"__before_{n}") + F.sum(c).over(inside) for n, c in sums.items()}
    )
    return summed.drop(PART, ROW, *[f"__b_{c}" for c in [*partition, PART]], *[f"__before_{n}" for n in sums])


def number_rows(
    df: DataFrame,
    order_by: list[str],
    name: str,
    partition: list[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """1..n in the order of ``order_by`` (together unique) within ``partition``, as a global
    row_number gives, and the count of the partition as ``total_<name>``.

    A row's number is its stored place plus the rows before its part: nothing is sorted twice.
    """
    partition = partition or []
    parts = ordered_parts(df, [*partition, *order_by], partitions)
    before = _before(parts, partition, {name: F.count(F.lit(1))}, {"first": F.min(ROW)})
    number = F.col(ROW) - F.col("__b_first") + 1 + F.col(f"__before_{name}")
    numbered = _joined(parts, before, partition).withColumn(name, number)
    return numbered.drop(PART, ROW, "__b_first", f"__before_{name}", *[f"__b_{c}" for c in [*partition, PART]])
