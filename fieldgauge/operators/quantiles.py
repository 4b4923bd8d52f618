"""Exact quantiles of many columns and groups by distributed selection.

Rows are counted in cells that keep the order of the values: first by sign and binary magnitude,
then the cells that hold a wanted rank are divided again between their least and greatest value,
until each holds one value or the rows left in open cells are few and are counted by value. What is
shuffled is one row a cell and map task; values move only from the last open cells.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.operators.groups import with_group_stats
from fieldgauge.operators.ordering import running_sums
from fieldgauge.session import fresh_path

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
#: Cells to a doubling of the magnitude at first, cells an open one is divided into, and rows in
#: open cells from which on they are counted by value.
CELLS_A_DOUBLING, DIVISIONS, FINISH_ROWS = 16, 1024, 2_000_000


def doubles(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Keys plus the measured columns as doubles."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])


def value_counts(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys, column, value, n): frequency of every distinct value of every column.

    Equal values are combined before the shuffle, so a value or a group that fills a third of
    the table costs one row per map task. NULL values are left out.

    Rows are turned by ``inline``: several uses of the counts in one plan then share one
    shuffle, which the expansion behind ``unpivot`` prevents.
    """
    return long_values(df, columns, keys).groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def long_values(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """(keys, column, value, n = 1): every value that is not NULL, as ``value_counts`` without the count."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(*keys, F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    return long.withColumn("n", F.lit(1).cast("bigint"))


def cumulated(counts: DataFrame, sums: dict[str, str], keys: list[str]) -> DataFrame:
    """Running sums of count columns over the ascending values of each (keys, column)."""
    return running_sums(counts, sums, ["value"], [*keys, "column"])


def magnitude_cell(value: Column) -> Column:
    """A whole number that never falls as the value rises: 0 for 0, sign times place of the magnitude.

    Infinities and NaN, which is above all, have cells of their own.
    """
    place = F.floor((F.least(F.log2(F.abs(value)), F.lit(1100.0)) + 1200) * CELLS_A_DOUBLING).cast("long")
    return F.when(F.isnan(value), 2**40).when(value == 0, 0).when(value > 0, place).otherwise(-place)


def _wanted_ranks(probabilities: dict[str, float]) -> Column:
    """The lower rank of each probability, then the upper ones: one array, however many are asked for."""
    last = F.col("total") - 1
    low = F.transform(F.array(*[F.lit(float(p)) for p in probabilities.values()]), lambda p: F.floor(p * last))
    return F.concat(low, F.transform(low, lambda r: F.least(r + 1, last)))


def _covers(rank: Column) -> Column:
    return (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))


def _holding(cells: DataFrame, probabilities: dict[str, float]) -> DataFrame:
    return cells.where(F.exists(_wanted_ranks(probabilities), _covers))


def _kept(cells: DataFrame) -> DataFrame:
    folder = fresh_path(cells.sparkSession, "cells")
    cells.write.parquet(folder)
    return cells.sparkSession.read.schema(cells.schema).parquet(folder)


def _rows_in(long: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """Values in the cells, each with its cell; a group has a few cells, which do not overlap."""
    lists = cells.groupBy(*group).agg(F.collect_list(F.struct("low", "high", "below", "total")).alias("__cells"))
    found = F.filter("__cells", lambda c: F.col("value").between(c["low"], c["high"]))
    return with_group_stats(long, lists, group).select(*group, "value", F.inline(found))


def selected_cells(long: DataFrame, group: list[str], probabilities: dict[str, float]) -> DataFrame:
    """(group, value, n, below, total): the values at the wanted ranks, with the rows before them."""
    measures = [F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
    first = long.groupBy(*group, magnitude_cell(F.col("value")).alias("cell")).agg(*measures)
    # some thousand cells a group at most
    earlier = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = first.withColumns(
        {"below": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "total": F.sum("n").over(Window.partitionBy(*group))}
    ).drop("cell")
    cells = _kept(_holding(first, probabilities))
    while rows := cells.where("low < high").agg(F.sum("n")).first()[0]:
        inside = _rows_in(long, cells.where("low < high"), group)
        share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
        part = F.least(F.floor(share * DIVISIONS).cast("double"), F.lit(DIVISIONS - 1.0)) if rows > FINISH_ROWS else F.col("value")
        divided = inside.groupBy(*group, "total", F.col("below").alias("__base"), part.alias("cell")).agg(*measures)
        earlier = Window.partitionBy(*group, "__base").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        divided = divided.withColumn("below", F.col("__base") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        cells = _kept(_holding(divided.select(*cells.columns), probabilities).unionByName(cells.where("low = high")))
    return cells.select(*group, F.col("low").alias("value"), "n", "below", "total")


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    keys: list[str] | None = None,
    probabilities: dict[str, float] | None = None,
) -> DataFrame:
    """(keys, column, n, one column per probability), linearly interpolated. NULL is no value."""
    keys = keys or []
    probabilities = probabilities or QUARTILES
    group = [*keys, "column"]
    cells = selected_cells(long_values(df, columns, keys).drop("n"), group, probabilities)
    # a cell tells the places in the array of the ranks that it covers; a group has two a probability
    hits = F.filter(F.transform(_wanted_ranks(probabilities), lambda r, i: F.when(_covers(r), i)), lambda i: i.isNotNull())
    told = cells.select(*group, "total", "value", F.explode(hits).alias("place")).withColumnRenamed("total", "n")
    found = told.groupBy(*group, "n").agg(F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("found"))
    size = len(probabilities)
    sides = [F.col("found")[i + shift].alias(f"__{side}_{name}") for side, shift in (("low", 0), ("high", size)) for i, name in enumerate(probabilities)]
    return _interpolated(found.select(*group, "n", *sides), [*group, "n"], probabilities)


def distinct_values(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """(keys, column, n_distinct)."""
    counts = value_counts(df, columns, keys or [])
    return counts.groupBy(*(keys or []), "column").agg(F.count(F.lit(1)).alias("n_distinct"))


def _interpolated(picked: DataFrame, keep: list[str], probabilities: dict[str, float]) -> DataFrame:
    def between(name: str, p: float) -> Column:
        position = F.lit(p) * (F.col("n") - 1)
        low, high = F.col(f"__low_{name}"), F.col(f"__high_{name}")
        return low + (high - low) * (position - F.floor(position))

    return picked.select(*keep, *[between(n, p).alias(n) for n, p in probabilities.items()])


def quantiles_of_counts(
    counts: DataFrame, keys: list[str] | None = None, probabilities: dict[str, float] | None = None
) -> DataFrame:
    """``exact_quantiles``, and the number of distinct values, from the counts of distinct values.

    Ranks come from running counts over the distinct values. Each value knows the ranks it
    covers, so picking the wanted ranks is one conditional aggregation.
    """
    keys = keys or []
    probabilities = probabilities or QUARTILES
    group = [*keys, "column"]
    ranked = cumulated(counts, {"upto": "n"}, keys)

    def value_at(rank: Column) -> Column:
        covered = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(covered, F.col("value")))

    last = F.col("total_upto") - 1
    picks = []
    for name, p in probabilities.items():
        low = F.floor(F.lit(p) * last)
        picks += [
            value_at(low).alias(f"__low_{name}"),
            value_at(F.least(low + 1, last)).alias(f"__high_{name}"),
        ]
    picked = ranked.groupBy(*group).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_distinct"), *picks
    )

    return _interpolated(picked, [*group, "n", "n_distinct"], probabilities)
