"""The numbers behind exploratory statistics and plots, as DataFrames."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.operators.groups import with_group_stats
from fieldgauge.operators.quantiles import (
    QUARTILES,
    doubles,
    exact_quantiles,
    long_values,
    value_counts,
)

APPROX_ACCURACY = 100_000
LISTED_BINS, COUNTED_BINS = 10_000, 2**53


def long_rows(wide: DataFrame, keys: list[str], columns: list[str], measures: list[str]) -> DataFrame:
    """Turn columns named ``<measure>__<column>`` into one row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{m}__{c}").alias(m) for m in measures])
        for c in columns
    ]
    return wide.select(*keys, F.inline(F.array(*entries)))


def moments(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Count, nulls, mean, sample deviation, min and max of every column, in one aggregation."""
    keys = keys or []
    measures = {
        "n": lambda c: F.count(c),
        "nulls": lambda c: F.count(F.lit(1)) - F.count(c),
        "mean": lambda c: F.avg(c),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
    }
    wide = (
        doubles(df, columns, keys)
        .groupBy(*keys)
        .agg(*[f(F.col(c)).alias(f"{m}__{c}") for c in columns for m, f in measures.items()])
    )
    return long_rows(wide, keys, columns, list(measures))


def describe_numeric(
    df: DataFrame, columns: list[str], quartiles: str = "exact"
) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per column.

    ``quartiles="approx"`` reads the table once and sketches the quartiles instead.
    """
    basic = moments(df, columns)
    if quartiles == "exact":
        quartile_rows = exact_quantiles(df, columns).select("column", *QUARTILES)
    else:
        points = F.array(*[F.lit(p) for p in QUARTILES.values()])
        wide = doubles(df, columns, []).agg(
            *[F.percentile_approx(c, points, F.lit(APPROX_ACCURACY)).alias(f"q__{c}") for c in columns]
        )
        quartile_rows = long_rows(wide, [], columns, ["q"]).select(
            "column", *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(QUARTILES)]
        )
    # both sides hold one row per listed column
    return basic.join(F.broadcast(quartile_rows), "column", "left").select(
        "column", F.col("n").alias("count"), "mean", "std", "min", *QUARTILES, "max"
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Type, non-null count and table length for every column."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(c)).alias(f"n__{c}") for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"n__{f.name}").alias("non_null"),
            F.col("rows").alias("rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return wide.select(F.inline(F.array(*entries)))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def histogram_by_class(df: DataFrame, column: str, label: str, bins: int | str = "auto") -> DataFrame:
    """(label, bin, left, right, n) over equal-width bins shared by all classes.

    ``"auto"`` takes the narrower of the Sturges and Freedman-Diaconis widths, the rule that
    numpy publishes under that name. The top edge belongs to the last bin. Bins without rows are
    listed up to ``LISTED_BINS`` bins; a far outlier can ask for more, of which only those with rows
    are returned. NULL and NaN are in no bin; an infinite value is an error.
    """
    data = doubles(df, [column], [label]).where(F.col(column).isNotNull() & ~F.isnan(column))
    # one row reaches the driver, so that the plan holds numbers and not a subquery at each use
    limits = data.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(F.lit(1)).alias("n")).first()
    low, high, n = limits["low"], limits["high"], limits["n"]
    if not n:
        return data.select(label, *[F.lit(None).cast(t).alias(c) for c, t in (("bin", "long"), ("left", "double"), ("right", "double"), ("n", "long"))])
    if not (math.isfinite(low) and math.isfinite(high) and math.isfinite(high - low)):
        raise ValueError(f"{column!r} reaches from {low} to {high}: equal bins need a finite range")
    low, span = (low - 0.5, 1.0) if low == high else (low, high - low)
    n_bins = bins
    if bins == "auto":
        quartiles = exact_quantiles(data, [column]).first()
        widths = [span / (math.log2(n) + 1), 2 * (quartiles["p75"] - quartiles["p25"]) / n ** (1 / 3)]
        n_bins = math.ceil(span / min(w for w in widths if w > 0))
    if n_bins > COUNTED_BINS:
        raise ValueError(f"{column!r} from {low} to {low + span} asks for {n_bins} bins, more than doubles can tell apart")
    place = F.floor(F.lit(float(n_bins)) * (F.col(column) - low) / span)
    counted = data.select(label, F.least(place, F.lit(n_bins - 1)).alias("bin")).groupBy(label, "bin").agg(F.count(F.lit(1)).alias("n"))
    if n_bins <= LISTED_BINS:
        # every class has every bin, as every cell of a confusion matrix is shown
        every = counted.select(label).distinct().select(F.col(label).alias("__class"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_bins - 1).cast("long"))).alias("__bin"))
        same = F.col(label).eqNullSafe(F.col("__class")) & (F.col("bin") == F.col("__bin"))
        counted = every.join(counted, same, "left").select(
            F.col("__class").alias(label), F.col("__bin").alias("bin"), F.coalesce("n", F.lit(0)).alias("n")
        )
    edge = lambda i: F.lit(low) + F.lit(span) * i / F.lit(float(n_bins))
    return counted.select(
        label, "bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"), "n"
    )


def density_by_class(
    df: DataFrame, columns: list[str], label: str, grid: int = 200, cut: float = 3.0
) -> DataFrame:
    """(column, label, point, x, density, scaled_density): Gaussian kernel density per class.

    The bandwidth is Scott's rule, n**(-1/5) * sample deviation. Each class has its own grid,
    reaching ``cut`` bandwidths past its extremes, and ``scaled_density`` weights a class by
    its share of the rows. A class without spread has no density.

    Equal values are merged first. Every distinct value then adds its kernel to each grid
    point; these sums are combined before the shuffle, which moves classes x grid rows.
    """
    group = ["column", label]
    n = F.col("n").cast("double")
    bandwidth = F.col("std") * F.pow(n, F.lit(-0.2))
    stats = moments(df, columns, [label])
    total = F.sum("n").over(Window.partitionBy("column")).cast("double")
    stats = (
        stats.withColumn("total", total)
        .where(F.col("std") > 0)
        .select(*group, n.alias("size"), "total", bandwidth.alias("bw"), "min", "max")
        .withColumn("start", F.col("min") - cut * F.col("bw"))
        .withColumn("step", (F.col("max") + cut * F.col("bw") - F.col("start")) / (grid - 1))
        .drop("min", "max")
    )
    spread = with_group_stats(value_counts(df, columns, [label]), stats, group)
    points = spread.select(
        *group, "value", "n", "bw", "start", "step",
        F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"),
    )
    x = F.col("start") + F.col("point") * F.col("step")
    distance = (x - F.col("value")) / F.col("bw")
    sums = points.groupBy(*group, "point").agg(
        F.sum(F.col("n") * F.exp(-0.5 * distance * distance)).alias("mass")
    )
    kernel = F.col("mass") / (F.col("bw") * F.lit(math.sqrt(2 * math.pi)))
    return with_group_stats(sums, stats, group).select(
        *group,
        "point",
        x.alias("x"),
        (kernel / F.col("size")).alias("density"),
        (kernel / F.col("total")).alias("scaled_density"),
    )


def box_stats(
    df: DataFrame,
    columns: list[str],
    label: str,
    reach: float = 1.5,
) -> DataFrame:
    """(column, label, n, q1, median, q3, whisker_low, whisker_high, outliers) per class.

    Whiskers end at the last value within ``reach`` interquartile ranges of the box.
    """
    group = ["column", label]
    boxes = exact_quantiles(df, columns, [label]).select(
        *group, F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3")
    )
    margin = reach * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - margin, F.col("q3") + margin)
    # rows are judged where they are; a row for each group and map task moves
    joined = with_group_stats(long_values(df, columns, [label]), boxes, group)
    return (
        joined.groupBy(*group)
        .agg(
            F.sum("n").alias("n"),
            *[F.max(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col("value"))).alias("low"),
            F.max(F.when(inside, F.col("value"))).alias("high"),
            F.sum(F.when(inside, F.lit(0)).otherwise(F.col("n"))).alias("outliers"),
        )
        .select(
            *group, "n", "q1", "median", "q3",
            F.least("low", "q1").alias("whisker_low"),
            F.greatest("high", "q3").alias("whisker_high"),
            "outliers",
        )
    )


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_a, column_b, r): the Pearson matrix in long form, from one aggregation.

    A pair uses the rows where both columns are present.
    """
    names = {}
    for i, a in enumerate(columns):
        for b in columns[i:]:
            names[(a, b)] = names[(b, a)] = f"r__{a}__{b}"
    wide = doubles(df, columns, []).agg(
        *[F.corr(a, b).alias(names[(a, b)]) for i, a in enumerate(columns) for b in columns[i:]]
    )
    entries = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(names[(a, b)]).alias("r"))
        for a in columns
        for b in columns
    ]
    return wide.select(F.inline(F.array(*entries)))


def first_rows(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """The first rows in a declared order."""
    return df.orderBy(*order_by).limit(n)
