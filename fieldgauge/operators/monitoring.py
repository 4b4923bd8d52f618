"""Profiles of logged predictions per window, and drift against a baseline or the day before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge import schemas
from fieldgauge.operators.descriptive import moments
from fieldgauge.operators.groups import with_group_stats
from fieldgauge.operators.quantiles import (
    QUARTILES,
    cumulated,
    distinct_values,
    exact_quantiles,
    long_values,
    value_counts,
)

# Columns and window length the monitor is set up with.
TIME, MODEL, PREDICTION, WINDOW_LENGTH = "timestamp_ms", "model_id", schemas.LABEL, "1 day"
START = "window_start"
KEYS = [START, MODEL]
SHARE_FLOOR = 1e-4


def prepare_baseline(features: DataFrame, label: str = schemas.LABEL) -> DataFrame:
    """Feature table plus ``model_id`` 0, with the label as a double."""
    return features.withColumns(
        {MODEL: F.lit(0).cast("int"), label: F.col(label).cast("double")}
    )


def with_window(log: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Tag each logged row with the start of its window."""
    return log.withColumn(START, F.window(TIME, length)["start"])


def window_profile(
    log: DataFrame,
    columns: list[str],
    length: str = WINDOW_LENGTH,
) -> DataFrame:
    """Per window, model and column: counts, distinct values, extremes, moments and quartiles."""
    keyed = with_window(log, length)
    basic = moments(keyed, columns, KEYS)
    group = [*KEYS, "column"]
    joined = with_group_stats(basic, exact_quantiles(keyed, columns, KEYS).drop("n"), group, how="left")
    joined = with_group_stats(joined, distinct_values(keyed, columns, KEYS), group, how="left")
    return joined.select(
        *KEYS, "column", "n", "nulls", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        "mean", "std", "min", *QUARTILES, "max",
    )


def prediction_share(log: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Per window and model: rows and share of each predicted class."""
    label = F.col(PREDICTION).cast("int").alias(PREDICTION)
    counted = with_window(log, length).groupBy(*KEYS, label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*KEYS))
    return counted.withColumn("share", F.col("n").cast("double") / total.cast("double"))


def shared_columns(baseline: DataFrame, log: DataFrame, columns: list[str]) -> list[str]:
    """The columns both tables have; only these can be compared."""
    return [c for c in columns if c in baseline.columns and c in log.columns]


def mean_drift(
    baseline: DataFrame, log: DataFrame, columns: list[str], length: str = WINDOW_LENGTH
) -> DataFrame:
    """Per window, model and column: mean next to the baseline mean, and their difference."""
    columns = shared_columns(baseline, log, columns)
    reference = moments(baseline, columns).select(
        "column", F.col("mean").alias("baseline_mean"), F.col("std").alias("baseline_std")
    )
    current = moments(with_window(log, length), columns, KEYS)
    # the baseline side holds one row per listed column
    return current.join(F.broadcast(reference), "column").select(
        *KEYS, "column", "n", "mean", "baseline_mean", (F.col("mean") - F.col("baseline_mean")).alias("mean_delta"),
        (F.col("std") - F.col("baseline_std")).alias("std_delta"),
    )


def _fraction(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def ks_drift(
    baseline: DataFrame,
    log: DataFrame,
    columns: list[str],
    length: str = WINDOW_LENGTH,
) -> DataFrame:
    """Per window, model and column: two-sample Kolmogorov-Smirnov statistic.

    The distance of two step functions is largest at, or just before, a value of the window,
    because the baseline rises steadily between two of them. So the baseline distribution is
    evaluated once, at every value seen anywhere, and joined by value: it is not repeated for
    each window.
    """
    columns = shared_columns(baseline, log, columns)
    keyed = with_window(log, length)
    counts = value_counts(keyed, columns, KEYS)

    seen = value_counts(baseline, columns, []).unionByName(
        counts.select("column", "value", F.lit(0).cast("bigint").alias("n"))
    )
    merged = seen.groupBy("column", "value").agg(F.sum("n").alias("b"))
    reference = cumulated(merged, {"b_upto": "b"}, []).select(
        "column",
        "value",
        _fraction(F.col("b_upto"), F.col("total_b_upto")).alias("b_at"),
        _fraction(F.col("b_upto") - F.col("b"), F.col("total_b_upto")).alias("b_before"),
    )
    current = cumulated(counts, {"upto": "n"}, KEYS)
    at = _fraction(F.col("upto"), F.col("total_upto"))
    before = _fraction(F.col("upto") - F.col("n"), F.col("total_upto"))
    gap = F.greatest(F.abs(at - F.col("b_at")), F.abs(before - F.col("b_before")))
    return (
        current.join(reference, ["column", "value"])
        .groupBy(*KEYS, "column")
        .agg(F.sum("n").alias("n"), F.max(gap).alias("ks"))
    )


def psi_drift(
    baseline: DataFrame,
    log: DataFrame,
    columns: list[str],
    bins: int = 10,
    length: str = WINDOW_LENGTH,
) -> DataFrame:
    """Per window, model and column: population stability index over baseline quantile bins.

    A share below ``SHARE_FLOOR`` counts as that floor, so an empty bin stays finite.
    """
    columns = shared_columns(baseline, log, columns)
    points = {f"q{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(baseline, columns, [], points).select(
        "column", F.array(*points).alias("edges")
    )

    def shares(counts: DataFrame, keys: list[str], name: str) -> DataFrame:
        # one row of edges per listed column
        placed = counts.join(F.broadcast(edges), "column").withColumn(
            "bin", F.size(F.filter("edges", lambda e: e < F.col("value")))
        )
        per_bin = [F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)) for i in range(bins)]
        total = F.sum("n")
        return placed.groupBy(*keys, "column").agg(
            F.array(*[F.greatest(_fraction(b, total), F.lit(SHARE_FLOOR)) for b in per_bin]).alias(name),
            total.alias("n"),
        )

    # rows are placed in their bins and summed where they are: what moves is one row per group
    expected = shares(long_values(baseline, columns, []), [], "expected").drop("n")
    actual = shares(long_values(with_window(log, length), columns, KEYS), KEYS, "actual")
    terms = F.zip_with("actual", "expected", lambda a, e: (a - e) * F.log(a / e))
    return actual.join(F.broadcast(expected), "column").select(
        *KEYS, "column", "n", F.aggregate(terms, F.lit(0.0), lambda s, t: s + t).alias("psi")
    )


def class_drift(baseline: DataFrame, log: DataFrame, length: str = WINDOW_LENGTH) -> DataFrame:
    """Per window and model: total variation and two-sample chi-square of the predicted classes.

    Baseline label and prediction are compared as int. A class the window lacks adds its
    whole baseline share, which is one minus the baseline share of the classes it has.
    """
    label = F.col(PREDICTION).cast("int").alias("class")
    reference = baseline.groupBy(label).agg(F.count(F.lit(1)).cast("double").alias("b"))
    current = (
        with_window(log, length).groupBy(*KEYS, label).agg(F.count(F.lit(1)).cast("double").alias("a"))
    )
    current = current.withColumn("a_total", F.sum("a").over(Window.partitionBy(*KEYS)))
    total = reference.agg(F.sum("b")).scalar()
    joined = with_group_stats(current, reference, ["class"], how="left")
    a, b = F.col("a"), F.coalesce("b", F.lit(0.0))
    ratio = F.sqrt(total / F.col("a_total"))
    term = F.pow(a * ratio - b / ratio, F.lit(2.0)) / (a + b)
    return joined.groupBy(*KEYS).agg(
        F.sum("a").cast("bigint").alias("n"),
        (0.5 * (F.sum(F.abs(a / F.col("a_total") - b / total)) + 1 - F.sum(b / total))).alias("tv_distance"),
        (F.sum(term) + F.sum("a") * (1 - F.sum(b / total))).alias("chi_square"),
    )


def previous_window_drift(
    log: DataFrame,
    columns: list[str],
    length: str = WINDOW_LENGTH,
) -> DataFrame:
    """Per window, model and column: change of mean and KS statistic since the window before.

    Each window's value counts are also emitted as the reference of the window after it, so
    the data is doubled once, whatever the number of windows.
    """
    keyed = with_window(log, length)
    group = [*KEYS, "column"]
    in_time = Window.partitionBy(MODEL).orderBy(START)
    # one row per window and model
    following = keyed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("rows")).select(
        *KEYS, F.lead(START).over(in_time).alias("next_start")
    )
    counts = value_counts(keyed, columns, KEYS)
    as_reference = (
        with_group_stats(counts, following, KEYS)
        .where(F.col("next_start").isNotNull())
        .select(
            F.col("next_start").alias(START), MODEL, "column", "value",
            F.lit(0).cast("bigint").alias("cur"), F.col("n").alias("ref"),
        )
    )
    both = counts.select(*group, "value", F.col("n").alias("cur"), F.lit(0).cast("bigint").alias("ref"))
    merged = (
        both.unionByName(as_reference)
        .groupBy(*group, "value")
        .agg(F.sum("cur").alias("cur"), F.sum("ref").alias("ref"))
    )
    ranked = cumulated(merged, {"cur_upto": "cur", "ref_upto": "ref"}, KEYS)
    gap = F.abs(
        _fraction(F.col("cur_upto"), F.col("total_cur_upto"))
        - _fraction(F.col("ref_upto"), F.col("total_ref_upto"))
    )
    distance = ranked.groupBy(*group).agg(F.max(gap).alias("ks"))
    per_column = Window.partitionBy(MODEL, "column").orderBy(START)
    means = moments(keyed, columns, KEYS).select(
        *group,
        "n",
        F.lag(START).over(per_column).alias("previous_start"),
        (F.col("mean") - F.lag("mean").over(per_column)).alias("mean_delta"),
    )
    known = means.where(F.col("previous_start").isNotNull())
    return with_group_stats(known, distance, group, how="left")
