"""Acceptance gates: is a candidate good enough, and better than the champion?"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Threshold:
    """Least value of a metric and, against a champion, least absolute and relative gain."""

    value: float
    min_absolute_gain: float | None = None
    min_relative_gain: float | None = None
    greater_is_better: bool = True


# Acceptance bounds without, and with, a champion.
STATIC_THRESHOLDS = {
    "accuracy": Threshold(0.10),
    "precision": Threshold(0.10),
    "recall": Threshold(0.10),
}
CHAMPION_THRESHOLDS = {"accuracy": Threshold(0.85, min_absolute_gain=0.5, min_relative_gain=0.05)}
CHAMPION, PREVIOUS = "champion", "previous"


def _checks(thresholds: dict[str, Threshold], against_champion: bool) -> dict[str, Column]:
    """Per check, a CASE over the metrics that have it; TRUE where a metric has no such bound."""
    candidate, champion = F.col("candidate"), F.col("champion")
    value_ok, absolute_ok, relative_ok = F.lit(True), F.lit(True), F.lit(True)
    for metric, bound in thresholds.items():
        mine = F.col("metric") == metric
        sign = 1.0 if bound.greater_is_better else -1.0
        gain = sign * (candidate - champion)
        value_ok = F.when(mine, sign * candidate >= sign * bound.value).otherwise(value_ok)
        if against_champion and bound.min_absolute_gain is not None:
            absolute_ok = F.when(mine, gain >= bound.min_absolute_gain).otherwise(absolute_ok)
        if against_champion and bound.min_relative_gain is not None:
            # without a base for a ratio, the candidate only has to be better
            ratio = F.when(champion == 0, gain > 0).otherwise(
                gain / F.nullif(F.abs(champion), F.lit(0.0)) >= bound.min_relative_gain
            )
            relative_ok = F.when(mine, ratio).otherwise(relative_ok)
    return {"value_ok": value_ok, "absolute_ok": absolute_ok, "relative_ok": relative_ok}


def _judge(compared: DataFrame, thresholds: dict[str, Threshold], against_champion: bool) -> DataFrame:
    checks = {n: F.coalesce(c, F.lit(False)) for n, c in _checks(thresholds, against_champion).items()}
    rows = compared.withColumns(checks)
    failed = F.array_compact(
        F.array(
            F.when(~F.col("value_ok"), "below threshold"),
            F.when(~F.col("absolute_ok"), "absolute gain too small"),
            F.when(~F.col("relative_ok"), "relative gain too small"),
        )
    )
    passed = F.col("value_ok") & F.col("absolute_ok") & F.col("relative_ok")
    return rows.select(
        "metric", "candidate", "champion", *checks, passed.alias("passed"),
        F.concat_ws("; ", failed).alias("reason"),
    )


def _required(candidate: DataFrame, thresholds: dict[str, Threshold]) -> DataFrame:
    """One row per bounded metric; a metric the candidate lacks has a NULL value and fails."""
    names = candidate.sparkSession.range(1).select(F.explode(F.lit(list(thresholds))).alias("metric"))
    values = candidate.select("metric", F.col("value").alias("candidate"))
    return names.join(values, "metric", "left")


def static_gate(candidate: DataFrame, thresholds: dict[str, Threshold] | None = None) -> DataFrame:
    """Judge (metric, value) rows against fixed bounds."""
    thresholds = thresholds or STATIC_THRESHOLDS
    compared = _required(candidate, thresholds).withColumn("champion", F.lit(None).cast("double"))
    return _judge(compared, thresholds, against_champion=False)


def champion_gate(
    candidate: DataFrame, champion: DataFrame, thresholds: dict[str, Threshold] | None = None
) -> DataFrame:
    """Judge (metric, value) rows against bounds and against the champion's rows."""
    thresholds = thresholds or CHAMPION_THRESHOLDS
    base = champion.select("metric", F.col("value").alias("champion"))
    compared = _required(candidate, thresholds).join(base, "metric", "left")
    return _judge(compared, thresholds, against_champion=True)


def gate_decision(gate: DataFrame) -> DataFrame:
    """One row: did every metric pass, and the reasons if not."""
    reasons = F.array_sort(
        F.collect_list(F.when(~F.col("passed"), F.concat_ws(": ", "metric", "reason")))
    )  # one entry per bounded metric
    return gate.agg(F.bool_and("passed").alias("passed"), F.concat_ws(", ", reasons).alias("reason"))


def promoted_aliases(aliases: DataFrame, decision: DataFrame, candidate: str) -> DataFrame:
    """(alias, model) after the decision: on success the champion becomes the previous one.

    ``aliases`` holds at most the two alias rows.
    """
    ok = F.coalesce(decision.select("passed").scalar(), F.lit(False))
    new = decision.select(F.lit(CHAMPION).alias("alias"), F.lit(candidate).alias("model")).where("passed")
    moved = aliases.where((F.col("alias") == CHAMPION) & ok).select(F.lit(PREVIOUS).alias("alias"), "model")
    had_champion = aliases.agg(F.count_if(F.col("alias") == CHAMPION) > 0).scalar()
    replaced = ok & ((F.col("alias") == CHAMPION) | ((F.col("alias") == PREVIOUS) & had_champion))
    return aliases.where(~replaced).unionByName(moved).unionByName(new)
