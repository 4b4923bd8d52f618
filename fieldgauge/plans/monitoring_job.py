"""Daily processing of logged requests, and the monitor tables over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldgauge import schemas
from fieldgauge.operators import monitoring
from fieldgauge.operators.inference_log import read_inference_log, unpack_positions
from fieldgauge.sources.requests import append_positions
from fieldgauge.sources.tables import drop_partitions, overwrite_partitions, read_table
from fieldgauge.session import fresh_path

MONITORED = [*schemas.MODEL_INPUTS, schemas.LABEL]


def process_day(
    spark: SparkSession,
    payload_table: str,
    clean_table: str,
    reject_table: str,
    as_of: dt.date | str | None = None,
) -> None:
    """Unpack one day of requests and append the requests that are not stored yet.

    The unpacked positions are stored once and both tables are cut from them.
    """
    requests = read_inference_log(read_table(spark, payload_table), as_of)
    append_positions(unpack_positions(requests, len(schemas.MODEL_INPUTS)), clean_table, reject_table)


DAY = "day"
KINDS = ("profile", "share", "mean_drift", "ks_drift", "psi_drift", "class_drift", "previous_drift")


def refresh_monitor(
    spark: SparkSession,
    clean_table: str,
    baseline_table: str,
    prefix: str,
    days: list[dt.date] | None = None,
    kinds: tuple[str, ...] = KINDS,
) -> list[str]:
    """Write profile and drift tables named ``<prefix>_<kind>``, partitioned by ``day``.

    Only the given days are computed and replaced, by default those whose rows differ, in number or
    content, from the ones that any of the tables was computed from; ``<prefix>_state`` holds the
    number of rows of a day and the sum of their hashes, which does not depend on their order, and
    is written last. A day that left the log, or has no rows of a kind any more, is emptied. A day is that of the request time; the log is read by the
    ``date`` partitions that its rows lie in. The drift since the window before is also renewed
    for the day that follows each of them.
    """
    log, baseline = read_table(spark, clean_table), read_table(spark, baseline_table)
    names = {kind: f"{prefix}_{kind}" for kind in kinds}
    seen = _logged_days(log)
    logged = sorted(seen)
    counted = f"{prefix}_state"
    known = _known_counts(spark, counted)
    gone = sorted({d for d, kind in known if d not in seen and kind in kinds and (days is None or d in days)})
    state = {d: (x[0], x[3]) for d, x in seen.items()}
    if days is None:
        days = [d for d in logged if any(known.get((d, kind)) != state[d] for kind in kinds)]
        # the day after one that is gone has another day before it now
        days += [next(later for later in logged if later > d) for d in gone if logged and d < logged[-1]]
    days = sorted(d for d in set(days) if d in seen)
    for name in [*names.values(), counted]:
        drop_partitions(spark, name, DAY, gone)
    if not days:
        return list(names.values())
    results = {
        "profile": lambda rows: monitoring.window_profile(rows, MONITORED),
        "share": lambda rows: monitoring.prediction_share(rows),
        "mean_drift": lambda rows: monitoring.mean_drift(baseline, rows, MONITORED),
        "ks_drift": lambda rows: monitoring.ks_drift(baseline, rows, MONITORED),
        "psi_drift": lambda rows: monitoring.psi_drift(baseline, rows, schemas.MODEL_INPUTS),
        "class_drift": lambda rows: monitoring.class_drift(baseline, rows),
        "previous_drift": lambda rows: monitoring.previous_window_drift(rows, MONITORED),
    }
    followed = sorted({*days, *[next(d for d in logged if d > day) for day in days if day < logged[-1]]})
    before = [d for d in logged if d < followed[0]][-1:]
    for kind, name in names.items():
        if kind == "previous_drift":
            rows, wanted = _of_days(log, seen, [*before, followed[0], followed[-1]], None), followed
        else:
            rows, wanted = _of_days(log, seen, days, days), days
        df = results[kind](rows).withColumn(DAY, F.to_date(monitoring.START))
        folder = fresh_path(spark, kind)
        df.where(F.col(DAY).isin(wanted)).write.parquet(folder)
        made = spark.read.schema(df.schema).parquet(folder)
        overwrite_partitions(made, name, DAY)
        filled = {r[DAY] for r in made.select(DAY).distinct().collect()}  # one value a day
        drop_partitions(spark, name, DAY, [d for d in wanted if d not in filled])
    fresh = {**{x: n for x, n in known.items() if x[0] in days}, **{(d, kind): state[d] for d in days for kind in kinds}}
    rows = [(kind, *n, d) for (d, kind), n in fresh.items()]
    overwrite_partitions(spark.createDataFrame(rows, f"kind string, n long, checksum decimal(38,0), {DAY} date"), counted, DAY)
    return list(names.values())


def _logged_days(log: DataFrame) -> dict[dt.date, tuple]:
    """Of each day of request time: rows, first and last ``date`` they lie in, and sum of the hashes of what is monitored."""
    at = F.to_date(monitoring.TIME).alias(DAY)
    monitored = sorted({monitoring.TIME, monitoring.MODEL, monitoring.PREDICTION, *MONITORED} & set(log.columns))
    # a NULL leaves a hash as it is, so each column says whether it is one
    hashed = F.xxhash64(*[x for c in monitored for x in (F.col(c).isNull(), F.col(c))])
    checksum = F.sum(hashed.cast("decimal(38,0)"))
    found = log.groupBy(at).agg(F.count("*").alias("n"), F.min("date").alias("low"), F.max("date").alias("high"), checksum.alias("checksum"))
    return {r[DAY]: (r["n"], r["low"], r["high"], r["checksum"]) for r in found.collect() if r[DAY]}  # one row a day


def _of_days(log: DataFrame, seen: dict, span: list[dt.date], days: list[dt.date] | None) -> DataFrame:
    """Rows of the span of days, and of the given days only: the dates they lie in pick partitions."""
    within = [seen[d] for d in seen if (d in days if days is not None else min(span) <= d <= max(span))]
    lows, highs = [x[1] for x in within if x[1]], [x[2] for x in within if x[2]]
    date = F.col("date")
    rows = log.where((date.between(min(lows), max(highs)) | date.isNull()) if lows else date.isNull())
    at = F.to_date(monitoring.TIME)
    return rows.where(at.isin(days) if days is not None else at.between(min(span), max(span)))


def _known_counts(spark: SparkSession, name: str) -> dict[tuple[dt.date, str], tuple]:
    """Rows and checksum that each table's day was computed from; one value a day and table."""
    if not spark.catalog.tableExists(name):
        return {}
    return {(r[DAY], r["kind"]): (r["n"], r["checksum"]) for r in read_table(spark, name).collect()}
