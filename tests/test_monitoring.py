import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldgauge import schemas
from fieldgauge.operators import monitoring

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    draw = np.random.default_rng(5)
    base = [(float(round(x, 1)), int(x > 21)) for x in draw.normal(21, 1, 300)] + [(21.0, 0)] * 150
    log = []
    for day in (0, 1, 3):
        for i, x in enumerate(draw.normal(21 + 0.3 * day, 1.2, 200 + 50 * day)):
            value = 20.0 if i % 3 == 0 else float(round(x, 1))
            log.append((DAY + dt.timedelta(days=day, minutes=i), i % 2, value, int(value > 21) + (2 if day == 3 and i % 50 == 0 else 0)))
    baseline = spark.createDataFrame(base, "Temperature double, Occupancy int")
    logged = spark.createDataFrame(log, "timestamp_ms timestamp, model_id int, Temperature double, Occupancy int")
    return base, log, monitoring.prepare_baseline(baseline), logged


def group(log, day, model):
    return [r for r in log if r[0].date() == (DAY + dt.timedelta(days=day)).date() and r[1] == model]


def ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(np.mean(np.array(a) <= p) - np.mean(np.array(b) <= p)) for p in points)


def by_key(df):
    return {(r["window_start"].date(), r["model_id"]): r for r in df.collect()}


def keys(log):
    return [(day, model) for day in (0, 1, 3) for model in (0, 1)]


def test_baseline_types(tables):
    types = dict(tables[2].dtypes)
    assert types["Occupancy"] == "double" and types["model_id"] == "int"


def test_ks_against_baseline(tables):
    base, log, baseline, logged = tables
    got = by_key(monitoring.ks_drift(baseline, logged, ["Temperature", "Humidity"]))
    for day, model in keys(log):
        sample = [r[2] for r in group(log, day, model)]
        row = got[((DAY + dt.timedelta(days=day)).date(), model)]
        assert row["n"] == len(sample)
        assert row["ks"] == pytest.approx(ks(sample, [r[0] for r in base]), abs=1e-12)


def test_change_since_previous_window_skips_gaps(tables):
    _, log, _, logged = tables
    got = by_key(monitoring.previous_window_drift(logged, ["Temperature"]))
    assert len(got) == 4
    for (before, day), model in [((0, 1), 0), ((0, 1), 1), ((1, 3), 0), ((1, 3), 1)]:
        new, old = ([r[2] for r in group(log, d, model)] for d in (day, before))
        row = got[((DAY + dt.timedelta(days=day)).date(), model)]
        assert row["previous_start"].date() == (DAY + dt.timedelta(days=before)).date()
        assert row["ks"] == pytest.approx(ks(new, old), abs=1e-12)
        assert row["mean_delta"] == pytest.approx(np.mean(new) - np.mean(old))


def test_stability_index(tables):
    base, log, baseline, logged = tables
    got = by_key(monitoring.psi_drift(baseline, logged, ["Temperature"], bins=4))
    reference = [r[0] for r in base]
    edges = np.quantile(reference, [0.25, 0.5, 0.75])

    def shares(values):
        bins = np.searchsorted(edges, values, side="left")
        return [max(np.mean(bins == i), monitoring.SHARE_FLOOR) for i in range(4)]

    for day, model in keys(log):
        sample = [r[2] for r in group(log, day, model)]
        want = sum((a - e) * math.log(a / e) for a, e in zip(shares(sample), shares(reference)))
        assert got[((DAY + dt.timedelta(days=day)).date(), model)]["psi"] == pytest.approx(want)


def test_class_drift_with_a_class_the_baseline_lacks(tables):
    base, log, baseline, logged = tables
    got = by_key(monitoring.class_drift(baseline, logged))
    for day, model in keys(log):
        sample, reference = [r[3] for r in group(log, day, model)], [r[1] for r in base]
        row, n, m = got[((DAY + dt.timedelta(days=day)).date(), model)], len(sample), len(reference)
        classes = set(sample) | set(reference)
        tv = 0.5 * sum(abs(sample.count(c) / n - reference.count(c) / m) for c in classes)
        chi = sum(
            (sample.count(c) * math.sqrt(m / n) - reference.count(c) * math.sqrt(n / m)) ** 2
            / (sample.count(c) + reference.count(c))
            for c in classes
        )
        assert row["tv_distance"] == pytest.approx(tv) and row["chi_square"] == pytest.approx(chi)


def test_profile(tables):
    _, log, _, logged = tables
    got = by_key(monitoring.window_profile(logged.withColumn("Light", F.lit(None).cast("double")), ["Temperature"]))
    sample = [r[2] for r in group(log, 1, 1)]
    row = got[((DAY + dt.timedelta(days=1)).date(), 1)]
    assert (row["n"], row["n_distinct"]) == (len(sample), len(set(sample)))
    assert row["p75"] == pytest.approx(np.quantile(sample, 0.75))


def test_column_of_nulls_keeps_its_profile_row(tables):
    logged = tables[3].withColumn("Light", F.lit(None).cast("double"))
    found = monitoring.window_profile(logged, ["Light"]).collect()
    assert len(found) == 6 and all((r["n"], r["n_distinct"], r["p50"]) == (0, 0, None) for r in found)
    assert all(r["nulls"] > 0 for r in found)


def test_mean_drift_uses_common_columns_only(tables):
    _, _, baseline, logged = tables
    drift = monitoring.mean_drift(baseline, logged, schemas.SENSOR_COLUMNS)
    assert {r["column"] for r in drift.collect()} == {"Temperature"}


def test_late_rows_and_missing_tables_are_computed(spark):
    import datetime as dt

    from fieldgauge import schemas
    from fieldgauge.plans.monitoring_job import refresh_monitor

    columns = [*schemas.MODEL_INPUTS, schemas.LABEL]
    schema = "timestamp_ms timestamp, model_id int, " + ", ".join(f"{c} double" for c in columns) + ", date date"

    def log(*rows):
        made = [(dt.datetime(2024, 1, day, 12), 0, *[float(day)] * len(columns), dt.date(2024, 1, date)) for day, date in rows]
        spark.createDataFrame(made, schema).write.mode("append").partitionBy("date").saveAsTable("late_log")

    def profiled():
        return {r["day"].day: r["n"] for r in spark.read.table("late_profile").select("day", "n").distinct().collect()}

    log((1, 1), (2, 2))
    spark.read.table("late_log").drop("timestamp_ms", "date").write.saveAsTable("late_base")
    refresh_monitor(spark, "late_log", "late_base", "late", kinds=("profile",))
    assert profiled() == {1: 1, 2: 1}
    log((1, 1), (2, 9), (5, 2))  # late, replayed a week on, and a day that is no date of the log
    refresh_monitor(spark, "late_log", "late_base", "late", kinds=("profile", "share"))
    assert profiled() == {1: 2, 2: 2, 5: 1}
    assert {r["day"].day: r["n"] for r in spark.read.table("late_share").collect()} == {1: 2, 2: 2, 5: 1}


def test_monitor_sees_rewritten_and_vanished_days(spark):
    """Equal numbers of rows with other values are computed again; a day that left the log is emptied."""
    import datetime as dt

    from fieldgauge.plans.monitoring_job import refresh_monitor

    def log(*days):
        data = [(dt.datetime(2024, 1, d, 5), 0, v, v, v, v, 1, dt.date(2024, 1, d)) for d, values in days for v in values]
        frame = spark.createDataFrame(data, "timestamp_ms timestamp, model_id int, Temperature double, Light double, CO2 double, HumidityRatio double, Occupancy int, date date")
        frame.write.mode("overwrite").partitionBy("date").saveAsTable("rewritten_log")

    log((1, [1.0, 2.0]), (2, [10.0, 10.0]), (3, [5.0, 6.0]))
    spark.table("rewritten_log").drop("timestamp_ms", "date").write.mode("overwrite").saveAsTable("rewritten_base")

    def means(kind="profile", value="mean"):
        refresh_monitor(spark, "rewritten_log", "rewritten_base", "rewritten", kinds=("profile", "previous_drift"))
        spark.catalog.refreshTable(f"rewritten_{kind}")
        found = spark.table(f"rewritten_{kind}").where("column = 'Light'")
        return {r["day"].day: r[value] for r in found.collect()}

    assert means() == {1: 1.5, 2: 10.0, 3: 5.5}
    log((1, [1.0, 2.0]), (2, [99.0, 99.0]), (3, [5.0, 6.0]))
    assert means() == {1: 1.5, 2: 99.0, 3: 5.5} and means("previous_drift", "mean_delta") == {2: 97.5, 3: -93.5}
    log((1, [1.0, 2.0]), (3, [5.0, 6.0]))
    assert means() == {1: 1.5, 3: 5.5} and means("previous_drift", "mean_delta") == {3: 4.0}
    log((3, [5.0, 6.0]))
    assert means() == {3: 5.5} and means("previous_drift", "mean_delta") == {}
