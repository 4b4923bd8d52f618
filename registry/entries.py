"""The registered queries: every operator over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldgauge import schemas
from fieldgauge.operators import changes, cleaning, descriptive, evaluation, features, gates, inference_log
from fieldgauge.operators import modeling, monitoring, quantiles, splits
from fieldgauge.operators.tree_growth import TreeSpec, grow_trees, with_predictions
from fieldgauge.plans.monitoring_job import refresh_monitor
from fieldgauge.plans.training_job import TrainingPaths, run_training_job
from fieldgauge.session import fresh_path
from fieldgauge.sources import csv_files, tables
from fieldgauge.sources.requests import append_positions
from fieldgauge.streaming import inference_stream
from registry.views import (
    millis,
    payload,
    prediction_log,
    predictions,
    readings,
    rounded,
    rule_prediction,
    ruled,
    table,
    varied_payload,
)

SENSORS = schemas.SENSOR_COLUMNS
INPUTS = schemas.MODEL_INPUTS
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DENSITIES = ["CO2", "Light", "Humidity", "HumidityRatio"]
SUMMARY = ["mean", "std", "min", "p25", "p50", "p75", "max"]
REPORT_DAY = "2024-01-15"
TRIAL_LIMITS = [20.5, 21.0, 21.5, 22.0]


# --- typing, filters, unions -------------------------------------------------------------


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = readings(spark, sf_dir).select(
        F.date_format("date", schemas.TIME_FORMAT).alias("date"),
        *[F.col(c).cast("string").alias(c) for c in SENSORS],
        F.col("Occupancy").cast("string").alias("Occupancy"),
    )
    typed = cleaning.type_silver(text)
    return rounded(typed.select(millis("date").alias("at_ms"), *schemas.GOLD_COLUMNS), *SENSORS)


def cast_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = readings(spark, sf_dir, "event_type").select(
        "event_id",
        F.when(F.col("user_id") % 3 == 0, "warm").otherwise(F.col("Temperature").cast("string")).alias("Temperature"),
        F.when(F.col("event_type") == "view", F.col("event_type")).otherwise(F.col("Occupancy").cast("string")).alias("Occupancy"),
    )
    found = cleaning.cast_rejects(text, {"Temperature": "double", "Occupancy": "bigint"})
    return found.select("event_id", F.concat_ws(",", "bad_columns").alias("bad_columns"))


def gold_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descriptive.class_counts(cleaning.remove_outliers(readings(spark, sf_dir)), "Occupancy")


def gold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cleaning.remove_outliers(readings(spark, sf_dir)), *SENSORS)


def gold_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = readings(spark, sf_dir)
    both = cleaning.union_by_name(cleaning.class_rows(source, 0), cleaning.class_rows(source, 1))
    return rounded(both, *SENSORS)


def union_by_name_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "raw")
    source = readings(spark, sf_dir, "event_type").withColumn(
        "date", F.date_format("date", schemas.TIME_FORMAT)
    )
    plain = source.where(F.col("event_type").isin("purchase", "click")).select("date", *schemas.GOLD_COLUMNS)
    numbered = source.where(F.col("event_type").isin("signup", "error")).select(
        F.col("event_id").alias(""), "date", *schemas.GOLD_COLUMNS
    )
    fewer = source.where(F.col("event_type") == "view").select(
        "CO2", "Light", "Temperature", "HumidityRatio", "date"
    )
    for part in (plain, numbered, fewer):
        part.write.mode("append").option("header", True).csv(folder)
    typed = cleaning.type_silver(csv_files.read_readings_csv(spark, folder))
    return rounded(typed.select(millis("date").alias("at_ms"), *schemas.GOLD_COLUMNS), *SENSORS)


# --- statistics --------------------------------------------------------------------------


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(descriptive.describe_numeric(readings(spark, sf_dir), schemas.GOLD_COLUMNS), *SUMMARY)


def _with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as a union of sources leaves them: one source has no humidity."""
    known = F.when(F.col("event_type") != "view", F.col("Humidity"))
    return readings(spark, sf_dir, "event_type").withColumn("Humidity", known)


def nonnull_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return descriptive.column_profile(_with_gaps(spark, sf_dir).select("date", *schemas.GOLD_COLUMNS))


def hist_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = descriptive.histogram_by_class(readings(spark, sf_dir), "Temperature", "Occupancy", bins=20)
    return rounded(bars, "left", "right")


def hist_auto_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = descriptive.histogram_by_class(readings(spark, sf_dir), "Temperature", "Occupancy")
    return rounded(bars, "left", "right")


def kde_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = descriptive.density_by_class(readings(spark, sf_dir), DENSITIES, "Occupancy")
    return rounded(curve, "x", "density", "scaled_density")


def box_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = descriptive.box_stats(readings(spark, sf_dir), SENSORS, "Occupancy")
    return rounded(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


def corr_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(descriptive.correlation_pairs(readings(spark, sf_dir), schemas.GOLD_COLUMNS), "r")


def corr_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(descriptive.correlation_pairs(_with_gaps(spark, sf_dir), schemas.GOLD_COLUMNS), "r")


def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = descriptive.first_rows(readings(spark, sf_dir), ["event_id"], 5)
    return rounded(rows.select("event_id", *schemas.GOLD_COLUMNS), *SENSORS)


def lineitem_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_to(descriptive.describe_numeric(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), 4, *SUMMARY)


def lineitem_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = descriptive.box_stats(table(spark, sf_dir, "lineitem"), LINE_NUMBERS, "l_linestatus")
    return rounded(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


def lineitem_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(descriptive.correlation_pairs(table(spark, sf_dir, "lineitem"), LINE_NUMBERS), "r")


def lineitem_group_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys, lines = ["l_returnflag", "l_linestatus"], table(spark, sf_dir, "lineitem")
    found = quantiles.exact_quantiles(lines, LINE_NUMBERS, keys, {"p05": 0.05, "p95": 0.95})
    return rounded(found.join(quantiles.distinct_values(lines, LINE_NUMBERS, keys), [*keys, "column"]), "p05", "p95")


def hist_far_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automatic bins over values of which a few lie so far off that most bins are empty."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linestatus", F.when(F.col("l_orderkey") == 100, 1e9).otherwise(F.col("l_quantity").cast("double")).alias("amount")
    )
    return rounded(descriptive.histogram_by_class(lines, "amount", "l_linestatus"), "left", "right")


def _rounded_to(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- keys, upsert, lookup, splits, scaling -----------------------------------------------


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = features.add_surrogate_key(
        readings(spark, sf_dir).select("event_id", "date", *schemas.GOLD_COLUMNS), ["date", "event_id"], drop=["date"]
    )
    return rounded(keyed, *SENSORS)


def surrogate_key_hot_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ranked = orders.select(F.ascii("o_orderstatus").alias("status"), "o_orderkey", "o_totalprice")
    keyed = features.add_surrogate_key(ranked, ["status", "o_orderkey"])
    return rounded(keyed, "o_totalprice")


def _order_update(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored order table, and a delivery that changes open orders and brings pending ones."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stored = orders.where(F.col("o_orderstatus") != "P")
    delivery = orders.where(F.col("o_orderstatus").isin("O", "P")).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    return stored, delivery


def feature_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, delivery = _order_update(spark, sf_dir)
    return _rounded_to(features.upsert(stored, delivery, ["o_orderkey"]), 2, "o_totalprice")


def feature_upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge through a catalog table: created, then merged."""
    stored, delivery = _order_update(spark, sf_dir)
    name, location = f"orders_{uuid.uuid4().hex}", fresh_path(spark, "orders")
    for part in (stored, delivery):
        tables.upsert_table(part, name, ["o_orderkey"], location)
    return _rounded_to(_detached(spark, name), 2, "o_totalprice")


def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    before = orders.where(F.col("o_orderstatus") != "P")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    after = orders.where(F.col("o_orderpriority") != "5-LOW").withColumn(
        "o_totalprice", F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return _rounded_to(changes.snapshot_changes(before, after, ["o_orderkey"]), 2, "o_totalprice")


def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = readings(spark, sf_dir).select(F.col("event_id").alias("Id"), "Humidity", "Occupancy")
    gold = cleaning.remove_outliers(readings(spark, sf_dir), keep=["event_id"]).withColumnRenamed("event_id", "Id")
    return rounded(features.training_frame(base, gold), *schemas.TRAINING_FEATURES)


def training_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = readings(spark, sf_dir).withColumnRenamed("event_id", "Id").select("Id", *schemas.GOLD_COLUMNS)
    return rounded(features.training_frame(keyed), *schemas.TRAINING_FEATURES)


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).withColumnRenamed("event_id", "Id")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = splits.with_split(_keyed(spark, sf_dir))
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("Id").alias("id_sum"))


def split_exact_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = splits.with_split(_keyed(spark, sf_dir), exact=True)
    return tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("Id").alias("id_sum"))


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = splits.with_stratified_folds(_keyed(spark, sf_dir))
    return tagged.groupBy("Occupancy", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("Id").alias("id_sum"))


def scaler_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.scaler_statistics(readings(spark, sf_dir), INPUTS), "mean", "std")


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = features.standardize(readings(spark, sf_dir).select("event_id", *INPUTS), INPUTS)
    return rounded(scaled, *INPUTS)


def validation_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = splits.split_parts(features.training_frame(_keyed(spark, sf_dir)))
    path = fresh_path(spark, "validation")
    csv_files.write_csv(parts[splits.VALIDATION].drop("Id"), path)
    return rounded(csv_files.read_validation_csv(spark, path), *schemas.TRAINING_FEATURES)


# --- inference log -----------------------------------------------------------------------


def day_success_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = inference_log.read_inference_log(payload(spark, sf_dir), REPORT_DAY)
    return chosen.select("request_id", "timestamp_ms", F.col("status_code").cast("bigint").alias("status_code"))


def _unpacked(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, DataFrame]:
    return inference_log.unpack_inference_log(inference_log.successful(varied_payload(spark, sf_dir)), **options)


def _shown(clean: DataFrame) -> DataFrame:
    shown = clean.withColumns({"timestamp_ms": F.unix_millis("timestamp_ms"), "date": F.col("date").cast("string")})
    return rounded(_nameless(shown).drop("status_code"), *INPUTS)


def _nameless(df: DataFrame) -> DataFrame:
    """Ids made of a request's content shown alike, as JSON text differs between engines."""
    made = F.col("request_id").startswith(inference_log.NO_ID)
    return df.withColumn("request_id", F.when(made, inference_log.NO_ID).otherwise(F.col("request_id")))


def _detached(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a catalog table, copied, and the table gone."""
    folder = fresh_path(spark, "result")
    tables.read_table(spark, name).write.parquet(folder)
    tables.drop_table(spark, name)
    return spark.read.parquet(folder)


def inference_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_unpacked(spark, sf_dir)[0])


def inference_row_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = inference_log.successful(payload(spark, sf_dir)).drop("request_id", "timestamp_ms")
    shared = logged.withColumns({"request_id": F.lit("shared"), "timestamp_ms": F.lit(0).cast("bigint")})
    clean, _ = inference_log.unpack_inference_log(shared, dedup="row", whole_seconds=True)
    return _shown(clean)


def inference_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = _unpacked(spark, sf_dir)[1]
    return _nameless(rejects).select("request_id", F.col("date").cast("string").alias("date"), "pos", "reason")


def _successful_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The successful requests of a stored log, which several batches are taken from."""
    folder, logged = fresh_path(spark, "payload"), varied_payload(spark, sf_dir)
    logged.write.parquet(folder)
    return inference_log.successful(spark.read.schema(logged.schema).parquet(folder))


def inference_append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended in two batches of days, then all days once more; the tables hold each request once."""
    requests = _successful_log(spark, sf_dir)
    early = requests.where(F.col("date") <= F.lit(REPORT_DAY).cast("date"))
    clean, rejected = (f"{kind}_{uuid.uuid4().hex}" for kind in ("clean", "rejected"))
    for batch in (early, requests, requests):
        append_positions(inference_log.unpack_positions(batch, len(INPUTS)), clean, rejected)
    tables.drop_table(spark, rejected)
    return _shown(_detached(spark, clean))


def inference_append_late_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request is logged once more 30 days later; the tables hold each once, under its first day."""
    requests = _successful_log(spark, sf_dir)
    again = requests.withColumn("date", F.date_add("date", 30))
    clean, rejected = (f"{kind}_{uuid.uuid4().hex}" for kind in ("clean", "rejected"))
    for batch in (requests, again):
        append_positions(inference_log.unpack_positions(batch, len(INPUTS)), clean, rejected)
    tables.drop_table(spark, rejected)
    return _shown(_detached(spark, clean))


def inference_append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = inference_log.unpack_inference_log(inference_log.successful(payload(spark, sf_dir)))[0]
    stored = everything.where(F.col("date") <= F.lit(REPORT_DAY).cast("date"))
    fresh = tables.new_rows(everything, stored, ["request_id", "pos"])
    return _shown(stored.unionByName(fresh))


def score_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    captured = inference_log.capture_scores(
        predictions(spark, sf_dir), INPUTS, "prediction", F.col("event_id"), "date"
    )
    return _shown(inference_log.unpack_inference_log(captured)[0])


# --- metrics and gates -------------------------------------------------------------------


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.confusion_matrix(predictions(spark, sf_dir))


def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.binary_metrics(predictions(spark, sf_dir)), "value")


def _trial_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold metrics of several rule limits: every reading is judged once per limit."""
    tagged = splits.with_stratified_folds(_keyed(spark, sf_dir))
    trials = F.array(
        *[
            F.struct(F.lit(f"limit={x}").alias("params"), rule_prediction(x).alias("prediction"))
            for x in TRIAL_LIMITS
        ]
    )
    judged = tagged.select("Occupancy", "fold", F.inline(trials))
    return evaluation.binary_metrics(judged, by=["params", "fold"])


def cv_mean_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluation.mean_fold_metrics(_trial_folds(spark, sf_dir)), "value")


def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = evaluation.mean_fold_metrics(_trial_folds(spark, sf_dir))
    return rounded(evaluation.best_trial(means), "loss")


def static_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = gates.static_gate(evaluation.binary_metrics(predictions(spark, sf_dir)))
    return rounded(gate, "candidate", "champion")


def champion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed rule against a champion that always predicts the negative class."""
    judged = predictions(spark, sf_dir)
    champion = evaluation.binary_metrics(judged.withColumn("prediction", F.lit(0)))
    gate = gates.champion_gate(evaluation.binary_metrics(judged), champion)
    return rounded(gate, "candidate", "champion")


def gate_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = gates.static_gate(evaluation.binary_metrics(predictions(spark, sf_dir)))
    return gates.gate_decision(gate)


def run_metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = evaluation.run_rows(evaluation.binary_metrics(predictions(spark, sf_dir)), "run-1", "test")
    return rounded(rows.drop("ts", "text"), "value")


# --- monitoring --------------------------------------------------------------------------


def baseline_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = cleaning.remove_outliers(readings(spark, sf_dir), keep=["event_id"])
    return rounded(monitoring.prepare_baseline(keyed.withColumnRenamed("event_id", "Id")), *SENSORS)


def _baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.prepare_baseline(cleaning.remove_outliers(readings(spark, sf_dir)))


def _by_day(df: DataFrame, *starts: str) -> DataFrame:
    return df.withColumns({s: F.date_format(s, "yyyy-MM-dd") for s in ("window_start", *starts)})


def daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = monitoring.window_profile(prediction_log(spark, sf_dir), [*INPUTS, "Occupancy"])
    return rounded(_by_day(profile), *SUMMARY)


def prediction_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_by_day(monitoring.prediction_share(prediction_log(spark, sf_dir))), "share")


def drift_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = monitoring.mean_drift(_baseline(spark, sf_dir), prediction_log(spark, sf_dir), SENSORS)
    return rounded(_by_day(drift), "mean", "baseline_mean", "mean_delta", "std_delta")


def drift_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = monitoring.ks_drift(_baseline(spark, sf_dir), prediction_log(spark, sf_dir), SENSORS)
    return rounded(_by_day(drift), "ks")


def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = monitoring.psi_drift(_baseline(spark, sf_dir), prediction_log(spark, sf_dir), SENSORS)
    return rounded(_by_day(drift), "psi")


def drift_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = monitoring.class_drift(_baseline(spark, sf_dir), prediction_log(spark, sf_dir))
    return rounded(_by_day(drift), "tv_distance", "chi_square")


def drift_vs_previous_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    drift = monitoring.previous_window_drift(prediction_log(spark, sf_dir), INPUTS)
    return rounded(_by_day(drift, "previous_start"), "mean_delta", "ks")


def monitor_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitor job over three spans of days and one day again, over a log stored by day."""
    log, base = f"log_{uuid.uuid4().hex}", f"base_{uuid.uuid4().hex}"
    whole = prediction_log(spark, sf_dir).withColumn("date", F.to_date("timestamp_ms"))
    tables.overwrite_table(whole, log, ["date"])
    tables.overwrite_table(_baseline(spark, sf_dir), base)
    prefix = f"monitor_{uuid.uuid4().hex}"
    days = sorted(r["date"] for r in whole.select("date").distinct().collect())  # one value a day
    third = max(1, len(days) // 3)
    for part in (days[:third], days[2 * third :], None, days[third : third + 1]):
        refresh_monitor(spark, log, base, prefix, part, ("profile", "previous_drift"))
    profile, drift = _detached(spark, f"{prefix}_profile"), _detached(spark, f"{prefix}_previous_drift")
    for name in (log, base):
        spark.sql(f"DROP TABLE {name}")
    both = profile.join(drift.select("window_start", "model_id", "column", "previous_start", "mean_delta", "ks"), ["window_start", "model_id", "column"], "left")
    return rounded(_by_day(both.drop("day"), "previous_start"), *SUMMARY, "mean_delta", "ks")


# --- models ------------------------------------------------------------------------------


RULED_BINS = 256  # above the distinct values of each feature, so that no threshold is left out


def _ruled_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return splits.split_parts(ruled(spark, sf_dir))


def tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _ruled_parts(spark, sf_dir)
    model = modeling.train_tree(parts[splits.TRAIN], max_bins=RULED_BINS)
    return modeling.score(parts[splits.TEST], model, ["Id", "Occupancy"])


def tree_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _ruled_parts(spark, sf_dir)
    return modeling.evaluate(parts[splits.VALIDATION], modeling.train_tree(parts[splits.TRAIN], max_bins=RULED_BINS))


def tree_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modeling.tune_tree(_ruled_parts(spark, sf_dir)[splits.TRAIN], max_bins=RULED_BINS).trials


def tree_least_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class by last two digits of the key, from a tree grown freely and from one that splits no node of under half the rows."""
    tail = (F.col("o_orderkey") % 100).cast("double")
    rows = table(spark, sf_dir, "orders").select(tail.alias("tail"), tail.between(60, 89).cast("int").alias("label"))
    half = rows.count() // 2 + 1
    free, bound = grow_trees(rows, ["tail"], "label", [TreeSpec(), TreeSpec(min_split=half)], max_bins=RULED_BINS)
    told = with_predictions(rows.groupBy("tail").agg(F.count("*").alias("n")), ["tail"], {"free": free, "bound": bound})
    return told.select(F.col("tail").cast("int").alias("tail"), "n", F.col("free").cast("int").alias("free"), F.col("bound").cast("int").alias("bound"))


def training_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training job over rows that follow a rule: metrics, gate rows and aliases it stores."""
    name = f"training_{uuid.uuid4().hex}"
    tables.overwrite_table(ruled(spark, sf_dir), name)
    folder = fresh_path(spark, "training")
    paths = TrainingPaths(f"{folder}/validation", f"{folder}/model", f"{name}_metrics", f"{name}_gates", f"{name}_aliases")
    points = [{"impurity": "gini", "maxDepth": None, "minSplit": 2, "minLeaf": 1}, {"impurity": "entropy", "maxDepth": 50, "minSplit": 20, "minLeaf": 5}]
    run_training_job(spark, name, paths, "r1", points=points)
    metrics, gate, aliases = (_detached(spark, t) for t in (paths.metrics_table, paths.gates_table, paths.aliases_table))
    spark.sql(f"DROP TABLE {name}")
    parts = [
        metrics.where(F.col("kind").isin("test", "cv", "validation")).select("kind", "name", "value"),
        gate.select(F.lit("gate").alias("kind"), F.col("metric").alias("name"), F.col("passed").cast("double").alias("value")),
        aliases.select(F.lit("alias").alias("kind"), F.col("alias").alias("name"), F.col("model").endswith("/r1").cast("double").alias("value")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def tree_score_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows scored by a fitted tree, logged as requests and unpacked again."""
    model = modeling.train_tree(_ruled_parts(spark, sf_dir)[splits.TRAIN], max_bins=RULED_BINS)
    rows = ruled(spark, sf_dir).join(readings(spark, sf_dir).select(F.col("event_id").alias("Id"), "date"), "Id")
    scored = modeling.score(rows, model).withColumnsRenamed({v: k for k, v in schemas.TRAINING_NAMES.items()})
    captured = inference_log.capture_scores(scored, INPUTS, "prediction", F.col("Id"), "date")
    return _shown(inference_log.unpack_inference_log(captured)[0])


def alias_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aliases after an accepted model, a rejected one, and the first one of all."""
    metrics = evaluation.binary_metrics(predictions(spark, sf_dir))
    accepted = gates.gate_decision(gates.static_gate(metrics))
    rejected = gates.gate_decision(gates.champion_gate(metrics, metrics))  # no gain over itself
    aliases = spark.createDataFrame([("champion", "m1"), ("previous", "m0")], "alias string, model string")
    cases = {"accepted": (aliases, accepted), "rejected": (aliases, rejected), "first": (aliases.limit(0), accepted)}
    after = [gates.promoted_aliases(a, d, "m2").select(F.lit(c).alias("case"), "alias", "model") for c, (a, d) in cases.items()]
    return after[0].unionByName(after[1]).unionByName(after[2])


# --- tables and files --------------------------------------------------------------------


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table overwritten with another schema, with properties, read with its format."""
    name = f"gold_{uuid.uuid4().hex}"
    gold = cleaning.remove_outliers(readings(spark, sf_dir), keep=["event_id"])
    tables.overwrite_table(gold.select("event_id", "Light"), name)
    tables.overwrite_table(gold.select("event_id", "CO2", "Occupancy"), name, properties={"kind": "it's gold"})
    tables.set_properties(spark, name, {"change_feed": "true"})
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    rows = tables.read_table(spark, name, "parquet")
    kept = rows.withColumn("properties", F.lit(f"{shown['kind']},{shown['change_feed']}"))
    folder = fresh_path(spark, "result")
    kept.write.parquet(folder)
    tables.drop_table(spark, name)
    return spark.read.parquet(folder)


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per event type, listed with the rows each holds."""
    folder = fresh_path(spark, "listed")
    for kind in ("purchase", "click", "signup", "error", "view"):
        part = readings(spark, sf_dir, "event_type").where(F.col("event_type") == kind).select("event_id")
        part.coalesce(1).write.mode("append").option("header", True).csv(folder)
    files = csv_files.list_files(spark, folder)
    held = spark.read.option("header", True).csv(folder).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
    return files.join(held, "path").where(F.col("length") > 0).select("n")


# --- streams -----------------------------------------------------------------------------


def stream_daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in files that are out of time order, one a batch."""
    source, out = fresh_path(spark, "log"), fresh_path(spark, "profile")
    log = prediction_log(spark, sf_dir)
    for turn in (2, 3, 0, 1):
        log.where(F.dayofmonth("timestamp_ms") % 4 == turn).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
    columns = [*INPUTS, "Occupancy"]
    inference_stream.window_profile_stream(stream, columns, out, fresh_path(spark, "offsets")).start().awaitTermination()
    # sums over counts differ from sums over rows in the last bits; ties must still round alike
    profile = _rounded_to(inference_stream.latest_profile(spark, out), 10, "mean", "std")
    return rounded(_by_day(profile), *SUMMARY)


def stream_unpacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream of several batches in which every request comes twice."""
    source = fresh_path(spark, "payload")
    clean, rejected = (f"{kind}_{uuid.uuid4().hex}" for kind in ("clean", "rejected"))
    logged = varied_payload(spark, sf_dir)
    logged.write.parquet(source)
    spark.read.schema(logged.schema).parquet(source).write.mode("append").parquet(source)
    files = len(spark.read.schema(logged.schema).parquet(source).inputFiles())  # grow with the log, batches do not
    stream = inference_stream.read_payload_stream(spark, source, files_per_batch=-(-files // 2))
    inference_stream.unpack_stream(stream, clean, rejected, fresh_path(spark, "offsets")).start().awaitTermination()
    spark.sql(f"DROP TABLE {rejected}")
    return _shown(_detached(spark, clean))


QUERIES = {
    f.__name__: f
    for f in (
        gold_class_counts,
        gold_rows,
        gold_union,
        silver_typed,
        cast_reject_rows,
        union_by_name_files,
        describe_numeric,
        nonnull_profile,
        hist_by_class,
        hist_auto_bins,
        kde_by_class,
        box_by_class,
        corr_long,
        corr_with_gaps,
        head_rows,
        lineitem_describe,
        lineitem_box,
        lineitem_corr,
        lineitem_group_quantiles,
        hist_far_outlier,
        surrogate_key,
        surrogate_key_hot_lead,
        feature_upsert,
        feature_upsert_table,
        key_check,
        snapshot_changes,
        feature_lookup,
        training_rename,
        split_counts,
        split_exact_counts,
        stratified_folds,
        scaler_statistics,
        scaled_features,
        validation_csv_roundtrip,
        day_success_requests,
        inference_unpacked,
        inference_row_dedup,
        inference_rejects,
        inference_append_idempotent,
        inference_append_late_repeat,
        inference_append_table,
        score_capture,
        confusion_matrix,
        binary_metrics,
        cv_mean_metrics,
        best_trial,
        static_gate,
        champion_gate,
        gate_decision,
        run_metric_rows,
        baseline_table,
        daily_profile,
        prediction_share,
        drift_mean,
        drift_ks,
        drift_psi,
        drift_categorical,
        drift_vs_previous_day,
        monitor_by_day,
        tree_predictions,
        tree_evaluation,
        tree_tuning,
        tree_least_split,
        training_job,
        tree_score_capture,
        alias_promotion,
        table_roundtrip,
        listed_files,
        stream_daily_profile,
        stream_unpacked,
    )
}
