"""The jobs end to end, and the streams."""

import datetime as dt
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from fieldgauge import schemas
from fieldgauge.operators import gates
from fieldgauge.operators.inference_log import capture_scores
from fieldgauge.operators.modeling import ScaledTree, score, tune_tree
from fieldgauge.plans.feature_job import FeatureTables, run_feature_job
from fieldgauge.plans.monitoring_job import _logged_days, process_day, refresh_monitor
from fieldgauge.plans.training_job import TrainingPaths, run_training_job
from fieldgauge.streaming import inference_stream

TABLES = FeatureTables("job_silver", "job_gold", "job_features", "job_baseline")
POINTS = [
    {"impurity": "gini", "maxDepth": 5, "minSplit": 2, "minLeaf": 5},
    {"impurity": "entropy", "maxDepth": None, "minSplit": 9, "minLeaf": 2},
]


@pytest.fixture(scope="module")
def raw_folder(tmp_path_factory):
    draw = random.Random(4)
    folder = tmp_path_factory.mktemp("raw")
    start = dt.datetime(2015, 2, 2)
    lines = []
    for i in range(1200):
        label = int(draw.random() < 0.4)
        temperature = round(draw.uniform(21.2, 23.0) if label else draw.uniform(19.0, 21.9), 2)
        light = round(draw.uniform(300, 600) if label else draw.uniform(0, 280), 1)
        lines.append(f"{start + dt.timedelta(minutes=i)},{temperature},27.1,{light},{draw.randint(420, 700)},0.0045,{label}")
    header = "date,Temperature,Humidity,Light,CO2,HumidityRatio,Occupancy\n"
    (folder / "a.csv").write_text(header + "\n".join(lines[:500]) + "\n")
    (folder / "b.csv").write_text(header + "\n".join(f"{i},{x}" for i, x in enumerate(lines[500:])) + "\n")
    return str(folder)


@pytest.fixture(scope="module")
def feature_tables(spark, raw_folder, tmp_path_factory):
    location = str(tmp_path_factory.mktemp("features"))
    assert run_feature_job(spark, raw_folder, location, TABLES) == "created"
    before = rows(spark.read.table(TABLES.features))
    assert run_feature_job(spark, raw_folder, location, TABLES) == "merged"
    assert rows(spark.read.table(TABLES.features)) == before
    return TABLES


@pytest.fixture(scope="module")
def trained(spark, feature_tables, tmp_path_factory):
    base = tmp_path_factory.mktemp("training")
    paths = TrainingPaths(str(base / "validation"), str(base / "model"), "job_run_metrics", "job_gates", "job_aliases")
    return paths, run_training_job(spark, feature_tables.features, paths, "run-1", points=POINTS)


def aliases(spark, paths):
    return {r["alias"]: r["model"].rsplit("/", 1)[1] for r in spark.read.table(paths.aliases_table).collect()}


def test_feature_job(spark, feature_tables):
    features = spark.read.table(feature_tables.features)
    assert features.columns == ["Id", *schemas.GOLD_COLUMNS]
    n = features.count()
    assert n == 1200 and rows(features.agg(F.min("Id"), F.max("Id"), F.count_distinct("Id"))) == [(1, n, n)]
    assert dict(spark.read.table(feature_tables.baseline).dtypes)["Occupancy"] == "double"


def test_training_job_saves_a_model_that_scores_alike(spark, feature_tables, trained):
    paths, model = trained
    metrics = spark.read.table(paths.metrics_table)
    assert {r["kind"] for r in metrics.select("kind").distinct().collect()} == {"param", "test", "confusion", "cv", "validation"}
    assert metrics.where("kind = 'validation' and name = 'accuracy' and value > 0.95").count() == 1
    assert metrics.where("kind = 'cv'").count() == len(POINTS) * 4
    frame = spark.read.csv(paths.validation, header=True, inferSchema=True)
    again = score(frame, ScaledTree.load(f"{paths.model}/run-1"))
    assert again.where("prediction <> Occupancy").count() == score(frame, model).where("prediction <> Occupancy").count()


def test_training_job_rejects_no_gain_over_the_champion(spark, feature_tables, trained, tmp_path):
    paths, _ = trained
    assert aliases(spark, paths) == {"champion": "run-1"}
    with pytest.raises(RuntimeError, match="gain too small"):
        run_training_job(spark, feature_tables.features, paths, "run-2", points=POINTS[:1])
    assert aliases(spark, paths) == {"champion": "run-1"}
    easy = {"accuracy": gates.Threshold(0.5, 0.0, None)}
    run_training_job(spark, feature_tables.features, paths, "run-3", thresholds=easy, points=POINTS[:1])
    assert aliases(spark, paths) == {"champion": "run-3", "previous": "run-1"}
    assert {r["run_id"] for r in spark.read.table(paths.gates_table).collect()} == {"run-1", "run-2", "run-3"}


def test_tuning_agrees_with_its_trial_rows(spark, feature_tables):
    from fieldgauge.operators.evaluation import best_trial
    from fieldgauge.operators.features import training_frame

    tuned = tune_tree(training_frame(spark.read.table(feature_tables.features)), POINTS, folds=3)
    assert best_trial(tuned.trials).first()["params"] == tuned.best
    assert tuned.trials.count() == len(POINTS) * 4


def captured(spark, feature_tables, model):
    """Scored features as a payload log over three days."""
    frame = spark.read.table(feature_tables.features).withColumnsRenamed(schemas.TRAINING_NAMES)
    scored = score(frame, model).withColumnsRenamed({v: k for k, v in schemas.TRAINING_NAMES.items()})
    at = F.timestamp_seconds(F.lit(1704067200) + (F.col("Id") % 3) * 86400 + F.col("Id"))
    return capture_scores(scored.withColumn("at", at), schemas.MODEL_INPUTS, "prediction", F.col("Id"), "at")


def test_monitoring_job(spark, feature_tables, trained):
    log = captured(spark, feature_tables, trained[1])
    log.write.mode("overwrite").partitionBy("date").saveAsTable("job_payload")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02", "2024-01-03"):
        process_day(spark, "job_payload", "job_clean", "job_rejects", day)
    assert spark.read.table("job_clean").count() == 1200
    assert spark.read.table("job_rejects").count() == 0
    for name in refresh_monitor(spark, "job_clean", feature_tables.baseline, "job_monitor"):
        assert spark.read.table(name).count() > 0
    assert spark.read.table("job_monitor_ks_drift").agg(F.max("ks")).first()[0] < 0.1


def test_stream_stores_each_request_once(spark, feature_tables, trained, tmp_path):
    source, checkpoint = str(tmp_path / "payload"), str(tmp_path / "checkpoint")
    log = captured(spark, feature_tables, trained[1]).select(schemas.PAYLOAD_SCHEMA.fieldNames())
    log.unionByName(log.limit(100)).write.parquet(source)

    def run(name):
        stream = inference_stream.read_payload_stream(spark, source)
        writer = inference_stream.unpack_stream(stream, "stream_clean", "stream_rejects", name)
        writer.start().awaitTermination()
        return spark.read.table("stream_clean").count()

    assert run(checkpoint) == 1200
    bad = log.limit(3).withColumns({"request": F.lit("oops"), "request_id": F.concat(F.lit("bad"), "request_id")})
    bad.write.mode("append").parquet(source)  # days that lie behind the newest request seen
    assert run(checkpoint) == 1200 and spark.read.table("stream_rejects").count() == 3
    # a lost checkpoint replays everything; nothing is stored twice
    assert run(str(tmp_path / "other")) == 1200 and spark.read.table("stream_rejects").count() == 3


def test_repeats_within_the_lateness_are_dropped(spark, tmp_path):
    source = str(tmp_path / "payload")
    log = spark.range(5).select(
        F.concat(F.lit("r"), F.col("id")).alias("request_id"), F.lit("2024-01-01").cast("date").alias("date"),
        (1704067200000 + F.col("id") * 1000).alias("timestamp_ms"), F.lit(200).alias("status_code"),
        *[F.lit("x").alias(c) for c in ("request", "response", "request_metadata")],
    )
    seen = []
    for part in (log.unionByName(log), log.where("request_id <> 'r0'")):
        part.write.mode("append").parquet(source)
        stream = inference_stream.without_repeats(inference_stream.read_payload_stream(spark, source))
        query = (
            stream.writeStream.foreachBatch(lambda batch, _: seen.extend(r["request_id"] for r in batch.collect()))
            .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    assert sorted(seen) == ["r0", "r1", "r2", "r3", "r4"]


def test_profile_stream_updates_across_batches(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("log", "profile", "checkpoint"))
    log = spark.range(100).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1000).alias("timestamp_ms"),
        F.lit(0).alias("model_id"), F.col("id").cast("double").alias("CO2"),
    )
    for part in ("id < 70", "id >= 70"):
        log.withColumn("id", F.col("CO2")).where(part).drop("id").write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        inference_stream.window_profile_stream(stream, ["CO2"], out, checkpoint).start().awaitTermination()
    found = inference_stream.latest_profile(spark, out).orderBy("window_start").collect()
    assert [r["n"] for r in found] == [87, 13] and found[0]["max"] == 86.0 and found[1]["mean"] == 93.0


def test_checksum_of_a_day_is_a_hash_of_the_columns(spark, monkeypatch):
    columns = "timestamp_ms timestamp, date date, Temperature double, Light double"
    day = dt.datetime(2024, 1, 15)
    table = lambda *values: spark.createDataFrame([(day, day.date(), *v) for v in values], columns)
    plans, grouped = [], type(table((1.0, 2.0)).groupBy()).agg

    def agg(self, *measures):
        found = grouped(self, *measures)
        plans.append(plan(found))
        return found

    monkeypatch.setattr(type(table((1.0, 2.0)).groupBy()), "agg", agg)
    checksum = lambda *values: _logged_days(table(*values))[day.date()][3]
    assert checksum((1.0, None), (3.0, 4.0)) == checksum((3.0, 4.0), (1.0, None))
    several = [checksum(x) for x in ((1.0, None), (None, 1.0), (None, None), (1.0, 1.0), (1.0, 2.0), (2.0, 1.0))]
    assert len(set(several)) == len(several)
    assert plans and not any("json" in p.lower() for p in plans)  # a row is not written as text to be hashed
