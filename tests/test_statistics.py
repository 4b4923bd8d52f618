import math

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from fieldgauge.operators import descriptive
from fieldgauge.operators.features import scaler_statistics, standardize
from fieldgauge.operators.modeling import random_trials


@pytest.fixture(scope="module")
def sample(spark):
    draw = np.random.default_rng(11)
    data = [(int(i % 3 == 0), float(x), float(y)) for i, (x, y) in enumerate(draw.normal([5, 50], [1, 9], (400, 2)))]
    data += [(1, 5.0, None)] * 200 + [(None, 4.0, 40.0)] * 3
    return data, spark.createDataFrame(data, "label int, x double, y double").repartition(5)


def test_describe_exact_and_approximate(sample):
    data, df = sample
    xs = [r[1] for r in data]
    row = {r["column"]: r for r in descriptive.describe_numeric(df, ["x", "y"]).collect()}["x"]
    assert row["count"] == len(xs)
    assert row["mean"] == pytest.approx(np.mean(xs)) and row["std"] == pytest.approx(np.std(xs, ddof=1))
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert row[name] == pytest.approx(np.quantile(xs, p))
    near = {r["column"]: r for r in descriptive.describe_numeric(df, ["x", "y"], quartiles="approx").collect()}["x"]
    assert near["p75"] == pytest.approx(np.quantile(xs, 0.75), abs=0.1)


def test_density_matches_the_kernel_sum(sample):
    data, df = sample
    got = descriptive.density_by_class(df, ["x"], "label", grid=50).where("label = 1").orderBy("point").collect()
    values = np.array([x for label, x, _ in data if label == 1])
    bandwidth = len(values) ** -0.2 * values.std(ddof=1)
    grid = np.linspace(values.min() - 3 * bandwidth, values.max() + 3 * bandwidth, 50)
    want = np.exp(-0.5 * ((grid[:, None] - values) / bandwidth) ** 2).sum(1) / (len(values) * bandwidth * math.sqrt(2 * math.pi))
    assert np.allclose([r["x"] for r in got], grid) and np.allclose([r["density"] for r in got], want)
    assert np.allclose([r["scaled_density"] for r in got], want * len(values) / len(data))


def test_density_skips_a_class_without_spread(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 1.0), (1, 1.0), (1, 2.0), (2, 7.0)], "label int, x double")
    assert rows(descriptive.density_by_class(df, ["x"], "label").select("label").distinct()) == [(1,)]


def test_density_moves_only_grid_sums(sample):
    text = plan(descriptive.density_by_class(sample[1], ["x"], "label"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_box_whiskers_and_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0]
    df = spark.createDataFrame([(0, v) for v in values] + [(1, 3.0)], "label int, x double")
    boxes = {r["label"]: r for r in descriptive.box_stats(df, ["x"], "label").collect()}
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    box = boxes[0]
    assert (box["q1"], box["median"], box["q3"]) == (q1, median, q3)
    assert (box["whisker_low"], box["whisker_high"], box["outliers"], box["n"]) == (1.0, 5.0, 2, 7)
    assert boxes[1]["whisker_low"] == boxes[1]["whisker_high"] == 3.0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0, float(v)) for v in range(11)] + [(1, 10.0), (1, None)], "label int, x double")
    bars = descriptive.histogram_by_class(df, "x", "label", bins=5)
    assert rows(bars.groupBy("label").sum("n")) == [(0, 11), (1, 1)]
    assert rows(bars.where("bin = 4").select("label", "n", "right")) == [(0, 3, 10.0), (1, 1, 10.0)]
    flat = spark.createDataFrame([(0, 2.0)] * 4, "label int, x double")
    assert descriptive.histogram_by_class(flat, "x", "label", bins=4).collect()[0]["n"] == 4


def test_automatic_bins_follow_the_published_rule(sample):
    data, df = sample
    edges = np.histogram_bin_edges([r[1] for r in data], bins="auto")
    bars = descriptive.histogram_by_class(df, "x", "label")
    assert bars.agg(F.max("right")).first()[0] == pytest.approx(edges[-1])
    assert bars.select((F.col("right") - F.col("left")).alias("w")).first()[0] == pytest.approx(edges[1] - edges[0])


def test_correlation_uses_pairs_that_are_present(sample):
    data, df = sample
    both = np.array([(x, y) for _, x, y in data if y is not None])
    got = {(r["column_a"], r["column_b"]): r["r"] for r in descriptive.correlation_pairs(df, ["x", "y"]).collect()}
    assert got[("x", "y")] == got[("y", "x")] == pytest.approx(np.corrcoef(both.T)[0, 1])
    assert got[("x", "x")] == pytest.approx(1.0)


def test_profile_counts_missing(sample):
    data, df = sample
    got = {r["column"]: r for r in descriptive.column_profile(df).collect()}
    assert (got["y"]["non_null"], got["y"]["rows"], got["y"]["dtype"]) == (len(data) - 200, len(data), "double")


def test_scaling_by_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (8.0, 7.0)], "a double, b double")
    stats = {r["column"]: r for r in scaler_statistics(df, ["a", "b"]).collect()}
    assert stats["a"]["std"] == pytest.approx(np.std([1, 3, 8]))
    scaled = rows(standardize(df, ["a", "b"]))
    want = (np.array([1, 3, 8]) - 4) / np.std([1, 3, 8])
    assert sorted(r[0] for r in scaled) == pytest.approx(list(want)) and {r[1] for r in scaled} == {0.0}


def test_trials_are_reproducible_and_in_range():
    points = random_trials()
    assert points == random_trials() and len(points) == 10
    assert all((p["maxDepth"] is None or 5 <= p["maxDepth"] <= 50) and 2 <= p["minSplit"] <= 40 and 1 <= p["minLeaf"] <= 20 for p in points)
