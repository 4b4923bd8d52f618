"""Quantiles by selection: every kind of value, every way through the levels, and what moves."""

import math

import numpy as np
import pytest
from conftest import plan, rows

from fieldgauge.operators import descriptive, quantiles

POINTS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}


@pytest.fixture(params=[200_000, 50, 0], ids=["by value", "mixed", "by cells"])
def finish(request, monkeypatch):
    monkeypatch.setattr(quantiles, "FINISH_ROWS", request.param)


def sets():
    draw = np.random.default_rng(4)
    return {
        "normal": draw.normal(size=3000),
        "wide": np.concatenate([-(10.0 ** draw.uniform(-300, 300, 500)), 10.0 ** draw.uniform(-300, 300, 700), [0.0, -0.0, 5e-324, -5e-324, 1.7e308]]),
        "close": 1.0 + np.arange(600) * 2.0**-52,
        "hot": np.concatenate([np.full(900, 7.25), draw.uniform(7.2, 7.3, 300)]),
        "one": np.array([3.0]),
        "infinite": np.array([math.inf, -math.inf, 1.0, 1.7e308, -1.7e308, math.inf]),
    }


def test_selection_equals_numpy(spark, finish):
    data = [(name, float(v)) for name, values in sets().items() for v in values]
    data += [(None, 2.0), (None, 4.0), ("empty", None), ("normal", None)]
    got = {r["g"]: r for r in quantiles.exact_quantiles(spark.createDataFrame(data, "g string, v double").repartition(7), ["v"], ["g"], POINTS).collect()}
    assert set(got) == {*sets(), None}
    for name, values in {**sets(), None: np.array([2.0, 4.0])}.items():
        assert got[name]["n"] == len(values)
        ordered = np.sort(values)
        for p, share in POINTS.items():
            position = share * (len(values) - 1)
            low, high = ordered[int(position)], ordered[min(int(position) + 1, len(values) - 1)]
            with np.errstate(all="ignore"):
                want = low + (high - low) * (position - int(position))
            assert got[name][p] == pytest.approx(want, rel=1e-12, nan_ok=True), (name, p)


def test_nan_is_above_all_and_nothing_without_values(spark, finish):
    df = spark.createDataFrame([(1.0,), (math.nan,), (2.0,), (math.inf,), (None,)], "v double")
    row = quantiles.exact_quantiles(df, ["v"], [], {"first": 0.0, "last": 1.0}).first()
    assert row["n"] == 4 and row["first"] == 1.0 and math.isnan(row["last"])
    assert quantiles.exact_quantiles(df.where("v < 0"), ["v"]).collect() == []


def test_cells_keep_the_order_of_values(spark):
    values = sorted(float(v) for s in sets().values() for v in s)
    found = spark.createDataFrame([(v,) for v in values], "v double").select("v", quantiles.magnitude_cell(quantiles.F.col("v")).alias("c")).collect()
    cells = [r["c"] for r in sorted(found, key=lambda r: r["v"])]
    assert cells == sorted(cells)


def test_only_cells_are_shuffled_before_few_rows_are_left(spark, monkeypatch):
    """The plan that reads all rows groups by cell; a grouping by value has the open cells' rows as its input."""
    seen = []
    keep = quantiles._kept

    def watched(cells):
        seen.append((plan(cells), cells))
        return keep(cells)

    monkeypatch.setattr(quantiles, "_kept", watched)
    monkeypatch.setattr(quantiles, "FINISH_ROWS", 100)
    df = spark.range(20_000).selectExpr("cast(id as double) / 7 as v")
    got = quantiles.exact_quantiles(df, ["v"]).first()
    assert got["p50"] == pytest.approx(19_999 / 14)
    exchanges = [line for text, _ in seen for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("value" in line for line in exchanges)
    assert len(seen) == 2  # magnitude, and one division of the open cells


def test_histogram_with_a_far_outlier(spark):
    df = spark.createDataFrame([(0, i / 2000) for i in range(2000)] + [(1, 1e12)], "label int, x double")
    bars = rows(descriptive.histogram_by_class(df, "x", "label"))
    assert sum(r[4] for r in bars) == 2001 and len(bars) == 14
    with pytest.raises(ValueError, match="more than doubles"):
        descriptive.histogram_by_class(df.unionByName(spark.createDataFrame([(0, 1e300)], "label int, x double")), "x", "label")
    with pytest.raises(ValueError, match="finite"):
        descriptive.histogram_by_class(spark.createDataFrame([(0, math.inf), (0, 1.0)], "label int, x double"), "x", "label")
    assert descriptive.histogram_by_class(df.where("x < 0"), "x", "label").collect() == []
    assert len(descriptive.histogram_by_class(df, "x", "label", bins=40).collect()) == 80
