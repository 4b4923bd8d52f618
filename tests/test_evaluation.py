import pytest
from conftest import rows

from fieldgauge.operators import evaluation, features, gates
from fieldgauge.operators.changes import snapshot_changes


def judged(spark, *pairs):
    return spark.createDataFrame(list(pairs), "Occupancy int, prediction int")


def values(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def metric_table(spark, **numbers):
    return spark.createDataFrame(list(numbers.items()), "metric string, value double")


def test_metrics(spark):
    df = judged(spark, (1, 1), (1, 1), (1, 0), (0, 1), (0, 0))
    assert values(evaluation.binary_metrics(df)) == pytest.approx(
        {"accuracy": 0.6, "precision": 2 / 3, "recall": 2 / 3, "f1": 2 / 3}
    )
    cells = [(r["label"], r["prediction"], r["n"]) for r in evaluation.confusion_matrix(df).orderBy("cell").collect()]
    assert cells == [(1, 1, 2), (1, 0, 1), (0, 1, 1), (0, 0, 1)]


def test_ratios_without_cases_are_zero(spark):
    assert values(evaluation.binary_metrics(judged(spark, (0, 0)))) == {
        "accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0
    }
    assert [r["n"] for r in evaluation.confusion_matrix(judged(spark, (0, 0))).orderBy("cell").collect()] == [0, 0, 0, 1]


def test_best_trial_and_tie(spark):
    means = spark.createDataFrame(
        [("b", "f1", 0.9), ("a", "f1", 0.9), ("c", "f1", 0.1), ("c", "accuracy", 1.0)], "params string, metric string, value double"
    )
    assert rows(evaluation.best_trial(means)) == [("a", -0.9)]


def test_static_gate(spark):
    good = gates.static_gate(metric_table(spark, accuracy=0.1, precision=0.5, recall=0.2, f1=0.0))
    assert gates.gate_decision(good).first()["passed"] is True
    bad = gates.static_gate(metric_table(spark, accuracy=0.9, precision=0.09, recall=0.5))
    decision = gates.gate_decision(bad).first()
    assert decision["passed"] is False and decision["reason"] == "precision: below threshold"


def test_missing_metric_fails(spark):
    decision = gates.gate_decision(gates.static_gate(metric_table(spark, accuracy=0.9, recall=0.9))).first()
    assert decision["passed"] is False and "precision" in decision["reason"]


@pytest.mark.parametrize(
    "candidate, champion, passed",
    [(0.95, 0.40, True), (0.95, 0.50, False), (0.84, 0.10, False), (0.90, 0.0, True)],
)
def test_champion_gate_with_the_default_bounds(spark, candidate, champion, passed):
    gate = gates.champion_gate(metric_table(spark, accuracy=candidate), metric_table(spark, accuracy=champion))
    assert gate.first()["passed"] is passed


def test_champion_gate_with_own_bounds(spark):
    bounds = {"accuracy": gates.Threshold(0.5, 0.0, 0.05), "loss": gates.Threshold(1.0, 0.1, greater_is_better=False)}
    gate = gates.champion_gate(
        metric_table(spark, accuracy=0.80, loss=0.3), metric_table(spark, accuracy=0.78, loss=0.5), bounds
    )
    assert {r["metric"]: (r["passed"], r["reason"]) for r in gate.collect()} == {
        "accuracy": (False, "relative gain too small"), "loss": (True, "")
    }


def test_promotion_moves_the_champion(spark):
    aliases = spark.createDataFrame([("champion", "m1"), ("previous", "m0")], "alias string, model string")
    passed = gates.gate_decision(gates.static_gate(metric_table(spark, accuracy=1.0, precision=1.0, recall=1.0)))
    failed = gates.gate_decision(gates.static_gate(metric_table(spark, accuracy=0.0, precision=1.0, recall=1.0)))
    assert rows(gates.promoted_aliases(aliases, passed, "m2")) == [("champion", "m2"), ("previous", "m1")]
    assert rows(gates.promoted_aliases(aliases, failed, "m2")) == [("champion", "m1"), ("previous", "m0")]
    assert rows(gates.promoted_aliases(aliases.limit(0), passed, "m2")) == [("champion", "m2")]


def test_upsert_and_lookup(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "Id int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "c")], "Id int, v string")
    assert rows(features.upsert(target, source, ["Id"])) == [(1, "a"), (2, "B"), (3, "c")]
    found = features.feature_lookup(
        spark.createDataFrame([(1, 0.5), (9, 0.7)], "Id int, h double"), target, "Id", ["v"], {"v": "renamed"}, ["h"]
    )
    assert found.columns == ["Id", "renamed"] and rows(found) == [(1, "a"), (9, None)]


def test_snapshot_changes_are_null_safe(spark):
    before = spark.createDataFrame([(1, None), (2, "x"), (3, "y"), (4, None)], "k int, v string")
    after = spark.createDataFrame([(1, None), (2, "z"), (4, "w"), (5, None)], "k int, v string")
    assert rows(snapshot_changes(before, after, ["k"])) == sorted(
        [
            ("delete", 3, "y"), ("insert", 5, None), ("update_preimage", 2, "x"), ("update_postimage", 2, "z"),
            ("update_preimage", 4, None), ("update_postimage", 4, "w"),
        ],
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )
