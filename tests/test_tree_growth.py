"""Trees against a plain recursion over all thresholds, and the rules that end them."""

import math

import numpy as np
import pytest

from fieldgauge.operators import tree_growth
from fieldgauge.operators.tree_growth import LEAF, TreeSpec, grow_trees, load_tree, save_tree, with_predictions


def impurity(y, kind):
    shares = [np.mean(y == c) for c in np.unique(y)]
    return 1 - sum(p * p for p in shares) if kind == "gini" else -sum(p * math.log2(p) for p in shares)


def plain(x, y, spec, depth=0):
    """Nested (feature, threshold, left, right) or the class counts of a leaf."""
    counts = tuple(int((y == c).sum()) for c in (0, 1))
    if (spec.max_depth is not None and depth >= spec.max_depth) or len(y) < spec.min_split or min(counts) == 0:
        return counts
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values, values[1:], strict=False):
            left = x[:, f] <= a
            if left.sum() < spec.min_leaf or (~left).sum() < spec.min_leaf:
                continue
            loss = left.sum() * impurity(y[left], spec.impurity) + (~left).sum() * impurity(y[~left], spec.impurity)
            if best is None or loss < best[0] - 1e-9:
                best = loss, f, (a + b) / 2, left
    if best is None:
        return counts
    _, f, threshold, left = best
    return f, threshold, plain(x[left], y[left], spec, depth + 1), plain(x[~left], y[~left], spec, depth + 1)


def nested(tree, node=0):
    if tree.feature[node] == LEAF:
        return tuple(tree.counts[node])
    return tree.feature[node], tree.threshold[node], nested(tree, tree.left[node]), nested(tree, tree.right[node])


def same(a, b):
    if len(a) == 2 or len(b) == 2:
        return a == b
    return a[0] == b[0] and a[1] == pytest.approx(b[1]) and same(a[2], b[2]) and same(a[3], b[3])


SPECS = [
    TreeSpec(), TreeSpec("entropy"), TreeSpec(min_split=30), TreeSpec(min_leaf=12), TreeSpec(max_depth=2), TreeSpec("entropy", 4, 9, 3),
    TreeSpec(left_out=0), TreeSpec("entropy", min_split=20, left_out=2),
]


@pytest.fixture(scope="module")
def sample(spark):
    draw = np.random.default_rng(8)
    x = np.stack([draw.integers(0, 12, 240), draw.integers(0, 7, 240) / 4, draw.integers(-5, 30, 240)], axis=1).astype(float)
    y = ((x[:, 0] > 5) ^ (x[:, 2] > 14) ^ (draw.random(240) < 0.15)).astype(int)
    fold = np.arange(240) % 3
    df = spark.createDataFrame([(*map(float, r), int(c), int(f)) for r, c, f in zip(x, y, fold, strict=True)], "a double, b double, c double, y int, fold int")
    return x, y, fold, df.repartition(5)


def test_trees_equal_a_plain_recursion(sample, monkeypatch):
    x, y, fold, df = sample
    monkeypatch.setattr(tree_growth, "HELD_COUNTS", 64)
    for spec, tree in zip(SPECS, grow_trees(df, ["a", "b", "c"], "y", SPECS, "fold"), strict=True):
        used = fold != spec.left_out
        assert same(nested(tree), plain(x[used], y[used], spec)), spec


def test_depth_beyond_thirty(spark):
    """Alternating classes over one feature take a split a value; unlimited growth goes as deep as it must."""
    values = [(float(i), i % 2) for i in range(90) for _ in range(1 if i % 2 else 3)]
    df = spark.createDataFrame(values, "a double, y int")
    deep, cut = grow_trees(df, ["a"], "y", [TreeSpec(), TreeSpec(max_depth=31)], max_bins=128)
    assert max(deep.depth) > 31 >= max(cut.depth)
    assert (deep.predict(np.array([[v] for v, _ in values])) == np.array([c for _, c in values])).all()


def test_missing_values_go_right_and_quantile_bins(spark):
    rows = [(float(i), int(i >= 500)) for i in range(1000)] + [(None, 0)] * 50 + [(math.nan, 0)] * 50 + [(3.0, None)]
    df = spark.createDataFrame(rows, "a double, y int")
    tree = grow_trees(df, ["a"], "y", [TreeSpec()], max_bins=8)[0]
    judged = {(r["a"] is None or math.isnan(r["a"]), r["p"], r["y"]) for r in with_predictions(df.where("y is not null"), ["a"], {"p": tree}).collect()}
    assert (True, 0.0, 0) in judged and (True, 1.0, 0) not in judged
    assert tree.predict(np.array([[10.0], [990.0], [np.nan]])).tolist() == [0, 1, 0]


def test_no_rows_one_class_and_constant_features(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (1.0, 1)], "a double, y int")
    assert nested(grow_trees(df, ["a"], "y", [TreeSpec()])[0]) == (1, 2)
    assert grow_trees(df.where("y = 1"), ["a"], "y", [TreeSpec()])[0].predict(np.array([[5.0]])).tolist() == [1]
    assert grow_trees(df.where("y = 7"), ["a"], "y", [TreeSpec()])[0].predict(np.array([[5.0]])).tolist() == [0]


def test_saved_trees_come_back(spark, sample, tmp_path):
    tree = grow_trees(sample[3], ["a", "b", "c"], "y", [TreeSpec(max_depth=4)])[0]
    save_tree(spark, tree, str(tmp_path / "tree"))
    assert load_tree(spark, str(tmp_path / "tree")) == tree


def test_a_level_of_all_trees_is_one_pass(spark, sample, monkeypatch):
    passes = []
    counted = tree_growth._counted
    monkeypatch.setattr(tree_growth, "_counted", lambda *a: passes.append(sum(map(bool, a[2]))) or counted(*a))
    trees = grow_trees(sample[3], ["a", "b", "c"], "y", SPECS, "fold")
    assert len(passes) <= max(max(t.depth) for t in trees) + 1 and passes[0] == len(SPECS)
