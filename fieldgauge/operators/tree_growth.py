"""Decision trees grown level by level, many at a time, from one aggregation a level.

Tasks place their rows in the trees as far as they are grown and count classes by tree, open node,
feature and bin; Spark adds the counts up and finds the best split of every node. A level of all
trees is one pass over the rows, whatever the number of trees. The driver holds the trees and gets
one row for each node that is split.

A feature of at most ``max_bins`` distinct values is split half-way between two values that follow
each other in the node; one of more is binned at its quantiles and split at their upper ends. Nodes
are split while they are impure, not too deep and hold ``min_split`` rows, into parts of at least
``min_leaf``; of equally good splits the first feature and the lowest threshold are taken.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fieldgauge.operators.quantiles import distinct_values, exact_quantiles
from fieldgauge.session import fresh_path, shuffle_partitions

# functions that run in tasks travel with the task, so that executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 256
LEAF = -1
#: Counts a task keeps before it hands them on.
HELD_COUNTS = 1 << 20


@dataclass(frozen=True)
class TreeSpec:
    """How a tree is grown; rows of the fold ``left_out`` are not used. No depth means no limit."""

    impurity: str = "gini"
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    left_out: int | None = None


@dataclass
class Tree:
    """Nodes by number: feature (or LEAF), threshold (up to it goes left), children, class counts, depth."""

    classes: list[int]
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    counts: list[list[int]] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)

    def add(self, counts: list[int], depth: int) -> int:
        for column, value in zip((self.feature, self.threshold, self.left, self.right, self.counts, self.depth), (LEAF, 0.0, LEAF, LEAF, counts, depth), strict=True):
            column.append(value)
        return len(self.feature) - 1

    def places(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row; a missing value goes right."""
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        node, inner = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while len(inner := inner[feature[node[inner]] != LEAF]):
            at = node[inner]
            node[inner] = np.where(x[inner, feature[at]] <= threshold[at], left[at], right[at])
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Most frequent class of each row's leaf; the smaller one of equally frequent ones."""
        best = np.array([self.classes[int(np.argmax(c))] for c in self.counts])
        return best[self.places(x)]


def matrix(columns: list[pa.Array]) -> np.ndarray:
    """Rows of the columns as doubles, NULL as NaN."""
    return np.stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64) for c in columns], axis=1)


def _bins(rows: DataFrame, features: list[str], max_bins: int) -> tuple[list[np.ndarray], list[bool]]:
    """Upper ends of the bins of each feature, and whether a bin is one value; at most ``max_bins`` a feature reach the driver."""
    found = {r["column"]: r["n_distinct"] for r in distinct_values(rows, features).collect()}
    few = [f for f in features if found.get(f, 0) <= max_bins]
    many = [f for f in features if f not in few]
    ends = {f: np.unique([r[f] for r in rows.select(f).where(F.col(f).isNotNull()).distinct().collect()]) for f in few}
    if many:
        points = {f"q{i}": i / max_bins for i in range(1, max_bins + 1)}
        for r in exact_quantiles(rows, many, [], points).collect():
            ends[r["column"]] = np.unique([r[p] for p in points])
    return [ends[f].astype(np.float64) for f in features], [f in few for f in features]


def _counted(trees: list[Tree], specs: list[TreeSpec], open_nodes: list[list[int]], ends: list[np.ndarray], names: list[str], label: str, fold: str):
    """A task function: (tree, node, feature, bin, class counts) of its rows in open nodes."""
    classes = trees[0].classes
    width = max(len(e) for e in ends) + 1
    size = len(ends) * width * len(classes)
    columns = ["tree", "node", "feature", "bin", *[f"c{k}" for k in range(len(classes))]]

    def handed(t: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        cells, where = np.unique(keys // len(classes), return_inverse=True)
        counts = [np.bincount(where, weights=n * (keys % len(classes) == k), minlength=len(cells)).astype(np.int64) for k in range(len(classes))]
        at = [np.full(len(cells), t), np.array(open_nodes[t])[cells // (len(ends) * width)], cells // width % len(ends), cells % width]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in [*at, *counts]], names=columns)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in trees]
        place = [np.full(len(t.feature), -1) for t in trees]
        for p, nodes in zip(place, open_nodes, strict=True):
            p[nodes] = np.arange(len(nodes))
        for batch in batches:
            x = matrix([batch.column(n) for n in names])
            y = np.searchsorted(classes, batch.column(label).to_numpy())
            folds = batch.column(fold).to_numpy()
            bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(ends)], axis=1)
            cells = (np.arange(len(ends)) * width + bins) * len(classes) + y[:, None]
            for t, (tree, spec) in enumerate(zip(trees, specs, strict=True)):
                if not open_nodes[t]:
                    continue
                node = place[t][tree.places(x)]
                used = np.flatnonzero((node >= 0) & ((folds != spec.left_out) if spec.left_out is not None else True))
                keys, n = np.unique((node[used, None] * size + cells[used]).ravel(), return_counts=True)
                both, more = np.concatenate([held[t][0], keys]), np.concatenate([held[t][1], n])
                keys, where = np.unique(both, return_inverse=True)
                held[t] = keys, np.bincount(where, weights=more, minlength=len(keys)).astype(np.int64)
                if len(keys) > HELD_COUNTS // len(trees):
                    yield handed(t, *held[t])
                    held[t] = keys[:0], keys[:0]
        for t, (keys, n) in enumerate(held):
            if len(keys):
                yield handed(t, keys, n)

    return count, ", ".join(f"{c} long" for c in columns)


def _impurity(counts: list[Column], gini: Column) -> Column:
    """Rows times impurity of a part."""
    n = sum(counts[1:], counts[0])
    shares = [c / n for c in counts]
    square = F.lit(1.0) - sum((s * s for s in shares[1:]), shares[0] * shares[0])
    terms = [F.when(s > 0, s * F.log2(s)).otherwise(0.0) for s in shares]
    return n * F.when(gini, square).otherwise(-sum(terms[1:], terms[0]))


def _best_splits(cells: DataFrame, specs: list[TreeSpec], classes: int) -> DataFrame:
    """(tree, node, feature, bin, next bin, class counts on the left) of the best split of each node that has one."""
    names = [f"c{k}" for k in range(classes)]
    in_order = Window.partitionBy("tree", "node", "feature").orderBy("bin")
    whole, upto = Window.partitionBy("tree", "node", "feature"), in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = cells.select(
        "tree", "node", "feature", "bin", F.lead("bin").over(in_order).alias("next"),
        *[F.sum(c).over(upto).alias(f"l_{c}") for c in names], *[F.sum(c).over(whole).alias(f"t_{c}") for c in names],
    )
    left = [F.col(f"l_{c}") for c in names]
    right = [F.col(f"t_{c}") - F.col(f"l_{c}") for c in names]
    of_tree = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("tree") + 1).cast("int"))
    least, gini = of_tree([s.min_leaf for s in specs]), of_tree([s.impurity == "gini" for s in specs])
    allowed = F.col("next").isNotNull() & (sum(left[1:], left[0]) >= least) & (sum(right[1:], right[0]) >= least)
    rated = summed.where(allowed).withColumn("loss", _impurity(left, gini) + _impurity(right, gini))
    best = F.min(F.struct("loss", "feature", "bin", "next", *[f"l_{c}" for c in names])).alias("b")
    return rated.groupBy("tree", "node").agg(best).select("tree", "node", "b.*")


def grow_trees(
    rows: DataFrame, features: list[str], label: str, specs: list[TreeSpec], fold: str | None = None, max_bins: int = MAX_BINS
) -> list[Tree]:
    """A tree for each spec. Rows without a label are left out; a missing value is above all others.

    The rows are stored once with the columns needed; each level of all trees reads them once.
    Without rows, trees predict 0; without a split that the spec allows, a tree is one leaf.
    """
    spark = rows.sparkSession
    names = [f"x{i}" for i in range(len(features))]
    numbers = [F.col(f).cast("double") for f in features]
    inputs = [F.when(~F.isnan(x), x).alias(n) for x, n in zip(numbers, names, strict=True)]  # NaN is missing, as NULL is
    ready = rows.where(F.col(label).isNotNull()).select(*inputs, F.col(label).cast("long").alias("y"), (F.col(fold) if fold else F.lit(-1)).cast("long").alias("fold"))
    folder = fresh_path(spark, "grow")
    ready.repartition(shuffle_partitions(spark)).write.parquet(folder)
    ready = spark.read.schema(ready.schema).parquet(folder)
    totals = {(r["fold"], r["y"]): r["n"] for r in ready.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}  # a row a fold and class
    classes = sorted({y for _, y in totals}) or [0]
    trees = [Tree(classes) for _ in specs]
    for tree, spec in zip(trees, specs, strict=True):
        tree.add([sum(n for (f, y), n in totals.items() if y == c and f != spec.left_out) for c in classes], 0)
    ends, single = _bins(ready, names, max_bins)
    open_nodes = [[0] if _open(t, 0, s) else [] for t, s in zip(trees, specs, strict=True)]
    while any(open_nodes) and any(len(e) for e in ends):
        task, schema = _counted(trees, specs, open_nodes, ends, names, "y", "fold")
        sums = [F.sum(f"c{k}").alias(f"c{k}") for k in range(len(classes))]
        cells = ready.mapInArrow(task, schema).groupBy("tree", "node", "feature", "bin").agg(*sums)
        found = _best_splits(cells, specs, len(classes)).collect()  # a row for each node that is split
        open_nodes = [[] for _ in trees]
        for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
            tree, node, f = trees[r["tree"]], r["node"], r["feature"]
            low = float(ends[f][r["bin"]])
            middle = (low + float(ends[f][r["next"]])) / 2 if single[f] and r["next"] < len(ends[f]) else low
            tree.feature[node], tree.threshold[node] = f, middle if middle < float(ends[f][min(r["next"], len(ends[f]) - 1)]) else low
            here = [r[f"l_c{k}"] for k in range(len(classes))]
            other = [a - b for a, b in zip(tree.counts[node], here, strict=True)]
            tree.left[node], tree.right[node] = (tree.add(c, tree.depth[node] + 1) for c in (here, other))
            open_nodes[r["tree"]] += [n for n in (tree.left[node], tree.right[node]) if _open(tree, n, specs[r["tree"]])]
    return trees


def _open(tree: Tree, node: int, spec: TreeSpec) -> bool:
    counts = tree.counts[node]
    deep = spec.max_depth is not None and tree.depth[node] >= spec.max_depth
    return not deep and sum(counts) >= spec.min_split and sum(c > 0 for c in counts) > 1


def with_predictions(df: DataFrame, features: list[str], trees: dict[str, Tree]) -> DataFrame:
    """The predicted class of each tree as a double column of its name; the trees travel with the task."""

    def judge(tree: Tree):
        def predict(*columns: pd.Series) -> pd.Series:
            return pd.Series(tree.predict(np.stack([c.to_numpy(dtype=np.float64) for c in columns], axis=1)).astype(np.float64))

        return F.pandas_udf(predict, "double")(*[F.col(f).cast("double") for f in features])

    return df.withColumns({name: judge(tree) for name, tree in trees.items()})


def save_tree(spark: SparkSession, tree: Tree, path: str) -> None:
    """One row a node."""
    nodes = list(zip(range(len(tree.feature)), tree.feature, tree.threshold, tree.left, tree.right, tree.counts, tree.depth, [tree.classes] * len(tree.feature), strict=True))
    schema = "node int, feature int, threshold double, left int, right int, counts array<long>, depth int, classes array<long>"
    spark.createDataFrame(nodes, schema).coalesce(1).write.mode("overwrite").parquet(path)


def load_tree(spark: SparkSession, path: str) -> Tree:
    nodes = spark.read.parquet(path).orderBy("node").collect()
    columns = [[r[c] for r in nodes] for c in ("feature", "threshold", "left", "right", "counts", "depth")]
    return Tree(list(nodes[0]["classes"]), *columns)
