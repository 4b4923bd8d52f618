"""Decision tree training, tuning, evaluation and batch scoring."""

from __future__ import annotations

import random
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fieldgauge import schemas
from fieldgauge.operators.evaluation import best_trial, binary_metrics, mean_fold_metrics
from fieldgauge.operators.features import scaler_statistics
from fieldgauge.operators.splits import with_stratified_folds
from fieldgauge.operators.tree_growth import MAX_BINS, Tree, TreeSpec, grow_trees, load_tree, matrix, save_tree, with_predictions
from fieldgauge.session import fresh_path

# functions that run in tasks travel with the task, so that executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLD = "fold"
PREDICTION = "prediction"

# Settings of the single training run.
TREE_SETTINGS = {"impurity": "gini", "maxDepth": 50, "minSplit": 20, "minLeaf": 5}

# Search space and budget. A depth is unlimited in half of the trials.
IMPURITIES = ["gini", "entropy"]
DEPTH_RANGE = (5, 50)
SPLIT_RANGE = (2, 40)
LEAF_RANGE = (1, 20)
TRIALS = 10
FOLDS = 5
SEED = 42


def spec(settings: dict, left_out: int | None = None) -> TreeSpec:
    return TreeSpec(settings["impurity"], settings["maxDepth"], settings["minSplit"], settings["minLeaf"], left_out)


@dataclass
class ScaledTree:
    """Scaler and tree, saved together, so that scoring does what training did."""

    scaler: PipelineModel
    tree: Tree
    features: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        names = _scaled(self.features)
        return with_predictions(self.scaler.transform(df), names, {PREDICTION: self.tree}).drop(*names)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.scaler.write().overwrite().save(f"{path}/scaler")
        save_tree(spark, self.tree, f"{path}/tree")
        spark.createDataFrame([(i, f) for i, f in enumerate(self.features)], "place int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")

    @staticmethod
    def load(path: str) -> ScaledTree:
        spark = SparkSession.getActiveSession()
        features = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("place").collect()]
        return ScaledTree(PipelineModel.load(f"{path}/scaler"), load_tree(spark, f"{path}/tree"), features)


@dataclass
class TunedModel:
    """Refitted model, (params, metric, value) rows of all trials, and the name of the best."""

    model: ScaledTree
    trials: DataFrame
    best: str


def _scaled(features: list[str]) -> list[str]:
    return [f"__s_{f}" for f in features]


def scaler(train: DataFrame, features: list[str]) -> PipelineModel:
    """Scale by the training rows' mean and population deviation. The driver gets one row per feature."""
    fitted = {r["column"]: r for r in scaler_statistics(train, features).collect()}

    def scaled(name: str) -> str:
        mean, deviation = fitted[name]["mean"] or 0.0, fitted[name]["std"] or 1.0
        return f"(CAST(`{name}` AS DOUBLE) - {mean!r}D) / {deviation!r}D AS `__s_{name}`"

    return PipelineModel([SQLTransformer(statement=f"SELECT *, {', '.join(scaled(f) for f in features)} FROM __THIS__")])


def bounded_rows(train: DataFrame, max_rows: int | None) -> DataFrame:
    """About ``max_rows`` of the rows, for a tree whose size must not follow the table; all if unset."""
    if max_rows is None:
        return train
    return train.sample(min(1.0, max_rows / max(1, train.count())), seed=SEED)


def train_tree(
    train: DataFrame,
    settings: dict | None = None,
    max_bins: int = MAX_BINS,
    max_rows: int | None = None,
    label: str = schemas.LABEL,
    features: list[str] | None = None,
) -> ScaledTree:
    """Fit scaler and tree on the training rows.

    ``max_bins`` bounds the thresholds tried for a feature: one of no more distinct values is split
    anywhere between them. ``max_rows`` bounds the rows the tree is fitted on: a fitted tree lives
    on the driver and grows with its rows, so set it where the table is large.
    """
    features = features or schemas.TRAINING_FEATURES
    rows = bounded_rows(train, max_rows)
    ready = scaler(rows, features)
    tree = grow_trees(ready.transform(rows), _scaled(features), label, [spec(settings or TREE_SETTINGS)], max_bins=max_bins)[0]
    return ScaledTree(ready, tree, features)


def random_trials(n: int = TRIALS, seed: int = SEED) -> list[dict]:
    """Seeded random points of the search space."""
    draw = random.Random(seed)
    points = []
    for _ in range(n):
        unlimited = draw.random() < 0.5
        points.append(
            {
                "impurity": draw.choice(IMPURITIES),
                "maxDepth": None if unlimited else draw.randint(*DEPTH_RANGE),
                "minSplit": draw.randint(*SPLIT_RANGE),
                "minLeaf": draw.randint(*LEAF_RANGE),
            }
        )
    return points


def trial_name(index: int, point: dict) -> str:
    settings = ",".join(f"{k}={v}" for k, v in sorted(point.items()))
    return f"{index:02d}:{settings}"


def tune_tree(
    train: DataFrame,
    points: list[dict] | None = None,
    folds: int = FOLDS,
    label: str = schemas.LABEL,
    key: str = schemas.KEY,
    max_bins: int = MAX_BINS,
    max_rows: int | None = None,
    features: list[str] | None = None,
) -> TunedModel:
    """Cross-validate the points on stratified folds and refit the one of best mean F1.

    The trees of all points and folds grow together: a level of all of them is one pass over the
    rows, so the passes follow the depth and not the number of trees. Held-out rows of a fold are
    judged by the trees of all points at once. The driver gets the trial rows and the trees.
    """
    points, features = points or random_trials(), features or schemas.TRAINING_FEATURES
    names = [trial_name(i, p) for i, p in enumerate(points)]
    train = bounded_rows(train, max_rows)
    ready = scaler(train, features)
    columns = _scaled(features)
    folder = fresh_path(train.sparkSession, "folded")
    with_stratified_folds(ready.transform(train), label, key, folds).select(*columns, label, FOLD).write.parquet(folder)
    folded = train.sparkSession.read.parquet(folder)
    jobs = [(i, fold) for i in range(len(points)) for fold in range(folds)]
    trees = dict(zip(jobs, grow_trees(folded, columns, label, [spec(points[i], fold) for i, fold in jobs], FOLD, max_bins), strict=True))
    judged = _judged_folds(folded, columns, trees, names, folds, label)
    path = fresh_path(train.sparkSession, "trials")
    mean_fold_metrics(binary_metrics(judged, label, PREDICTION, ["params", FOLD])).write.parquet(path)
    trials = train.sparkSession.read.parquet(path)
    best = best_trial(trials).first()["params"]
    tree = grow_trees(folded, columns, label, [spec(points[names.index(best)])], max_bins=max_bins)[0]
    return TunedModel(ScaledTree(ready, tree, features), trials, best)


def _judged_folds(folded: DataFrame, columns: list[str], trees: dict[tuple[int, int], Tree], names: list[str], folds: int, label: str) -> DataFrame:
    """(params, fold, label, prediction): one pass over the rows applies the trees that left their fold out."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fold = matrix([batch.column(c) for c in columns]), batch.column(FOLD).to_numpy()
            for i, name in enumerate(names):
                told = np.zeros(len(fold))
                for f in range(folds):
                    told[fold == f] = trees[i, f].predict(x[fold == f])
                answers = [pa.array([name] * len(fold), pa.string()), batch.column(FOLD), batch.column(label), pa.array(told)]
                yield pa.RecordBatch.from_arrays(answers, names=["params", FOLD, label, PREDICTION])

    schema = StructType([StructField("params", StringType()), folded.schema[FOLD], folded.schema[label], StructField(PREDICTION, DoubleType())])
    return folded.mapInArrow(judge, schema)


def score(df: DataFrame, model: ScaledTree, keep: list[str] | None = None) -> DataFrame:
    """Add the int ``prediction`` to the rows, or to the listed columns of them."""
    wanted = keep or df.columns
    return model.transform(df).select(*wanted, F.col(PREDICTION).cast("int").alias(PREDICTION))


def evaluate(df: DataFrame, model: ScaledTree, label: str = schemas.LABEL) -> DataFrame:
    """(metric, value) of a model on labelled rows."""
    return binary_metrics(score(df, model, [label]), label, PREDICTION)
