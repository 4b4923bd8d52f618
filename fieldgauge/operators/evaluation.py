"""Binary classification metrics from label and prediction columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge import schemas
from fieldgauge.functions.scalars import safe_ratio

METRICS = ["accuracy", "precision", "recall", "f1"]
# Row and column order of the confusion matrix.
LABEL_ORDER = [1, 0]


def confusion_matrix(
    df: DataFrame,
    label: str = schemas.LABEL,
    prediction: str = "prediction",
    order: list[int] | None = None,
) -> DataFrame:
    """(row, label, prediction, n) for every cell, empty ones included, in one aggregation."""
    order = order or LABEL_ORDER
    cells = [(a, p) for a in order for p in order]
    wide = df.agg(
        *[
            F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"n__{i}")
            for i, (a, p) in enumerate(cells)
        ]
    )
    entries = [
        F.struct(
            F.lit(i).alias("cell"), F.lit(a).alias("label"), F.lit(p).alias("prediction"),
            F.col(f"n__{i}").alias("n"),
        )
        for i, (a, p) in enumerate(cells)
    ]
    return wide.select(F.inline(F.array(*entries)))


def metric_columns(label: str, prediction: str, positive: int = 1) -> dict[str, Column]:
    """Aggregates for accuracy, precision, recall and F1; a ratio without cases is 0."""
    actual, predicted = F.col(label) == positive, F.col(prediction) == positive
    hits = F.count_if(actual & predicted)
    return {
        "accuracy": safe_ratio(F.count_if(F.col(label) == F.col(prediction)), F.count(F.lit(1))),
        "precision": safe_ratio(hits, F.count_if(predicted)),
        "recall": safe_ratio(hits, F.count_if(actual)),
        "f1": safe_ratio(2 * hits, F.count_if(predicted) + F.count_if(actual)),
    }


def binary_metrics(
    df: DataFrame,
    label: str = schemas.LABEL,
    prediction: str = "prediction",
    by: list[str] | None = None,
) -> DataFrame:
    """(by, metric, value) from one aggregation with map-side combine."""
    by = by or []
    wide = df.groupBy(*by).agg(*[c.alias(m) for m, c in metric_columns(label, prediction).items()])
    entries = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]
    return wide.select(*by, F.inline(F.array(*entries)))


def mean_fold_metrics(fold_metrics: DataFrame, trial: str = "params") -> DataFrame:
    """(trial, metric, value): mean over the folds of each trial."""
    return fold_metrics.groupBy(trial, "metric").agg(F.avg("value").alias("value"))


def trial_losses(mean_metrics: DataFrame, trial: str = "params", metric: str = "f1") -> DataFrame:
    """(trial, loss): the score to maximise, negated."""
    return mean_metrics.where(F.col("metric") == metric).select(trial, (-F.col("value")).alias("loss"))


def best_trial(mean_metrics: DataFrame, trial: str = "params", metric: str = "f1") -> DataFrame:
    """The trial of least loss; the smaller name wins a tie."""
    return trial_losses(mean_metrics, trial, metric).orderBy("loss", trial).limit(1)


def run_rows(values: DataFrame, run_id: str, kind: str, name: str = "metric", value: str = "value") -> DataFrame:
    """Numbers of a run in the shape of the run-metrics table."""
    return values.select(
        F.lit(run_id).alias("run_id"),
        F.lit(kind).alias("kind"),
        F.col(name).alias("name"),
        F.col(value).cast("double").alias("value"),
        F.lit(None).cast("string").alias("text"),
        F.current_timestamp().alias("ts"),
    )


def parameter_rows(anchor: DataFrame, run_id: str, parameters: dict[str, object]) -> DataFrame:
    """Parameters of a run in the same shape; ``anchor`` only lends its session."""
    rows = [
        (run_id, "param", n, float(v) if isinstance(v, (int, float)) else None, str(v), None)
        for n, v in parameters.items()
    ]
    return anchor.sparkSession.createDataFrame(rows, schemas.RUN_METRICS_SCHEMA).withColumn(
        "ts", F.current_timestamp()
    )
