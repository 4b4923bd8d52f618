"""Feature table to a trained, tuned and accepted model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldgauge import schemas
from fieldgauge.operators import gates
from fieldgauge.operators.evaluation import confusion_matrix, parameter_rows, run_rows
from fieldgauge.operators.features import training_frame
from fieldgauge.operators.modeling import TREE_SETTINGS, ScaledTree, evaluate, score, train_tree, tune_tree
from fieldgauge.operators.splits import TEST, TRAIN, VALIDATION, split_parts
from fieldgauge.sources.csv_files import read_validation_csv, write_csv
from fieldgauge.session import fresh_path
from fieldgauge.sources.tables import append_table, overwrite_table, read_table


@dataclass(frozen=True)
class TrainingPaths:
    validation: str
    model: str
    metrics_table: str = "run_metrics"
    gates_table: str = "gate_rows"
    aliases_table: str = "model_aliases"


def _log_trained(train: DataFrame, test: DataFrame, run_id: str, table: str) -> None:
    """The single run with fixed settings: parameters, test metrics and confusion matrix."""
    model = train_tree(train)
    scored = score(test, model, [schemas.LABEL])
    cells = confusion_matrix(scored).withColumn(
        "name", F.format_string("label=%d,prediction=%d", "label", "prediction")
    )
    append_table(parameter_rows(test, run_id, TREE_SETTINGS), table)
    append_table(run_rows(evaluate(test, model), run_id, "test"), table)
    append_table(run_rows(cells, run_id, "confusion", "name", "n"), table)


def run_training_job(
    spark: SparkSession,
    feature_table: str,
    paths: TrainingPaths,
    run_id: str,
    thresholds: dict[str, gates.Threshold] | None = None,
    points: list[dict] | None = None,
) -> ScaledTree:
    """Split, train, tune and judge against the champion that the alias table names, if any.

    Gate rows are stored either way. An accepted model is saved below ``paths.model`` and becomes
    the champion, and the champion before it the previous one; a rejected one raises.
    """
    parts = split_parts(training_frame(read_table(spark, feature_table)))
    write_csv(parts[VALIDATION].drop(schemas.KEY), paths.validation)
    _log_trained(parts[TRAIN], parts[TEST], run_id, paths.metrics_table)

    tuned = tune_tree(parts[TRAIN], points)
    cv = tuned.trials.select(F.concat_ws("/", "params", "metric").alias("name"), "value")
    append_table(run_rows(cv, run_id, "cv", "name"), paths.metrics_table)

    validation = read_validation_csv(spark, paths.validation)
    candidate = evaluate(validation, tuned.model)
    append_table(run_rows(candidate, run_id, "validation"), paths.metrics_table)
    aliases = model_aliases(spark, paths.aliases_table)
    named = aliases.where(F.col("alias") == gates.CHAMPION).first()  # at most one row
    if named is None:
        gate = gates.static_gate(candidate, thresholds)
    else:
        champion = ScaledTree.load(named["model"])
        gate = gates.champion_gate(candidate, evaluate(validation, champion), thresholds)
    append_table(gate.select(F.lit(run_id).alias("run_id"), "*"), paths.gates_table)
    decision = gates.gate_decision(read_table(spark, paths.gates_table).where(F.col("run_id") == run_id))
    outcome = decision.first()
    if not outcome["passed"]:
        raise RuntimeError(f"candidate rejected: {outcome['reason']}")
    place = f"{paths.model.rstrip('/')}/{run_id}"
    tuned.model.save(place)
    promoted = gates.promoted_aliases(aliases, decision, place)
    folder = fresh_path(spark, "aliases")
    promoted.write.parquet(folder)  # the table is read while its successor is computed
    overwrite_table(spark.read.parquet(folder), paths.aliases_table)
    return tuned.model


def model_aliases(spark: SparkSession, table: str) -> DataFrame:
    """(alias, model): empty before the first accepted model."""
    if spark.catalog.tableExists(table):
        return read_table(spark, table)
    return spark.createDataFrame([], "alias string, model string")
