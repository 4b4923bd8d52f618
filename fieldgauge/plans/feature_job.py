"""Raw files to silver, gold, feature and baseline tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from fieldgauge import schemas
from fieldgauge.operators.cleaning import remove_outliers, type_silver
from fieldgauge.operators.features import add_surrogate_key
from fieldgauge.operators.monitoring import prepare_baseline
from fieldgauge.sources.csv_files import read_readings_csv
from fieldgauge.sources.tables import overwrite_table, read_table, upsert_table


@dataclass(frozen=True)
class FeatureTables:
    silver: str = "silver"
    gold: str = "gold"
    features: str = "features"
    baseline: str = "baseline"


def run_feature_job(
    spark: SparkSession, raw_folder: str, location: str, tables: FeatureTables = FeatureTables()
) -> str:
    """Build all tables; each step reads the table the step before has written.

    Gold keeps the event time, which orders the surrogate key; the feature table drops it.
    Returns whether the feature table was created or merged.
    """
    overwrite_table(type_silver(read_readings_csv(spark, raw_folder)), tables.silver)
    gold = remove_outliers(read_table(spark, tables.silver), keep=[schemas.EVENT_TIME])
    overwrite_table(gold, tables.gold)
    # rows equal in every column are interchangeable, so this order fixes the keys
    order = [schemas.EVENT_TIME, *schemas.GOLD_COLUMNS]
    features = add_surrogate_key(read_table(spark, tables.gold), order, drop=[schemas.EVENT_TIME])
    outcome = upsert_table(
        features,
        tables.features,
        [schemas.KEY],
        location,
        description="Sensor features by surrogate key",
        properties={"source": "gold"},
    )
    overwrite_table(prepare_baseline(read_table(spark, tables.features)), tables.baseline)
    return outcome
