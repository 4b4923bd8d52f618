"""Session helpers: the shared scratch folder and the settings results depend on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone so that days and epoch values mean the same everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Where the setting is missing, a folder below the warehouse is used: the one other place
    that every executor of a session can write to and read from.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    return (configured or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
