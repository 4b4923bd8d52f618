"""Storing unpacked requests: clean rows and rejects from one pass over the bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fieldgauge.operators.inference_log import POSITION, REQUEST_KEY, split_positions
from fieldgauge.session import fresh_path
from fieldgauge.sources.tables import append_new_rows


def append_positions(positions: DataFrame, clean_table: str, reject_table: str) -> None:
    """Append the requests of ``positions`` that the tables do not hold yet.

    A request is one key: if its id is stored, on whatever day, none of its
    rows is added, so a retry with another body cannot mix with the first one.
    """
    spark = positions.sparkSession
    folder = fresh_path(spark, "positions")
    positions.write.parquet(folder)
    stored = spark.read.schema(positions.schema).parquet(folder)
    clean, rejects = split_positions(stored)
    append_new_rows(clean, clean_table, [REQUEST_KEY], "date")
    append_new_rows(rejects, reject_table, [REQUEST_KEY, POSITION, "reason"], "date")
