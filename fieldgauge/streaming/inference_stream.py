"""The inference-log transform and the window profile as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from fieldgauge import schemas
from fieldgauge.operators.groups import with_group_stats
from fieldgauge.operators.inference_log import REQUEST_KEY, successful, unpack_positions
from fieldgauge.operators.monitoring import KEYS, WINDOW_LENGTH, with_window
from fieldgauge.operators.quantiles import QUARTILES, quantiles_of_counts
from fieldgauge.sources.requests import append_positions

LATENESS = "1 day"
BATCH = "batch_id"


def read_payload_stream(
    spark: SparkSession, folder: str, schema: StructType = schemas.PAYLOAD_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


def without_repeats(payload: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Successful requests without those logged again within the lateness.

    Failed attempts go first, so that a successful retry is not taken for a repeat of them. State
    older than the lateness is released. A request that arrives later than the lateness is dropped as well. Where none may be lost,
    leave this out: ``unpack_stream`` stores a repeated request only once by itself.
    """
    timed = successful(payload).withColumn("__at", F.timestamp_millis("timestamp_ms")).withWatermark("__at", lateness)
    return timed.dropDuplicatesWithinWatermark([REQUEST_KEY]).drop("__at")


def unpack_stream(
    payload: DataFrame, clean_table: str, reject_table: str, checkpoint: str
) -> DataStreamWriter:
    """Writer that appends unpacked rows and rejects batch by batch.

    A batch that is repeated after a failure finds its rows stored and adds none twice.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        append_positions(unpack_positions(successful(batch), len(schemas.MODEL_INPUTS)), clean_table, reject_table)

    return (
        payload.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )


def window_profile_stream(
    log: DataFrame,
    columns: list[str],
    folder: str,
    checkpoint: str,
    length: str = WINDOW_LENGTH,
) -> DataStreamWriter:
    """Writer that stores the value counts of each batch by window, model and column.

    Counts of one window add up over batches, so a row that comes late, by however long, joins
    its window: there is no state and no watermark that could drop it. A batch replaces only its
    own folder, so a repeat leaves the same files.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
        long = with_window(batch, length).select(*KEYS, F.inline(F.array(*cells)))
        counts = long.groupBy(*KEYS, "column", "value").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")

    return (
        log.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )


def latest_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Current profile of all windows, as ``window_profile`` gives it over the rows seen so far."""
    group = [*KEYS, "column"]
    merged = spark.read.parquet(folder).groupBy(*group, "value").agg(F.sum("n").alias("n"))
    value, n = F.col("value"), F.col("n")
    present = F.when(value.isNotNull(), n)
    means = merged.groupBy(*group).agg(
        F.coalesce(F.sum(present), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("nulls"),
        (F.sum(value * n) / F.nullif(F.sum(present), F.lit(0))).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    counts = merged.where(value.isNotNull())
    off = F.pow(value - F.col("mean"), F.lit(2.0)) * n
    spread = with_group_stats(counts, means.select(*group, "mean"), group).groupBy(*group).agg(F.sum(off).alias("squares"))
    ranks = quantiles_of_counts(counts, KEYS).select(*group, "n_distinct", *QUARTILES)
    joined = with_group_stats(with_group_stats(means, spread, group, "left"), ranks, group, "left")
    deviation = F.when(F.col("rows") > 1, F.sqrt(F.col("squares") / (F.col("rows") - 1)))
    return joined.select(
        *group, F.col("rows").alias("n"), "nulls", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        "mean", deviation.alias("std"), "min", *QUARTILES, "max",
    )
