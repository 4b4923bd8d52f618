"""Catalog tables: readers, writers, keyed upsert and idempotent append."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldgauge.operators.features import key_violations, upsert
from fieldgauge.operators.groups import matching_keys
from fieldgauge.session import fresh_path
from fieldgauge.sources.key_filters import add_filters, days_that_may_hold, filter_table, key_filters


def read_table(spark: SparkSession, name: str, format: str | None = None) -> DataFrame:
    """A catalog table. A missing table is reported as a failed load."""
    try:
        reader = spark.read.format(format) if format else spark.read
        return reader.table(name)
    except AnalysisException as error:
        raise RuntimeError(f"cannot load table {name}: {error}") from error


def overwrite_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Replace a managed table, schema included."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    if properties:
        set_properties(df.sparkSession, name, properties)


def overwrite_partitions(df: DataFrame, name: str, partition: str) -> None:
    """Replace the partitions that ``df`` has rows for; the others stay as they are."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.write.format("parquet").partitionBy(partition).saveAsTable(name)
        return
    order = spark.read.table(name).columns
    mode = "spark.sql.sources.partitionOverwriteMode"  # an insert takes it from the session only
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*order).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def drop_partitions(spark: SparkSession, name: str, partition: str, values: list) -> None:
    """Remove the partitions of these values with their rows; nothing where there is none."""
    if values and spark.catalog.tableExists(name):
        listed = ", ".join(f"PARTITION ({partition} = '{v}')" for v in values)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {listed}")


def append_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def set_properties(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    pairs = ", ".join("'{}' = '{}'".format(*(x.replace("'", "\\'") for x in kv)) for kv in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def assert_unique_key(df: DataFrame, keys: list[str]) -> None:
    """Fail if a key is NULL or repeated; at most one offending key reaches the driver."""
    found = key_violations(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"key {keys} is not unique and non-null, e.g. {found[0].asDict()}")


def upsert_table(
    source: DataFrame,
    name: str,
    keys: list[str],
    location: str,
    description: str | None = None,
    properties: dict[str, str] | None = None,
) -> str:
    """Merge the source into a keyed table, or create the table if there is none.

    The source is computed once, stored, and its key checked on the stored column. The merged
    rows go to a new folder below ``location`` and the table is then pointed at it: readers
    see the old or the new table, and nothing reads the folder being written.

    Returns ``"created"`` or ``"merged"``. Only a missing table leads to creation; any other
    failure is raised.
    """
    spark = source.sparkSession
    exists = spark.catalog.tableExists(name)
    fresh = f"{location.rstrip('/')}/{uuid.uuid4().hex}"
    folder = fresh_path(spark, "upsert-source") if exists else fresh
    source.write.parquet(folder)
    staged = spark.read.parquet(folder)
    assert_unique_key(staged, keys)
    if exists:
        merged = upsert(spark.read.table(name), staged, keys)
        merged.write.parquet(fresh)
        known = spark.read.table(name).schema.fieldNames()
        added = [f for f in merged.schema.fields if f.name not in known]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
        quoted = fresh.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
        spark.catalog.refreshTable(name)
        return "merged"
    spark.catalog.createTable(
        name, path=fresh, source="parquet", schema=staged.schema, description=description
    )
    set_properties(spark, name, {"primary_key": ",".join(keys), **(properties or {})})
    return "created"


def new_rows(batch: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the batch whose key is not stored yet; a NULL in a key equals a stored NULL."""
    stored_keys = existing.select(*[F.col(k).alias(f"__k_{k}") for k in keys]).distinct()
    return batch.join(stored_keys, matching_keys(batch, keys, "__k_"), "left_anti")


def stored_days(batch: DataFrame, name: str, keys: list[str], partition: str) -> DataFrame:
    """The stored rows of the days that may hold a key of the batch, and those without a day."""
    day = F.col(partition)
    days = days_that_may_hold(batch, name, keys, partition)
    return batch.sparkSession.read.table(name).where(day.isin(days) | day.isNull() if days else day.isNull())


def append_new_rows(batch: DataFrame, name: str, keys: list[str], partition: str | None = None) -> None:
    """Append that may be repeated: rows whose key is stored already, however long ago, are left out.

    With ``partition``, bit arrays of the stored keys (:mod:`fieldgauge.sources.key_filters`) name
    the days to compare with, so that the cost follows the batch and not the history. All rows of
    such a table must come through here.
    """
    spark = batch.sparkSession
    if not partition:
        if spark.catalog.tableExists(name):
            batch = new_rows(batch, spark.read.table(name), keys)
        append_table(batch, name)
        return
    exists = spark.catalog.tableExists(name)
    fresh = new_rows(batch, stored_days(batch, name, keys, partition), keys) if exists else batch
    folder = fresh_path(spark, "append")
    fresh.write.parquet(folder)
    staged = spark.read.schema(fresh.schema).parquet(folder)
    add_filters(key_filters(staged, spark.read.table(name) if exists else staged, keys, partition), name, partition)
    append_table(staged, name, [partition])


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table and the arrays of its keys."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {filter_table(name)}")
