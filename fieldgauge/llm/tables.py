"""Reading the given tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import Column

from fieldgauge.session import fresh_path

#: Spark removes the shuffle files of a query when that query ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run meanwhile go when these end; the setting of the session is put back."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write once to the shared folder and go on from the files.

    This cuts the lineage: a lost executor costs a re-read of files, not a recomputation,
    and every later use sees the same rows. What was shuffled for it is of no use once it is
    written, and is removed.
    """
    path = fresh_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing will read again."""
    for table in tables:
        jvm, jsc = table.sparkSession._jvm, table.sparkSession._jsc
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, UPPER, LOWER)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, whatever other columns a table carries."""
    return df.select(*[F.col(c) for c in columns])
