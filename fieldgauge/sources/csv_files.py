"""CSV folders of sensor readings, whose files may differ in layout, and validation files."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fieldgauge import schemas
from fieldgauge.operators.cleaning import cast_columns
from fieldgauge.session import fresh_path

ROW_NUMBER = "_row_number"

# Texts that CSV readers for data frames take as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the files directly in a folder; their contents are not read."""
    try:
        return spark.read.format("binaryFile").load(folder).select("path", "length")
    except AnalysisException as error:
        raise FileNotFoundError(f"no such folder: {folder}") from error


def _field_count(line: Column) -> Column:
    """Comma-separated fields of a line; commas inside double quotes do not count."""
    outside = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"[^"]*"', "")).otherwise(line)
    return F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1


#: A line that names one of these columns is a header; data rows hold numbers and times.
HEADER_NAMES = schemas.GOLD_COLUMNS


def file_layouts(spark: SparkSession, folder: str, names: list[str] | None = None) -> DataFrame:
    """(path, header, width): header line and widest data row of each file.

    A header is the line that names one of the known columns, which no data row does; a file may
    lack any of them. Each map task reduces its lines to one row per file before the shuffle.
    """
    try:
        lines = spark.read.text(folder)
    except AnalysisException as error:
        raise FileNotFoundError(f"no such folder: {folder}") from error
    line = F.col("value")
    is_header = reduce(operator.or_, [F.contains(line, F.lit(n)) for n in names or HEADER_NAMES])
    return (
        lines.where(F.trim(line) != "")
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(
            F.max(F.when(is_header, line)).alias("header"),
            F.max(F.when(~is_header, _field_count(line))).alias("width"),
        )
    )


def _names(header: str, width: int | None) -> list[str]:
    names = [n.strip().strip('"') for n in header.lstrip("﻿").rstrip("\r").split(",")]
    if names and names[0] == "":
        return [ROW_NUMBER, *names[1:]]
    if width is not None and width == len(names) + 1:
        return [ROW_NUMBER, *names]  # data rows lead with a row number the header does not name
    if width is not None and width > len(names):
        raise ValueError(f"data rows have {width} fields, header names {len(names)}: {header}")
    return names


def _present(name: str, value: Column) -> Column:
    return F.when(~F.trim(value).isin(MISSING_TEXTS), value).alias(name)


def _read_uniform(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Files that all share one layout: the plain CSV reader with that schema."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).option("header", True).csv(folder)
    return rows.select(*[_present(n, F.col(f"`{n}`")) for n in names if n != ROW_NUMBER])


def _read_mixed(
    spark: SparkSession, folder: str, layouts: DataFrame, kinds: dict[tuple, list[str]]
) -> DataFrame:
    """Files of several layouts: every line is parsed with the schema of its own file."""
    every = list(dict.fromkeys(n for names in kinds.values() for n in names if n != ROW_NUMBER))
    row: Column = F.lit(None)
    for (header, width), names in kinds.items():
        fields = F.from_csv("value", ", ".join(f"`{n}` STRING" for n in names))
        aligned = F.struct(
            *[(fields[n] if n in names else F.lit(None).cast("string")).alias(n) for n in every]
        )
        mine = (F.col("header") == header) & F.col("width").eqNullSafe(F.lit(width))
        row = F.when(mine, aligned).otherwise(row)
    lines = spark.read.text(folder).select("value", F.col("_metadata.file_path").alias("path"))
    data = lines.join(layouts, "path").where((F.trim("value") != "") & (F.col("value") != F.col("header")))
    return data.select(row.alias("row")).select(*[_present(n, F.col(f"row.`{n}`")) for n in every])


def read_readings_csv(
    spark: SparkSession, folder: str, header: list[str] | None = None
) -> DataFrame:
    """All files of a folder as text columns, stacked by column name.

    Spark matches CSV fields by position, so a leading row number or another column order
    would shift values silently. A first pass therefore finds the layout of each file, and each
    line follows the layout of its file. A column that no file has is NULL. Passing ``header`` declares one layout for all files (its first name may be
    ``_row_number``) and saves the first pass.
    """
    if header is not None:
        return _read_uniform(spark, folder, header)
    found = fresh_path(spark, "csv-layouts")
    file_layouts(spark, folder).write.parquet(found)
    layouts = spark.read.parquet(found)
    distinct = layouts.select("header", "width").distinct().collect()  # one row per layout
    if not distinct or any(k["header"] is None for k in distinct):
        raise ValueError(f"every file in {folder} needs a header that names one of {HEADER_NAMES}")
    kinds = {(k["header"], k["width"]): _names(k["header"], k["width"]) for k in distinct}
    rows = _read_mixed(spark, folder, layouts, dict(sorted(kinds.items(), key=lambda k: str(k[0]))))
    missing = [c for c in (schemas.EVENT_TIME, *schemas.GOLD_COLUMNS) if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string") for c in missing})


def write_csv(df: DataFrame, path: str) -> None:
    """Replace a folder of CSV files with headers."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_validation_csv(spark: SparkSession, path: str) -> DataFrame:
    """Validation rows with their declared types; a value that does not convert fails."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in schemas.VALIDATION_TYPES])
    try:
        text = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    except AnalysisException as error:
        raise ValueError(f"cannot load validation data from {path}: {error}") from error
    return cast_columns(text, schemas.VALIDATION_TYPES)
