"""Typing, projection and rule-based outlier removal of sensor readings."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge import schemas
from fieldgauge.functions.evaluation_order import computed_once
from fieldgauge.functions.scalars import nan_to_null, strict_cast

# Bounds of plausible readings per class.
OUTLIER_RULES = {
    0: [("Temperature", "<", 22), ("CO2", "<", 720)],
    1: [("Temperature", ">", 21), ("Temperature", "<", 23.1), ("CO2", "<", 1550)],
}

COMPARISONS = {
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "==": operator.eq,
}


def cast_columns(df: DataFrame, types: dict[str, str], on_error: str = "fail") -> DataFrame:
    """Cast the listed columns. A value that does not convert fails the job, or becomes NULL."""
    if on_error not in ("fail", "null"):
        raise ValueError("on_error is 'fail' or 'null'")

    def converted(name: str, target: str) -> Column:
        column = F.col(name)
        result = strict_cast(column, name, target) if on_error == "fail" else column.try_cast(target)
        return nan_to_null(result) if target in ("double", "float") else result

    return df.withColumns({name: converted(name, target) for name, target in types.items()})


def cast_rejects(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Rows with a value that does not convert, with the names of the columns at fault."""
    faults = [
        F.when(F.col(n).isNotNull() & F.col(n).try_cast(t).isNull(), F.lit(n)) for n, t in types.items()
    ]
    listed = computed_once(df, {"bad_columns": F.array_compact(F.array(*faults))})
    return listed.where(F.size("bad_columns") > 0)


def parse_event_time(df: DataFrame, column: str = schemas.EVENT_TIME, pattern: str = schemas.TIME_FORMAT) -> DataFrame:
    """Text to a timestamp without a zone, as the files carry none; unparsable text fails."""
    text = F.col(column)
    parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    message = F.concat(F.lit(f"cannot parse {column}: "), text)
    failed = text.isNotNull() & parsed.isNull()
    return df.withColumn(column, F.when(failed, F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed))


def type_silver(df: DataFrame) -> DataFrame:
    """Raw text columns to the types of the silver table."""
    return parse_event_time(cast_columns(df, schemas.SILVER_TYPES))


def rule_predicate(rules: dict[int, list[tuple]], label: str = schemas.LABEL) -> Column:
    """One predicate for all classes: a row must meet every bound of its own class."""

    def of_class(value: int, bounds: list[tuple]) -> Column:
        parts = [COMPARISONS[op](F.col(name), F.lit(bound)) for name, op, bound in bounds]
        return reduce(lambda a, b: a & b, [F.col(label) == value, *parts])

    return reduce(lambda a, b: a | b, [of_class(v, bounds) for v, bounds in rules.items()])


def remove_outliers(
    df: DataFrame,
    rules: dict[int, list[tuple]] | None = None,
    label: str = schemas.LABEL,
    keep: list[str] | None = None,
) -> DataFrame:
    """Gold rows: the per-class filters and their union in one pass over the table.

    The classes exclude each other, so a disjunction gives the same bag as the union of the
    filtered classes and reads the input once. ``keep`` names extra columns to carry along,
    such as the event time that orders the surrogate key.
    """
    wanted = [*(keep or []), *schemas.GOLD_COLUMNS]
    return df.where(rule_predicate(rules or OUTLIER_RULES, label)).select(*wanted)


def class_rows(df: DataFrame, value: int, rules: dict[int, list[tuple]] | None = None) -> DataFrame:
    """Gold rows of one class."""
    rules = rules or OUTLIER_RULES
    return remove_outliers(df, {value: rules[value]})


def union_by_name(*parts: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing from one part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
