"""Column expressions shared by the operators. All stay on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000


def nan_to_null(column: Column) -> Column:
    """Missing readings as NULL: NaN would sort above, and compare greater than, everything."""
    return F.when(~F.isnan(column), column)


def strict_cast(column: Column, name: str, target: str) -> Column:
    """Cast that fails on a value it cannot convert, whether or not ANSI mode is on."""
    cast = column.try_cast(target)
    message = F.concat(F.lit(f"cannot cast {name} to {target}: "), column.cast("string"))
    return F.when(column.isNotNull() & cast.isNull(), F.raise_error(message).cast(target)).otherwise(cast)


def epoch_millis_to_timestamp(column: Column, whole_seconds: bool = False) -> Column:
    """Epoch milliseconds to a timestamp; ``whole_seconds`` cuts the fraction off."""
    moment = F.timestamp_millis(column)
    return F.date_trunc("second", moment) if whole_seconds else moment


def standardized(column: Column, mean: Column, deviation: Column) -> Column:
    """(x - mean) / deviation; a constant column divides by one instead of zero."""
    return (column - mean) / F.when(deviation == 0, 1.0).otherwise(deviation)


def key_hash(*columns: Column) -> Column:
    """Hex digest of a row key: the same pseudo-random order in every run and engine."""
    text = [c.cast("string") for c in columns]
    return F.md5(text[0] if len(text) == 1 else F.concat_ws("|", *text))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two counts as a double, 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    )
