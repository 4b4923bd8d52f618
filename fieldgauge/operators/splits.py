"""Reproducible train / validation / test splits and stratified folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldgauge import schemas
from fieldgauge.functions.scalars import key_hash
from fieldgauge.operators.ordering import number_rows

TRAIN, VALIDATION, TEST = "train", "validation", "test"

# Hold-out shares of the two successive splits.
TEST_SHARE = 0.2
VALIDATION_SHARE = 0.2

HEX_SPACE = 16**4


def _hex(share: float) -> str:
    return format(int(share * HEX_SPACE), "04x")


def split_of(key: Column, test: float = TEST_SHARE, validation: float = VALIDATION_SHARE) -> Column:
    """Split name of a key from its hash: no shuffle, and the same answer in any engine."""
    prefix = F.substring(key_hash(key), 1, 4)
    return (
        F.when(prefix < _hex((1 - test) * (1 - validation)), TRAIN)
        .when(prefix < _hex(1 - test), VALIDATION)
        .otherwise(TEST)
    )


def with_split(df: DataFrame, key: str = schemas.KEY, exact: bool = False) -> DataFrame:
    """Add ``split``. ``exact`` gives exact sizes, rounding each hold-out up, at one shuffle."""
    if not exact:
        return df.withColumn("split", split_of(F.col(key)))
    ranked = number_rows(df.withColumn("__hash", key_hash(F.col(key))), ["__hash", key], "__rank")
    rows = F.col("total___rank")
    n_test = F.ceil(rows * TEST_SHARE)
    n_validation = F.ceil((rows - n_test) * VALIDATION_SHARE)
    name = (
        F.when(F.col("__rank") <= n_test, TEST)
        .when(F.col("__rank") <= n_test + n_validation, VALIDATION)
        .otherwise(TRAIN)
    )
    return ranked.withColumn("split", name).drop("__hash", "__rank", "total___rank")


def split_parts(df: DataFrame, key: str = schemas.KEY, exact: bool = False) -> dict[str, DataFrame]:
    tagged = with_split(df, key, exact)
    return {s: tagged.where(F.col("split") == s).drop("split") for s in (TRAIN, VALIDATION, TEST)}


def with_stratified_folds(
    df: DataFrame, label: str = schemas.LABEL, key: str = schemas.KEY, folds: int = 5
) -> DataFrame:
    """Add ``fold`` 0..folds-1: rows of a class are dealt out in hash order.

    Class sizes in two folds differ by at most one. A class is numbered in range partitions,
    so a dominant class does not land in one task.
    """
    hashed = df.withColumn("__hash", key_hash(F.col(key)))
    ranked = number_rows(hashed, ["__hash", key], "__rank", [label])
    return ranked.withColumn("fold", (F.col("__rank") % folds).cast("int")).drop(
        "__hash", "__rank", "total___rank"
    )
