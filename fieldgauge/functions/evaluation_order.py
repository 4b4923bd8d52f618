"""Keeping a costly expression from being evaluated more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns like ``withColumns``, as the output of a one-row generator.

    A filter on a projected column is pushed below the projection with the expression
    copied into it, so a parsed JSON body would be parsed again for every condition on it.
    Conditions on generated columns stay above the generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
