"""Joining a table back to statistics of its own groups."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

def matching_keys(left: DataFrame, keys: list[str], prefix: str) -> Column:
    """``key = <prefix>key`` for all keys, NULL-safe for those that may be NULL."""
    optional = {f.name: f.nullable for f in left.schema.fields}
    parts = [
        F.col(k).eqNullSafe(F.col(prefix + k)) if optional[k] else F.col(k) == F.col(prefix + k) for k in keys
    ]
    return reduce(operator.and_, parts)


def with_group_stats(
    df: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Attach the one row of ``stats`` per group to the rows of ``df``.

    Spark chooses the join from the sizes it meets; adaptive execution broadcasts few groups and
    splits the partition of a hot one.
    """
    renamed = stats.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in stats.columns if c not in keys]
    )
    return df.join(renamed, matching_keys(df, keys, "__k_"), how).drop(*[f"__k_{k}" for k in keys])
