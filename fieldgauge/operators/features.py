"""Feature table: surrogate key, keyed upsert, lookup and scaling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fieldgauge import schemas
from fieldgauge.functions.scalars import standardized
from fieldgauge.operators.descriptive import long_rows
from fieldgauge.operators.ordering import number_rows


def add_surrogate_key(
    df: DataFrame,
    order_by: list[str],
    key: str = schemas.KEY,
    partitions: int | None = None,
    drop: list[str] | None = None,
) -> DataFrame:
    """Dense key 1..n as the first column, following a declared unique order.

    The same rows get the same keys in every run, whatever their physical order. The order may
    use columns of any sortable type, NULLs included.
    """
    numbered = number_rows(df, order_by, key, partitions=partitions)
    kept = [c for c in df.columns if c not in (drop or [])]
    return numbered.select(key, *kept)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are NULL or occur more than once, with their row counts."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(missing | (F.col("n") > 1))
    )


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after merging the source: its rows replace those with the same key.

    Columns that only one side has are NULL on the other.
    """
    return target.join(source.select(*keys), keys, "left_anti").unionByName(
        source, allowMissingColumns=True
    )


def feature_lookup(
    base: DataFrame,
    features: DataFrame,
    key: str,
    names: list[str],
    rename: dict[str, str] | None = None,
    exclude: list[str] | None = None,
) -> DataFrame:
    """Left join of the chosen feature columns, renamed, minus the excluded columns.

    The key is unique in the feature table, so no key can grow hot; the join strategy is left
    to Spark because both sides grow with the data.
    """
    rename = rename or {}
    picked = features.select(key, *[F.col(n).alias(rename.get(n, n)) for n in names])
    clash = [c for c in picked.columns if c != key and c in base.columns]
    return base.drop(*clash).join(picked, key, "left").drop(*(exclude or []))


def training_frame(base: DataFrame, features: DataFrame | None = None) -> DataFrame:
    """Model inputs under their training names, plus the label.

    Without ``features`` the base is the feature table itself and the lookup is a rename.
    """
    if features is None:
        renamed = base.withColumnsRenamed(schemas.TRAINING_NAMES)
    else:
        renamed = feature_lookup(
            base, features, schemas.KEY, schemas.MODEL_INPUTS, schemas.TRAINING_NAMES, ["Humidity"]
        )
    return renamed.select(schemas.KEY, *schemas.TRAINING_FEATURES, schemas.LABEL)


def scaler_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, std): mean and population deviation per feature."""
    measures = {"mean": F.avg, "std": F.stddev_pop}
    wide = df.agg(*[f(c).alias(f"{m}__{c}") for c in columns for m, f in measures.items()])
    return long_rows(wide, [], columns, list(measures))


def standardize(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace each column by (x - mean) / population deviation of ``fit_on``."""
    fitted = (df if fit_on is None else fit_on).agg(
        F.struct(
            *[F.avg(c).alias(f"mean__{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"std__{c}") for c in columns],
        )
    ).scalar()
    return df.withColumns(
        {c: standardized(F.col(c), fitted[f"mean__{c}"], fitted[f"std__{c}"]) for c in columns}
    )
