"""Changed rows between two snapshots of a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

CHANGE = "change_type"
# Change types of a row-level change feed.
INSERT, DELETE, BEFORE, AFTER = "insert", "delete", "update_preimage", "update_postimage"


def snapshot_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Inserted and deleted rows, and both images of updated rows. Keys must be unique.

    One full outer join on the key; values are compared NULL-safely.
    """
    columns = after.columns
    left = before.select(*keys, F.struct(*columns).alias("__old"))
    right = after.select(*keys, F.struct(*columns).alias("__new"))
    old, new = F.col("__old"), F.col("__new")

    def image(kind: str, row):
        return F.struct(F.lit(kind).alias(CHANGE), row.alias("row"))

    changes = (
        F.when(old.isNull(), F.array(image(INSERT, new)))
        .when(new.isNull(), F.array(image(DELETE, old)))
        .otherwise(F.array(image(BEFORE, old), image(AFTER, new)))
    )
    joined = left.join(right, keys, "full_outer").where(~old.eqNullSafe(new))
    return joined.select(F.inline(changes)).select(CHANGE, "row.*")
