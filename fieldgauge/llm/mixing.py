"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed to cells of source x language x topic. Raking scales the cells in turn
until every marginal meets its target; the ratio of raked to present tokens, times one constant,
is a document's chance to be kept. The constant is chosen so that the expected tokens of the
sample meet the budget although no chance may exceed 1. Only DataFrame functions are used; the
loop works on cells, whose number does not grow with the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldgauge.llm.tables import stored

#: Target share of a marginal value: its token share to this power, rescaled to 1. Below 1 the
#: small ones gain.
FLATTENING = {"source": 0.5, "lang": 0.7, "topic": 0.8}
KEEP_SHARE = 0.8
MAX_SWEEPS, SWEEPS_A_JOB, TOLERANCE = 40, 4, 1e-9
WORD = r"[^\x20\x09-\x0D]+"
UNIT = 2.0**52


def token_count(text: Column) -> Column:
    """Words between white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """Kind of text by its marks: table, shouting, symbols, notice or prose."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("!!")), "shout")
        .when(F.contains(text, F.lit("%%%")), "symbols")
        .when(F.contains(text, F.lit("License")) | F.contains(text, F.lit("rights reserved")), "notice")
        .otherwise("prose")
    )


def cell_tokens(documents: DataFrame, dimensions: list[str]) -> DataFrame:
    """Tokens per cell; a NULL value is a value of its own."""
    return documents.groupBy(*dimensions).agg(F.sum("tokens").alias("tokens"))


def rake(cells: DataFrame, flattening: dict[str, float], max_sweeps: int = MAX_SWEEPS) -> DataFrame:
    """Add ``weight``: cell tokens scaled until each marginal has its target share."""
    total = Window.partitionBy(F.lit(0))
    with_targets = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d, power in flattening.items():
        flat = (
            cells.groupBy(d)
            .agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("__p"), F.sum("tokens").alias("__t"))
            .select(F.col(d).alias("__v"), F.when(F.col("__t") > 0, F.col("__p")).otherwise(0.0).alias("__p"))
        )
        sums = flat.agg(F.sum("__p").alias("__s"))
        mass = cells.agg(F.sum("tokens").cast("double").alias("__m"))
        shares = flat.join(F.broadcast(sums.join(F.broadcast(mass), F.lit(True))), F.lit(True))  # one row
        target = F.when(F.col("__s") > 0, F.col("__p") / F.col("__s") * F.col("__m")).otherwise(0.0)
        with_targets = with_targets.join(
            shares.select("__v", target.alias(f"__target_{d}")), F.col(d).eqNullSafe(F.col("__v"))
        ).drop("__v")
    current = stored(with_targets, "cells")
    for _ in range(0, max_sweeps, SWEEPS_A_JOB):
        current = current.coalesce(1)  # the cells, which are few: no sweep shuffles them, whatever the number of partitions
        for _ in range(SWEEPS_A_JOB):
            for d in flattening:
                have = F.sum("weight").over(Window.partitionBy(d))
                current = current.withColumn("weight", F.when(have > 0, F.col("weight") * F.col(f"__target_{d}") / have).otherwise(0.0))
        current = stored(current, "cells")
        errors = [
            current.groupBy(d).agg(F.abs(F.sum("weight") - F.first(f"__target_{d}")).alias("e"), F.first(f"__target_{d}").alias("t"))
            .agg(F.max(F.when(F.col("t") > 0, F.col("e") / F.col("t"))).alias("e"))
            for d in flattening
        ]
        worst = [e.first()["e"] for e in errors]
        if all(e is None or e <= TOLERANCE for e in worst):
            break
    return current.drop(*[f"__target_{d}" for d in flattening])


def chances(cells: DataFrame, keep_share: float) -> DataFrame:
    """Add ``ratio`` (raked over present tokens) and ``chance`` with the budget met in expectation."""
    rated = cells.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(1.0))
    total = cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    scale, clipped = None, -1
    while total:
        full = F.lit(False) if scale is None else F.col("ratio") * scale >= 1
        row = rated.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("rest"),
            F.sum(full.cast("int")).alias("n"),
        ).first()
        if row["n"] == clipped or not row["rest"]:
            break
        scale, clipped = (keep_share * total - row["full"]) / row["rest"], row["n"]
    return rated.withColumn("chance", F.least(F.lit(1.0), F.col("ratio") * F.lit(scale if scale is not None else keep_share)))


def lot(id_column: str = "doc_id") -> Column:
    """A number in [0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(UNIT)


def mix(documents: DataFrame, flattening: dict[str, float] = FLATTENING, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Every document with topic, tokens, ratio, chance and ``kept``.

    NULL source, language or id are values of their own; a NULL or empty text has no tokens and
    takes the chance of its cell (ratio 1 where the whole cell has none); repeated rows share one
    fate, as the lot depends on the id; other columns are kept, except ones named as those added.
    """
    # the columns added win over columns of the same name
    named = documents.withColumns({"topic": topic_of(F.col("text")), "tokens": token_count(F.col("text"))})
    dimensions = list(flattening)
    rated = stored(chances(rake(stored(cell_tokens(named, dimensions), "cells"), flattening), keep_share), "mixture")
    rated = rated.select(*[F.col(d).alias(f"__{d}") for d in dimensions], "ratio", "chance")
    same = [F.col(d).eqNullSafe(F.col(f"__{d}")) for d in dimensions]
    condition = same[0]
    for more in same[1:]:
        condition = condition & more
    joined = named.drop("ratio", "chance", "kept").join(rated, condition, "left").drop(*[f"__{d}" for d in dimensions])
    return joined.withColumn("kept", lot() < F.col("chance"))
