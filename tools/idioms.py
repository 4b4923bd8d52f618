"""Time three operators next to the plain form they replace, on a table grown to many rows.

Usage: python tools/idioms.py [SF_DIR]

Each pair is checked to give the same rows before it is timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd  # noqa: E402
from pyspark.sql import DataFrame, Window, functions as F  # noqa: E402

from compare import session  # noqa: E402
from fieldgauge import schemas  # noqa: E402
from fieldgauge.operators.inference_log import unpack_inference_log  # noqa: E402
from fieldgauge.operators.ordering import number_rows  # noqa: E402
from fieldgauge.operators.quantiles import QUARTILES, exact_quantiles, quantiles_of_counts, value_counts  # noqa: E402
from fieldgauge.session import fresh_path  # noqa: E402
from registry.views import readings  # noqa: E402

COPIES = 20
ROWS_PER_REQUEST = 50
DISTINCT = 10_000_000


def timed(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def called(make: Callable[[], DataFrame]) -> float:
    """Seconds of an operator that runs jobs while it builds its result."""
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 2)


def stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.repartition(16).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def python_unpack(log: DataFrame) -> DataFrame:
    """A Python UDF for the request body, and two explodes filtered to equal positions."""

    @F.pandas_udf("string")
    def values_only(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda body: json.dumps(json.loads(body)["inputs"]))

    rows = log.withColumn("x", F.from_json(values_only("request"), "array<array<double>>"))
    rows = rows.withColumn("y", F.from_json("response", "predictions array<int>")["predictions"])
    rows = rows.select("request_id", "y", F.posexplode("x").alias("i", "values"))
    rows = rows.select("request_id", "i", "values", F.posexplode("y").alias("j", "label")).where("i = j")
    return rows.select(
        "request_id", *[F.get("values", F.lit(k)).alias(c) for k, c in enumerate(schemas.MODEL_INPUTS)], "label"
    ).dropDuplicates()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session()
    one = readings(spark, sf_dir).drop("user_id")
    many = stored(
        one.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        .withColumn("Light", F.col("Light") + F.col("copy") * 0.001)
        .withColumn("event_id", F.col("event_id") * COPIES + F.col("copy")),
        "readings",
    )
    results: dict[str, dict[str, float]] = {}

    order = ["date", "event_id"]
    plain = many.withColumn("Id", F.row_number().over(Window.orderBy(*order)))
    ours = number_rows(many, order, "Id")
    assert plain.select("event_id", "Id").exceptAll(ours.select("event_id", "Id")).isEmpty()
    results["row number"] = {"one partition": timed(plain), "range buckets": timed(ours)}

    points = F.array(*[F.lit(p) for p in QUARTILES.values()])
    builtin = many.groupBy("Occupancy").agg(*[F.percentile(c, points).alias(c) for c in schemas.SENSOR_COLUMNS])
    ours = [lambda: exact_quantiles(many, schemas.SENSOR_COLUMNS, ["Occupancy"]), lambda: quantiles_of_counts(value_counts(many, schemas.SENSOR_COLUMNS, ["Occupancy"]), ["Occupancy"])]
    results["exact quartiles"] = {"one task per class": timed(builtin), "selection": called(ours[0]), "sorted value counts": called(ours[1])}

    distinct = stored(spark.range(DISTINCT).select((F.col("id") % 3).alias("g"), F.rand(1).alias("a"), F.randn(2).alias("b")), "distinct")
    builtin = distinct.groupBy("g").agg(*[F.percentile(c, points).alias(c) for c in "ab"])
    ours = [lambda: exact_quantiles(distinct, ["a", "b"], ["g"]), lambda: quantiles_of_counts(value_counts(distinct, ["a", "b"], ["g"]), ["g"])]
    results["exact quartiles, distinct values"] = {"one task per class": timed(builtin), "selection": called(ours[0]), "sorted value counts": called(ours[1])}

    request = F.floor(F.col("event_id") / ROWS_PER_REQUEST).cast("string")
    entry = F.struct("event_id", F.array(*schemas.MODEL_INPUTS).alias("a"), F.col("Occupancy").cast("int").alias("p"))
    log = stored(
        many.groupBy(request.alias("request_id"))
        .agg(F.array_sort(F.collect_list(entry)).alias("e"))
        .select(
            "request_id",
            F.lit("2024-01-01").cast("date").alias("date"),
            F.lit(0).cast("bigint").alias("timestamp_ms"),
            F.to_json(F.struct(F.transform("e", lambda r: r["a"]).alias("inputs"))).alias("request"),
            F.to_json(F.struct(F.transform("e", lambda r: r["p"]).alias("predictions"))).alias("response"),
        ),
        "payload",
    )
    clean, _ = unpack_inference_log(log)
    assert clean.count() == many.count()
    results["inference log"] = {"python and two explodes": timed(python_unpack(log)), "zip on the JVM": timed(clean)}
    print(json.dumps({"rows": many.count(), "seconds": results}))


if __name__ == "__main__":
    main()
