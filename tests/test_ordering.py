import random

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import Window, functions as F

from fieldgauge.operators import ordering, splits
from fieldgauge.operators.features import add_surrogate_key
from fieldgauge.operators.quantiles import distinct_values, exact_quantiles


def global_numbers(df, order):
    return df.withColumn("Id", F.row_number().over(Window.orderBy(*order)))


def test_numbers_equal_global_row_number_over_many_buckets(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("k"), F.col("id").alias("payload"))
    got = ordering.number_rows(df, ["k"], "Id", partitions=40)
    assert rows(got.select("k", "payload", "Id")) == rows(global_numbers(df, ["k"]).select("k", "payload", "Id"))


def test_hot_leading_value_is_split_by_second_key(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 100).otherwise(F.col("id") % 300).cast("double").alias("ts"),
        (F.col("id") * 31 % 4003).alias("k"),
    )
    sizes = ordering.ordered_parts(df, ["ts", "k"], 40).groupBy(ordering.PART).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * 4000 / 40  # half of the rows share one leading value
    got = ordering.number_rows(df, ["ts", "k"], "Id", partitions=40)
    assert rows(got.select("ts", "k", "Id")) == rows(global_numbers(df, ["ts", "k"]).select("ts", "k", "Id"))


def test_null_and_nan_keys_are_numbered(spark):
    values = [None, float("nan"), 3.0, 1.0, 2.0] + [float(i) for i in range(10, 60)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, k int")
    got = ordering.number_rows(df, ["v", "k"], "Id", partitions=9)
    assert rows(got.select("k", "Id")) == rows(global_numbers(df, ["v", "k"]).select("k", "Id"))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(20,0)", "int"])
def test_orderable_types(spark, kind):
    base = "timestamp_seconds(id * 90000)" if kind.startswith(("timestamp", "date")) else "id"
    df = spark.range(200).selectExpr(f"cast({base} as {kind}) as k", "id")
    got = ordering.number_rows(df, ["k", "id"], "number", partitions=11)
    assert got.where("number <> id + 1").count() == 0


def test_half_null_lead_and_equal_first_columns_are_split(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 50).alias("a"), F.lit(7).alias("b"), F.sha2(F.col("id").cast("string"), 256).alias("key")
    )
    order = ["b", "a", "key"]
    sizes = ordering.ordered_parts(df, order, 30).groupBy(ordering.PART).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * 6000 / 30
    got = ordering.number_rows(df, order, "Id", partitions=30)
    assert rows(got.select("key", "Id")) == rows(global_numbers(df, order).select("key", "Id"))


def test_text_keys_are_numbered(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("ä",)], "k string")
    got = ordering.number_rows(df, ["k"], "Id").select("k", "Id").orderBy("Id")
    assert [tuple(r) for r in got.collect()] == [(None, 1), ("a", 2), ("b", 3), ("ä", 4)]


def test_numbers_within_groups_carry_the_group_size(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    got = ordering.number_rows(df, ["k"], "n", ["g"], partitions=7).collect()
    assert all(r["n"] == r["k"] // 3 + 1 and r["total_n"] == (167 if r["g"] < 2 else 166) for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long")
    assert ordering.number_rows(df, ["k"], "Id").count() == 0


def skewed_values(spark):
    draw = np.random.default_rng(3)
    data = [("a", 5.0)] * 700 + [("a", float(x)) for x in draw.normal(5, 2, 900)]
    data += [("b", float(x)) for x in draw.exponential(3, 333)] + [(None, 1.5), (None, 4.0), ("c", 2.0), ("a", None)]
    return data, spark.createDataFrame(data, "g string, v double").repartition(7)


def test_exact_quantiles_match_numpy(spark):
    data, df = skewed_values(spark)
    points = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "lo": 0.0, "hi": 1.0}
    got = exact_quantiles(df, ["v"], ["g"], points).collect()
    distinct = {r["g"]: r["n_distinct"] for r in distinct_values(df, ["v"], ["g"]).collect()}
    assert {r["g"] for r in got} == {"a", "b", "c", None}
    for r in got:
        group = [v for g, v in data if g == r["g"] and v is not None]
        assert r["n"] == len(group) and distinct[r["g"]] == len(set(group))
        for name, p in points.items():
            assert r[name] == pytest.approx(np.quantile(group, p), abs=1e-12)


def test_exact_split_sizes(spark):
    df = spark.range(1003).withColumnRenamed("id", "Id")
    sizes = dict(rows(splits.with_split(df, exact=True).groupBy("split").count()))
    assert sizes == {"test": 201, "validation": 161, "train": 641}


def test_hash_split_needs_no_shuffle(spark):
    df = spark.range(100).withColumnRenamed("id", "Id")
    assert "Exchange" not in plan(splits.with_split(df))


def test_folds_are_balanced_per_class_even_with_null_label(spark):
    df = spark.range(1001).select(
        F.col("id").alias("Id"), F.when(F.col("id") % 10 < 9, F.col("id") % 2).alias("Occupancy")
    )
    folded = splits.with_stratified_folds(df)
    assert folded.count() == 1001
    for row in folded.groupBy("Occupancy").pivot("fold").count().collect():
        counts = [row[str(i)] for i in range(5)]
        assert max(counts) - min(counts) <= 1
