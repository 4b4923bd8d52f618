import datetime as dt
import re

import pytest
from conftest import plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldgauge import schemas
from fieldgauge.operators.cleaning import cast_columns, cast_rejects, remove_outliers, type_silver
from fieldgauge.sources import csv_files, tables
from fieldgauge.sources.key_filters import days_that_may_hold

HEADER = "date,Temperature,Humidity,Light,CO2,HumidityRatio,Occupancy"
LINE = "2015-02-04 17:51:00,23.18,27.272,426.0,721.25,0.00479,1"


def folder_with(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    return str(tmp_path)


def test_files_of_different_layouts_are_stacked_by_name(spark, tmp_path):
    folder = folder_with(
        tmp_path,
        plain=f"{HEADER}\n{LINE}\n",
        numbered=f'{HEADER.replace("date", chr(34) + "date" + chr(34), 1)}\n"1",{LINE}\n"2",{LINE}\n',
        unnamed=f",{HEADER}\n1,{LINE}\n",
        reordered="Occupancy,CO2,date,Temperature\n0,450.5,2015-02-05 01:00:00,20.5\n",
    )
    typed = type_silver(csv_files.read_readings_csv(spark, folder))
    full = (23.18, 27.272, 426.0, 721.25, 0.00479, 1)
    got = rows(typed.select(*schemas.GOLD_COLUMNS))
    assert got == sorted([full] * 4 + [(20.5, None, None, 450.5, None, 0)], key=lambda r: tuple((x is None, str(x)) for x in r))
    assert typed.where("date = timestamp_ntz'2015-02-04 17:51:00'").count() == 4
    # a pruned read must not shift columns either
    assert rows(typed.select("CO2").distinct()) == [(450.5,), (721.25,)]


def test_one_layout_and_declared_header(spark, tmp_path):
    folder = folder_with(tmp_path, a=f"{HEADER}\n1,{LINE}\n", b=f"{HEADER}\n7,{LINE}\n")
    detected = csv_files.read_readings_csv(spark, folder)
    declared = csv_files.read_readings_csv(spark, folder, [csv_files.ROW_NUMBER, *HEADER.split(",")])
    assert rows(detected) == rows(declared) and detected.count() == 2
    assert detected.columns == HEADER.split(",")


def test_missing_texts_become_null_and_blank_lines_are_skipped(spark, tmp_path):
    folder = folder_with(tmp_path, a=f"{HEADER}\n\n2015-02-04 17:51:00,NA,,nan,None,NULL,0\n")
    row = type_silver(csv_files.read_readings_csv(spark, folder)).first()
    assert [row[c] for c in schemas.SENSOR_COLUMNS] == [None] * 5 and row["Occupancy"] == 0


def test_too_many_fields_and_missing_header_fail(spark, tmp_path):
    wide = tmp_path / "wide"
    wide.mkdir()
    with pytest.raises(ValueError):
        csv_files.read_readings_csv(spark, folder_with(wide, a=f"{HEADER}\n1,2,{LINE}\n"))
    bare = tmp_path / "bare"
    bare.mkdir()
    with pytest.raises(ValueError):
        csv_files.read_readings_csv(spark, folder_with(bare, a=f"{LINE}\n"))


def test_missing_folder_and_listing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_files.read_readings_csv(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        csv_files.list_files(spark, str(tmp_path / "none"))
    folder = folder_with(tmp_path, a=HEADER, b=HEADER)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text(HEADER)
    names = [r["path"].split("/")[-1] for r in csv_files.list_files(spark, folder).collect()]
    assert sorted(names) == ["a.csv", "b.csv"]


def test_bad_value_fails_or_is_reported(spark):
    df = spark.createDataFrame([("1.5", "0"), ("x", "1"), (None, "2.5")], "Temperature string, Occupancy string")
    types = {"Temperature": "double", "Occupancy": "bigint"}
    with pytest.raises(PySparkException):
        cast_columns(df, types).collect()
    assert rows(cast_columns(df, types, on_error="null")) == [(1.5, 0), (None, 1), (None, None)]
    assert rows(cast_rejects(df, types).select("bad_columns")) == [(["Occupancy"],), (["Temperature"],)]
    with pytest.raises(ValueError):
        cast_columns(df, types, on_error="maybe")


def test_outlier_bounds_are_strict_and_nan_is_no_reading(spark):
    def reading(temperature, co2, label):
        return (temperature, 30.0, 1.0, co2, 0.004, label)

    kept = [reading(21.99, 719.9, 0), reading(-5.0, 0.0, 0), reading(21.01, 1549.0, 1), reading(23.09, 500.0, 1)]
    dropped = [
        reading(22.0, 500.0, 0), reading(20.0, 720.0, 0), reading(21.0, 500.0, 1), reading(23.1, 500.0, 1),
        reading(22.0, 1550.0, 1), reading(float("nan"), 500.0, 1), reading(None, 500.0, 0), reading(22.5, 500.0, 2),
    ]
    schema = "Temperature double, Humidity double, Light double, CO2 double, HumidityRatio double, Occupancy bigint"
    df = spark.createDataFrame(kept + dropped, schema)
    assert rows(remove_outliers(df)) == rows(spark.createDataFrame(kept, schema))


def test_validation_csv(spark, tmp_path):
    path = str(tmp_path / "validation")
    df = spark.createDataFrame([(1.5, 2.5, 3.5, 4.5, 1)], ", ".join(f"{c} {t}" for c, t in schemas.VALIDATION_TYPES.items()))
    csv_files.write_csv(df, path)
    back = csv_files.read_validation_csv(spark, path)
    assert back.schema.simpleString() == df.schema.simpleString() and rows(back) == rows(df)
    with pytest.raises(ValueError):
        csv_files.read_validation_csv(spark, str(tmp_path / "none"))
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "a.csv").write_text(",".join(schemas.VALIDATION_TYPES) + "\n1,2,3,oops,1\n")
    with pytest.raises(PySparkException):
        csv_files.read_validation_csv(spark, str(bad)).collect()


def test_upsert_creates_merges_and_checks_keys(spark, tmp_path):
    location = str(tmp_path / "features")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "Id int, v string")
    assert tables.upsert_table(first, "features_t", ["Id"], location, "a table", {"source": "gold"}) == "created"
    second = spark.createDataFrame([(2, "B", 0.5), (4, "d", 1.5)], "Id int, v string, extra double")
    assert tables.upsert_table(second, "features_t", ["Id"], location) == "merged"
    assert rows(tables.read_table(spark, "features_t")) == [(1, "a", None), (2, "B", 0.5), (3, "c", None), (4, "d", 1.5)]
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES features_t").collect()}
    assert properties["source"] == "gold" and properties["primary_key"] == "Id"
    for bad in ([(1, "x"), (1, "y")], [(None, "x")]):
        with pytest.raises(ValueError):
            tables.upsert_table(spark.createDataFrame(bad, "Id int, v string"), "features_t", ["Id"], location)


def test_append_twice_stores_rows_once(spark):
    batch = spark.createDataFrame([("r1", 0, "2024-01-01"), ("r1", 1, "2024-01-01"), ("r2", 0, "2024-01-02")], "request_id string, pos int, date string")
    batch = batch.withColumn("date", F.to_date("date"))
    for _ in range(2):
        tables.append_new_rows(batch, "processed_t", ["request_id", "pos"], "date")
    assert spark.read.table("processed_t").count() == 3
    late = batch.where("request_id = 'r2'").withColumn("date", F.date_add("date", 400))
    tables.append_new_rows(late.unionByName(late.withColumn("request_id", F.lit("r3"))), "processed_t", ["request_id", "pos"], "date")
    assert rows(spark.read.table("processed_t").select("request_id", "pos")) == [("r1", 0), ("r1", 1), ("r2", 0), ("r3", 0)]


def test_filters_name_the_days_to_read(spark):
    days = [(f"k{d}-{i}", d) for d in range(40) for i in range(50)]
    batch = spark.createDataFrame(days, "id string, day int")
    tables.append_new_rows(batch, "filtered_t", ["id"], "day")
    asked = spark.createDataFrame([("k7-3", 90), ("k31-0", 90), ("new", 90)], "id string, day int")
    named = days_that_may_hold(asked, "filtered_t", ["id"], "day")
    assert {7, 31} <= set(named) and len(named) < 10
    assert re.search(r"PartitionFilters: \[\(*day#\d+ IN", plan(tables.stored_days(asked, "filtered_t", ["id"], "day")))
    # a table that is older than its arrays gets them, whatever type the delivery's key has
    spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, day int").write.partitionBy("day").saveAsTable("older_t")
    tables.append_new_rows(spark.createDataFrame([(4, 9), (30, 9)], "id int, day int"), "older_t", ["id"], "day")
    assert rows(spark.read.table("older_t").where("day = 9").select("id")) == [(30,)]
    tables.append_new_rows(spark.createDataFrame([], "id long, day int"), "older_t", ["id"], "day")
    assert spark.read.table("older_t").count() == 31
    tables.drop_table(spark, "older_t")
    assert not spark.catalog.tableExists("older_t_key_filter")


def test_append_starts_from_an_empty_delivery(spark):
    schema = "request_id string, pos int, reason string, date date"
    empty = spark.createDataFrame([], schema)
    some = spark.createDataFrame([("a", None, "x", dt.date(2024, 1, 1)), ("b", 1, "y", None)], schema)
    for batch, n in ((empty, 0), (some, 2), (some, 2), (empty, 2)):
        tables.append_new_rows(batch, "empty_first_t", ["request_id", "pos", "reason"], "date")
        assert spark.read.table("empty_first_t").count() == n


def test_append_compares_missing_key_parts(spark):
    batch = spark.createDataFrame([("r1", None, None), ("r2", None, "d")], "request_id string, pos int, day string")
    for _ in range(2):
        tables.append_new_rows(batch, "null_keys_t", ["request_id", "pos"], "day")
    assert spark.read.table("null_keys_t").count() == 2


def test_missing_table_and_overwrite_with_new_schema(spark):
    with pytest.raises(RuntimeError):
        tables.read_table(spark, "no_such_table")
    tables.overwrite_table(spark.range(3), "over_t")
    tables.overwrite_table(spark.range(2).withColumn("x", F.lit(1.0)), "over_t", properties={"feed": "on"})
    assert spark.read.table("over_t").columns == ["id", "x"]
