"""Sensor-shaped views that Spark derives from the given tables. Each covers the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldgauge import schemas
from fieldgauge.session import use_utc

RULE_LIMIT = 21.5
RULE_CO2 = 800.0
REQUEST_ROWS = 4096  # a request covers at most this many consecutive events of a user and day


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One sensor reading per event; ``extra`` names event columns to keep."""
    k = F.get_json_object("props", "$.k").cast("int")
    by_user = F.col("user_id") % 20
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("date"),
        "user_id",
        (F.lit(19.0) + F.col("value") % 5).alias("Temperature"),
        (20 + by_user).cast("double").alias("Humidity"),
        F.col("value").alias("Light"),
        (400 + 12 * k).cast("double").alias("CO2"),
        (F.lit(0.0001) * (30 + by_user).cast("double")).alias("HumidityRatio"),
        F.col("event_type").isin("purchase", "click").cast("int").cast("bigint").alias("Occupancy"),
        *extra,
    )


def rule_prediction(limit: float = RULE_LIMIT) -> Column:
    return (F.col("Temperature") > limit).cast("int")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the prediction of a fixed rule, which gives metrics an exact answer."""
    return readings(spark, sf_dir).withColumn("prediction", rule_prediction())


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows over few distinct values whose label is a rule, so that every tree that fits
    them gives the rule back: warm and with high CO2."""
    source = readings(spark, sf_dir)
    temperature, co2 = F.floor("Temperature").cast("double"), F.col("CO2")
    return source.select(
        F.col("event_id").alias("Id"),
        temperature.alias("room_temperature"),
        (F.col("user_id") % 7).cast("double").alias("room_light"),
        co2.alias("co2_ppm"),
        F.col("HumidityRatio").alias("humidity_ratio"),
        ((temperature >= 21) & (co2 >= RULE_CO2)).cast("int").cast("bigint").alias("Occupancy"),
    )


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed log: features, predicted class, request time and model."""
    return readings(spark, sf_dir).select(
        F.col("date").cast("timestamp").alias("timestamp_ms"),
        F.lit(0).alias("model_id"),
        *schemas.MODEL_INPUTS,
        rule_prediction().alias("Occupancy"),
    )


def payload(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Logged requests: the readings of a user, day and block of events in one body.

    The block bounds a request however many events a user has. Some users send failing or
    unreadable requests, so that every outcome occurs; all events are in some request.
    """
    day = F.to_date("date")
    block = F.floor(F.col("event_id") / REQUEST_ROWS)
    user = F.col("user_id")
    inputs = F.array("Temperature", "Light", "CO2", "HumidityRatio")
    entries = F.array_sort(
        F.collect_list(F.struct("event_id", inputs.alias("a"), rule_prediction().alias("p")))
    )
    requests = (
        readings(spark, sf_dir)
        .groupBy("user_id", day.alias("date"), block.alias("block"))
        .agg(F.min(F.unix_millis(F.col("date").cast("timestamp"))).alias("timestamp_ms"), entries.alias("e"))
    )
    body = F.to_json(F.struct(F.transform("e", lambda x: x["a"]).alias("inputs")))
    return requests.select(
        F.sha2(F.concat_ws("|", user, F.col("date"), F.col("block")), 256).alias("request_id"),
        "date",
        "timestamp_ms",
        F.when(user % 10 == 0, 500).otherwise(200).alias("status_code"),
        F.when(user % 17 == 0, "not json")
        .when(user % 19 == 0, '{"dataframe_split":{"data":[]}}')
        .otherwise(body)
        .alias("request"),
        F.to_json(F.struct(F.transform("e", lambda x: x["p"]).alias("predictions"))).alias("response"),
        F.lit(None).cast("string").alias("request_metadata"),
        *keep,
    )


def varied_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload with every shape of request that a log may hold, chosen by the user.

    By user modulo 29: no id (0), leading line break (1), record form (2), fractional (3) or missing
    (4) first prediction, five values (5), a prediction too many (6) or too few (7), no body (8),
    no inputs (9), unreadable response (10), a later retry with another body (11), a failed first
    attempt (12), a repeat on the next day (13).
    """
    whole = payload(spark, sf_dir, keep=("user_id", "e"))
    shaped = (F.col("user_id") % 17 != 0) & (F.col("user_id") % 19 != 0)
    c = F.when(shaped, F.col("user_id") % 29)
    inputs, labels = F.transform("e", lambda x: x["a"]), F.transform("e", lambda x: x["p"].cast("double"))
    rest = F.slice(labels, F.lit(2), F.size("e") - 1)
    body = lambda rows: F.to_json(F.struct(rows.alias("inputs")))
    answer = lambda rows: F.to_json(F.struct(rows.alias("predictions")), {"ignoreNullFields": "false"})
    record = F.transform("e", lambda x: F.struct(*[F.get(x["a"], i).alias(f"input_{i}") for i in range(4)]))
    request = (
        F.when(c == 1, F.concat(F.lit("\n\t "), body(inputs)))
        .when(c == 2, F.to_json(record))
        .when(c == 5, body(F.transform(inputs, lambda a: F.concat(a, F.array(F.lit(1.0))))))
        .when(c == 8, F.lit(None).cast("string"))
        .when(c == 9, '{"inputs":[]}')
        .otherwise(F.col("request"))
    )
    response = (
        F.when(c == 3, answer(F.concat(F.array(F.lit(0.7)), rest)))
        .when(c == 4, answer(F.concat(F.array(F.lit(None).cast("double")), rest)))
        .when(c == 6, answer(F.concat(labels, F.array(F.lit(1.0)))))
        .when(c == 7, answer(F.slice(labels, F.lit(1), F.size("e") - 1)))
        .when(c == 10, "oops")
        .otherwise(F.col("response"))
    )
    kept_id = F.when(~F.coalesce(c == 0, F.lit(False)), F.col("request_id"))
    retry = F.col("__again") & (c == 11)
    changed = {
        "request": F.when(retry, body(F.concat(inputs, inputs))).otherwise(request),
        "response": F.when(retry, answer(F.concat(labels, labels))).otherwise(response),
        "request_id": kept_id,
        "timestamp_ms": F.col("timestamp_ms") + F.when(F.col("__again"), F.when(c == 11, 60_000).when(c == 12, -1000).otherwise(86_400_000)).otherwise(0),
        "status_code": F.when(F.col("__again") & (c == 12), 500).otherwise(F.col("status_code")),
        "date": F.when(F.col("__again") & (c == 13), F.date_add("date", 1)).otherwise(F.col("date")),
    }
    # both copies come from one row, so that a request is put together once
    copies = F.when(c.isin(11, 12, 13), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    columns = ["request_id", "date", "timestamp_ms", "status_code", "request", "response", "request_metadata"]
    return whole.withColumn("__again", F.explode(copies)).withColumns(changed).select(*columns)


def r6(column: Column | str) -> Column:
    """Six decimals, without a negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def millis(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))
