"""Declared schemas, column lists and fixed thresholds of the sensor data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the data model.
SENSOR_COLUMNS = ["Temperature", "Humidity", "Light", "CO2", "HumidityRatio"]
LABEL = "Occupancy"
GOLD_COLUMNS = [*SENSOR_COLUMNS, LABEL]
EVENT_TIME = "date"
KEY = "Id"

# Model inputs in training order, and their names in the training frame.
MODEL_INPUTS = ["Temperature", "Light", "CO2", "HumidityRatio"]
TRAINING_NAMES = {
    "Temperature": "room_temperature",
    "Light": "room_light",
    "CO2": "co2_ppm",
    "HumidityRatio": "humidity_ratio",
}
TRAINING_FEATURES = list(TRAINING_NAMES.values())

# Cast map of the silver table.
SILVER_TYPES = {
    "Temperature": "double",
    "Humidity": "double",
    "Light": "double",
    "CO2": "double",
    "HumidityRatio": "double",
    "Occupancy": "bigint",
}
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Cast map of the validation files.
VALIDATION_TYPES = {
    "room_temperature": "double",
    "room_light": "double",
    "co2_ppm": "double",
    "humidity_ratio": "double",
    "Occupancy": "bigint",
}

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("request_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("timestamp_ms", T.LongType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("request", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("request_metadata", T.StringType()),
    ]
)

RUN_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)
