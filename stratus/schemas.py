"""Declared schemas.  Nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

# The 15 observation fields every record must carry (validation contract).
OBSERVATION_FIELDS = [
    "city", "country", "temperature", "feels_like", "humidity", "pressure",
    "wind_speed", "wind_direction", "visibility", "weather_condition",
    "weather_description", "cloudiness", "recorded_at", "latitude", "longitude",
]

INT_FIELDS = ["humidity", "pressure", "wind_direction", "visibility", "cloudiness"]
DOUBLE_FIELDS = ["temperature", "feels_like", "wind_speed", "latitude", "longitude"]

# Wire format of a validated message: numbers are doubles (not 32-bit floats,
# which leak representation error into 2-dp results), time is ISO-8601 text.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("feels_like", T.DoubleType()),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("pressure", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("wind_direction", T.IntegerType()),
    T.StructField("visibility", T.IntegerType()),
    T.StructField("weather_condition", T.StringType()),
    T.StructField("weather_description", T.StringType()),
    T.StructField("cloudiness", T.IntegerType()),
    T.StructField("recorded_at", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("schema_version", T.StringType()),
])

# Lax decode for validation: every field as text, coerced afterwards.
RAW_TEXT_SCHEMA = T.StructType(
    [T.StructField(f, T.StringType()) for f in OBSERVATION_FIELDS])

# Nested provider payload (one observation).
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("sys", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("main", T.StructType([
        T.StructField("temp", T.DoubleType()),
        T.StructField("feels_like", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("pressure", T.IntegerType()),
    ])),
    T.StructField("wind", T.StructType([
        T.StructField("speed", T.DoubleType()),
        T.StructField("deg", T.IntegerType()),
    ])),
    T.StructField("visibility", T.IntegerType()),
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("main", T.StringType()),
        T.StructField("description", T.StringType()),
    ]))),
    T.StructField("clouds", T.StructType([T.StructField("all", T.IntegerType())])),
    T.StructField("dt", T.LongType()),
])

PARTITION_COLUMNS = ["year", "month", "day", "hour"]

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("job_name", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("completed_at", T.TimestampType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("error_message", T.StringType()),
])
