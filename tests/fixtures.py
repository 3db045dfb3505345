"""Small, hand-written frames."""

import datetime as dt

from pyspark.sql import types as T

UTC = dt.timezone.utc

F1_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()), T.StructField("country", T.StringType()),
    T.StructField("temperature", T.DoubleType()), T.StructField("feels_like", T.DoubleType()),
    T.StructField("humidity", T.IntegerType()), T.StructField("pressure", T.IntegerType()),
    T.StructField("wind_speed", T.DoubleType()), T.StructField("wind_direction", T.IntegerType()),
    T.StructField("visibility", T.IntegerType()), T.StructField("weather_condition", T.StringType()),
    T.StructField("weather_description", T.StringType()), T.StructField("cloudiness", T.IntegerType()),
    T.StructField("recorded_at", T.TimestampType()), T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("kafka_offset", T.LongType()), T.StructField("kafka_partition", T.IntegerType()),
])

NOON = dt.datetime(2026, 6, 2, 12, 0, tzinfo=UTC)
TEN = dt.datetime(2026, 6, 16, 10, 0, tzinfo=UTC)

# Two rows in different temperature bands (warm, hot) and one wind band, and a third at another hour.
BERGEN = ("Bergen", "NO", 21.4, 20.9, 58, 1019, 4.6, 205, 9500, "Clear", "clear night", 5, NOON, 60.3913, 5.3221)
LIMA = ("Lima", "PE", 33.2, 36.5, 81, 1006, 2.4, 75, 7200, "Rain", "heavy rain", 90, NOON, -12.0464, -77.0428)
NUUK = ("Nuuk", "GL", -4.0, -9.5, 71, 1002, 7.9, 310, 6400, "Snow", "light snow", 65, TEN, 64.1814, -51.6941)


def f1(spark):
    """Bergen, Lima, and an exact copy of Bergen."""
    rows = [BERGEN + (0, 0), LIMA + (1, 0), BERGEN + (2, 0)]
    return spark.createDataFrame(rows, F1_SCHEMA)


def f2(spark):
    """Three parsed rows at 2026-06-16 10:00 UTC."""
    rows = [(BERGEN[:12] + (TEN,) + BERGEN[13:]) + (0, 0), (LIMA[:12] + (TEN,) + LIMA[13:]) + (1, 0),
            NUUK + (2, 0)]
    return spark.createDataFrame(rows, F1_SCHEMA)


BASE_RECORD = {
    "city": "bergen", "country": "NO", "temperature": 21.4, "feels_like": 20.9, "humidity": 58,
    "pressure": 1019, "wind_speed": 4.6, "wind_direction": 205, "visibility": 9500,
    "weather_condition": "Clear", "weather_description": "Clear Night", "cloudiness": 5,
    "recorded_at": "2026-06-02T12:00:00+00:00", "latitude": 60.3913, "longitude": 5.3221,
}
