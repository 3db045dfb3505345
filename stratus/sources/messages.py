"""Wire encodings: provider payloads and topic messages.

Both directions are plain column expressions: ``to_json`` to encode,
``from_json`` with a declared schema to decode.  The generators below derive
their input from the observation table, so their size follows the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.schemas import MESSAGE_SCHEMA, OBSERVATION_FIELDS, PAYLOAD_SCHEMA
from stratus.sources.observations import date_parts

# ISO-8601 with a numeric offset, e.g. 2024-01-01T00:00:07.179575+00:00.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# Fixture rule: every n-th message (by offset) is cut short (broken JSON).
BROKEN_EVERY = 199


def iso_text(c) -> F.Column:
    return F.date_format(c, ISO_FORMAT)


def record_struct(df: DataFrame) -> F.Column:
    """The 15-field record with the event time as ISO text."""
    cols = [iso_text("recorded_at").alias("recorded_at") if f == "recorded_at" else F.col(f)
            for f in OBSERVATION_FIELDS]
    return F.struct(*cols)


def encode_messages(df: DataFrame, broken_every: int | None = BROKEN_EVERY) -> DataFrame:
    """Observation rows -> topic messages (key, value, partition, offset, timestamp).

    Same columns as a Kafka source row; ``value`` is JSON text.  With
    ``broken_every`` some values are truncated to exercise permissive decoding.
    """
    value = F.to_json(record_struct(df))
    if broken_every:
        value = F.when(F.col("kafka_offset") % broken_every == 0,
                       F.substring(value, 1, 25)).otherwise(value)
    return df.select(
        F.col("city").alias("key"),
        value.alias("value"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("recorded_at").alias("timestamp"),
    )


def parse_messages(raw: DataFrame) -> DataFrame:
    """Decode messages into typed rows plus topic metadata and date parts.

    Permissive: a malformed value gives a row of nulls that keeps its
    topic metadata.  Bad timestamp text becomes null (no ANSI error).
    """
    topic = {name: F.col(name).alias(f"kafka_{name}") for name in ("timestamp", "offset", "partition")}
    record = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA)
    parsed = raw.select(F.inline(F.array(record)), *topic.values())
    parsed = parsed.select(*[F.try_to_timestamp(c).alias(c) if c == "recorded_at" else F.col(c) for c in parsed.columns])
    return date_parts(parsed)


# ------------------------------------------------------------- payloads --

def encode_payloads(df: DataFrame) -> DataFrame:
    """Observation rows -> nested provider payload JSON keyed by city id.

    Optional fields are left out when absent (``wind.deg`` on every 13th
    offset, ``visibility`` when null), as the provider does.
    """
    deg = F.when(F.col("kafka_offset") % 13 == 0, F.lit(None)).otherwise(F.col("wind_direction"))
    payload = F.struct(
        F.col("city_id").alias("id"),
        F.struct(F.col("country").alias("country")).alias("sys"),
        F.struct(F.col("temperature").alias("temp"), F.col("feels_like").alias("feels_like"),
                 F.col("humidity").alias("humidity"), F.col("pressure").alias("pressure")).alias("main"),
        F.struct(F.col("wind_speed").alias("speed"), deg.alias("deg")).alias("wind"),
        F.col("visibility").alias("visibility"),
        F.array(F.struct(F.col("weather_condition").alias("main"),
                         F.col("weather_description").alias("description")),
                F.struct(F.lit("Secondary").alias("main"), F.lit("secondary").alias("description"))
                ).alias("weather"),
        F.struct(F.col("cloudiness").alias("all")).alias("clouds"),
        F.unix_seconds(F.col("recorded_at")).alias("dt"),
    )
    return df.select(F.col("kafka_offset").alias("message_id"), F.to_json(payload).alias("payload"))


def flatten_payload(payloads: DataFrame, cities: DataFrame) -> DataFrame:
    """Nested payload -> flat 15-field record, enriched from the city dimension.

    Name and coordinates come from the dimension, country from the payload;
    missing ``wind.deg`` / ``visibility`` default to 0; the first weather
    entry is used; ``dt`` epoch seconds become a UTC timestamp.
    """
    # Decode inside a generator: one parse per row, never copied into filters.
    p = payloads.select("message_id", F.inline(F.array(F.from_json("payload", PAYLOAD_SCHEMA))))
    first = F.get(F.col("weather"), 0)
    flat = p.select(
        "message_id",
        F.col("id").alias("city_id"),
        F.col("sys.country").alias("country"),
        F.col("main.temp").alias("temperature"),
        F.col("main.feels_like").alias("feels_like"),
        F.col("main.humidity").alias("humidity"),
        F.col("main.pressure").alias("pressure"),
        F.col("wind.speed").alias("wind_speed"),
        F.coalesce(F.col("wind.deg"), F.lit(0)).alias("wind_direction"),
        F.coalesce(F.col("visibility"), F.lit(0)).alias("visibility"),
        first.getField("main").alias("weather_condition"),
        first.getField("description").alias("weather_description"),
        F.col("clouds.all").alias("cloudiness"),
        F.timestamp_seconds(F.col("dt")).alias("recorded_at"),
    )
    from stratus.operators.joins import broadcast_if_bounded

    dim = broadcast_if_bounded(cities.select("city_id", F.col("name").alias("city"),
                                             F.col("lat").alias("latitude"), F.col("lon").alias("longitude")))
    return flat.join(dim, "city_id").select("message_id", *OBSERVATION_FIELDS)


# ------------------------------------------------------- untidy records --

# Fixture rules for the producer-side text variant (by message offset):
# blank city every 53rd, lower-case city every 3rd, temperature sent as a
# JSON string every 5th, humidity as 65.0-style number every 4th and with a
# fractional part every 101st, unparseable time every 211th, and the whole
# value cut short every 199th.  Descriptions are padded and title-cased.
UNTIDY_RULES = {"blank_city": 53, "lower_city": 3, "text_temp": 5, "float_hum": 4,
                "frac_hum": 101, "bad_time": 211, "broken": 199}


def untidy_messages(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """Observation rows -> raw producer records (message_id, value JSON text)."""
    r = {**UNTIDY_RULES, **(rules or {})}
    mid = F.col("kafka_offset")
    city = (F.when(mid % r["blank_city"] == 0, F.lit("   "))
             .when(mid % r["lower_city"] == 0, F.lower("city"))
             .otherwise(F.col("city")))
    desc = F.concat(F.lit("  "), F.initcap("weather_description"), F.lit(" "))
    when_ts = F.when(mid % r["bad_time"] == 0, F.lit("not-a-date")).otherwise(iso_text("recorded_at"))
    hum_frac = mid % r["frac_hum"] == 0
    hum_float = mid % r["float_hum"] == 0
    hum_d = F.when(hum_frac, F.col("humidity") + F.lit(0.5)).otherwise(F.col("humidity").cast("double"))

    def rec(temp, hum):
        cols = {
            "city": city, "country": F.col("country"), "temperature": temp,
            "feels_like": F.col("feels_like"), "humidity": hum, "pressure": F.col("pressure"),
            "wind_speed": F.col("wind_speed"), "wind_direction": F.col("wind_direction"),
            "visibility": F.col("visibility"), "weather_condition": F.col("weather_condition"),
            "weather_description": desc, "cloudiness": F.col("cloudiness"),
            "recorded_at": when_ts, "latitude": F.col("latitude"), "longitude": F.col("longitude"),
        }
        return F.to_json(F.struct(*[v.alias(k) for k, v in cols.items()]))

    t_txt = F.col("temperature").cast("string")
    t_num = F.col("temperature")
    text_temp = mid % r["text_temp"] == 0
    hum_as_double = hum_frac | hum_float
    value = (F.when(text_temp & hum_as_double, rec(t_txt, hum_d))
              .when(text_temp, rec(t_txt, F.col("humidity")))
              .when(hum_as_double, rec(t_num, hum_d))
              .otherwise(rec(t_num, F.col("humidity"))))
    out = df.select(mid.alias("message_id"), value.alias("value"))
    cut = F.when(F.col("message_id") % r["broken"] == 0, F.substring("value", 1, 30)).otherwise(F.col("value"))
    return out.withColumn("value", cut)
