"""The ``observations`` table, derived by Spark from the driver's tables.

No weather table exists in the test data, so observations are defined as
``events`` joined with ``nation`` and ``region``: one event is one reading of
one city.  Work grows with ``events``; the city dimension is the broadcast
side once its row count is checked (never the fact table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.schemas import PARTITION_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def city_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dimension: id, name, country (region), fixed coordinates."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("city_id"),
                    F.col("n_name").alias("name"),
                    F.col("r_name").alias("country"),
                    (F.col("n_nationkey") * 5 - 60).cast("double").alias("lat"),
                    (F.col("n_nationkey") * 10 - 120).cast("double").alias("lon")))


def date_parts(df: DataFrame, ts: str = "recorded_at") -> DataFrame:
    """year / month / day-of-month / hour of the event time (session zone UTC)."""
    c = F.col(ts)
    return (df.withColumn("year", F.year(c))
              .withColumn("month", F.month(c))
              .withColumn("day", F.dayofmonth(c))
              .withColumn("hour", F.hour(c)))


def observations(spark: SparkSession, sf_dir: str, with_parts: bool = True,
                 with_city_id: bool = False, spread: bool = False, by_time: bool = False) -> DataFrame:
    """Typed observation rows (the lake table's content).

    Column formulas (fixed adapter definition, shared with the oracle SQL):
    temperature = round(value*0.4-10, 2); feels_like = round(value*0.4-10-(k-50)*0.1, 2);
    humidity = k (+50 when event_id % 97 = 0); pressure = 980 + event_id % 60;
    wind_speed = ((event_id*7) % 3000) / 100; wind_direction = event_id % 360;
    visibility = 1000 + event_id % 9000 (null when event_id % 11 = 0);
    cloudiness = (k*3) % 101; condition = event_type; description = event_type || ' sky'.
    """
    from stratus.operators.joins import broadcast_if_bounded
    from stratus.operators.partitioning import ensure_parallelism, tasks_for

    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    if by_time:  # the same, in contiguous ranges of event time, as a feed delivers them
        ev = ev.repartitionByRange(tasks_for(spark, ev.count()), "ts")
    elif spread:  # heavy per-row work follows (JSON, regex): use every core
        ev = ensure_parallelism(ev)
    dim = broadcast_if_bounded(city_dimension(spark, sf_dir), cache_key=f"city_dimension:{sf_dir}")
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id")
    signed0 = F.lit(0.0)
    df = (ev.join(dim, (F.col("user_id") % 25) == F.col("city_id"))
            .select(
                F.col("name").alias("city"),
                F.col("country"),
                (F.round(F.col("value") * F.expr("0.4") - 10, 2) + signed0).alias("temperature"),
                (F.round(F.col("value") * F.expr("0.4") - 10 - (k - 50) * F.expr("0.1"), 2)
                 + signed0).alias("feels_like"),
                (k + F.when(eid % 97 == 0, 50).otherwise(0)).cast("int").alias("humidity"),
                (980 + eid % 60).cast("int").alias("pressure"),
                (((eid * 7) % 3000).cast("double") / 100).alias("wind_speed"),
                (eid % 360).cast("int").alias("wind_direction"),
                F.when(eid % 11 == 0, F.lit(None)).otherwise(1000 + eid % 9000).cast("int").alias("visibility"),
                F.col("event_type").alias("weather_condition"),
                F.concat(F.col("event_type"), F.lit(" sky")).alias("weather_description"),
                ((k * 3) % 101).cast("int").alias("cloudiness"),
                F.col("ts").cast("timestamp").alias("recorded_at"),
                F.col("lat").alias("latitude"),
                F.col("lon").alias("longitude"),
                eid.alias("kafka_offset"),
                (eid % 3).cast("int").alias("kafka_partition"),
                *([F.col("city_id")] if with_city_id else []),
            ))
    return date_parts(df) if with_parts else df


# Oracle-side definition of the same table (DuckDB dialect).
OBSERVATIONS_SQL = """
SELECT n.n_name AS city,
       r.r_name AS country,
       ROUND(e.value*0.4-10, 2) + 0.0::DOUBLE AS temperature,
       ROUND(e.value*0.4-10-(CAST(e.props->>'$.k' AS INT)-50)*0.1, 2) + 0.0::DOUBLE AS feels_like,
       CAST(CAST(e.props->>'$.k' AS INT) + CASE WHEN e.event_id%97=0 THEN 50 ELSE 0 END AS INT) AS humidity,
       CAST(980 + e.event_id%60 AS INT) AS pressure,
       CAST((e.event_id*7)%3000 AS DOUBLE)/100 AS wind_speed,
       CAST(e.event_id%360 AS INT) AS wind_direction,
       CASE WHEN e.event_id%11=0 THEN NULL ELSE CAST(1000+e.event_id%9000 AS INT) END AS visibility,
       e.event_type AS weather_condition,
       CONCAT(e.event_type, ' sky') AS weather_description,
       CAST((CAST(e.props->>'$.k' AS INT)*3)%101 AS INT) AS cloudiness,
       CAST(e.ts AS TIMESTAMP) AS recorded_at,
       CAST(n.n_nationkey*5-60 AS DOUBLE) AS latitude,
       CAST(n.n_nationkey*10-120 AS DOUBLE) AS longitude,
       e.event_id AS kafka_offset,
       CAST(e.event_id%3 AS INT) AS kafka_partition,
       CAST(year(e.ts) AS INT) AS year, CAST(month(e.ts) AS INT) AS month,
       CAST(day(e.ts) AS INT) AS day, CAST(hour(e.ts) AS INT) AS hour
FROM events e
JOIN nation n ON n.n_nationkey = e.user_id % 25
JOIN region r ON r.r_regionkey = n.n_regionkey
"""

__all__ = ["table", "city_dimension", "date_parts", "observations", "OBSERVATIONS_SQL", "PARTITION_COLUMNS"]
