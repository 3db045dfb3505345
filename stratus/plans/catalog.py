"""Registry of queries (Spark) and their oracle SQL (DuckDB dialect).

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables.  Oracle SQL is given where the result is SQL-expressible; keys
without one get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators import analytics as A
from stratus.operators import enrich as EN
from stratus.operators import quality as Q
from stratus.operators import runlog as RL
from stratus.operators import upkeep as U
from stratus.operators import validate as V
from stratus.operators.enrich import REPLAY_OFFSET
from stratus.plans import models as M
from stratus.plans.oracle import (
    HEAT_DUCK, MART_SELECT_DUCK, NORMALIZED_SELECT_DUCK, REPLAY_DEDUP_CTES, STAGING_DUCK, TEMP_BAND_DUCK,
    WIND_STREAM_DUCK, avg2_sql, mart_duck, mode_sql, title_duck, validation_ctes, with_obs)
from stratus.session import configure, scratch_path
from stratus.sources import messages as MS
from stratus.sources import tablelog as L
from stratus.sources.lake import read_table, write_partitioned, write_table
from stratus.sources.observations import city_dimension, observations
from stratus.streaming import faults as FA
from stratus.streaming import fixtures as SF
from stratus.streaming import ingest as ST
from stratus.streaming import monitor as MO

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Expose instants as ``timestamp_ntz`` holding UTC wall-clock time.

    Internally event time is ``timestamp`` (watermarks need it).  Results are
    handed out without a zone, so a client in any local time zone (PySpark
    converts ``timestamp`` to the client's zone on collect) and a SQL engine
    with naive ``TIMESTAMP`` see the same values.
    """
    from pyspark.sql import types as T

    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def register(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return naive_timestamps(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run
    return deco


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir)


# ---------------------------------------------------------------- scans --

@register("scan_observations", with_obs("SELECT * FROM obs"))
def scan_observations(spark, sf_dir):
    """O-02: the lake table's content (adapter over events/nation/region)."""
    return obs(spark, sf_dir)


@register("date_parts", with_obs(
    "SELECT kafka_offset, recorded_at, year, month, day, hour FROM obs"))
def date_parts_q(spark, sf_dir):
    """O-16: date-part columns of the event time."""
    return obs(spark, sf_dir).select("kafka_offset", "recorded_at", "year", "month", "day", "hour")


# ------------------------------------------------------------ analytics --

_AVG_T = avg2_sql("temperature")

@register("avg_temperature_by_city", with_obs(f"""
SELECT city, country, {_AVG_T} AS avg_temperature,
       ROUND(MAX(temperature), 2) AS max_temperature,
       ROUND(MIN(temperature), 2) AS min_temperature,
       COUNT(*) AS record_count
FROM obs GROUP BY city, country"""))
def avg_temperature_by_city(spark, sf_dir):
    """O-42a."""
    return A.avg_temperature_by_city(obs(spark, sf_dir))


@register("city_temperature_rankings", with_obs(f"""
SELECT *, CAST(RANK() OVER (ORDER BY avg_temperature DESC NULLS LAST) AS INTEGER) AS temperature_rank
FROM (SELECT city, country, {_AVG_T} AS avg_temperature,
             ROUND(MAX(temperature), 2) AS max_temperature,
             ROUND(MIN(temperature), 2) AS min_temperature,
             COUNT(*) AS record_count
      FROM obs GROUP BY city, country)"""))
def city_temperature_rankings(spark, sf_dir):
    """O-47: global rank on the rounded average, distributed."""
    return A.city_temperature_rankings(obs(spark, sf_dir))


@register("humidity_trends", with_obs(f"""
SELECT city, country, {avg2_sql('humidity')} AS avg_humidity,
       ROUND(MAX(humidity), 2) AS max_humidity, ROUND(MIN(humidity), 2) AS min_humidity
FROM obs GROUP BY city, country"""))
def humidity_trends(spark, sf_dir):
    """O-42b."""
    return A.humidity_trends(obs(spark, sf_dir))


@register("wind_distribution", with_obs(f"""
SELECT city, country, wind_category, {avg2_sql('wind_speed')} AS avg_wind_speed,
       ROUND(MAX(wind_speed), 2) AS max_wind_speed, COUNT(*) AS occurrence_count
FROM (SELECT *, CASE WHEN wind_speed < 1.5 THEN 'Calm' WHEN wind_speed < 5.5 THEN 'Light Breeze'
                     WHEN wind_speed < 10.7 THEN 'Moderate' ELSE 'Strong' END AS wind_category FROM obs)
GROUP BY city, country, wind_category"""))
def wind_distribution(spark, sf_dir):
    """O-42c, O-19b."""
    return A.wind_distribution(obs(spark, sf_dir))


@register("condition_frequency", with_obs("""
SELECT city, country, weather_condition, COUNT(*) AS occurrence_count
FROM obs GROUP BY city, country, weather_condition
ORDER BY city, occurrence_count DESC"""))
def condition_frequency(spark, sf_dir):
    """O-42d, O-48."""
    return A.condition_frequency(obs(spark, sf_dir))


@register("temp_humidity_correlation", with_obs(f"""
SELECT city, country,
       ROUND(CASE WHEN STDDEV_POP(temperature) * STDDEV_POP(humidity) > 0
             THEN CORR(temperature, humidity) END, 4) AS temp_humidity_correlation,
       {_AVG_T} AS avg_temperature, {avg2_sql('humidity')} AS avg_humidity
FROM obs GROUP BY city, country"""))
def temp_humidity_correlation(spark, sf_dir):
    """O-42e (guarded Pearson correlation)."""
    return A.temp_humidity_correlation(obs(spark, sf_dir))


@register("daily_temperature_range", with_obs(f"""
SELECT city, country, year, month, day,
       ROUND(MAX(temperature) - MIN(temperature), 2) AS daily_range, {_AVG_T} AS avg_temperature
FROM obs GROUP BY city, country, year, month, day"""))
def daily_temperature_range(spark, sf_dir):
    """O-42f."""
    return A.daily_temperature_range(obs(spark, sf_dir))


@register("city_stats", with_obs("""
SELECT city, ROUND(AVG(temperature), 6) AS mean_temp, ROUND(STDDEV_SAMP(temperature), 6) AS stddev_temp,
       COUNT(*) AS record_count
FROM obs GROUP BY city"""))
def city_stats(spark, sf_dir):
    """O-42g: per-city mean and sample stddev (6 dp)."""
    return A.city_stats(obs(spark, sf_dir), places=6)


@register("anomaly_detection", with_obs("""
SELECT city, country, temperature, recorded_at, z_score FROM (
  SELECT o.city, o.country, o.temperature, o.recorded_at,
         ROUND((o.temperature - s.m) / NULLIF(s.sd, 0), 2) AS z_score
  FROM obs o JOIN (SELECT city, AVG(temperature) AS m, STDDEV_SAMP(temperature) AS sd
                   FROM obs GROUP BY city) s ON o.city = s.city)
WHERE z_score IS NOT NULL AND (z_score > 2.0 OR z_score < -2.0)"""))
def anomaly_detection(spark, sf_dir):
    """O-28, O-37, O-39."""
    return A.anomaly_detection(obs(spark, sf_dir))


# ----------------------------------------------------------- enrichment --

@register("temperature_category", with_obs(
    f"SELECT kafka_offset, temperature, {TEMP_BAND_DUCK} AS temperature_category FROM obs"))
def temperature_category(spark, sf_dir):
    """O-17."""
    return EN.with_columns(obs(spark, sf_dir), "temperature_category").select(
        "kafka_offset", "temperature", "temperature_category")


@register("heat_index", with_obs(
    f"SELECT kafka_offset, temperature, humidity, {HEAT_DUCK} AS heat_index FROM obs"))
def heat_index_q(spark, sf_dir):
    """O-18."""
    return (EN.with_columns(obs(spark, sf_dir), "heat_index")
            .select("kafka_offset", "temperature", "humidity", (F.col("heat_index") + 0.0).alias("heat_index")))


@register("wind_category_stream", with_obs(
    f"SELECT kafka_offset, wind_speed, {WIND_STREAM_DUCK} AS wind_category FROM obs"))
def wind_category_stream(spark, sf_dir):
    """O-19a."""
    return EN.with_columns(obs(spark, sf_dir), "wind_category").select("kafka_offset", "wind_speed", "wind_category")


@register("dedup_city_time", with_obs("SELECT * FROM dedup", REPLAY_DEDUP_CTES))
def dedup_city_time(spark, sf_dir):
    """O-45: table + full replay, one row per (city, recorded_at), earliest offset wins."""
    return EN.deduplicate(EN.with_replay(obs(spark, sf_dir)))


@register("enrich_batch", with_obs(f"""
SELECT *, {TEMP_BAND_DUCK} AS temperature_category, {HEAT_DUCK} AS heat_index,
       {WIND_STREAM_DUCK} AS wind_category, '1.0.0' AS pipeline_version
FROM dedup""", REPLAY_DEDUP_CTES))
def enrich_batch(spark, sf_dir):
    """O-24, O-25: dedup -> bands -> heat index -> wind band -> lineage (processed_at left out)."""
    out = EN.transform_batch(EN.with_replay(obs(spark, sf_dir)))
    return out.drop("processed_at").withColumn("heat_index", F.col("heat_index") + 0.0)


# ----------------------------------------------------------- SQL models --

@register("staging_weather", with_obs("SELECT * FROM stg", f"stg AS ({STAGING_DUCK.format(source='obs')})"))
def staging_weather(spark, sf_dir):
    """O-26, O-27, O-29, O-19c."""
    return M.staging(obs(spark, sf_dir))


@register("mart_city_weather_summary", with_obs(
    MART_SELECT_DUCK, f"stg AS ({STAGING_DUCK.format(source='obs')}),\n" + mart_duck("stg")))
def mart_city_weather_summary(spark, sf_dir):
    """O-43, O-44, O-49: daily city summary, 21 columns."""
    return M.mart(M.staging(obs(spark, sf_dir)))


@register("mart_incremental", ORACLE["mart_city_weather_summary"])
def mart_incremental(spark, sf_dir):
    """O-43 kept up batch by batch: every batch holds rows of every day, and the second one is replayed."""
    o, state, path = obs(spark, sf_dir), scratch_path(spark, "mart_state"), scratch_path(spark, "mart")
    for i in (0, 1, 1, 2):
        M.update_mart(o.filter(F.pmod("kafka_offset", F.lit(3)) == i), f"batch-{i}", state, path)
    return M.read_mart(spark, path)


_DOM_KEYS = ["city", "country"]


@register("dominant_conditions", with_obs("""
SELECT c.city, c.country, m1.dominant_weather_condition, m2.dominant_temperature_category,
       m3.dominant_wind_category, c.record_count
FROM (SELECT city, country, COUNT(*) AS record_count FROM stg GROUP BY city, country) c
LEFT JOIN m1 ON c.city = m1.city AND c.country = m1.country
LEFT JOIN m2 ON c.city = m2.city AND c.country = m2.country
LEFT JOIN m3 ON c.city = m3.city AND c.country = m3.country""",
    f"stg AS ({STAGING_DUCK.format(source='obs')}),\n"
    f"m1 AS ({mode_sql(_DOM_KEYS, 'weather_condition', 'stg', 'dominant_weather_condition')}),\n"
    f"m2 AS ({mode_sql(_DOM_KEYS, 'temperature_category', 'stg', 'dominant_temperature_category')}),\n"
    f"m3 AS ({mode_sql(_DOM_KEYS, 'wind_category', 'stg', 'dominant_wind_category')})"))
def dominant_conditions(spark, sf_dir):
    """O-44: ordered-set mode per city, ties to the smallest value."""
    return M.dominant_conditions(M.staging(obs(spark, sf_dir)))


# ------------------------------------------------------ wire encodings --


@register("flatten_payload", with_obs("""
SELECT kafka_offset AS message_id, city, country, temperature, feels_like, humidity, pressure, wind_speed,
       CASE WHEN kafka_offset % 13 = 0 THEN 0 ELSE wind_direction END AS wind_direction,
       COALESCE(visibility, 0) AS visibility, weather_condition, weather_description, cloudiness,
       DATE_TRUNC('second', recorded_at) AS recorded_at, latitude, longitude
FROM obs"""))
def flatten_payload(spark, sf_dir):
    """O-03, O-40: nested payload JSON -> flat record joined with the city dimension."""
    payloads = MS.encode_payloads(observations(spark, sf_dir, with_parts=False, with_city_id=True, spread=True))
    return MS.flatten_payload(payloads, city_dimension(spark, sf_dir))


@register("parse_messages", with_obs(f"""
SELECT CASE WHEN b THEN NULL ELSE city END AS city, CASE WHEN b THEN NULL ELSE country END AS country,
       CASE WHEN b THEN NULL ELSE temperature END AS temperature,
       CASE WHEN b THEN NULL ELSE feels_like END AS feels_like,
       CASE WHEN b THEN NULL ELSE humidity END AS humidity, CASE WHEN b THEN NULL ELSE pressure END AS pressure,
       CASE WHEN b THEN NULL ELSE wind_speed END AS wind_speed,
       CASE WHEN b THEN NULL ELSE wind_direction END AS wind_direction,
       CASE WHEN b THEN NULL ELSE visibility END AS visibility,
       CASE WHEN b THEN NULL ELSE weather_condition END AS weather_condition,
       CASE WHEN b THEN NULL ELSE weather_description END AS weather_description,
       CASE WHEN b THEN NULL ELSE cloudiness END AS cloudiness,
       CASE WHEN b THEN NULL ELSE recorded_at END AS recorded_at,
       CASE WHEN b THEN NULL ELSE latitude END AS latitude, CASE WHEN b THEN NULL ELSE longitude END AS longitude,
       CAST(NULL AS VARCHAR) AS schema_version, ts0 AS kafka_timestamp, kafka_offset, kafka_partition,
       CASE WHEN b THEN NULL ELSE year END AS year, CASE WHEN b THEN NULL ELSE month END AS month,
       CASE WHEN b THEN NULL ELSE day END AS day, CASE WHEN b THEN NULL ELSE hour END AS hour
FROM (SELECT *, kafka_offset % {MS.BROKEN_EVERY} = 0 AS b, recorded_at AS ts0 FROM obs)"""))
def parse_messages_q(spark, sf_dir):
    """O-13, O-14, O-15, O-51: to_json messages decoded back (permissive, try_to_timestamp)."""
    return MS.parse_messages(MS.encode_messages(observations(spark, sf_dir, with_parts=False, spread=True)))


def _checked(spark, sf_dir, by_time=False):
    raw = MS.untidy_messages(observations(spark, sf_dir, with_parts=False, spread=True, by_time=by_time))
    return V.check(raw)


@register("normalize_records", with_obs(
    NORMALIZED_SELECT_DUCK.format(title=title_duck("city_raw")), validation_ctes()))
def normalize_records(spark, sf_dir):
    """O-20..O-23: lax coercion + title/strip/round normalisation of valid records."""
    return V.normalized(_checked(spark, sf_dir), keep=["message_id"])


@register("valid_records", with_obs(
    "SELECT message_id, is_valid, error_count FROM checked", validation_ctes()))
def valid_records(spark, sf_dir):
    """O-30: range and type rules; one verdict per record."""
    return _checked(spark, sf_dir).select("message_id", "is_valid", F.size("errors").cast("long").alias("error_count"))


@register("invalid_records", with_obs("""
SELECT message_id, CASE WHEN broken THEN 'unknown' ELSE city_raw END AS key, error_count, fields
FROM checked WHERE NOT is_valid""", validation_ctes()))
def invalid_records(spark, sf_dir):
    """O-31: invalid records with their key and failed fields."""
    c = _checked(spark, sf_dir)
    return (c.filter(~F.col("is_valid"))
             .select("message_id", V.message_key(c).alias("key"), F.size("errors").cast("long").alias("error_count"),
                     F.array_join(F.col("errors.loc"), ",").alias("fields")))


@register("error_report", with_obs(
    "SELECT message_id, loc, type, msg, input FROM errs", validation_ctes()))
def error_report(spark, sf_dir):
    """O-32: every failure of every record (not only the first)."""
    return V.error_rows(_checked(spark, sf_dir), keep=["message_id"])


@register("route_summary", with_obs("""
SELECT 'raw_weather_stream' AS topic, COUNT(*) AS messages FROM checked
UNION ALL SELECT 'validated_weather_stream', COUNT(*) FROM checked WHERE is_valid
UNION ALL SELECT 'invalid_weather_stream', COUNT(*) FROM checked WHERE NOT is_valid""", validation_ctes()))
def route_summary(spark, sf_dir):
    """O-10: routed messages written to a topic-partitioned table, counted per topic."""
    target = scratch_path(spark, "topics")
    V.write_routed(V.route(_checked(spark, sf_dir)), target)
    return spark.read.parquet(target).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@register("route_topics")
def route_topics(spark, sf_dir):
    """O-10, O-13: the routed messages themselves (topic, key, JSON value)."""
    return V.route(_checked(spark, sf_dir), keep=["message_id"])


# --------------------------------------------------------- data quality --


def _dq_union_duck(scope: str, source: str, rules: list[tuple[str, str, str]]) -> str:
    parts = [f"SELECT '{scope}' AS scope, '{chk}' AS check_name, '{col}' AS column_name, "
             f"CAST(COUNT(*) FILTER (WHERE {pred}) AS BIGINT) AS violations FROM {source}"
             for chk, col, pred in rules]
    return "\nUNION ALL ".join(parts)


_CONSTRAINT_RULES_DUCK = ([("not_null", c, f"{c} IS NULL") for c in Q.NOT_NULL_COLUMNS]
                          + [("check", c, f"NOT COALESCE({cond}, TRUE)") for c, cond in Q.CHECKS.items()])


@register("dq_constraints", with_obs(_dq_union_duck("observations", "obs", _CONSTRAINT_RULES_DUCK)))
def dq_constraints(spark, sf_dir):
    """O-33: NOT NULL and CHECK violations of the observation table, one pass."""
    return Q.constraints(obs(spark, sf_dir))


@register("dq_not_null", with_obs(
    _dq_union_duck("stg_weather_events", "stg", [("not_null", c, f"{c} IS NULL") for c in Q.STAGING_NOT_NULL])
    + "\nUNION ALL "
    + _dq_union_duck("mart_city_weather_summary", "mart", [("not_null", c, f"{c} IS NULL") for c in Q.MART_NOT_NULL]),
    f"stg AS ({STAGING_DUCK.format(source='obs')}),\n" + mart_duck("stg")
    + f",\nmart AS ({MART_SELECT_DUCK})"))
def dq_not_null(spark, sf_dir):
    """O-35: declared not_null tests of both models."""
    stg = M.staging(obs(spark, sf_dir))
    return (Q.not_null(stg, Q.STAGING_NOT_NULL, "stg_weather_events")
            .unionByName(Q.not_null(M.mart(stg), Q.MART_NOT_NULL, "mart_city_weather_summary")))


def _accepted_duck() -> str:
    rules = []
    for c, vals in Q.ACCEPTED_VALUES.items():
        lst = ", ".join(f"'{v}'" for v in vals)
        rules.append(("accepted_values", c, f"{c} IS NOT NULL AND {c} NOT IN ({lst})"))
    return _dq_union_duck("stg_weather_events", "stg", rules)


@register("dq_accepted_values", with_obs(_accepted_duck(), f"stg AS ({STAGING_DUCK.format(source='obs')})"))
def dq_accepted_values(spark, sf_dir):
    """O-36: band columns only take their declared values (nulls not reported)."""
    return Q.accepted_values(M.staging(obs(spark, sf_dir)), Q.ACCEPTED_VALUES, "stg_weather_events")


# ------------------------------------------------------------- run log --

def _runs_duck(unit: str, job: str, status: str) -> str:
    t = f"date_trunc('{unit}', recorded_at)"
    return (f"SELECT '{job}__' || strftime({t}, '%Y-%m-%dT%H:%M:%S') AS run_id, '{job}' AS job_name, "
            f"{t} AS started_at, MAX(recorded_at) AS completed_at, COUNT(*) AS records_processed, "
            f"'{status}' AS status, CAST(NULL AS VARCHAR) AS error_message "
            f"FROM obs WHERE recorded_at IS NOT NULL GROUP BY {t}")


_RUN_CTES = (f"hourly AS ({_runs_duck('hour', 'batch_analysis', 'success')}),\n"
             f"daily AS ({_runs_duck('day', 'daily_rollup', 'success')}),\n"
             f"final_log AS (SELECT * FROM hourly UNION ALL SELECT * FROM daily)")


def _incoming_runs(o):
    return (RL.runs_from_observations(o, "hour", "batch_analysis", "retry", attempt=2)
            .unionByName(RL.runs_from_observations(o, "day", "daily_rollup", "success", attempt=1))
            .unionByName(RL.runs_from_observations(o, "day", "daily_rollup", "retry", attempt=2)))


def _run_log(spark, sf_dir):
    """Write the hourly run log, then idempotently append a batch with retries."""
    from stratus.schemas import RUN_LOG_SCHEMA
    o = obs(spark, sf_dir)
    path = scratch_path(spark, "run_log")
    write_table(RL.runs_from_observations(o, "hour").select(*RL.RUN_COLUMNS), path)
    existing = read_table(spark, path, schema=RUN_LOG_SCHEMA)
    RL.append_idempotent(existing, _incoming_runs(o)).write.mode("append").parquet(path)
    return read_table(spark, path, schema=RUN_LOG_SCHEMA)


@register("run_log_append", with_obs("SELECT * FROM final_log", _RUN_CTES))
def run_log_append(spark, sf_dir):
    """O-11, O-41: insert-or-ignore on run_id (in-batch dedup + left anti join)."""
    return _run_log(spark, sf_dir)


@register("dq_unique", with_obs("""
SELECT run_id, COUNT(*) AS occurrences FROM (
  SELECT run_id FROM hourly UNION ALL SELECT run_id FROM daily UNION ALL SELECT run_id FROM daily)
GROUP BY run_id HAVING COUNT(*) > 1""", _RUN_CTES))
def dq_unique(spark, sf_dir):
    """O-34: uniqueness test on run_id over an incoming batch with retries."""
    return Q.duplicates(_incoming_runs(obs(spark, sf_dir)), "run_id")


@register("latest_run", with_obs(
    "SELECT * FROM final_log ORDER BY started_at DESC, run_id DESC LIMIT 1", _RUN_CTES))
def latest_run(spark, sf_dir):
    """O-50: newest run first, limit 1 (history(1))."""
    return RL.latest(_run_log(spark, sf_dir), 1)


# --------------------------------------------------------------- sinks --


def _write_lake(spark, sf_dir, mode="overwrite"):
    """Partitioned lake table of the observations; returns (path, schema)."""
    o = obs(spark, sf_dir)
    path = scratch_path(spark, "weather_events")
    write_partitioned(o, path, mode=mode)
    return path, o.schema


def analytics_tables(spark, sf_dir, base: str | None = None, fmt: str = "parquet") -> dict[str, str]:
    """O-63: the eight jobs over one cached, column-pruned scan; each table overwritten."""
    return analytics_run(spark, sf_dir, base, fmt)[0]


def analytics_run(spark, sf_dir, base: str | None = None, fmt: str = "parquet"):
    """Batch analyses over the observations; returns (table paths, run record)."""
    from stratus.plans.jobs import batch_analysis

    return batch_analysis(obs(spark, sf_dir), base or scratch_path(spark, "analytics"), fmt)


def _roundtrip_oracle() -> str:
    parts = [f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM ({ORACLE[n]})" for n in A.JOBS]
    return "\nUNION ALL ".join(parts)


@register("analytics_roundtrip", _roundtrip_oracle())
def analytics_roundtrip(spark, sf_dir):
    """O-07, O-63: eight analytics tables written (overwrite) and read back."""
    paths = analytics_tables(spark, sf_dir)
    frames = [read_table(spark, p).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
              for n, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("batch_run_log", with_obs(
    "SELECT 'batch_analysis' AS job_name, COUNT(*) AS records_processed, 'success' AS status, 8 AS jobs_run FROM obs"))
def batch_run_log(spark, sf_dir):
    """G9, O-11: the batch run's log record from real counts (times and id left out)."""
    _, run = analytics_run(spark, sf_dir)
    return run.select("job_name", "records_processed", "status", "jobs_run")


@register("partition_roundtrip", with_obs("SELECT * FROM obs"))
def partition_roundtrip(spark, sf_dir):
    """O-08: partitioned write by year/month/day/hour, read back with values preserved."""
    path, schema = _write_lake(spark, sf_dir)
    return read_table(spark, path, schema=schema)


@register("append_accumulates", with_obs("SELECT * FROM obs UNION ALL SELECT * FROM obs"))
def append_accumulates(spark, sf_dir):
    """O-09: a second append doubles the rows (bag union)."""
    path, schema = _write_lake(spark, sf_dir)
    write_partitioned(obs(spark, sf_dir), path, mode="append")
    return read_table(spark, path, schema=schema)


@register("partition_inventory", with_obs("""
SELECT year, COUNT(*) AS partitions FROM (SELECT DISTINCT year, month, day, hour FROM obs) GROUP BY year"""))
def partition_inventory(spark, sf_dir):
    """O-38: readiness check (fails on a missing table) and partitions per year."""
    path, _ = _write_lake(spark, sf_dir)
    return U.partition_inventory(spark, path)


@register("table_metrics")
def table_metrics(spark, sf_dir):
    """O-46: file count and bytes of the lake table (file layout: rows-only check)."""
    path, _ = _write_lake(spark, sf_dir)
    return U.table_metrics(spark, path)


@register("compact_table")
def compact_table(spark, sf_dir):
    """O-59: compaction of a many-small-files table; rows preserved, metrics reported."""
    path, schema = _write_lake(spark, sf_dir)
    write_partitioned(obs(spark, sf_dir), path, mode="append")  # a second batch: 2 files per partition
    new_path = scratch_path(spark, "weather_events_compacted")
    m = U.compact(spark, path, new_path)
    rows_before = read_table(spark, path, schema=schema).count()
    rows_after = read_table(spark, new_path, schema=schema).count()
    return spark.createDataFrame(
        [(m["files_added"], m["files_removed"], float(m["duration_seconds"]), rows_before, rows_after)],
        "files_added int, files_removed int, duration_seconds double, rows_before long, rows_after long")


@register("retention_report")
def retention_report(spark, sf_dir):
    """O-60: files older than the retention window (report only on Parquet)."""
    path, _ = _write_lake(spark, sf_dir)
    return U.retention_report(spark, path)


@register("maintenance_report")
def maintenance_report(spark, sf_dir):
    """O-61: metrics -> compact -> retention -> metrics, one nested row from the table's run log."""
    path, schema = _write_lake(spark, sf_dir)
    return U.upkeep(spark, path, "maintenance", schema=schema).select(*U.REPORT_SCHEMA.names)


_SLICE_CTES = """
bounds AS (SELECT coalesce(min(epoch_us(recorded_at)), 0) AS lo, coalesce(max(epoch_us(recorded_at)), 0) AS hi FROM obs),
sliced AS (SELECT obs.*, coalesce(least(floor((epoch_us(recorded_at) - lo) / greatest(1, (hi - lo + 3) // 3)), 2), 0) AS slice FROM obs, bounds)"""
_MONTHS = ["year", "month"]


def _slices_with_upkeep(spark, sf_dir, run_ids: list[str], small_files: int = 4):
    """A table by month that grows by event-time slices of many small files, with an upkeep run after each."""
    o, path = obs(spark, sf_dir), scratch_path(spark, "weather_events")
    for cond, run_id in zip(SF.slices(o, len(run_ids)), run_ids):
        # Dealt by the offset's hash: a round-robin exchange would sort the whole slice first.
        write_partitioned(o.filter(cond).repartition(small_files, "kafka_offset"), path, partition_cols=_MONTHS, rebalance=False)
        U.upkeep(spark, path, run_id, partition_cols=_MONTHS, schema=o.schema)
    return path, o.schema


@register("compact_selective", with_obs("SELECT * FROM obs"))
def compact_selective(spark, sf_dir):
    """O-59: the present version of a table whose small files were packed after every append."""
    path, schema = _slices_with_upkeep(spark, sf_dir, ["run-0", "run-1", "run-2"])
    files = L.files_of(L.manifest(spark, path))
    if files.filter("not compacted").isEmpty() and not files.isEmpty():
        return L.read_version(spark, path, schema=schema)
    raise RuntimeError("small files were left")


@register("read_as_of_run", with_obs("""
SELECT CAST(v AS INTEGER) AS version, count(*) AS n_rows, CAST(sum(kafka_offset) AS BIGINT) AS offsets, count(DISTINCT city) AS cities
FROM sliced, (SELECT unnest(range(4)) AS v) WHERE slice < greatest(v, 1) GROUP BY v""", _SLICE_CTES))
def read_as_of_run(spark, sf_dir):
    """O-64: every version of the table, read after all its runs: the rows of that run and no later ones."""
    path, schema = _slices_with_upkeep(spark, sf_dir, ["run-0", "run-1", "run-2"])
    out = None
    for v in range(4):
        rows = read_table(spark, path, schema=schema, version_as_of=v).agg(
            F.lit(v).alias("version"), F.count("*").alias("n_rows"), F.sum("kafka_offset").alias("offsets"),
            F.countDistinct("city").alias("cities"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("maintenance_status", with_obs("""
SELECT run_id, CASE WHEN r <= 2 THEN 'completed' ELSE 'no_result' END AS status,
       CASE WHEN r <= 2 THEN CAST(least(n, 2) - r AS VARCHAR) END AS before_version,
       CASE WHEN r <= 2 THEN CAST(least(n, 2) - r + 1 AS VARCHAR) END AS after_version
FROM (SELECT *, row_number() OVER (ORDER BY started_at DESC) AS r, count(*) OVER () AS n FROM upkeep_runs)""",
    f"upkeep_runs AS ({_runs_duck('day', 'table_upkeep', 'success')})"))
def maintenance_status(spark, sf_dir):
    """O-62: the scheduled daily runs against the table's run log, in which the last two days' runs are."""
    o = obs(spark, sf_dir)
    scheduled = RL.runs_from_observations(o, "day", "table_upkeep")
    ran = [r["run_id"] for r in RL.latest(scheduled, 2).select("run_id").collect()][::-1]
    path, _ = _slices_with_upkeep(spark, sf_dir, ran)
    return U.maintenance_status(scheduled, L.runs(spark, path)).drop("files_removed")


# ----------------------------------------------------------- streaming --


_PARSED_COLS = ("city, country, temperature, feels_like, humidity, pressure, wind_speed, wind_direction, "
                "visibility, weather_condition, weather_description, cloudiness, recorded_at, latitude, "
                "longitude, CAST(NULL AS VARCHAR) AS schema_version, recorded_at AS kafka_timestamp, "
                "kafka_offset, kafka_partition, year, month, day, hour")


def _stream(spark, sf_dir, kind: str, replay: bool, broken_every=None, extra_noop_run=False,
            partitioned: bool = True, replay_in_batch: bool = False):
    """Stage message groups one at a time; after each, one availableNow run of ``kind``."""
    return _streams(spark, sf_dir, [kind], replay, broken_every, extra_noop_run, partitioned, replay_in_batch)[kind]


def _streams(spark, sf_dir, kinds: list[str], replay: bool, broken_every=None, extra_noop_run=False,
             partitioned: bool = True, replay_in_batch: bool = False) -> dict[str, DataFrame]:
    """Like ``_stream`` for several queries reading one staged source (each with its own
    sink and checkpoint); returns each sink's batch read.  The replay comes as a last
    group, or with ``replay_in_batch`` beside every group's own rows."""
    # One staged file range per task (see fixtures.stage): the partitioned sink
    # then writes each hour from one task.
    o = observations(spark, sf_dir, with_parts=False)
    src = scratch_path(spark, "messages")
    dirs = {k: (scratch_path(spark, f"{k}_sink"), scratch_path(spark, f"{k}_ckpt")) for k in kinds}
    groups = [(c, False) for c in SF.slices(o, 3)] + ([(None, True)] if replay and not replay_in_batch else [])

    def starter(kind):
        sink, ckpt = dirs[kind]

        def start():
            parsed = ST.parse_stream(ST.read_messages(spark, src))
            if kind == "enrich":
                return ST.start_enrich(parsed, sink, ckpt, trigger={"availableNow": True})
            if kind == "dedup":
                parsed = ST.dedup_stream(parsed)
            cols = None if partitioned else []
            return ST.start_ingest(parsed, sink, ckpt, trigger={"availableNow": True}, partition_cols=cols)
        return start

    for cond, is_replay in groups:
        SF.stage(o, src, cond, replay=is_replay, broken_every=broken_every)
        if replay_in_batch:
            SF.stage(o, src, cond, replay=True, broken_every=broken_every)
        for k in kinds:
            ST.run_available(starter(k))
    if extra_noop_run:
        for k in kinds:
            ST.run_available(starter(k))
    parsed_schema = ST.parse_stream(ST.read_messages(spark, src)).schema
    return {k: (spark.read.parquet(dirs[k][0]) if k == "enrich"
                else spark.read.schema(parsed_schema).parquet(dirs[k][0])) for k in kinds}


@register("stream_ingest", ORACLE["parse_messages"])
def stream_ingest(spark, sf_dir):
    """O-01, O-06, O-52: file-source stream -> parse + watermark -> partitioned append sink."""
    return _stream(spark, sf_dir, "ingest", replay=False, broken_every=MS.BROKEN_EVERY)


@register("stream_restart", with_obs(f"SELECT {_PARSED_COLS} FROM obs"))
def stream_restart(spark, sf_dir):
    """O-56, O-57: checkpointed availableNow runs; a restart without new files adds nothing."""
    return _stream(spark, sf_dir, "ingest", replay=False, extra_noop_run=True)


@register("stream_dedup", with_obs(f"SELECT {_PARSED_COLS} FROM obs"))
def stream_dedup(spark, sf_dir):
    """O-55: dropDuplicatesWithinWatermark on (city, recorded_at) across batches, replay included."""
    return _stream(spark, sf_dir, "dedup", replay=True, partitioned=False)


@register("stream_late_dropped", with_obs(
    "SELECT kafka_offset + 1000000000000 AS kafka_offset, city, recorded_at FROM obs"))
def stream_late_dropped(spark, sf_dir):
    """O-53: rows the raw ingest keeps but the stateful dedup drops (late or duplicate)."""
    out = _streams(spark, sf_dir, ["ingest", "dedup"], replay=True, partitioned=False)
    raw, kept = out["ingest"], out["dedup"]
    return (raw.join(kept.select("kafka_offset"), "kafka_offset", "left_anti")
               .select("kafka_offset", "city", "recorded_at"))


@register("stream_enrich", with_obs(f"""
SELECT {_PARSED_COLS}, {TEMP_BAND_DUCK} AS temperature_category, {HEAT_DUCK} AS heat_index,
       {WIND_STREAM_DUCK} AS wind_category, '1.0.0' AS pipeline_version FROM obs"""))
def stream_enrich(spark, sf_dir):
    """O-54, G1: foreachBatch enrichment; every batch holds a replay of its own rows, which its dedup removes."""
    out = _stream(spark, sf_dir, "enrich", replay=True, replay_in_batch=True)
    return out.drop("processed_at", "query_id", "batch_id").withColumn("heat_index", F.col("heat_index") + 0.0)


@register("stream_validated_topic", with_obs(f"""
SELECT {title_duck('city_raw')} AS city, country, ROUND(temperature, 2) AS temperature,
       ROUND(feels_like, 2) AS feels_like, humidity, pressure, ROUND(wind_speed, 2) AS wind_speed,
       wind_direction, visibility, weather_condition, lower(weather_description) AS weather_description,
       cloudiness, recorded_at, latitude, longitude, CAST(NULL AS VARCHAR) AS schema_version,
       recorded_at AS kafka_timestamp, message_id AS kafka_offset, CAST(message_id % 3 AS INTEGER) AS kafka_partition,
       CAST(year(recorded_at) AS INTEGER) AS year, CAST(month(recorded_at) AS INTEGER) AS month,
       CAST(day(recorded_at) AS INTEGER) AS day, CAST(hour(recorded_at) AS INTEGER) AS hour
FROM checked WHERE is_valid""", validation_ctes()))
def stream_validated_topic(spark, sf_dir):
    """O-10 -> O-01 -> O-06 end to end: raw records are validated and routed to a
    topic-partitioned table; the validated topic is streamed into the lake table."""
    # Topic files cover event-time ranges (a time-ordered feed), so each stream
    # task writes only its own hour directories.  The records are ordered before
    # they are checked: a range exchange runs what is below it twice.
    checked = _checked(spark, sf_dir, by_time=True)
    routed = V.route(checked, keep=["message_id", "v_recorded_at"]).select(
        "topic", "key", "value", (F.col("message_id") % 3).cast("int").alias("partition"),
        F.col("message_id").alias("offset"), F.col("v_recorded_at").alias("timestamp"))
    topics, sink, ckpt = (scratch_path(spark, n) for n in ("topics", "validated_sink", "validated_ckpt"))
    V.write_routed(routed, topics)
    source = f"{topics}/topic={V.TOPIC_VALID}"

    def start():
        parsed = ST.parse_stream(ST.read_messages(spark, source))
        return ST.start_ingest(parsed, sink, ckpt, trigger={"availableNow": True})

    ST.run_available(start)
    return spark.read.schema(ST.parse_stream(ST.read_messages(spark, source)).schema).parquet(sink)


@register("stream_route", with_obs(f"""
SELECT '{V.TOPIC_RAW}' AS topic, message_id, CASE WHEN broken THEN 'unknown' ELSE city_raw END AS key,
       CAST(NULL AS VARCHAR) AS city, CAST(NULL AS DOUBLE) AS temperature, CAST(NULL AS BIGINT) AS error_count FROM checked
UNION ALL SELECT '{V.TOPIC_VALID}', message_id, city_raw, {title_duck('city_raw')}, ROUND(temperature, 2), NULL FROM checked WHERE is_valid
UNION ALL SELECT '{V.TOPIC_INVALID}', message_id, CASE WHEN broken THEN 'unknown' ELSE city_raw END, NULL, NULL, error_count
FROM checked WHERE NOT is_valid""", validation_ctes()))
def stream_route(spark, sf_dir):
    """O-10 as a running stream: raw messages of three runs to three topics, their bodies decoded again."""
    raw = MS.untidy_messages(observations(spark, sf_dir, with_parts=False, spread=True)).select(
        F.lit(None).cast("string").alias("key"), "value", F.lit(0).alias("partition"), F.col("message_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"))
    src, out, ckpt = (scratch_path(spark, n) for n in ("raw", "topics", "router_ckpt"))
    for run in range(3):
        raw.filter(F.pmod("offset", F.lit(3)) == run).write.mode("append").parquet(src)
        ST.run_available(lambda: ST.start_router(ST.read_messages(spark, src), out, ckpt, trigger={"availableNow": True}))
    valid, invalid = F.col("topic") == V.TOPIC_VALID, F.col("topic") == V.TOPIC_INVALID
    return spark.read.parquet(out).select(
        "topic", F.col("offset").alias("message_id"), "key",
        F.when(valid, F.get_json_object("value", "$.city")).alias("city"),
        F.when(valid, F.get_json_object("value", "$.temperature").cast("double")).alias("temperature"),
        F.when(invalid, F.size(F.from_json("value", f"raw string, errors {V.ERROR_TYPE}")["errors"])).cast("long").alias("error_count"))


@register("stream_dedup_lowest", with_obs(f"SELECT {_PARSED_COLS} FROM obs"))
def stream_dedup_lowest(spark, sf_dir):
    """O-45, O-55: every batch brings its rows' replays before the rows; the lowest offset stays, as in ``dedup_city_time``."""
    o = observations(spark, sf_dir, with_parts=False)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("messages", "lowest_sink", "lowest_ckpt"))
    # A message a day later closes the last keys; its own key stays open.
    end = F.lit(o.agg(F.max("recorded_at")).first()[0]) + F.expr("interval 1 day")
    closing = o.orderBy("kafka_offset").limit(1).withColumn("recorded_at", end).withColumn("kafka_offset", F.lit(-1).cast("long"))
    for i, cond in enumerate([*SF.slices(o, 3), None]):
        for replay in ((True, False) if i < 3 else (False,)):
            SF.stage(o if i < 3 else closing, src, cond, replay=replay)
        ST.run_available(lambda: ST.start_ingest(ST.dedup_lowest(ST.parse_stream(ST.read_messages(spark, src))), sink, ckpt,
                                                 trigger={"availableNow": True}, partition_cols=[]))
    return spark.read.parquet(sink)


@register("stream_from_latest", with_obs(f"""
SELECT {_PARSED_COLS} FROM obs, (SELECT min(epoch_us(recorded_at)) AS lo, max(epoch_us(recorded_at)) AS hi FROM obs)
WHERE (epoch_us(recorded_at) - lo) // greatest(1, (hi - lo + 3) // 3) >= 1"""))
def stream_from_latest(spark, sf_dir):
    """O-58: the first slice is there before the first start from the latest position; what comes after is read, restarts included."""
    o = observations(spark, sf_dir, with_parts=False)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("messages", "latest_sink", "latest_ckpt"))

    def start():
        raw = ST.read_messages(spark, src, starting=ST.LATEST, checkpoint=ckpt, tolerate_loss=True)
        return ST.start_ingest(ST.parse_stream(raw), sink, ckpt, trigger={"availableNow": True}, partition_cols=[])

    for cond in SF.slices(o, 3):
        SF.stage(o, src, cond)
        ST.run_available(start)
    return spark.read.parquet(sink)


@register("stream_recovery", with_obs("""
SELECT sink, kafka_offset, city, recorded_at FROM obs, (VALUES ('append'), ('batch')) AS s(sink)"""))
def stream_recovery(spark, sf_dir):
    """O-56 under faults: every batch of both sinks is written, lost before its commit, and run again."""
    o = observations(spark, sf_dir, with_parts=False)
    src, sink, ckpt, out, out_ckpt = (scratch_path(spark, n) for n in ("messages", "sink", "ckpt", "batches", "batches_ckpt"))

    def append():
        return ST.start_ingest(ST.parse_stream(ST.read_messages(spark, src)), sink, ckpt,
                               trigger={"availableNow": True}, partition_cols=[])

    write = FA.fail_after(ST.enriched_batch_writer(out, out_ckpt), range(3))

    def batches():
        return (ST.parse_stream(ST.read_messages(spark, src)).writeStream.option("checkpointLocation", out_ckpt)
                  .foreachBatch(write).trigger(availableNow=True).start())

    for i, cond in enumerate(SF.slices(o, 3)):
        SF.stage(o, src, cond)
        ST.run_available(append)
        FA.forget_last_batch(spark, ckpt, sink if i % 2 else None)
        ST.run_available(append)
        FA.run_to_fault(batches)
        ST.run_available(batches)
    cols = ["kafka_offset", "city", "recorded_at"]
    return (spark.read.parquet(sink).select(F.lit("append").alias("sink"), *cols)
            .unionByName(spark.read.parquet(out).select(F.lit("batch").alias("sink"), *cols)))


@register("stream_quality", ORACLE["dq_constraints"])
def stream_quality(spark, sf_dir):
    """O-33 in the stream: the constraints' violations as the ingest observed them, summed over its batches."""
    o = observations(spark, sf_dir, with_parts=False)
    src, sink, ckpt = (scratch_path(spark, n) for n in ("messages", "quality_sink", "quality_ckpt"))
    total: dict[str, int] = {}
    for cond in SF.slices(o, 3):
        SF.stage(o, src, cond)
        for batch in MO.run_watched(spark, lambda: ST.start_ingest(
                MO.with_quality(ST.parse_stream(ST.read_messages(spark, src))), sink, ckpt,
                trigger={"availableNow": True}, partition_cols=[])):
            for rule, n in batch.quality.items():
                total[rule] = total.get(rule, 0) + n
    return spark.createDataFrame([("observations", chk, col, total.get(MO.rule_name(chk, col), 0))
                                  for chk, col, _ in Q.constraint_rules()],
                                 "scope string, check_name string, column_name string, violations long")


@register("stream_late_split", with_obs(f"""
SELECT false AS late, kafka_offset, city, recorded_at FROM obs
UNION ALL SELECT coalesce(recorded_at <= (SELECT max(recorded_at) FROM obs) - INTERVAL {ST.WATERMARK_DELAY}, false),
  kafka_offset + {REPLAY_OFFSET}, city, recorded_at FROM obs"""))
def stream_late_split(spark, sf_dir):
    """O-53 with every row in one place: a replay of all rows is late but for the last minutes."""
    o = observations(spark, sf_dir, with_parts=False)
    src, out, log, ckpt = (scratch_path(spark, n) for n in ("messages", "split", "split_log", "split_ckpt"))
    for cond, replay in [(c, False) for c in SF.slices(o, 3)] + [(None, True)]:
        SF.stage(o, src, cond, replay=replay)
        ST.run_available(lambda: MO.start_split(ST.parse_stream(ST.read_messages(spark, src)), out, log, ckpt,
                                                trigger={"availableNow": True}))
    return spark.read.parquet(out).select(F.col("late").cast("boolean"), "kafka_offset", "city", "recorded_at")
