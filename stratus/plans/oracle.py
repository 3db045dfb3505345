"""DuckDB-dialect SQL helpers for the oracle side of the correctness gate."""

from __future__ import annotations

from stratus.sources.observations import OBSERVATIONS_SQL


def avg2_sql(x: str) -> str:
    """Exact 2-dp average, half away from zero (mirrors ``avg2``)."""
    s = f"SUM(CAST(ROUND(({x})*100) AS BIGINT))"
    n = f"COUNT({x})"
    return f"(SIGN({s})*((2*ABS({s})+{n})//(2*{n}))/100.0::DOUBLE)"


def with_obs(body: str, extra_ctes: str = "") -> str:
    ctes = f"obs AS ({OBSERVATIONS_SQL})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def mode_sql(group_keys: list[str], value: str, source: str, alias: str) -> str:
    """Most frequent ``value`` per group, ties to the smallest value, as a CTE body."""
    g = ", ".join(group_keys)
    return (f"SELECT {g}, {value} AS {alias} FROM ("
            f"SELECT {g}, {value}, ROW_NUMBER() OVER (PARTITION BY {g} "
            f"ORDER BY COUNT(*) DESC, {value} ASC) AS rn FROM {source} "
            f"WHERE {value} IS NOT NULL GROUP BY {g}, {value}) WHERE rn = 1")


# Staging model over ``obs`` (DuckDB dialect; signed rounded values normalised to +0.0).
STAGING_DUCK = """
SELECT city, country,
       ROUND(temperature, 2) + 0.0::DOUBLE AS temperature_c,
       ROUND(feels_like, 2) + 0.0::DOUBLE AS feels_like_c,
       ROUND(temperature - feels_like, 2) + 0.0::DOUBLE AS feels_like_gap_c,
       humidity AS humidity_pct, pressure AS pressure_hpa,
       ROUND(wind_speed, 2) + 0.0::DOUBLE AS wind_speed_ms,
       wind_direction AS wind_direction_deg, cloudiness AS cloudiness_pct, visibility AS visibility_m,
       weather_condition, weather_description,
       CASE WHEN temperature < 0 THEN 'freezing' WHEN temperature < 10 THEN 'cold'
            WHEN temperature < 20 THEN 'mild' WHEN temperature < 30 THEN 'warm' ELSE 'hot' END
         AS temperature_category,
       CASE WHEN wind_speed < 1.5 THEN 'calm' WHEN wind_speed < 5.5 THEN 'light_breeze'
            WHEN wind_speed < 10.7 THEN 'moderate' ELSE 'strong' END AS wind_category,
       latitude, longitude, recorded_at,
       CAST(recorded_at AS DATE) AS recorded_date,
       DATE_TRUNC('hour', recorded_at) AS recorded_hour,
       kafka_offset, kafka_partition
FROM {source}
WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND city IS NOT NULL AND recorded_at IS NOT NULL
"""

TEMP_BAND_DUCK = ("CASE WHEN temperature < 0 THEN 'freezing' WHEN temperature < 10 THEN 'cold' "
                  "WHEN temperature < 20 THEN 'mild' WHEN temperature < 30 THEN 'warm' ELSE 'hot' END")
WIND_STREAM_DUCK = ("CASE WHEN wind_speed < 1.5 THEN 'calm' WHEN wind_speed < 5.5 THEN 'light breeze' "
                    "WHEN wind_speed < 10.7 THEN 'gentle breeze' WHEN wind_speed < 17.1 THEN 'moderate breeze' "
                    "WHEN wind_speed < 24.5 THEN 'fresh breeze' ELSE 'strong wind' END")
HEAT_DUCK = "ROUND(temperature + (0.33::DOUBLE*humidity/100*6.105::DOUBLE) - 4.0::DOUBLE, 2) + 0.0::DOUBLE"

# Observations plus a full replay (later offsets), deduplicated on (city, recorded_at).
REPLAY_DEDUP_CTES = """
replayed AS (SELECT * FROM obs UNION ALL
             SELECT * REPLACE (kafka_offset + 1000000000000 AS kafka_offset) FROM obs),
dedup AS (SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY city, recorded_at
                                         ORDER BY kafka_offset, kafka_partition) AS rn
            FROM replayed) WHERE rn = 1)
"""


def mart_duck(source: str = "stg") -> str:
    """Daily mart over a staging relation, modes picked by count then value."""
    a = avg2_sql
    keys = ["city", "country", "recorded_date"]
    return f"""
agg AS (
  SELECT city, country, recorded_date,
         {a('temperature_c')} AS avg_temperature_c,
         ROUND(MIN(temperature_c), 2) AS min_temperature_c,
         ROUND(MAX(temperature_c), 2) AS max_temperature_c,
         ROUND(MAX(temperature_c) - MIN(temperature_c), 2) + 0.0::DOUBLE AS temperature_range_c,
         {a('feels_like_c')} AS avg_feels_like_c,
         {a('feels_like_gap_c')} AS avg_feels_like_gap_c,
         {a('humidity_pct')} AS avg_humidity_pct,
         ROUND(MIN(humidity_pct), 2) AS min_humidity_pct,
         ROUND(MAX(humidity_pct), 2) AS max_humidity_pct,
         {a('pressure_hpa')} AS avg_pressure_hpa,
         ROUND(MIN(pressure_hpa), 2) AS min_pressure_hpa,
         ROUND(MAX(pressure_hpa), 2) AS max_pressure_hpa,
         {a('wind_speed_ms')} AS avg_wind_speed_ms,
         ROUND(MAX(wind_speed_ms), 2) AS max_wind_speed_ms,
         COUNT(*) AS record_count
  FROM {source} GROUP BY city, country, recorded_date),
m1 AS ({mode_sql(keys, 'temperature_category', source, 'dominant_temperature_category')}),
m2 AS ({mode_sql(keys, 'wind_category', source, 'dominant_wind_category')}),
m3 AS ({mode_sql(keys, 'weather_description', source, 'dominant_weather_description')})
"""


MART_SELECT_DUCK = """
SELECT agg.city, agg.country, agg.recorded_date, avg_temperature_c, min_temperature_c, max_temperature_c,
       temperature_range_c, avg_feels_like_c, avg_feels_like_gap_c, avg_humidity_pct, min_humidity_pct,
       max_humidity_pct, avg_pressure_hpa, min_pressure_hpa, max_pressure_hpa, avg_wind_speed_ms,
       max_wind_speed_ms, dominant_temperature_category, dominant_wind_category,
       dominant_weather_description, record_count
FROM agg
LEFT JOIN m1 ON agg.city IS NOT DISTINCT FROM m1.city AND agg.country IS NOT DISTINCT FROM m1.country
            AND agg.recorded_date IS NOT DISTINCT FROM m1.recorded_date
LEFT JOIN m2 ON agg.city IS NOT DISTINCT FROM m2.city AND agg.country IS NOT DISTINCT FROM m2.country
            AND agg.recorded_date IS NOT DISTINCT FROM m2.recorded_date
LEFT JOIN m3 ON agg.city IS NOT DISTINCT FROM m3.city AND agg.country IS NOT DISTINCT FROM m3.country
            AND agg.recorded_date IS NOT DISTINCT FROM m3.recorded_date
ORDER BY agg.recorded_date DESC, agg.city
"""


def title_duck(s: str) -> str:
    """``str.title`` in DuckDB: upper after any non-letter, lower elsewhere."""
    return (f"array_to_string(list_transform(range(1, length({s})+1), lambda i: "
            f"CASE WHEN i = 1 OR NOT regexp_matches(substring({s}, i-1, 1), '\\p{{L}}') "
            f"THEN upper(substring({s}, i, 1)) ELSE lower(substring({s}, i, 1)) END), '')")


def validation_ctes() -> str:
    """CTEs ``raw_rec`` (fixture fields as sent), ``errs`` (one row per failure), ``checked``."""
    from stratus.operators.validate import CITY_MSG, MSG, RANGES, WIND_MSG
    from stratus.schemas import OBSERVATION_FIELDS
    from stratus.sources.messages import UNTIDY_RULES as R

    raw = f"""
raw_rec AS (
  SELECT kafka_offset AS message_id, kafka_offset % {R['broken']} = 0 AS broken,
         CASE WHEN kafka_offset % {R['blank_city']} = 0 THEN '   '
              WHEN kafka_offset % {R['lower_city']} = 0 THEN lower(city) ELSE city END AS city_raw,
         country, temperature, feels_like, humidity,
         CASE WHEN kafka_offset % {R['frac_hum']} = 0 THEN CAST(humidity + 0.5 AS VARCHAR)
              WHEN kafka_offset % {R['float_hum']} = 0 THEN CAST(CAST(humidity AS DOUBLE) AS VARCHAR)
              ELSE CAST(humidity AS VARCHAR) END AS humidity_txt,
         kafka_offset % {R['frac_hum']} = 0 AS hum_frac,
         pressure, wind_speed, wind_direction, visibility, weather_condition, weather_description,
         cloudiness, recorded_at, kafka_offset % {R['bad_time']} = 0 AS bad_time, latitude, longitude
  FROM obs)"""

    def e(loc, typ, msg, inp, cond):
        inp_sql = "CAST(NULL AS VARCHAR)" if inp is None else inp
        m = msg.replace("'", "''")
        return (f"SELECT message_id, {OBSERVATION_FIELDS.index(loc)} AS pos, '{loc}' AS loc, '{typ}' AS type, "
                f"'{m}' AS msg, {inp_sql} AS input FROM raw_rec WHERE {cond}")

    parts = [e(f, "missing", MSG["missing"], None, "broken") for f in OBSERVATION_FIELDS]
    ok = "NOT broken"
    parts.append(e("city", "value_error", "Value error, " + CITY_MSG, "city_raw",
                   f"{ok} AND trim(city_raw) = ''"))
    for f in ("temperature", "feels_like"):
        lo, hi, m = RANGES[f]
        parts.append(e(f, "value_error", "Value error, " + m, f"CAST({f} AS VARCHAR)",
                       f"{ok} AND NOT ({f} BETWEEN {lo} AND {hi})"))
    lo, hi, m = RANGES["humidity"]
    parts.append(e("humidity", "int_from_float", MSG["int_from_float"], "humidity_txt", f"{ok} AND hum_frac"))
    parts.append(e("humidity", "value_error", "Value error, " + m, "humidity_txt",
                   f"{ok} AND NOT hum_frac AND NOT (humidity BETWEEN {lo} AND {hi})"))
    for f in ("pressure", "cloudiness"):
        lo, hi, m = RANGES[f]
        parts.append(e(f, "value_error", "Value error, " + m, f"CAST({f} AS VARCHAR)",
                       f"{ok} AND NOT ({f} BETWEEN {lo} AND {hi})"))
    parts.append(e("wind_speed", "value_error", "Value error, " + WIND_MSG, "CAST(wind_speed AS VARCHAR)",
                   f"{ok} AND wind_speed < 0"))
    for f in ("wind_direction", "visibility"):
        parts.append(e(f, "missing", MSG["missing"], None, f"{ok} AND {f} IS NULL"))
    parts.append(e("recorded_at", "datetime_parsing", MSG["datetime_parsing"], "'not-a-date'",
                   f"{ok} AND bad_time"))
    errs = "errs AS (\n  " + "\n  UNION ALL ".join(parts) + ")"
    checked = f"""
checked AS (
  SELECT r.*, COALESCE(c.n_errors, 0) AS error_count, COALESCE(c.n_errors, 0) = 0 AS is_valid,
         c.fields
  FROM raw_rec r LEFT JOIN (SELECT message_id, COUNT(*) AS n_errors,
                                   string_agg(loc, ',' ORDER BY pos) AS fields
                            FROM errs GROUP BY message_id) c USING (message_id))"""
    return ",\n".join([raw, errs, checked])


NORMALIZED_SELECT_DUCK = """
SELECT message_id, {title} AS city, country, ROUND(temperature, 2) AS temperature,
       ROUND(feels_like, 2) AS feels_like, humidity, pressure, ROUND(wind_speed, 2) AS wind_speed,
       wind_direction, visibility, weather_condition, lower(weather_description) AS weather_description,
       cloudiness, recorded_at, latitude, longitude
FROM checked WHERE is_valid
"""
