"""The models: the staging view and the daily city mart, as DataFrame projections.

Column names, order and rules are the contract of the tables.  The mart is a
table (``materialize_mart``) or, for reads, a DataFrame.  Both summaries read
their rows once, into cells: one per group and combination of the values whose
most frequent one is asked for, with mergeable states of the measures.  Cells of
several batches are summed like those of one, so the daily mart can also be kept
up batch by batch (``update_mart``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.functions import avg_state, merged_avg, round_signed, temperature_band, wind_band_staging
from stratus.operators.joins import materialize

DAY = ["city", "country", "recorded_date"]
REQUIRED = ["temperature", "humidity", "city", "recorded_at"]


def staging(events: DataFrame) -> DataFrame:
    """Staging model over a lake-table DataFrame: complete rows, renamed, rounded and banded."""
    c = F.col
    same = lambda *names: [c(n) for n in names]
    measures = {"temperature_c": c("temperature"), "feels_like_c": c("feels_like"),
                "feels_like_gap_c": c("temperature") - c("feels_like")}
    kept = events.filter(reduce(Column.__and__, [c(n).isNotNull() for n in REQUIRED]))
    return kept.select(
        *same("city", "country"),
        *[round_signed(v).alias(n) for n, v in measures.items()],
        c("humidity").alias("humidity_pct"), c("pressure").alias("pressure_hpa"),
        round_signed(c("wind_speed")).alias("wind_speed_ms"), c("wind_direction").alias("wind_direction_deg"),
        c("cloudiness").alias("cloudiness_pct"), c("visibility").alias("visibility_m"),
        *same("weather_condition", "weather_description"),
        temperature_band().alias("temperature_category"), wind_band_staging().alias("wind_category"),
        *same("latitude", "longitude", "recorded_at"),
        c("recorded_at").cast("date").alias("recorded_date"), F.date_trunc("hour", c("recorded_at")).alias("recorded_hour"),
        *same("kafka_offset", "kafka_partition"))


AVERAGES = ["temperature_c", "feels_like_c", "feels_like_gap_c", "humidity_pct", "pressure_hpa", "wind_speed_ms"]
EXTREMES = {"temperature_c": ("min", "max"), "humidity_pct": ("min", "max"), "pressure_hpa": ("min", "max"), "wind_speed_ms": ("max",)}
MART_VALUES = ["temperature_category", "wind_category", "weather_description"]
_USE = {"min": F.min, "max": F.max, "total": F.sum, "exact": F.sum, "plain": F.sum, "n": F.sum}


def _cells(df: DataFrame, keys: list[str], columns: list[str], states: list[Column] = ()) -> DataFrame:
    """One row per group of ``keys`` and combination of ``columns``: its row count and states."""
    return df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("rows_n"), *states)


def _summed(cells: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per group of ``keys``: all states merged (by the ending of their names), and the most frequent non-null value
    of each column, the smallest on a tie, as ``dominant_<column>``.

    Every cell counts once for the group (which = -1) and once for its value of
    each column; what is merged and compared is one row per distinct value.
    """
    states = [c for c in cells.columns if c not in keys and c not in columns]
    pairs = F.array(*[F.struct(F.lit(i).alias("which"), (F.col(columns[i]) if i >= 0 else F.lit(None).cast("string")).alias("value"))
                      for i in range(-1, len(columns))])
    values = (cells.select(*keys, *states, F.inline(pairs))
              .filter((F.col("which") < 0) | F.col("value").isNotNull())
              .groupBy(*keys, "which", "value").agg(*[_USE[c.rsplit("_", 1)[1]](c).alias(c) for c in states]))
    first = F.struct((-F.col("rows_n")).alias("n"), "value")
    return values.groupBy(*keys).agg(
        *[F.max(F.when(F.col("which") < 0, F.col(c))).alias(c) for c in states],
        *[F.min(F.when(F.col("which") == i, first))["value"].alias(f"dominant_{c}") for i, c in enumerate(columns)])


def mart_cells(stg: DataFrame) -> DataFrame:
    """The daily mart's mergeable partial state over some rows of the staging model."""
    states = [s for c in AVERAGES for s in avg_state(c, c)]
    states += [_USE[w](c).alias(f"{c}_{w}") for c, which in EXTREMES.items() for w in which]
    return _cells(stg, DAY, MART_VALUES, states)


def mart_of(cells: DataFrame) -> DataFrame:
    """Daily city summary from the cells of any number of batches."""
    c = F.col
    measures = []
    for name in AVERAGES:
        measures.append(merged_avg(name).alias(f"avg_{name}"))
        measures += [F.round(c(f"{name}_{w}"), 2).alias(f"{w}_{name}") for w in EXTREMES.get(name, ())]
        if name == "temperature_c":
            measures.append(round_signed(c("temperature_c_max") - c("temperature_c_min")).alias("temperature_range_c"))
    return _summed(cells, DAY, MART_VALUES).select(
        *DAY, *measures, *[f"dominant_{v}" for v in MART_VALUES], c("rows_n").alias("record_count"))


def mart(stg: DataFrame) -> DataFrame:
    """Daily city summary over the staging model, latest day first."""
    return mart_of(mart_cells(stg)).orderBy(F.desc("recorded_date"), "city")


def dominant_conditions(stg: DataFrame) -> DataFrame:
    keys, values = ["city", "country"], ["weather_condition", "temperature_category", "wind_category"]
    return _summed(_cells(stg, keys, values), keys, values).select(
        *keys, *[f"dominant_{v}" for v in values], F.col("rows_n").alias("record_count"))


def materialize_mart(spark: SparkSession, events: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Table materialisation: overwrite the mart at ``path`` and return its read."""
    mart(staging(events)).write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def update_mart(events: DataFrame, batch: str, state: str, path: str, fmt: str = "parquet") -> list:
    """Bring the mart at ``path`` up to date with a batch of events; returns the days it touched.

    ``state`` holds the cells of every batch, by day and batch.  A batch rewrites
    its own partitions of it (and none of other batches), then the mart's
    partitions of the days it has rows of, from all cells of those days.  So a
    batch that failed anywhere is replayed under the same name without counting
    twice, and files of other days stay as they are.  A batch without complete
    rows changes nothing.  Days, a date each, are the only thing collected.
    """
    spark, day = events.sparkSession, F.col("recorded_date")
    spread = {"mode": "overwrite", "partitionOverwriteMode": "dynamic", "format": fmt}
    cells = materialize(mart_cells(staging(events)))
    days = sorted(r[0] for r in cells.select(day).distinct().collect())
    if not days:
        return []
    cells.withColumn("batch", F.lit(batch)).hint("rebalance", "recorded_date").write.save(
        state, partitionBy=["recorded_date", "batch"], **spread)
    schema = T.StructType([*cells.schema.fields, T.StructField("batch", T.StringType())])
    touched = spark.read.schema(schema).format(fmt).load(state).filter(day.isin(days)).drop("batch")
    mart_of(touched).hint("rebalance", "recorded_date").write.save(path, partitionBy=["recorded_date"], **spread)
    return days


def read_mart(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The mart that ``update_mart`` keeps, its columns in the contract's order."""
    found = spark.read.format(fmt).load(path)
    rest = [c for c in found.columns if c not in DAY]
    return found.select("city", "country", F.col("recorded_date").cast("date"), *rest)
