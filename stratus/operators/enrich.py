"""Per-row enrichment: bands, heat index, lineage columns, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.functions import heat_index, temperature_band, wind_band_stream

# Fixed value: version stamp written on every enriched row.
PIPELINE_VERSION = "1.0.0"
DEDUP_KEYS = ["city", "recorded_at"]
# Replayed copies get offsets past every original offset.
REPLAY_OFFSET = 1_000_000_000_000


def dedup_keep_first(df: DataFrame, keys: list[str] | None = None,
                     order: list[str] | None = None) -> DataFrame:
    """One row per key: the one with the smallest ``order`` (then the rest of the row).

    Written as ``min(struct(order..., rest...))`` per key, a hash aggregate
    with a map-side phase: many copies of one key are collapsed before the
    shuffle, so a hot key never lands whole in one task.  Null keys group
    together, as in ``dropDuplicates``.
    """
    keys = keys or DEDUP_KEYS
    order = order or ["kafka_offset", "kafka_partition"]
    order = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_row")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order + rest]).select(*df.columns)


def deduplicate(df: DataFrame) -> DataFrame:
    return dedup_keep_first(df, DEDUP_KEYS)


# Added column -> its expression over the row.
ADDED = {
    "temperature_category": temperature_band,
    "heat_index": heat_index,
    "wind_category": wind_band_stream,
    "processed_at": F.current_timestamp,
    "pipeline_version": lambda: F.lit(PIPELINE_VERSION),
}


def with_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` and the named columns of ``ADDED`` (all of them by default), in one projection."""
    return df.select("*", *[ADDED[n]().alias(n) for n in names or ADDED])


def transform_batch(df: DataFrame, dedup: bool = True) -> DataFrame:
    """The enriched batch: one row per key, with every added column."""
    return with_columns(deduplicate(df) if dedup else df)


def with_replay(df: DataFrame) -> DataFrame:
    """The table plus a full replay of it (same payload, later offsets)."""
    return df.unionByName(df.withColumn("kafka_offset", F.col("kafka_offset") + F.lit(REPLAY_OFFSET)))
