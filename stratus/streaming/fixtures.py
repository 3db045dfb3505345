"""Stage message files from the observation table for the file source.

Messages are written group by group (event-time slices of the table, then
an optional full replay with later offsets); each group is consumed by one
``availableNow`` run, i.e. one micro-batch per group, each run a restart
from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratus.operators.enrich import REPLAY_OFFSET
from stratus.sources.messages import encode_messages


def slices(obs: DataFrame, n: int = 3) -> list:
    """``n`` contiguous, equally wide event-time slices (rows without a time go first).

    Only the two ends of the time range reach the driver.
    """
    r = obs.agg(F.min(F.unix_micros("recorded_at")).alias("lo"),
                F.max(F.unix_micros("recorded_at")).alias("hi")).first()
    lo, hi = (r["lo"] or 0), (r["hi"] or 0)
    width = max(1, (hi - lo + n) // n)
    g = F.least(F.floor((F.unix_micros("recorded_at") - F.lit(lo)) / F.lit(width)), F.lit(n - 1))
    g = F.coalesce(g, F.lit(0))
    return [g == i for i in range(n)]


def stage(obs: DataFrame, path: str, cond=None, replay: bool = False, broken_every: int | None = None) -> None:
    df = obs if cond is None else obs.filter(cond)
    if replay:
        df = df.withColumn("kafka_offset", F.col("kafka_offset") + F.lit(REPLAY_OFFSET))
    # Files cover contiguous event-time ranges, like a time-ordered feed: each
    # streaming task then writes only the hour directories of its own range.
    n = df.sparkSession.sparkContext.defaultParallelism
    (encode_messages(df, broken_every=broken_every).repartitionByRange(n, "timestamp")
        .write.mode("append").parquet(path))
