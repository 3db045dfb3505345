"""Joins whose broadcast side has a checked size.

``join_checked`` materialises the small side once (a reliable checkpoint in
the shared folder, so a lost executor cannot lose it), counts it, and only
broadcasts it under a row bound.  Beyond the bound it falls back to a shuffle
join that is salted for hot keys: a key holding a large share of the rows is
spread over several tasks instead of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Default row bound for broadcasting an aggregated side (conf-overridable).
BROADCAST_ROWS_CONF = "stratus.broadcast.maxRows"
BROADCAST_ROWS_DEFAULT = 1_000_000
# Target rows of the big side per task on a salted key.
ROWS_PER_TASK_CONF = "stratus.join.rowsPerTask"
ROWS_PER_TASK_DEFAULT = 5_000_000


def _conf(df: DataFrame, key: str, default: int) -> int:
    return int(df.sparkSession.conf.get(key, str(default)))


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint under ``spark.checkpoint.dir``."""
    return materialize_counted(df)[0]


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Reliable checkpoint plus its row count, from one job (an ``Observation``)."""
    from stratus.session import shared_dir

    shared_dir(df.sparkSession)
    obs = Observation()
    cp = df.observe(obs, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
    return cp, int(obs.get["rows"])


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner",
                 count_col: str | None = None, max_rows: int | None = None,
                 rows_per_task: int | None = None, small_rows: int | None = None) -> tuple[DataFrame, str]:
    """Join ``big`` with an aggregated ``small`` side.

    ``count_col`` (rows of ``big`` per key, as produced by the aggregation)
    lets the fallback salt hot keys.  ``small_rows``: the small side's row
    count when already known (it is then cheap to recompute, e.g. derived
    from a checkpointed table) - no new checkpoint is taken.  Returns the
    joined frame and the strategy used (``broadcast`` / ``salted`` / ``shuffle``).
    """
    if small_rows is None:
        small, n = materialize_counted(small)
    else:
        n = small_rows
    limit = max_rows if max_rows is not None else _conf(big, BROADCAST_ROWS_CONF, BROADCAST_ROWS_DEFAULT)
    if n <= limit:
        return big.join(F.broadcast(small), on, how), "broadcast"
    if count_col is None or how not in ("inner", "left"):
        return big.join(small, on, how), "shuffle"
    target = rows_per_task or _conf(big, ROWS_PER_TASK_CONF, ROWS_PER_TASK_DEFAULT)
    return salted_join(big, small, on, count_col, target, limit, how), "salted"


def salted_join(big: DataFrame, small: DataFrame, on: list[str], count_col: str,
                rows_per_task: int, max_hot_rows: int, how: str = "inner") -> DataFrame:
    """Shuffle join on (key, salt) where hot keys get ``ceil(n / rows_per_task)`` salts.

    The hot-key table has at most ``total_rows / rows_per_task`` entries; its
    size is checked before it is broadcast (the target grows until it fits).
    Every salt of a hot key carries the key's small-side row, so each big row
    matches exactly once whatever salt it draws.  The salt is a hash of the row,
    so a retried stage draws the same one.
    """
    while True:
        hot = (small.filter(F.col(count_col) > rows_per_task)
               .select(*on, F.ceil(F.col(count_col) / F.lit(rows_per_task)).cast("int").alias("_nsalt")))
        if hot.count() <= max_hot_rows:
            break
        rows_per_task *= 2
    hot_b = F.broadcast(hot)
    nsalt = F.coalesce(F.col("_nsalt"), F.lit(1))
    big_s = (big.join(hot_b, on, "left")
                .withColumn("_salt", F.pmod(F.xxhash64(*[c for c in big.columns]), nsalt.cast("long")).cast("int"))
                .drop("_nsalt"))
    small_s = (small.join(hot_b, on, "left")
                    .withColumn("_salt", F.explode(F.sequence(F.lit(0), nsalt - 1)))
                    .drop("_nsalt"))
    return big_s.join(small_s, on + ["_salt"], how).drop("_salt")


DIMENSION_ROWS_CONF = "stratus.broadcast.dimensionMaxRows"
DIMENSION_ROWS_DEFAULT = 100_000
_dimension_checks: dict[tuple[str, str], bool] = {}


def broadcast_if_bounded(dim: DataFrame, cache_key: str | None = None,
                         max_rows: int | None = None) -> DataFrame:
    """Mark a dimension as the broadcast side after checking its row count.

    Without the hint the optimizer broadcasts whichever side its file-size
    estimate puts under the threshold, which on small inputs can be the fact
    table.  The count runs once per (application, ``cache_key``).
    """
    limit = max_rows if max_rows is not None else _conf(dim, DIMENSION_ROWS_CONF, DIMENSION_ROWS_DEFAULT)
    key = (dim.sparkSession.sparkContext.applicationId, cache_key) if cache_key else None
    ok = _dimension_checks.get(key) if key else None
    if ok is None:
        ok = dim.count() <= limit
        if key:
            _dimension_checks[key] = ok
    return F.broadcast(dim) if ok else dim
