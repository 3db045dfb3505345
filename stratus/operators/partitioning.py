"""Parallelism helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MIN_PARTITIONS_CONF = "stratus.scan.minPartitions"
# Rows of one task where every row takes long (JSON, patterns); conf-overridable.
SPREAD_ROWS_CONF = "stratus.scan.rowsPerTask"
SPREAD_ROWS_DEFAULT = 250_000


def tasks_for(spark: SparkSession, rows: int, min_partitions: int | None = None) -> int:
    """Tasks for ``rows`` rows: at least the cluster's default parallelism, and none with too many rows."""
    least = min_partitions or int(spark.conf.get(MIN_PARTITIONS_CONF, "0")) or spark.sparkContext.defaultParallelism
    return max(least, -(-rows // int(spark.conf.get(SPREAD_ROWS_CONF, str(SPREAD_ROWS_DEFAULT)))))


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan's rows evenly over ``tasks_for`` their number.

    The number of splits of a scan says nothing of its rows: a row group of a
    Parquet file goes whole to the split that holds its middle, so a file of one
    row group leaves all its rows to one task, however many splits it has.  The
    rows are counted (for Parquet, from the footers) and dealt by a hash of the
    whole row: unlike a round-robin exchange that sorts nothing, and a retried
    task deals the same.  The exchange is cheap beside the work after it.
    """
    return df.repartition(tasks_for(df.sparkSession, df.count(), min_partitions), *df.columns)
