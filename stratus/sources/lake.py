"""Lake tables: format-parameterised reads and writes.

Parquet is the default format; Delta (or any other) is used when its
connector is on the classpath, by passing ``fmt``.  Nothing imports a
connector package at module load.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratus.schemas import PARTITION_COLUMNS
from stratus.sources.tablelog import FILE_FORMATS, read_version


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
               version_as_of: int | None = None, timestamp_as_of: str | None = None) -> DataFrame:
    """Batch scan of a lake table, as of a version or a time when one is given.

    Tables of plain files have the versions of their run log; formats with a
    log of their own get the options passed through.
    """
    if fmt in FILE_FORMATS and (version_as_of is not None or timestamp_as_of is not None):
        return read_version(spark, path, version_as_of, timestamp_as_of, fmt, schema)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if version_as_of is not None:
        reader = reader.option("versionAsOf", version_as_of)
    if timestamp_as_of is not None:
        reader = reader.option("timestampAsOf", timestamp_as_of)
    return reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Batch write of a named table (overwrite by default)."""
    df.write.mode(mode).format(fmt).save(path)


# Files that a task of a partitioned write without rebalancing keeps open.
OPEN_WRITERS = 4


@contextmanager
def open_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Writes inside keep a file open for each of up to ``n`` partition values of a task.

    By default a task sorts all its rows by the partition columns, in memory, to
    write one file after the other.  Beyond ``n`` values the rest is sorted as before.
    """
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    old = spark.conf.get(conf)
    spark.conf.set(conf, str(n))
    try:
        yield
    finally:
        spark.conf.set(conf, old)


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                      partition_cols: list[str] | None = None, rebalance: bool = True) -> None:
    """Partitioned write (year/month/day/hour by default).

    ``rebalance`` shuffles rows by the partition columns first, with AQE free
    to split a hot partition value over several tasks and merge small ones,
    so each output directory gets few, evenly sized files.  Without it a task may
    hold many rows of few partition values, which it then writes unsorted.
    """
    cols = partition_cols or PARTITION_COLUMNS
    if rebalance:
        df = df.hint("rebalance", *cols)
    with open_writers(df.sparkSession, 0 if rebalance else OPEN_WRITERS):
        df.write.mode(mode).format(fmt).partitionBy(*cols).save(path)

