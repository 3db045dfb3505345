"""Shared helpers: table access, text batches, checked materialisation."""

from __future__ import annotations

import ctypes
import gc
import sys
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.operators.joins import materialize_counted

# Rows a checkpointed side may have to be broadcast; beyond it, a shuffle join
# whose hot partitions AQE splits.
BROADCAST_ROWS = 100_000


# Rows of a batch that goes to a Python worker: texts are long, and a batch is held several times over.
BATCH_ROWS = 1000
# The same for rows of a few numbers: about a megabyte.
NUMBER_ROWS = 1 << 16


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's batches for Python workers bounded to ``BATCH_ROWS`` rows (a runtime setting)."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


@contextmanager
def number_batches(spark: SparkSession):
    """Within it, plans of rows of a few numbers reach Python workers in batches of ``NUMBER_ROWS``."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(NUMBER_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidy(run):
    """An iterator function for Python workers that gives freed memory back to the system when it ends.

    Workers are kept for the tasks of later stages; what an allocator keeps
    for itself would stay beside those stages' own memory.
    """
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return inner


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(batch: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in batch.cast(pa.large_binary()).to_pylist()]


def text_blocks(batch: pa.Array, max_bytes: int = 8 << 20):
    """Yield (start row, texts) slices of a batch holding about ``max_bytes`` (one text at least)."""
    rows, start, size = [], 0, 0
    for i, t in enumerate(texts(batch)):
        if rows and size + len(t) > max_bytes:
            yield start, rows
            rows, start, size = [], i, 0
        rows.append(t)
        size += len(t)
    if rows:
        yield start, rows


def byte_blocks(column: pa.Array, max_bytes: int = 8 << 20):
    """Like ``text_blocks``, but only the texts of one block at a time become Python objects."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype("int64")
    start = 0
    while start < len(size):
        stop = start + max(1, int(size[start:].cumsum().searchsorted(max_bytes, "right")))
        yield start, texts(column.slice(start, stop - start))
        start = stop


def packed(text: bytes) -> bytes:
    """A text compressed for a shuffle, behind its length: about two thirds of what Spark's own blocks take."""
    return len(text).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(text, asbytes=True)


def unpacked(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def small_or_shuffled(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Checkpoint ``df``, count it, and hint a broadcast only under ``limit`` rows."""
    saved, n = materialize_counted(df)
    return F.broadcast(saved) if n <= limit else saved


def row_key(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``(id, fp, len)`` of every row: doc_id and a content hash (null and empty text alike).

    ``carry`` adds the whole row as struct ``row``, so no column of ``docs`` can clash.
    """
    t = F.coalesce(docs["text"], F.lit(""))
    cols = [docs["doc_id"].alias("id"), F.xxhash64(t).alias("fp"), F.length(t).alias("len")]
    if carry:
        cols.append(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    return docs.select(*cols)


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["fp"] == b["fp"]) & (a["len"] == b["len"])


def without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key ``(id, fp, len)`` is in ``removed``; columns unchanged."""
    rows, gone = row_key(docs, carry=True), small_or_shuffled(removed.select("id", "fp", "len").distinct())
    return rows.join(gone, same_row(rows, gone), "left_anti").select("row.*")
