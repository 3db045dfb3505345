"""Faults for streams: a query that dies between writing a batch and committing it.

Recovery is checked with these, on the sinks themselves: ``fail_after`` raises in
``foreachBatch`` once its rows are written, ``forget_last_batch`` takes a stopped query
back to where its driver would have died after the file sink's write.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stratus.streaming.ingest import run_available

SINK_LOG = "_spark_metadata"


class InjectedFault(RuntimeError):
    """Raised on purpose after a batch's rows were written."""


def fail_after(write: Callable[[DataFrame, int], None], batches: Iterable[int]) -> Callable[[DataFrame, int], None]:
    """``write``, but each of ``batches`` fails once, after its write and before Spark commits it."""
    left = set(batches)

    def faulty(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id in left:
            left.discard(batch_id)
            raise InjectedFault(f"InjectedFault after batch {batch_id}")
    return faulty


def run_to_fault(start: Callable[[], StreamingQuery]) -> bool:
    """Run a query that may hit an injected fault: whether it did.  Any other failure is raised."""
    try:
        run_available(start)
    except (StreamingQueryException, RuntimeError) as e:
        if InjectedFault.__name__ not in str(e):
            raise
        return True
    return False


def forget_last_batch(spark: SparkSession, checkpoint: str, sink: str | None = None) -> int | None:
    """Remove the last entry of a stopped query's commit log and return its batch id (None if it has none).

    With ``sink``, the file sink's own entry of that batch goes too: its files are
    written, but no reader of the sink knows them.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    ids = [int(n) for n in (f.getPath().getName() for f in fs.listStatus(folder)) if n.isdigit()]
    if not ids:
        return None
    last = max(ids)
    fs.delete(jvm.org.apache.hadoop.fs.Path(folder, str(last)), False)
    if sink is not None:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{sink.rstrip('/')}/{SINK_LOG}/{last}"), False)
    return last
