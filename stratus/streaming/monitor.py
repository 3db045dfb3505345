"""What a running stream did with its rows: late rows set apart, quality counted on the way, bounds that stop it.

``Watch`` is a listener that keeps each batch's input rows, rows dropped behind
the watermark, the watermark and the observed quality counts.  The counts are
metrics of the ingest itself (``with_quality``), so no row is read for them a
second time.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from stratus.operators.quality import constraint_rules
from stratus.streaming.ingest import DEFAULT_TRIGGER, WATERMARK_DELAY, query_id

QUALITY = "quality"
#: How long to wait for the listener's last event after a query has ended.
FLUSH_SECONDS = 60


class QualityBreach(RuntimeError):
    """A batch broke a bound; the query was stopped after it."""


def rule_name(check: str, column: str) -> str:
    return f"{check}:{column}"


def with_quality(parsed: DataFrame) -> DataFrame:
    """``parsed``, its row count and violations of every table constraint observed batch by batch."""
    broken = [F.sum(F.when(pred, 1).otherwise(0)).alias(rule_name(check, column)) for check, column, pred in constraint_rules()]
    return parsed.observe(QUALITY, F.count(F.lit(1)).alias("rows"), *broken)


@dataclass
class Batch:
    rows: int  #: read from the source
    dropped: int  #: dropped behind the watermark by stateful operators
    watermark: str | None
    quality: dict[str, int] = field(default_factory=dict)  #: observed rows and violations by rule


class Watch(StreamingQueryListener):
    """Batches by run id of a query, and the first broken bound of each run.

    ``bounds``: by rule name, the share of a batch's rows that may break it; a
    rule that is not named has no bound.
    """

    def __init__(self, bounds: dict[str, float] | None = None):
        self.bounds = bounds or {}
        self.batches: dict[str, dict[int, Batch]] = {}
        self.breach: dict[str, str] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def ended(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended(str(event.runId)).set()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run, seen = str(p.runId), p.observedMetrics.get(QUALITY)
        counts = {k: int(v or 0) for k, v in seen.asDict().items()} if seen is not None else {}
        batch = Batch(int(p.numInputRows), sum(int(s.numRowsDroppedByWatermark) for s in p.stateOperators),
                      p.eventTime.get("watermark"), counts)
        self.batches.setdefault(run, {})[int(p.batchId)] = batch
        for rule, share in self.bounds.items():
            if counts.get(rule, 0) > share * counts.get("rows", 0):
                self.breach.setdefault(run, f"batch {p.batchId}: {rule} in {counts[rule]} of {counts['rows']} rows")


def run_watched(spark: SparkSession, start: Callable[[], StreamingQuery], bounds: dict[str, float] | None = None) -> list[Batch]:
    """Run a query to its end under a ``Watch`` and return its batches in order.

    A batch over a bound stops the query (that batch is committed: it can be told
    by its partition and replaced) and raises ``QualityBreach``; a failure of the query is raised.
    """
    watch = Watch(bounds)
    spark.streams.addListener(watch)
    try:
        q = start()
        run = str(q.runId)
        while not q.awaitTermination(0.2):
            if run in watch.breach:
                q.stop()
        if not watch.ended(run).wait(FLUSH_SECONDS):  # events come in order: all batches are known at the last one
            raise TimeoutError("the listener did not see the query end")
    finally:
        spark.streams.removeListener(watch)
    if run in watch.breach:
        raise QualityBreach(watch.breach[run])
    return [b for _, b in sorted(watch.batches.get(run, {}).items())]


LATENESS = T.StructType([
    T.StructField("rows", T.LongType()), T.StructField("late_rows", T.LongType()),
    T.StructField("watermark", T.TimestampType()), T.StructField("latest", T.TimestampType())])


def lateness(spark: SparkSession, log: str, fmt: str = "parquet") -> DataFrame:
    """The log of ``start_split``: per query and batch its rows, late rows, watermark, and latest event time so far."""
    parts = [T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())]
    return spark.read.schema(T.StructType([*LATENESS.fields, *parts])).format(fmt).load(log)


def split_batch_writer(out: str, log: str, checkpoint: str, time: str = "recorded_at", delay: str = WATERMARK_DELAY,
                       fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: rows behind the watermark to ``late=true``, all others to ``late=false``, in one write.

    The watermark of a batch is the latest event time of all batches before it
    less ``delay``; a row at or before it is late, a row without a time is not.
    It comes from the log entry of the batch before, so a replayed batch is
    divided as it was, into the same partitions (its query's id and its batch id).
    """
    known: list[str] = []

    def entry(batch_id: int) -> str:
        return f"{log.rstrip('/')}/query_id={known[0]}/batch_id={batch_id}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not known:
            known.append(query_id(spark, checkpoint))
        before = spark.read.schema(LATENESS).format(fmt).load(entry(batch_id - 1)) if batch_id else spark.createDataFrame([], LATENESS)
        ended = before.select("latest", (F.col("latest") - F.expr(f"interval {delay}")).alias("mark")).first()
        latest, mark = (F.lit(x).cast("timestamp") for x in (ended or (None, None)))
        seen, is_late = Observation(), F.coalesce(F.col(time) <= mark, F.lit(False))
        rows = batch.withColumn("late", is_late).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("late_rows"), F.max(time).alias("latest"))
        (rows.withColumn("query_id", F.lit(known[0])).withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
            .partitionBy("late", "query_id", "batch_id").save(out))
        got = seen.get
        (spark.range(1, numPartitions=1).select(
            F.lit(got["rows"]).alias("rows"), F.lit(got["late_rows"]).alias("late_rows"), mark.alias("watermark"),
            F.greatest(latest, F.lit(got["latest"]).cast("timestamp")).alias("latest"))
            .write.mode("overwrite").format(fmt).save(entry(batch_id)))
    return write


def start_split(parsed: DataFrame, out: str, log: str, checkpoint: str, delay: str = WATERMARK_DELAY, fmt: str = "parquet",
                trigger: dict | None = None) -> StreamingQuery:
    """Stream into ``out/late=false`` and the quarantine ``out/late=true``, with a log of what each batch gave to either."""
    w = (parsed.writeStream.option("checkpointLocation", checkpoint)
               .foreachBatch(split_batch_writer(out, log, checkpoint, delay=delay, fmt=fmt)))
    return w.trigger(**(DEFAULT_TRIGGER if trigger is None else trigger)).start()
