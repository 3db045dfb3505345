"""Streaming ingest of topic messages into a partitioned lake table.

Source: Kafka when its connector is present (``fmt="kafka"``), otherwise a
file source holding the same columns (key, value, partition, offset,
timestamp).  The parse is the batch ``parse_messages`` plus a watermark on
the event time; sinks are checkpointed, so a restarted query resumes where it
stopped and never writes a batch twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratus.operators.enrich import DEDUP_KEYS, transform_batch
from stratus.operators.partitioning import ensure_parallelism
from stratus.operators.validate import TOPIC_INVALID, TOPIC_RAW, TOPIC_VALID, TOPICS, check, route  # noqa: F401
from stratus.plans.models import update_mart
from stratus.schemas import PARTITION_COLUMNS
from stratus.session import path_exists
from stratus.sources.messages import parse_messages
from stratus.sources.tablelog import put_if_absent

# Event-time lateness bound, documented micro-batch interval and
# the topic the ingest subscribes to.
WATERMARK_DELAY = "10 minutes"
DEFAULT_TRIGGER = {"processingTime": "30 seconds"}
VALIDATED_TOPIC = "validated_weather_stream"
EARLIEST, LATEST = "earliest", "latest"
START_MARKER = "start_position"

MESSAGE_FILE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def start_marker(spark: SparkSession, checkpoint: str, starting: str) -> tuple[str, int]:
    """The position a query over files first started from, and when that was (ms, by the file system's clock).

    Saved beside the checkpoint at the first start and kept: what a restart asks
    for changes nothing.  A checkpoint that ran without a marker had all files.
    """
    if starting not in (EARLIEST, LATEST):
        raise ValueError(f"starting position {starting!r} is neither {EARLIEST!r} nor {LATEST!r}")
    folder = checkpoint.rstrip("/")
    marker = f"{folder}/{START_MARKER}"
    if not path_exists(spark, marker):
        put_if_absent(spark, marker, EARLIEST if path_exists(spark, f"{folder}/metadata") else starting)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(marker)
    status = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)
    return spark.read.text(marker).first()[0], int(status.getModificationTime())


def read_messages(spark: SparkSession, path: str | None = None, fmt: str = "parquet",
                  options: dict | None = None, max_files_per_trigger: int | None = None,
                  starting: str = EARLIEST, checkpoint: str | None = None, tolerate_loss: bool = False) -> DataFrame:
    """Streaming message source.

    Kafka: ``subscribe`` the validated topic from the latest offsets and
    tolerate data loss, unless ``options`` say otherwise.  Files: declared
    schema, optional rate limit, and the same two choices by argument:
    ``starting="latest"`` passes over files written before the first start of the
    query that owns ``checkpoint`` (they are listed, not opened; a file of the
    marker's own instant is read), ``tolerate_loss`` over files that have
    vanished by the time they are read.
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("subscribe", VALIDATED_TOPIC)
        opts.setdefault("startingOffsets", "latest")
        opts.setdefault("failOnDataLoss", "false")
        return spark.readStream.format("kafka").options(**opts).load()
    reader = spark.readStream.format(fmt).schema(MESSAGE_FILE_SCHEMA).options(**opts)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if tolerate_loss:
        reader = reader.option("ignoreMissingFiles", "true")
    messages = reader.load(path)
    if checkpoint is None:
        if starting != EARLIEST:
            raise ValueError("a starting position of files is kept with the checkpoint: name it")
        return messages
    position, since = start_marker(spark, checkpoint, starting)
    if position == EARLIEST:
        return messages
    return messages.filter(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(since)))


def parse_stream(raw: DataFrame, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Typed rows + date parts, with a watermark on ``recorded_at``."""
    return parse_messages(raw).withWatermark("recorded_at", watermark)


def _trigger(writer, trigger: dict | None):
    t = DEFAULT_TRIGGER if trigger is None else trigger
    return writer.trigger(**t) if t else writer


def start_ingest(parsed: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                 trigger: dict | None = None, query_name: str | None = None,
                 partition_cols: list[str] | None = None) -> StreamingQuery:
    """Append sink, partitioned by year/month/day/hour unless ``partition_cols`` says
    otherwise (``[]``: unpartitioned).  Without state, late rows are kept."""
    cols = PARTITION_COLUMNS if partition_cols is None else partition_cols
    w = (parsed.writeStream.format(fmt).outputMode("append")
               .option("checkpointLocation", checkpoint))
    if cols:
        w = w.partitionBy(*cols)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start(sink)


def dedup_stream(parsed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Cross-batch dedup: state kept per key for the watermark delay; late rows dropped.

    A row that lacks a key is like no other: it passes without state.  Within a
    micro-batch any one of a key's rows may stay; ``transform_batch`` keeps the
    lowest offset.
    """
    keys = keys or DEDUP_KEYS
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return parsed.filter(whole).dropDuplicatesWithinWatermark(keys).unionByName(parsed.filter(~whole))


def dedup_lowest(parsed: DataFrame, keys: list[str] | None = None, order: str = "kafka_offset") -> DataFrame:
    """Cross-batch dedup that does not depend on the order of arrival: of a key's rows the lowest ``order`` stays.

    State holds one row per key, the lowest so far, and gives it out when the
    watermark has passed the key's event time (which must be one of ``keys``);
    rows later than that are dropped.  A row that lacks a key passes without state.
    """
    keys = keys or DEDUP_KEYS
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    row = F.struct(*[F.col(f"`{c}`") for c in parsed.columns])
    lowest = parsed.filter(whole).groupBy(*keys).agg(F.min_by(row, order).alias("_row")).select("_row.*")
    return lowest.unionByName(parsed.filter(~whole))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The persistent id of the query that owns a checkpoint (Spark writes it before the first batch)."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


def enriched_batch_writer(sink: str, checkpoint: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: enrich the micro-batch and overwrite its own folder.

    A folder belongs to the query's persistent id and the batch id: a batch
    replayed after a failure rewrites the same folder, while a query with a new
    checkpoint, whose batches count from 0 again, has others.  Date parts are
    columns, so folders grow with batches only, whatever hours a batch spans; a
    batch covers a short time, so a time range skips files by their statistics.
    """
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(query_id(batch.sparkSession, checkpoint))
        (transform_batch(batch).write.mode("overwrite").format(fmt)
            .save(f"{sink.rstrip('/')}/query_id={known[0]}/batch_id={batch_id}"))
    return write


def start_enrich(parsed: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                 trigger: dict | None = None) -> StreamingQuery:
    w = (parsed.writeStream.option("checkpointLocation", checkpoint)
               .foreachBatch(enriched_batch_writer(sink, checkpoint, fmt)))
    return _trigger(w, trigger).start()


def start_mart(parsed: DataFrame, state: str, path: str, checkpoint: str, fmt: str = "parquet",
               trigger: dict | None = None) -> StreamingQuery:
    """Keep the daily mart up with the stream; a replayed batch replaces what it wrote before (``update_mart``)."""
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(query_id(batch.sparkSession, checkpoint))
        update_mart(batch, f"{known[0]}-{batch_id}", state, path, fmt)

    w = parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return _trigger(w, trigger).start()


def routed_batch_writer(out: str, checkpoint: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body of the router: one parse of the batch, three topic writes.

    The routed batch is kept while the topics are written, so it is parsed once;
    its rows are counted and spread first, so no task keeps or reads too many.
    Every topic's folder belongs to the query's persistent id and the batch id:
    a batch that failed between two writes is replayed into the same folders.
    """
    known: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(query_id(batch.sparkSession, checkpoint))
        routed = route(check(ensure_parallelism(batch)), keep=["partition", "offset", "timestamp"]).persist()
        try:
            for topic in TOPICS:
                (routed.filter(F.col("topic") == topic).drop("topic").write.mode("overwrite").format(fmt)
                    .save(f"{out.rstrip('/')}/topic={topic}/query_id={known[0]}/batch_id={batch_id}"))
        finally:
            routed.unpersist()
    return write


def start_router(raw: DataFrame, out: str, checkpoint: str, fmt: str = "parquet",
                 trigger: dict | None = None) -> StreamingQuery:
    """Stream of raw messages (the columns of ``read_messages``) to the raw, validated and invalid topics."""
    w = (raw.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(routed_batch_writer(out, checkpoint, fmt)))
    return _trigger(w, trigger).start()


def run_available(start: Callable[[], StreamingQuery]) -> None:
    """Run one ``availableNow`` query to completion (one restart from its checkpoint)."""
    q = start()
    try:
        q.awaitTermination()
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
