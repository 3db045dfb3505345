"""Streams that die between a batch's write and its commit, and where streams over files start."""

import datetime as dt
import os
import time

import pytest

from stratus.streaming import faults as FA
from stratus.streaming import ingest as ST
from stratus.streaming import monitor as MO
from tests.test_streaming import _msg, _stage

UTC = dt.timezone.utc
T0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
NOW = {"availableNow": True}


def _paths(tmp_dir, *names):
    return [os.path.join(tmp_dir, n) for n in names]


def _offsets(spark, path):
    return sorted(r["kafka_offset"] for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("sink_forgets", [False, True])
def test_file_sink_repeats_a_batch_without_its_commit(spark, tmp_dir, sink_forgets):
    src, sink, ckpt = _paths(tmp_dir, "src", "sink", "ckpt")

    def start():
        return ST.start_ingest(ST.parse_stream(ST.read_messages(spark, src)), sink, ckpt, trigger=NOW)

    for batch in range(3):
        _stage(spark, src, [_msg(2 * batch, "Paris", T0), _msg(2 * batch + 1, "Oslo", T0)])
        ST.run_available(start)
        assert FA.forget_last_batch(spark, ckpt, sink if sink_forgets else None) == batch
        ST.run_available(start)
        assert _offsets(spark, sink) == list(range(2 * batch + 2))
    # Files of the lost writes lie in the sink, but its readers do not know them.
    files = [f for _, _, names in os.walk(sink) for f in names if f.endswith(".parquet")]
    assert len(files) > len(spark.read.parquet(sink).inputFiles()) if sink_forgets else True


@pytest.mark.parametrize("kind", ["enrich", "route", "split"])
def test_batch_writers_repeat_a_batch_without_doubling(spark, tmp_dir, kind):
    src, out, log, ckpt = _paths(tmp_dir, "src", "out", "log", "ckpt")
    body = {"enrich": lambda: ST.enriched_batch_writer(out, ckpt), "route": lambda: ST.routed_batch_writer(out, ckpt),
            "split": lambda: MO.split_batch_writer(out, log, ckpt)}[kind]()
    write = FA.fail_after(body, [0, 2])

    def start():
        raw = ST.read_messages(spark, src)
        rows = raw if kind == "route" else ST.parse_stream(raw)
        return rows.writeStream.option("checkpointLocation", ckpt).foreachBatch(write).trigger(**NOW).start()

    for batch in range(3):
        _stage(spark, src, [_msg(2 * batch, "Paris", T0), _msg(2 * batch + 1, "Oslo", T0)])
        assert FA.run_to_fault(start) == (batch != 1)
        assert not FA.run_to_fault(start)
    if kind == "route":
        rows = spark.read.parquet(out).groupBy("topic", "offset").count().collect()
        assert {r["count"] for r in rows} == {1} and {r["offset"] for r in rows} == set(range(6))
        assert {r["topic"] for r in rows} == {ST.TOPIC_RAW, ST.TOPIC_VALID}
    else:
        assert _offsets(spark, out) == list(range(6))


def test_other_failures_are_raised(spark, tmp_dir):
    src, ckpt = _paths(tmp_dir, "src", "ckpt")
    _stage(spark, src, [_msg(0, "Paris", T0)])

    def broken(batch, batch_id):
        raise ValueError("not on purpose")

    with pytest.raises(Exception, match="not on purpose"):
        FA.run_to_fault(lambda: ST.read_messages(spark, src).writeStream.option("checkpointLocation", ckpt)
                        .foreachBatch(broken).trigger(**NOW).start())
    assert FA.forget_last_batch(spark, ckpt) is None


def test_enriched_folders_grow_with_batches_only(spark, tmp_dir):
    src, out, ckpt = _paths(tmp_dir, "src", "out", "ckpt")
    _stage(spark, src, [_msg(i, "Paris", T0 + dt.timedelta(hours=i)) for i in range(30)])
    ST.run_available(lambda: ST.start_enrich(ST.parse_stream(ST.read_messages(spark, src)), out, ckpt, trigger=NOW))
    assert len(os.listdir(out)) == 1 and _offsets(spark, out) == list(range(30))
    assert {r["hour"] for r in spark.read.parquet(out).select("hour").distinct().collect()} == set(range(24))


def _ingest(spark, src, sink, ckpt, **position):
    raw = ST.read_messages(spark, src, checkpoint=ckpt, **position)
    return lambda: ST.start_ingest(ST.parse_stream(raw), sink, ckpt, trigger=NOW, partition_cols=[])


def test_latest_passes_over_older_files_once(spark, tmp_dir):
    src, sink, ckpt = _paths(tmp_dir, "src", "sink", "ckpt")
    _stage(spark, src, [_msg(0, "Paris", T0)])
    time.sleep(0.05)
    ST.run_available(_ingest(spark, src, sink, ckpt, starting=ST.LATEST))
    assert _offsets(spark, sink) == [] if os.path.exists(os.path.join(sink, "_spark_metadata")) else True
    for n in (1, 2):  # files that come while the query is down are read, whatever position the restart asks for
        _stage(spark, src, [_msg(n, "Oslo", T0)])
        time.sleep(0.05)
        ST.run_available(_ingest(spark, src, sink, ckpt, starting=ST.LATEST if n == 1 else ST.EARLIEST))
        assert _offsets(spark, sink) == list(range(1, n + 1))


def test_first_start_decides_the_position(spark, tmp_dir):
    src, sink, ckpt = _paths(tmp_dir, "src", "sink", "ckpt")
    _stage(spark, src, [_msg(0, "Paris", T0)])
    time.sleep(0.05)
    ST.run_available(_ingest(spark, src, sink, ckpt))  # earliest
    _stage(spark, src, [_msg(1, "Paris", T0)])
    time.sleep(0.05)
    ST.run_available(_ingest(spark, src, sink, ckpt, starting=ST.LATEST))
    assert _offsets(spark, sink) == [0, 1]
    # A checkpoint that ran without a marker had all files.
    src, sink, ckpt = _paths(tmp_dir, "src", "sink2", "ckpt2")
    ST.run_available(lambda: ST.start_ingest(ST.parse_stream(ST.read_messages(spark, src)), sink, ckpt, trigger=NOW))
    assert ST.start_marker(spark, ckpt, ST.LATEST)[0] == ST.EARLIEST


def test_position_needs_a_checkpoint_and_a_known_name(spark, tmp_dir):
    with pytest.raises(ValueError):
        ST.read_messages(spark, tmp_dir, starting=ST.LATEST)
    with pytest.raises(ValueError):
        ST.read_messages(spark, tmp_dir, starting="middle", checkpoint=os.path.join(tmp_dir, "ckpt"))


def test_a_vanished_file_does_not_fail_a_tolerant_query(spark, tmp_dir):
    src, out, ckpt = _paths(tmp_dir, "src", "out", "ckpt")
    for n in range(2):
        _stage(spark, src, [_msg(n, "Paris", T0)])
    named = spark.read.parquet(src).select("offset", "_metadata.file_path").collect()
    file = next(r["file_path"] for r in named if r["offset"] == 0).removeprefix("file:")
    file = "/" + file.lstrip("/")
    write = ST.enriched_batch_writer(out, ckpt)
    lost = []

    def losing(batch, batch_id):
        if not lost:  # listed for this batch, gone before it is read
            lost.append(file)
            os.remove(file)
        write(batch, batch_id)

    raw = ST.read_messages(spark, src, tolerate_loss=True)
    ST.run_available(lambda: ST.parse_stream(raw).writeStream.option("checkpointLocation", ckpt)
                     .foreachBatch(losing).trigger(**NOW).start())
    assert lost and _offsets(spark, out) == [1]
