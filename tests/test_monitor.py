"""Late rows set apart, quality observed in the stream, bounds that stop it."""

import datetime as dt
import os

import pytest

from stratus.operators import quality as Q
from stratus.streaming import ingest as ST
from stratus.streaming import monitor as MO
from tests.test_streaming import _msg, _stage

T0 = dt.datetime(2026, 6, 16, 10, tzinfo=dt.timezone.utc)
NOW = {"availableNow": True}


def _parsed(spark, src, **kw):
    return ST.parse_stream(ST.read_messages(spark, src, **kw))


def test_every_late_row_is_in_one_place_also_after_a_fault(spark, tmp_dir, monkeypatch):
    src, out, log, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "out", "log", "ckpt"))

    def run():
        ST.run_available(lambda: MO.start_split(_parsed(spark, src), out, log, ckpt, trigger=NOW))

    at = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [[_msg(0, "Paris", at(0)), _msg(1, "Lima", at(60))],
               [_msg(2, "Paris", at(49)), _msg(3, "Lima", at(50)), _msg(4, "Oslo", at(51)), ("k", "{broken", 0, 5, T0)],
               [_msg(6, "Paris", at(20)), _msg(7, "Oslo", at(200))],
               [_msg(8, "Paris", at(190)), _msg(9, "Paris", at(191))]]
    for i, rows in enumerate(batches):
        _stage(spark, src, rows)
        if i == 2:  # the rows are written, the log entry is not
            from pyspark.sql import DataFrameWriter
            save = DataFrameWriter.save

            def fail(self, path=None, *args, **kwargs):
                if path and path.startswith(log):
                    raise OSError("lost")
                return save(self, path, *args, **kwargs)

            monkeypatch.setattr(DataFrameWriter, "save", fail)
            with pytest.raises(Exception, match="lost"):
                run()
            monkeypatch.undo()
        run()
    got = [(r["kafka_offset"], r["late"]) for r in spark.read.parquet(out).collect()]
    assert sorted(x for x, late in got if str(late).lower() == "true") == [2, 3, 6, 8]
    assert sorted(x for x, _ in got) == list(range(10))
    counts = {r["batch_id"]: (r["rows"], r["late_rows"]) for r in MO.lateness(spark, log).collect()}
    assert counts == {0: (2, 0), 1: (4, 2), 2: (2, 1), 3: (2, 1)}


def test_watch_sees_rows_dropped_by_the_dedup(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    seen = []
    for rows in ([_msg(0, "Paris", T0)], [_msg(1, "Paris", T0 + dt.timedelta(hours=5))], [_msg(2, "Lagos", T0 + dt.timedelta(hours=6))],
                 [_msg(3, "Lagos", T0 + dt.timedelta(hours=1)), _msg(4, "Oslo", T0 + dt.timedelta(hours=6))]):
        _stage(spark, src, rows)
        seen += MO.run_watched(spark, lambda: ST.start_ingest(ST.dedup_stream(_parsed(spark, src)), sink, ckpt, trigger=NOW))
    kept = spark.read.parquet(sink).count()
    assert kept == 4 and sum(b.dropped for b in seen) == 1
    assert any(b.watermark and b.watermark.startswith("2026-06-16T15:50") for b in seen)


def test_observed_counts_equal_the_batch_check_and_a_bad_batch_stops_the_query(spark, tmp_dir):
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    bad = [("k", "{broken", 0, i, T0) for i in range(10, 13)]
    files = [[_msg(0, "Paris", T0), _msg(1, "Lima", T0), bad[0]], [_msg(3, "Oslo", T0), *bad[1:]], [_msg(6, "Rome", T0)]]

    def start(sink, ckpt, **kw):
        return lambda: ST.start_ingest(MO.with_quality(_parsed(spark, src, **kw)), sink, ckpt, trigger=NOW)

    for rows in files[:2]:
        spark.createDataFrame(rows, ST.MESSAGE_FILE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    batches = MO.run_watched(spark, start(sink, ckpt))
    want = {(r["check_name"], r["column_name"]): r["violations"] for r in Q.constraints(
        spark.read.parquet(sink)).collect()}
    got = {}
    for b in batches:
        for k, n in b.quality.items():
            got[k] = got.get(k, 0) + n
    assert got.pop("rows") == 6 and got == {MO.rule_name(*k): n for k, n in want.items()}
    assert got["not_null:city"] == 3

    # One file a batch: the second batch breaks the bound, whatever follows is not started without a new run.
    sink2, ckpt2 = sink + "2", ckpt + "2"
    with pytest.raises(MO.QualityBreach, match="batch 1: not_null:city in 2 of 3"):
        MO.run_watched(spark, start(sink2, ckpt2, max_files_per_trigger=1), bounds={"not_null:city": 0.5})
    assert spark.read.parquet(sink2).count() == 6
    spark.createDataFrame(files[2], ST.MESSAGE_FILE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    MO.run_watched(spark, start(sink2, ckpt2, max_files_per_trigger=1), bounds={"not_null:city": 0.5})
    assert spark.read.parquet(sink2).count() == 7
