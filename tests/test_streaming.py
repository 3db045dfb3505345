import datetime as dt
import json
import os

import pytest

from stratus.streaming import ingest as ST

UTC = dt.timezone.utc


def _msg(offset, city, ts, temp=20.0):
    rec = {"city": city, "country": "XX", "temperature": temp, "feels_like": temp, "humidity": 50,
           "pressure": 1000, "wind_speed": 3.0, "wind_direction": 10, "visibility": 1000,
           "weather_condition": "Clear", "weather_description": "clear sky", "cloudiness": 0,
           "recorded_at": ts.isoformat(), "latitude": 1.0, "longitude": 2.0}
    return (city, json.dumps(rec), 0, offset, ts)


def _stage(spark, path, rows):
    spark.createDataFrame(rows, ST.MESSAGE_FILE_SCHEMA).write.mode("append").parquet(path)


def _run(spark, kind, src, sink, ckpt):
    def start():
        parsed = ST.parse_stream(ST.read_messages(spark, src))
        if kind == "dedup":
            parsed = ST.dedup_stream(parsed)
        if kind == "enrich":
            return ST.start_enrich(parsed, sink, ckpt, trigger={"availableNow": True})
        return ST.start_ingest(parsed, sink, ckpt, trigger={"availableNow": True})
    ST.run_available(start)


def test_late_row_kept_by_ingest_dropped_by_dedup(spark, tmp_dir):
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    batches = [
        [_msg(0, "Paris", t0), _msg(1, "Tokyo", t0)],
        [_msg(2, "Paris", t0 + dt.timedelta(hours=5))],                       # advances the watermark
        [_msg(3, "Lagos", t0 + dt.timedelta(hours=1)),                       # 4 h behind: late
         _msg(4, "Paris", t0 + dt.timedelta(hours=5))],                      # duplicate key
    ]
    for kind in ("ingest", "dedup"):
        src, sink, ckpt = (os.path.join(tmp_dir, kind, n) for n in ("src", "sink", "ckpt"))
        for rows in batches:
            _stage(spark, src, rows)
            _run(spark, kind, src, sink, ckpt)
        got = sorted(r["kafka_offset"] for r in spark.read.parquet(sink).collect())
        if kind == "ingest":
            assert got == [0, 1, 2, 3, 4]
        else:
            assert got == [0, 1, 2]


def test_restart_without_new_files_adds_nothing(spark, tmp_dir):
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    _stage(spark, src, [_msg(0, "Paris", t0), _msg(1, "Tokyo", t0)])
    _run(spark, "ingest", src, sink, ckpt)
    _run(spark, "ingest", src, sink, ckpt)
    back = spark.read.parquet(sink)
    assert back.count() == 2
    assert {tuple(r) for r in back.select("year", "month", "day", "hour").distinct().collect()} == {(2026, 6, 16, 10)}


def test_malformed_message_becomes_null_row(spark, tmp_dir):
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    _stage(spark, src, [("k", '{"city": "Par', 0, 7, t0), _msg(8, "Tokyo", t0)])
    _run(spark, "ingest", src, sink, ckpt)
    rows = {r["kafka_offset"]: r for r in spark.read.parquet(sink).collect()}
    assert rows[7]["city"] is None and rows[7]["year"] is None
    assert rows[8]["city"] == "Tokyo"


def test_foreach_batch_replay_is_idempotent(spark, tmp_dir):
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    batch = spark.createDataFrame([_msg(0, "Paris", t0), _msg(1, "Paris", t0)], ST.MESSAGE_FILE_SCHEMA)
    from stratus.sources.messages import parse_messages
    parsed = parse_messages(batch)
    ckpt, tmp_dir = os.path.join(tmp_dir, "ckpt"), os.path.join(tmp_dir, "sink")
    os.makedirs(ckpt)
    with open(os.path.join(ckpt, "metadata"), "w") as f:
        f.write('{"id":"a-query"}')
    write = ST.enriched_batch_writer(tmp_dir, ckpt)
    write(parsed, 0)
    write(parsed, 0)     # replay of batch 0 after a failure
    write(parsed, 1)
    back = spark.read.parquet(tmp_dir)
    assert back.count() == 2  # one row per batch after within-batch dedup
    assert sorted(r["batch_id"] for r in back.collect()) == [0, 1]
    assert back.first()["temperature_category"] == "warm"


def test_new_checkpoint_keeps_earlier_batches(spark, tmp_dir):
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    sink = os.path.join(tmp_dir, "sink")
    for name, cities in (("one", ["Paris", "Tokyo", "Lagos"]), ("two", ["Oslo", "Lima"])):
        src, ckpt = (os.path.join(tmp_dir, name, n) for n in ("src", "ckpt"))
        _stage(spark, src, [_msg(i, c, t0) for i, c in enumerate(cities)])
        _run(spark, "enrich", src, sink, ckpt)
        _run(spark, "enrich", src, sink, ckpt)
    back = spark.read.parquet(sink)
    assert sorted(r["city"] for r in back.collect()) == ["Lagos", "Lima", "Oslo", "Paris", "Tokyo"]
    assert {"year", "hour", "query_id", "batch_id"} <= set(back.columns)


def test_rows_without_a_key_pass_the_dedup(spark, tmp_dir):
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    _stage(spark, src, [("k", "{broken", 0, i, t0) for i in range(4)] + [_msg(8, "Tokyo", t0), _msg(9, "Tokyo", t0)])
    _run(spark, "dedup", src, sink, ckpt)
    got = [r["kafka_offset"] for r in spark.read.parquet(sink).collect()]
    assert sorted(got)[:4] == [0, 1, 2, 3] and len(got) == 5


def test_metrics_on_stream_sink_count_committed_files_only(spark, tmp_dir):
    from stratus.operators import upkeep as U
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    _stage(spark, src, [_msg(0, "Paris", t0), _msg(1, "Tokyo", t0)])
    _run(spark, "ingest", src, sink, ckpt)
    # a stray file dropped into the sink folder outside the stream is not part of the table
    spark.createDataFrame([(1,)], "x int").write.parquet(os.path.join(sink, "year=2026", "stray"))
    committed = spark.read.parquet(sink).select("_metadata.file_path").distinct().count()
    assert U.table_metrics(spark, sink).first()["num_files"] == committed


def test_router_replays_a_batch_after_a_fault(spark, tmp_dir, monkeypatch):
    from pyspark.sql import DataFrameWriter

    from stratus.operators import validate as V
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    src, out, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "topics", "ckpt"))
    _stage(spark, src, [_msg(0, "Paris", t0), ("k", "{broken", 0, 1, t0), _msg(2, "Lima", t0)])

    def run():
        ST.run_available(lambda: ST.start_router(ST.read_messages(spark, src), out, ckpt, trigger={"availableNow": True}))

    save = DataFrameWriter.save

    def fail(self, path=None, *args, **kwargs):  # after the raw and the validated topic, before the invalid one
        if path and f"topic={V.TOPIC_INVALID}" in path:
            raise OSError("lost")
        return save(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "save", fail)
    with pytest.raises(Exception, match="lost"):
        run()
    assert os.path.exists(os.path.join(out, f"topic={V.TOPIC_VALID}")) and not os.path.exists(os.path.join(out, f"topic={V.TOPIC_INVALID}"))
    monkeypatch.undo()
    run()
    _stage(spark, src, [_msg(3, "Oslo", t0)])
    run()
    run()
    got = sorted((r["topic"], r["offset"]) for r in spark.read.parquet(out).collect())
    # ``_msg`` leaves out some fields, so which record is valid follows from the rules alone.
    checked = V.check(spark.read.schema(ST.MESSAGE_FILE_SCHEMA).parquet(src))
    want = sorted((r["topic"], r["offset"]) for r in V.route(checked, keep=["offset"]).collect())
    assert got == want and len(got) == 8


@pytest.mark.parametrize("seed", [1, 2])
def test_lowest_offset_stays_whatever_the_order(spark, tmp_dir, seed):
    import random

    from stratus.operators.enrich import dedup_keep_first
    from stratus.sources.messages import parse_messages
    t0 = dt.datetime(2026, 6, 16, 10, tzinfo=UTC)
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "sink", "ckpt"))
    rows = [_msg(i, city, t0 + dt.timedelta(minutes=minute)) for i, (city, minute) in enumerate(
        [(c, m) for m in range(4) for c in ("Paris", "Lima")] * 3)] + [("k", "{broken", 0, 99, t0)]
    random.Random(seed).shuffle(rows)
    # Three batches within the watermark's delay, then one that closes them.
    for part in (rows[:9], rows[9:17], rows[17:], [_msg(100, "Oslo", t0 + dt.timedelta(hours=2))]):
        _stage(spark, src, part)
        ST.run_available(lambda: ST.start_ingest(ST.dedup_lowest(ST.parse_stream(ST.read_messages(spark, src))), sink, ckpt,
                                                 trigger={"availableNow": True}, partition_cols=[]))
    got = sorted(r["kafka_offset"] for r in spark.read.parquet(sink).collect())
    batch = parse_messages(spark.createDataFrame(rows, ST.MESSAGE_FILE_SCHEMA))
    want = dedup_keep_first(batch.filter("city is not null"), ["city", "recorded_at"], ["kafka_offset"])
    assert got == sorted([r["kafka_offset"] for r in want.collect()] + [99])
