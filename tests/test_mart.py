"""The daily mart from mergeable cells: one scan, and batch by batch."""

import datetime as dt
import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from stratus.functions import avg_state, exact_avg, merged_avg
from stratus.plans import models as M
from stratus.sources.messages import parse_messages
from stratus.sources.observations import observations
from stratus.streaming import ingest as ST
from tests.test_streaming import _msg, _stage

SF = "/root/testdata/sf0.001"
UTC = dt.timezone.utc


def _same(a, b):
    assert a.columns == b.columns and a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/recorded_date=*/**/*.parquet", recursive=True)}


def test_mart_and_modes_scan_their_input_once(spark):
    stg = M.staging(observations(spark, SF))
    scans = stg._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
    for df in (M.mart(stg), M.dominant_conditions(stg)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        initial = plan.split("== Initial Plan ==")[-1]
        assert initial.count("Scan parquet") == scans, plan


def test_merged_average_equals_the_direct_one(spark):
    rows = [("a", 0, 0.125), ("a", 1, 0.125), ("a", 1, 0.13), ("b", 0, None), ("c", 0, math.nan), ("c", 1, 1.0),
            ("d", 0, 1e15), ("d", 1, 3e15), ("e", 0, -2.345), ("e", 1, -2.345)]
    df = spark.createDataFrame(rows, "k string, part int, x double")
    parts = df.groupBy("k", "part").agg(*avg_state("x", "x"))
    merged = parts.groupBy("k").agg(*[F.sum(f"x_{s}").alias(f"x_{s}") for s in ("total", "exact", "plain", "n")])
    got = {r[0]: r[1] for r in merged.select("k", merged_avg("x")).collect()}
    want = {r[0]: r[1] for r in df.groupBy("k").agg(exact_avg("x")).collect()}
    assert math.isnan(got.pop("c")) and math.isnan(want.pop("c"))
    assert got == want and got["a"] == 0.13 and got["b"] is None and got["d"] == 2e15


def test_incremental_mart_equals_the_batch_mart(spark, tmp_dir):
    o = observations(spark, SF)
    state, path = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "mart")
    for i in (0, 1, 2, 1):  # the second batch comes again after the third
        M.update_mart(o.filter(F.pmod("kafka_offset", F.lit(3)) == i), f"b{i}", state, path)
    _same(M.read_mart(spark, path), M.mart(M.staging(o)))


def test_files_of_untouched_days_stay(spark, tmp_dir):
    o = observations(spark, SF)
    state, path = os.path.join(tmp_dir, "state"), os.path.join(tmp_dir, "mart")
    M.update_mart(o, "b0", state, path)
    before, day = _files(path), M.mart(M.staging(o)).first()["recorded_date"]
    again = o.filter(F.to_date("recorded_at") == day)
    assert M.update_mart(again, "b1", state, path) == [day]
    after = _files(path)
    same = {f for f in before if f"recorded_date={day}" not in f}
    assert same and all(after.get(f) == before[f] for f in same)
    assert not {f for f in before if f"recorded_date={day}" in f} & set(after)
    _same(M.read_mart(spark, path), M.mart(M.staging(o.unionByName(again))))
    held = _files(path)
    assert M.update_mart(o.filter("false"), "b2", state, path) == [] and _files(path) == held


def test_fault_between_state_and_mart_is_replayed(spark, tmp_dir, monkeypatch):
    t0 = dt.datetime(2026, 6, 16, 23, 50, tzinfo=UTC)
    src, state, path, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "state", "mart", "ckpt"))

    def run():
        ST.run_available(lambda: ST.start_mart(ST.parse_stream(ST.read_messages(spark, src)), state, path, ckpt,
                                               trigger={"availableNow": True}))

    rows = [_msg(i, "Paris", t0 + dt.timedelta(minutes=5 * i)) for i in range(6)]
    _stage(spark, src, rows[:3])
    run()
    _stage(spark, src, rows[3:] + [("k", "{broken", 0, 99, t0)])
    whole = M.mart_of
    monkeypatch.setattr(M, "mart_of", lambda cells: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(M, "mart_of", whole)
    run()
    want = M.mart(M.staging(parse_messages(spark.createDataFrame(rows, ST.MESSAGE_FILE_SCHEMA))))
    got = M.read_mart(spark, path)
    _same(got, want)
    assert sorted(r["record_count"] for r in got.collect()) == [2, 4]
