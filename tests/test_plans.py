import datetime as dt

from pyspark.sql import functions as F

from stratus.operators import analytics as A
from stratus.operators import validate as V
from stratus.plans import models as M
from stratus.sources.lake import read_table, write_partitioned
from stratus.sources.observations import date_parts, observations
from tests.fixtures import F1_SCHEMA, BERGEN

SF = "/root/testdata/sf0.001"


def _hours(spark, n=6):
    base = dt.datetime(2026, 6, 16, 0, 0, tzinfo=dt.timezone.utc)
    rows = [BERGEN[:12] + (base + dt.timedelta(minutes=30 * i),) + BERGEN[13:] + (i, 0) for i in range(2 * n)]
    return date_parts(spark.createDataFrame(rows, F1_SCHEMA))


def test_time_range_prunes_partitions(spark, tmp_dir):
    df = _hours(spark)
    write_partitioned(df, tmp_dir, mode="overwrite")
    table = read_table(spark, tmp_dir, schema=df.schema)
    got = A.time_range(table, "2026-06-16 01:15:00", "2026-06-16 03:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    expected = table.filter((F.col("recorded_at") >= "2026-06-16 01:15:00") & (F.col("recorded_at") < "2026-06-16 03:00:00"))
    assert sorted(r["kafka_offset"] for r in got.collect()) == sorted(r["kafka_offset"] for r in expected.collect()) == [3, 4, 5]


def test_mart_materialisation_as_table(spark, tmp_dir):
    events = observations(spark, SF)
    back = M.materialize_mart(spark, events, tmp_dir)
    direct = M.mart(M.staging(events))
    assert back.count() == direct.count() > 0
    assert back.exceptAll(direct).count() == 0


def test_routed_messages_written_by_topic(spark, tmp_dir):
    import json
    from tests.fixtures import BASE_RECORD
    rows = [(0, json.dumps(BASE_RECORD)), (1, json.dumps({**BASE_RECORD, "humidity": 300}))]
    routed = V.route(V.check(spark.createDataFrame(rows, "message_id long, value string")))
    V.write_routed(routed, tmp_dir)
    counts = {r["topic"]: r["count"] for r in spark.read.parquet(tmp_dir).groupBy("topic").count().collect()}
    assert counts == {V.TOPIC_RAW: 2, V.TOPIC_VALID: 1, V.TOPIC_INVALID: 1}


def test_profile_jobs_equal_individual_jobs(spark):
    scan = observations(spark, SF).select(*A.JOB_COLUMNS)
    shared = A.jobs_from_scan(scan)
    for name, job in A.JOBS.items():
        a, b = shared[name], job(scan)
        assert sorted(a.columns) == sorted(b.columns), name
        cols = sorted(a.columns)
        assert a.select(cols).exceptAll(b.select(cols)).count() == 0, name
        assert a.count() == b.count(), name


def test_bad_timestamp_text_is_null_not_error(spark):
    df = spark.createDataFrame([("garbage",), ("2026-06-16T10:00:00+00:00",)], "t string")
    got = [r[0] for r in df.select(F.try_to_timestamp("t")).collect()]
    assert got[0] is None and got[1] is not None


def test_error_report_evaluates_its_rules_once(spark):
    import json
    from tests.fixtures import BASE_RECORD
    rows = [(0, json.dumps(BASE_RECORD)), (1, json.dumps({**BASE_RECORD, "humidity": 300, "pressure": 1}))]
    rows_of = V.error_rows(V.check(spark.createDataFrame(rows, "message_id long, value string")), keep=["message_id"])
    plan = rows_of._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(V.RANGES["pressure"][2]) == 1 and "Filter" not in plan
    assert sorted((r["message_id"], r["loc"]) for r in rows_of.collect()) == [(1, "humidity"), (1, "pressure")]
