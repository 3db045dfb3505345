import datetime as dt

from stratus.operators import runlog as RL
from stratus.operators import upkeep as U
from stratus.schemas import RUN_LOG_SCHEMA
from stratus.sources.lake import read_table, write_partitioned
from stratus.sources.observations import date_parts
from tests.fixtures import f2


def test_partition_values_preserved(spark, tmp_dir):
    df = date_parts(f2(spark))
    write_partitioned(df, tmp_dir, mode="overwrite")
    back = read_table(spark, tmp_dir, schema=df.schema)
    assert back.count() == 3
    assert {tuple(r) for r in back.select("year", "month", "day", "hour").distinct().collect()} == {(2026, 6, 16, 10)}
    bergen = back.filter("city = 'Bergen'").first()
    assert abs(bergen["temperature"] - 21.4) < 0.01


def test_append_doubles_rows(spark, tmp_dir):
    df = date_parts(f2(spark))
    write_partitioned(df, tmp_dir, mode="overwrite")
    write_partitioned(df, tmp_dir, mode="append")
    assert read_table(spark, tmp_dir, schema=df.schema).count() == 6


def _run(run_id, attempt, status="success"):
    t = dt.datetime(2026, 6, 16, 10)
    return (run_id, "job", t, t, 3, status, None, attempt)


def test_run_log_insert_or_ignore(spark):
    from pyspark.sql import types as T
    schema = T.StructType(RUN_LOG_SCHEMA.fields + [T.StructField("attempt", T.IntegerType())])
    existing = spark.createDataFrame([_run("a", 1)], schema).select(*RL.RUN_COLUMNS)
    incoming = spark.createDataFrame([_run("a", 2, "retry"), _run("b", 2, "retry"), _run("b", 1)], schema)
    new = RL.append_idempotent(existing, incoming).collect()
    assert [(r["run_id"], r["status"]) for r in new] == [("b", "success")]


def test_run_log_append_to_a_large_log(spark, tmp_dir):
    """The filter of the batch's keys keeps strangers from the join; the rows to append are those of the plain anti join."""
    from pyspark.sql import functions as F
    rows = lambda lo, hi: spark.range(lo, hi, 1, 4).select(
        F.concat(F.lit("run-"), F.col("id")).alias("run_id"), F.lit("job").alias("job_name"),
        F.lit(dt.datetime(2026, 6, 16, 10)).alias("started_at"), F.lit(dt.datetime(2026, 6, 16, 11)).alias("completed_at"),
        F.col("id").alias("records_processed"), F.lit("success").alias("status"), F.lit(None).cast("string").alias("error_message"))
    rows(0, 50_000).write.mode("overwrite").parquet(tmp_dir)
    log = read_table(spark, tmp_dir, schema=RUN_LOG_SCHEMA)
    incoming = rows(49_000, 51_000).unionByName(rows(49_500, 50_500))
    got = RL.append_idempotent(log, incoming)
    plain = incoming.dropDuplicates(["run_id"]).join(log.select("run_id"), "run_id", "left_anti")
    assert got.count() == 1_000 and got.exceptAll(plain.select(*RL.RUN_COLUMNS)).count() == 0

    keys = incoming.select("run_id").distinct()
    passed = RL.may_hold(log.select("run_id"), "run_id", *RL.key_filter(keys, "run_id", 2_000))
    n = passed.count()
    assert 1_000 <= n < 3_000  # of 50,000; every key that is in the batch passes
    assert keys.join(log, "run_id", "left_semi").join(passed, "run_id", "left_anti").count() == 0
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_run_log_filter_without_keys_and_with_null_keys(spark):
    schema = "run_id string"
    none, some = spark.createDataFrame([], schema), spark.createDataFrame([("a",), (None,)], schema)
    assert RL.may_hold(some, "run_id", *RL.key_filter(none, "run_id", 0)).count() == 0
    assert {r[0] for r in RL.may_hold(some, "run_id", *RL.key_filter(some, "run_id", 2)).collect()} == {"a", None}


def test_compaction_preserves_rows(spark, tmp_dir):
    df = date_parts(f2(spark))
    for _ in range(3):
        write_partitioned(df.repartition(3), tmp_dir, mode="append", rebalance=False)
    before = U.table_metrics(spark, tmp_dir).first()
    new_path = tmp_dir + "_compacted"
    m = U.compact(spark, tmp_dir, new_path)
    after = U.table_metrics(spark, new_path).first()
    assert before["num_files"] > after["num_files"] >= 1 and before["size_bytes"] > 0
    assert m["files_removed"] == before["num_files"] and m["files_added"] == after["num_files"]
    a = read_table(spark, tmp_dir, schema=df.schema)
    b = read_table(spark, new_path, schema=df.schema)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_retention_report_zero_hours(spark, tmp_dir):
    write_partitioned(date_parts(f2(spark)), tmp_dir, mode="overwrite")
    r = U.retention_report(spark, tmp_dir, retention_hours=0).first()
    assert r["files_total"] >= 1 and r["files_eligible"] >= 0


def test_maintenance_report_shape(spark, tmp_dir):
    write_partitioned(date_parts(f2(spark)), tmp_dir, mode="overwrite")
    rep = U.maintenance_report(spark, tmp_dir, tmp_dir + "_c").first()
    assert set(rep.asDict()) == {"delta_path", "before", "after", "optimize", "vacuum_files_eligible"}
    assert rep["before"]["num_files"] > 0 and rep["optimize"]["duration_seconds"] >= 0


def test_maintenance_status(spark):
    runs = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "run_id string")
    full = spark.createDataFrame(
        [("r1", (5, 20, 1024), (7, 8, 900), (1, 12, 3.2), "p")],
        "run_id string, before struct<table_version:int,num_files:int,size_bytes:bigint>, "
        "after struct<table_version:int,num_files:int,size_bytes:bigint>, "
        "optimize struct<files_added:int,files_removed:int,duration_seconds:double>, delta_path string")
    out = {r["run_id"]: r for r in U.maintenance_status(runs, full).collect()}
    assert out["r1"]["status"] == "completed" and out["r1"]["files_removed"] == "12"
    assert out["r2"]["status"] == "no_result"
    empty = spark.createDataFrame([("r3",)], "run_id string")  # a report without any keys
    out2 = {r["run_id"]: r for r in U.maintenance_status(runs, empty).collect()}
    assert out2["r3"]["status"] == "completed" and out2["r3"]["before_version"] == "unknown"


def test_partition_inventory_missing_table(spark, tmp_dir):
    import pytest
    with pytest.raises(FileNotFoundError):
        U.partition_inventory(spark, tmp_dir + "/does_not_exist")


def test_latest_run(spark):
    schema = RUN_LOG_SCHEMA
    t1, t2 = dt.datetime(2026, 6, 16, 10), dt.datetime(2026, 6, 16, 11)
    log = spark.createDataFrame([("a", "j", t1, t1, 1, "success", None), ("b", "j", t2, t2, 1, "success", None)], schema)
    assert RL.latest(log).first()["run_id"] == "b"
