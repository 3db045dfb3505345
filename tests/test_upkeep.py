"""Selective compaction, the run log, unreferenced files and reads as of a run."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from stratus.operators import upkeep as U
from stratus.sources import tablelog as L
from stratus.sources.lake import read_table, write_partitioned

CAPACITY = 40_000


def rows(spark, start, n):
    return spark.range(start, start + n).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                                (F.col("id") % 2).cast("int").alias("year"))


def add(spark, path, start, n, files=1):
    write_partitioned(rows(spark, start, n).repartition(files), path, partition_cols=["year"], rebalance=False)


def upkeep(spark, path, run_id):
    return U.upkeep(spark, path, run_id, partition_cols=["year"], target_bytes=CAPACITY).first()


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def names(df):
    return {r["file_path"] for r in df.select("file_path").collect()}


def test_first_fit_decreasing():
    assert U.first_fit_decreasing([5, 7, 3, 2, 4, 10], 10) == [2, 1, 1, 3, 2, 0]
    assert U.first_fit_decreasing([], 10) == []
    bins = U.first_fit_decreasing([i % 7 + 1 for i in range(500)], 20)
    room = [sum(i % 7 + 1 for i, b in enumerate(bins) if b == x) for x in range(max(bins) + 1)]
    assert max(room) <= 20 and sum(r < 14 for r in room) <= 1


@pytest.fixture()
def table(spark, tmp_dir):
    """A partition has one large file, and many small ones."""
    path = f"{tmp_dir}/a table+%"
    add(spark, path, 0, 4000)
    add(spark, path, 10_000, 300, files=6)
    return path


def test_only_small_files_are_rewritten(spark, table):
    before = {r["file_path"]: r["file_size"] for r in L.list_files(spark, table).collect()}
    large = {f for f, size in before.items() if size >= CAPACITY * U.SMALL_SHARE}
    assert len(large) == 2 and len(before) == 14
    plan = U.plan_compaction(L.files_of(L.manifest(spark, table)), CAPACITY).collect()
    assert {r["partition"] for r in plan} == {"/year=0", "/year=1"} and sum(r["n_files"] for r in plan) == 12
    assert all(r["bytes"] <= CAPACITY for r in plan)
    run = upkeep(spark, table, "a")
    assert run["optimize"]["files_removed"] == 12 and run["optimize"]["files_added"] == len(plan)
    assert run["bytes_rewritten"] == sum(s for f, s in before.items() if f not in large)
    now = L.files_of(L.manifest(spark, table))
    assert names(now.filter("not compacted")) == large
    assert now.filter("compacted").count() == len(plan)
    want = [*range(4000), *range(10_000, 10_300)]
    got = L.read_version(spark, table)
    assert got.columns == ["id", "v", "year"] and ids(got) == want and got.filter("year <> id % 2").isEmpty()
    # Nothing was deleted: a plain reader sees the table as it was.
    assert ids(spark.read.parquet(table)) == want
    again = upkeep(spark, table, "b")
    assert again["optimize"]["files_removed"] == again["optimize"]["files_added"] == again["bytes_rewritten"] == 0


def test_many_jobs_and_chunks(spark, table):
    plan = U.plan_compaction(L.files_of(L.manifest(spark, table)), CAPACITY, chunk_files=4)
    assert plan.select("partition", "chunk").distinct().count() > 2
    U.upkeep(spark, table, "a", partition_cols=["year"], target_bytes=9000, job_files=3)
    assert ids(L.read_version(spark, table)) == [*range(4000), *range(10_000, 10_300)]
    assert L.files_of(L.manifest(spark, table)).filter("compacted").count() > 2


def test_versions_count_runs(spark, table):
    assert U.table_metrics(spark, table).first()["table_version"] == 0
    first, second = upkeep(spark, table, "a"), upkeep(spark, table, "b")
    assert [(r["before"]["table_version"], r["after"]["table_version"]) for r in (first, second)] == [(0, 1), (1, 2)]
    assert first["after"][1:] == second["before"][1:]
    retried = upkeep(spark, table, "a")
    assert retried["version"] == 1 and L.version(spark, table) == 2
    assert U.table_metrics(spark, table).first()["table_version"] == 2
    assert [tuple(r) for r in U.maintenance_status(spark.createDataFrame([("a",), ("x",)], "run_id string"), L.runs(spark, table))
            .select("run_id", "status", "before_version", "after_version").orderBy("run_id").collect()] == [
                ("a", "completed", "0", "1"), ("x", "no_result", None, None)]


def test_concurrent_appends(spark, tmp_dir):
    def put(i):
        return L.append(spark, tmp_dir, {"run_id": f"run-{i % 6}"})

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(put, range(12)))
    log = {r["run_id"]: r["version"] for r in L.runs(spark, tmp_dir).collect()}
    assert sorted(log.values()) == [1, 2, 3, 4, 5, 6] and [log[f"run-{i % 6}"] for i in range(12)] == got
    assert not L.put_if_absent(spark, f"{tmp_dir}/{L.RUNS}/0000000001.json", "{}")
    with pytest.raises(L.TableChanged):
        L.append(spark, tmp_dir, {"run_id": "late"}, after=5)
    assert L.version(spark, tmp_dir) == 6


def test_unreferenced_files(spark, table):
    assert U.unreferenced_files(spark, table).isEmpty()
    upkeep(spark, table, "a")
    add(spark, table, 20_000, 10)  # appended since: live, whatever its age
    live = names(L.files_of(L.manifest(spark, table)))
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=167)
    soon = U.unreferenced_files(spark, table, now=later)
    assert soon.count() == 12 and soon.filter("eligible").isEmpty()
    assert U.retention_report(spark, table, now=later).first()["files_eligible"] == 0
    later += dt.timedelta(hours=2)
    old = U.unreferenced_files(spark, table, now=later).filter("eligible")
    assert old.count() == 12 and not names(old) & live
    assert U.retention_report(spark, table, now=later).first()["files_eligible"] == 12
    assert U.vacuum(spark, table, now=later) == 0 and U.unreferenced_files(spark, table).count() == 12
    assert U.vacuum(spark, table, now=later, delete=True) == 12
    assert names(L.listed(spark, table)) == live
    assert ids(L.read_version(spark, table)) == [*range(4000), *range(10_000, 10_300), *range(20_000, 20_010)]
    with pytest.raises(FileNotFoundError):
        L.read_version(spark, table, 0)


def test_failed_run_changes_nothing(spark, table, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(L, "append", fail)
    with pytest.raises(RuntimeError, match="lost"):
        upkeep(spark, table, "a")
    monkeypatch.undo()
    want = [*range(4000), *range(10_000, 10_300)]
    assert L.version(spark, table) == 0 and ids(L.read_version(spark, table)) == want
    orphans = U.unreferenced_files(spark, table)
    assert orphans.count() >= 2 and all(f"/{L.COMPACTED}/" in f for f in names(orphans))
    assert upkeep(spark, table, "a")["version"] == 1 and ids(L.read_version(spark, table)) == want


def test_read_as_of_run(spark, table):
    upkeep(spark, table, "a")
    add(spark, table, 20_000, 20)
    upkeep(spark, table, "b")
    between = L.runs(spark, table).filter("version = 1").first()["completed_at"] + dt.timedelta(milliseconds=1)
    add(spark, table, 30_000, 5)
    base = [*range(4000), *range(10_000, 10_300)]
    for at, want in ((0, base), (1, base), (2, [*base, *range(20_000, 20_020)]), (None, [*base, *range(20_000, 20_020), *range(30_000, 30_005)])):
        assert ids(L.read_version(spark, table, at)) == want
    assert ids(read_table(spark, table, version_as_of=1)) == base
    # ``completed_at`` comes to Python in the client's zone; the session's zone is UTC.
    between = between.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    assert ids(read_table(spark, table, timestamp_as_of=between)) == base
    for at in (3, -1):
        with pytest.raises(ValueError):
            read_table(spark, table, version_as_of=at)


def test_table_without_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "flat")
    for i in range(3):
        rows(spark, i * 10, 10).coalesce(1).write.mode("append").parquet(path)
    U.upkeep(spark, path, "a", partition_cols=[])
    assert ids(L.read_version(spark, path)) == list(range(30))
    assert L.files_of(L.manifest(spark, path)).count() == 1
