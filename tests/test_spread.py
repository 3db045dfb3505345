"""Work per task where the input is one large file."""

import json
import os

import pytest
from pyspark.sql import functions as F

from stratus.operators import partitioning as P
from stratus.operators import validate as V
from stratus.sources.lake import open_writers
from stratus.sources.observations import observations
from tests.fixtures import BASE_RECORD

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def small_splits(spark):
    """A scan has far more splits than there are cores; the test file still has one row group."""
    conf = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "1000")
    yield
    spark.conf.set(conf, old)


def _rows_of_tasks(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_one_row_group_is_spread_over_all_tasks(spark, small_splits):
    events = spark.read.parquet(f"{SF}/events.parquet")
    n, cores = events.count(), spark.sparkContext.defaultParallelism
    assert events.rdd.getNumPartitions() >= cores and max(_rows_of_tasks(events)) == n
    rows = _rows_of_tasks(observations(spark, SF, with_parts=False, spread=True))
    assert sum(rows) == n and len(rows) == cores and max(rows) <= 2 * n / cores


def test_tasks_grow_with_the_rows(spark):
    spark.conf.set(P.SPREAD_ROWS_CONF, "1000")
    try:
        out = P.ensure_parallelism(spark.range(0, 20_000, numPartitions=1).withColumn("v", F.lit(None).cast("string")))
    finally:
        spark.conf.unset(P.SPREAD_ROWS_CONF)
    rows = _rows_of_tasks(out)
    assert len(rows) == out.rdd.getNumPartitions() == 20 and sum(rows) == 20_000 and max(rows) <= 1300


def test_patterns_and_errors_are_evaluated_once(spark):
    c = V.check(spark.createDataFrame([(0, json.dumps(BASE_RECORD))], "message_id long, value string"))
    number = V.NUMBER.replace("(?i)", "")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    for rows in (c, c.filter(~F.col("is_valid")), V.route(c, keep=["message_id"])):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        # Once per number; the time's own expression has it some times more.
        assert plan.count(number) < 2 * len(V.FLOAT_FIELDS + V.INTEGER_FIELDS)
        assert plan.count(V.RANGES["pressure"][2]) == 1


def test_topic_files_cover_times_and_records_are_checked_once(spark, monkeypatch):
    import __spark_entry__ as E
    from stratus.plans import catalog

    written = []
    write = catalog.V.write_routed

    def keep(routed, target, **kwargs):
        written.append((routed, target))
        write(routed, target, **kwargs)

    monkeypatch.setattr(catalog.V, "write_routed", keep)
    E.queries()["stream_validated_topic"](spark, SF)
    (routed, target), = written
    plan = routed._jdf.queryExecution().executedPlan().toString()
    # Nothing is exchanged above the decode; a range exchange would run it twice.
    assert "from_json" in plan and "Exchange" not in plan[:plan.index("from_json")] and "rangepartitioning(ts" in plan
    spans = sorted(tuple(r)[1:] for r in spark.read.parquet(f"{target}/topic={V.TOPIC_VALID}").groupBy(
        F.input_file_name()).agg(F.min("timestamp").alias("lo"), F.max("timestamp")).collect())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_topics_are_written_without_a_sort(spark, tmp_dir):
    good = json.dumps(BASE_RECORD)
    rows = [(i, good if i % 3 else "{broken") for i in range(30)]
    routed = V.route(V.check(spark.createDataFrame(rows, "message_id long, value string").coalesce(1)))
    seen = []
    listener_conf = "spark.sql.maxConcurrentOutputFileWriters"
    save = type(routed.write).save

    def look(self, *args, **kwargs):
        seen.append(spark.conf.get(listener_conf))
        return save(self, *args, **kwargs)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(routed.write), "save", look)
        V.write_routed(routed, tmp_dir)
    assert seen == ["3"] and spark.conf.get(listener_conf) == "0"
    out = spark.read.parquet(tmp_dir)
    assert {r["topic"]: r["count"] for r in out.groupBy("topic").count().collect()} == {
        V.TOPIC_RAW: 30, V.TOPIC_VALID: 20, V.TOPIC_INVALID: 10}
    assert sorted(os.listdir(tmp_dir))[-3:] == sorted(f"topic={t}" for t in V.TOPICS)


def test_more_values_than_open_writers(spark, tmp_dir):
    rows = spark.range(0, 1000, numPartitions=2).withColumn("p", F.col("id") % 7)
    with open_writers(spark, 3):
        rows.write.mode("append").partitionBy("p").parquet(tmp_dir)
    assert spark.read.parquet(tmp_dir).groupBy("p").count().filter("count in (142, 143)").count() == 7


def test_router_spreads_a_batch(spark, tmp_dir):
    from stratus.streaming import ingest as ST

    src, out, ckpt = (os.path.join(tmp_dir, n) for n in ("src", "topics", "ckpt"))
    (spark.range(0, 4000, numPartitions=1).select(
        F.lit("k").alias("key"), F.lit(json.dumps(BASE_RECORD)).alias("value"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp")).write.parquet(src))
    spark.conf.set(P.SPREAD_ROWS_CONF, "500")
    try:
        ST.run_available(lambda: ST.start_router(ST.read_messages(spark, src), out, ckpt, trigger={"availableNow": True}))
    finally:
        spark.conf.unset(P.SPREAD_ROWS_CONF)
    files = spark.read.parquet(out).filter(F.col("topic") == V.TOPIC_VALID).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 8 and sum(f["count"] for f in files) == 4000 and max(f["count"] for f in files) < 800


def test_compaction_and_plain_writes_do_not_sort(spark, tmp_dir):
    from stratus.operators import upkeep as U
    from stratus.sources import tablelog as L
    from stratus.sources.lake import write_partitioned

    seen = []
    sorts = type(spark.range(1).write).save

    def look(self, *args, **kwargs):
        seen.append(int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        return sorts(self, *args, **kwargs)

    rows = spark.range(0, 3000).withColumn("year", (F.col("id") % 2).cast("int"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(rows.write), "save", look)
        for _ in range(2):
            write_partitioned(rows.repartition(3, "id"), tmp_dir, partition_cols=["year"], rebalance=False)
        U.upkeep(spark, tmp_dir, "a", partition_cols=["year"])
    assert seen == [4, 4, 1]
    assert L.files_of(L.manifest(spark, tmp_dir)).count() == 2
    assert L.read_version(spark, tmp_dir).groupBy("id", "year").count().filter("count = 2").count() == 3000
