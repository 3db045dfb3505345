from pyspark.sql import functions as F

from stratus.operators import enrich as EN
from tests.fixtures import f1


def test_dedup_removes_exact_copy(spark):
    out = EN.deduplicate(f1(spark))
    assert out.count() == 2
    # earliest offset of the (city, recorded_at) key survives
    assert sorted(r["kafka_offset"] for r in out.collect()) == [0, 1]


def test_dedup_keeps_columns_and_order(spark):
    df = f1(spark)
    assert EN.deduplicate(df).columns == df.columns


def test_transform_batch(spark):
    out = {r["city"]: r for r in EN.transform_batch(f1(spark)).collect()}
    assert len(out) == 2
    assert out["Bergen"]["temperature_category"] == "warm"
    assert out["Lima"]["temperature_category"] == "hot"
    assert out["Bergen"]["wind_category"] == "light breeze"
    assert out["Lima"]["wind_category"] == "light breeze"
    assert out["Bergen"]["heat_index"] == 18.57
    assert out["Bergen"]["pipeline_version"] == "1.0.0"
    assert out["Bergen"]["processed_at"] is not None


def test_dedup_hot_key_is_preaggregated(spark):
    # many copies of one key: the plan must aggregate map-side before the shuffle
    df = f1(spark).unionByName(f1(spark)).unionByName(f1(spark))
    plan = EN.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan or "ObjectHashAggregate" in plan or "SortAggregate" in plan
    assert EN.deduplicate(df).count() == 2


def test_with_replay_doubles_rows(spark):
    df = f1(spark)
    assert EN.with_replay(df).count() == 6
    assert EN.deduplicate(EN.with_replay(df)).agg(F.max("kafka_offset")).first()[0] < EN.REPLAY_OFFSET
