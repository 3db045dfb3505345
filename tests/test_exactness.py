"""Averages, correlation, ranks and sinks at the edges where rounding or replay could go wrong."""

import math

from pyspark.sql import functions as F

from stratus.functions import avg2, guarded_corr
from stratus.operators.rank import rank_desc


def one(spark, rows, column, schema="x double"):
    return spark.createDataFrame(rows, schema).agg(column).first()[0]


def test_average_is_rounded_once(spark):
    assert spark.range(20_001).agg(avg2(F.when(F.col("id") < 10_000, 0.01).otherwise(0.0))).first()[0] == 0.0
    assert one(spark, [(0.0149,), (0.0149,), (0.0249,)], avg2("x")) == 0.02
    assert one(spark, [(0.005,), (0.005,)], avg2("x")) == 0.01
    assert one(spark, [(-0.005,), (-0.005,)], avg2("x")) == -0.01


def test_average_of_odd_values(spark):
    assert math.isnan(one(spark, [(float("nan"),), (10.0,)], avg2("x")))
    assert one(spark, [(1e20,), (1e20,)], avg2("x")) == 1e20
    assert one(spark, [(float("inf"),), (1.0,)], avg2("x")) == math.inf
    assert one(spark, [(None,), (3.0,)], avg2("x")) == 3.0
    assert one(spark, [(None,)], avg2("x")) is None


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 10.0), (2.0, 21.0), (3.0, 29.0), (40.0, None), (None, 7.0)]
    assert round(one(spark, rows, guarded_corr("x", "y"), "x double, y double"), 4) == 0.9959
    assert one(spark, [(1.0, 2.0), (1.0, 3.0)], guarded_corr("x", "y"), "x double, y double") is None


def test_rank_of_large_longs(spark):
    rows = [(2**53,), (2**53 + 1,), (None,)]
    got = rank_desc(spark.createDataFrame(rows, "v long"), "v", "r").collect()
    assert {r["v"]: r["r"] for r in got} == {2**53 + 1: 1, 2**53: 2, None: 3} and len(got) == 3
