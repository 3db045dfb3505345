import pytest
from pyspark.sql import functions as F

from stratus.functions import (avg2, guarded_corr, heat_index, strip_lower, temperature_band, title_case,
                               wind_band_batch, wind_band_staging, wind_band_stream, zscore)


def one(spark, expr, value, ddl):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("t,band", [(23.5, "warm"), (36.0, "hot"), (-0.01, "freezing"), (0.0, "cold"),
                                    (9.99, "cold"), (10.0, "mild"), (29.99, "warm"), (30.0, "hot"),
                                    (None, "hot"), (float("nan"), "hot")])
def test_temperature_band(spark, t, band):
    assert one(spark, temperature_band("x"), t, "x double") == band


@pytest.mark.parametrize("w,stream,batch,staging", [
    (5.2, "light breeze", "Light Breeze", "light_breeze"),
    (2.1, "light breeze", "Light Breeze", "light_breeze"),
    (0.0, "calm", "Calm", "calm"), (1.5, "light breeze", "Light Breeze", "light_breeze"),
    (10.7, "moderate breeze", "Strong", "strong"), (17.0, "moderate breeze", "Strong", "strong"),
    (20.0, "fresh breeze", "Strong", "strong"), (24.5, "strong wind", "Strong", "strong"),
    (7.0, "gentle breeze", "Moderate", "moderate")])
def test_wind_bands(spark, w, stream, batch, staging):
    assert one(spark, wind_band_stream("x"), w, "x double") == stream
    assert one(spark, wind_band_batch("x"), w, "x double") == batch
    assert one(spark, wind_band_staging("x"), w, "x double") == staging


def test_heat_index_paris(spark):
    df = spark.createDataFrame([(23.5, 65)], "temperature double, humidity int")
    assert df.select(heat_index()).first()[0] == pytest.approx(20.81)


def test_heat_index_null_propagates(spark):
    df = spark.createDataFrame([(None, 65)], "temperature double, humidity int")
    assert df.select(heat_index()).first()[0] is None


@pytest.mark.parametrize("s,expected", [("paris", "Paris"), ("o'brien", "O'Brien"), ("new-york", "New-York"),
                                        ("são paulo", "São Paulo"), ("NATION_3", "Nation_3"),
                                        ("stratford-upon-avon", "Stratford-Upon-Avon"), ("3rd street", "3Rd Street"),
                                        ("  padded ", "  Padded "), ("", "")])
def test_title_case_matches_python(spark, s, expected):
    assert expected == s.title()
    assert one(spark, title_case("x"), s, "x string") == expected


def test_strip_lower(spark):
    assert one(spark, strip_lower("x"), "  Clear Sky\t\n", "x string") == "clear sky"


def test_avg2_is_exact_and_half_up(spark):
    df = spark.createDataFrame([(0.01,), (0.02,)], "x double")
    # true mean 0.015 -> 0.02 (half up); a double average can land just below it
    assert df.agg(avg2("x")).first()[0] == 0.02


def test_guarded_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "a double, b double")
    assert df.agg(guarded_corr("a", "b")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "a double, b double")
    assert df2.agg(guarded_corr("a", "b")).first()[0] == pytest.approx(1.0)
    assert df2.agg(F.corr("a", "b")).first()[0] == pytest.approx(1.0)


def test_zscore_zero_sd_is_null(spark):
    df = spark.createDataFrame([(5.0, 5.0, 0.0), (7.0, 5.0, None)], "v double, m double, s double")
    assert [r[0] for r in df.select(zscore("v", "m", "s")).collect()] == [None, None]

