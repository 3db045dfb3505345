"""Banding and derived weather measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's for identical results).
# Temperature bands in degrees Celsius: upper bound (exclusive) -> label.
TEMPERATURE_BANDS = [(0, "freezing"), (10, "cold"), (20, "mild"), (30, "warm")]
TEMPERATURE_TOP = "hot"
# Wind bands in m/s, three spellings used by the three consumers.
WIND_BANDS_STREAM = [(1.5, "calm"), (5.5, "light breeze"), (10.7, "gentle breeze"),
                     (17.1, "moderate breeze"), (24.5, "fresh breeze")]
WIND_TOP_STREAM = "strong wind"
WIND_BANDS_BATCH = [(1.5, "Calm"), (5.5, "Light Breeze"), (10.7, "Moderate")]
WIND_TOP_BATCH = "Strong"
WIND_BANDS_STAGING = [(1.5, "calm"), (5.5, "light_breeze"), (10.7, "moderate")]
WIND_TOP_STAGING = "strong"
# Heat index: t + HEAT_COEF * humidity / 100 * HEAT_VAPOUR - HEAT_OFFSET, 2 dp.
HEAT_COEF = 0.33
HEAT_VAPOUR = 6.105
HEAT_OFFSET = 4.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value, bounds, top: str) -> Column:
    """``value < b0 -> l0, value < b1 -> l1, ..., otherwise top``.

    Null and NaN fall through every comparison and land in ``top``.
    """
    v = _col(value)
    expr = None
    for bound, label in bounds:
        expr = F.when(v < F.lit(bound), label) if expr is None else expr.when(v < F.lit(bound), label)
    return expr.otherwise(top)


def temperature_band(c="temperature") -> Column:
    return band(c, TEMPERATURE_BANDS, TEMPERATURE_TOP)


def wind_band_stream(c="wind_speed") -> Column:
    return band(c, WIND_BANDS_STREAM, WIND_TOP_STREAM)


def wind_band_batch(c="wind_speed") -> Column:
    return band(c, WIND_BANDS_BATCH, WIND_TOP_BATCH)


def wind_band_staging(c="wind_speed") -> Column:
    return band(c, WIND_BANDS_STAGING, WIND_TOP_STAGING)


def heat_index(t="temperature", h="humidity") -> Column:
    """Approximate heat index; double arithmetic, nulls propagate."""
    return F.round(_col(t) + (F.lit(HEAT_COEF) * _col(h) / F.lit(100.0) * F.lit(HEAT_VAPOUR))
                   - F.lit(HEAT_OFFSET), 2)
