"""Column-level building blocks (all JVM-side built-ins, no Python UDFs)."""

from stratus.functions.numeric import avg2, avg_state, exact_avg, guarded_corr, merged_avg, round_signed, zscore
from stratus.functions.text import strip_lower, title_case
from stratus.functions.weather import (
    heat_index,
    temperature_band,
    wind_band_batch,
    wind_band_staging,
    wind_band_stream,
)

__all__ = [
    "avg2", "avg_state", "exact_avg", "guarded_corr", "merged_avg", "round_signed", "zscore",
    "strip_lower", "title_case",
    "heat_index", "temperature_band", "wind_band_batch", "wind_band_staging", "wind_band_stream",
]
