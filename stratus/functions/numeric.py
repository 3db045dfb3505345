"""Numeric helpers that stay exact and ANSI-safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _parts(c) -> tuple[Column, Column]:
    """A value as double and, where it is one, as an exact decimal."""
    x = _col(c).cast("double")
    return x, x.try_cast("decimal(24,10)")


def _quotient(total: Column, exact: Column, plain: Column, n: Column, places: int) -> Column:
    """The average of ``exact`` decimals summing to ``total``; of ``n`` doubles summing to ``plain`` if some were no decimals."""
    den = F.greatest(exact.cast("decimal(18,0)"), F.lit(1)) * F.lit(2)
    scale = 10 ** places
    num = F.abs(total) * F.lit(2 * scale) + exact.cast("decimal(18,0)")
    units = ((num - num % den) / den).cast("long")
    value = F.when(total < 0, -units).otherwise(units) / F.lit(float(scale))
    return F.when(exact == n, value).otherwise(F.round(F.try_divide(plain, n), places))


def exact_avg(c, places: int = 2) -> Column:
    """Average rounded half away from zero to ``places`` decimals, summed exactly and rounded once.

    Values are summed as DECIMAL(24, 10) and the quotient is taken in whole
    units of the last place, so the result depends neither on the order of the
    rows nor on a second rounding.  A group holding a value that is no such
    decimal (NaN, infinite, 1e14 or more) has the rounded plain average: NaN
    stays NaN and nothing overflows.  Null values do not count; a group without
    values has a null average.
    """
    x, dec = _parts(c)
    return _quotient(F.sum(dec), F.count(dec), F.sum(x), F.count(x), places)


def avg_state(c, name: str) -> list[Column]:
    """Aggregates that hold ``exact_avg`` of a column in mergeable form (see ``merged_avg``)."""
    x, dec = _parts(c)
    return [F.sum(dec).alias(f"{name}_total"), F.count(dec).alias(f"{name}_exact"),
            F.sum(x).alias(f"{name}_plain"), F.count(x).alias(f"{name}_n")]


def merged_avg(name: str, places: int = 2) -> Column:
    """``exact_avg`` from the columns of ``avg_state`` after each has been summed over the parts."""
    c = F.col
    return _quotient(c(f"{name}_total").cast("decimal(34,10)"), c(f"{name}_exact"), c(f"{name}_plain"), c(f"{name}_n"), places)


def avg2(c) -> Column:
    return exact_avg(c, 2)


def round_signed(c: Column, places: int = 2) -> Column:
    """``round`` that never yields -0.0 (adding 0.0 turns -0.0 into 0.0)."""
    return F.round(c, places) + F.lit(0.0)


def guarded_corr(x, y) -> Column:
    """Pearson correlation over complete pairs, null (not an error) for a constant column.

    Under ANSI ``corr`` raises on a zero variance; covariance over the
    product of the population deviations is the same statistic.  A row that
    lacks either value counts for neither deviation.
    """
    x, y = _col(x), _col(y)
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def zscore(value, mean, sd, places: int = 2) -> Column:
    """Rounded z-score; null when the deviation is null or zero."""
    return F.round(F.try_divide(_col(value) - _col(mean), _col(sd)), places)
