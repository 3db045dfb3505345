"""String normalisation matching the validation contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A private-use sentinel (U+E000) marks the spaces inserted after each
# non-letter; it does not occur in city names.
_MARK = "\ue000"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Title case that capitalises after *any* non-letter, like ``str.title``.

    ``initcap`` alone only restarts words after spaces (``o'brien`` would stay
    ``O'brien``).  Inserting a marked space after every non-letter, applying
    ``initcap`` and removing the marks gives the same result with plain
    string expressions (no lambda, so the projection stays in whole-stage
    codegen).  Leading/trailing whitespace is kept.
    """
    spaced = F.regexp_replace(_col(c), r"([^\p{L}])", "$1" + _MARK + " ")
    return F.regexp_replace(F.initcap(spaced), _MARK + " ", "")


def strip_lower(c) -> Column:
    """Lower-case and strip Unicode whitespace at both ends."""
    return F.regexp_replace(F.lower(_col(c)), r"(?U)^\s+|\s+$", "")


def is_blank(c) -> Column:
    """True for null, empty or whitespace-only text."""
    return _col(c).isNull() | (F.regexp_replace(_col(c), r"(?U)\s", "") == F.lit(""))
