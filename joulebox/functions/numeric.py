"""Numeric helpers that stay safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def finite_or_null(col: Column | str) -> Column:
    """NaN / +Inf / -Inf -> NULL on a double column.

    ``abs(d) < inf`` is false for NaN (NaN sorts above every number in Spark)
    and for both infinities, so one comparison replaces three tests.
    """
    d = _c(col)
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def nonfinite_to_null(col: Column | str) -> Column:
    """Cast to double (NULL when not numeric) and map NaN / +Inf / -Inf to NULL."""
    return finite_or_null(_c(col).try_cast("double"))


def floor_int(col: Column | str) -> Column:
    """floor then int; NULL when out of int range instead of an ANSI error."""
    return F.floor(_c(col)).try_cast("int")


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """Division with a zero (or NULL) denominator giving NULL."""
    d = _c(den)
    return _c(num) / F.when(d != 0, d)


def clamp_health_score(deviation: Column | str) -> Column:
    """100 - max(dev, 0) clamped to [0, 100]; NULL when the deviation is NULL.

    The NULL guard keeps warehouse semantics (GREATEST/LEAST return NULL on a
    NULL argument) where Spark's greatest/least would skip it and yield 100.
    """
    d = _c(deviation)
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.lit(100.0) - F.greatest(d, F.lit(0.0))))
    return F.when(d.isNotNull(), score)
