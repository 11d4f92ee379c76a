"""Percent changes, bands and report rounding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_change(new: Column | str, old: Column | str, zero: float | None = 0.0) -> Column:
    """Change from ``old`` to ``new`` in percent; ``zero`` if ``old`` is 0."""
    new, old = _col(new), _col(old)
    change = F.try_divide(new - old, old) * 100
    return F.when(old == 0, F.lit(zero).cast("double")).otherwise(change)


def trend_band(pct: Column | str, width: float = 0.3) -> Column:
    pct = F.coalesce(_col(pct), F.lit(0.0))
    return F.when(pct > width, "up").when(pct < -width, "down").otherwise("flat")


def alert_class(pct: Column | str, threshold: float = 5.0) -> Column:
    """``up``/``down`` beyond the threshold, null otherwise."""
    pct = _col(pct)
    return F.when(pct > threshold, "up").when(pct < -threshold, "down")


def sign_class(value: Column | str) -> Column:
    value = F.coalesce(_col(value), F.lit(0.0))
    return F.when(value > 0, "up").when(value < 0, "down").otherwise("flat")


def r2_band(r2: Column | str) -> Column:
    """``good`` from 0.7, ``medium`` from 0.4, else ``low`` (also for null and NaN)."""
    r2 = _col(r2)
    r2 = F.when(~F.isnan(r2), r2)
    return F.when(r2 >= 0.7, "good").when(r2 >= 0.4, "medium").otherwise("low")


def round_for_report(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Half-even rounding of the named columns; used in reports only."""
    return df.withColumns({c: F.bround(F.col(c), n) for c, n in digits.items() if c in df.columns})
