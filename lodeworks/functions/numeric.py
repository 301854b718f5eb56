"""Arithmetic with the warehouse's null, rounding and unit rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(num: Column, den: Column) -> Column:
    """num / den as double; null where the divisor is 0 or null.

    Both sides are cast first: Spark would otherwise divide integers as decimals.
    """
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct_share(part: Column, total: Column) -> Column:
    """100 * part / total; a zero total gives null rather than an error."""
    return safe_divide(F.lit(100.0) * part, total)


def recovery(feed: Column, conc: Column, tail: Column) -> Column:
    """Two-product metallurgical recovery in percent.

    Null when a grade is null, feed <= tail or conc <= tail. conc < feed is not rejected: it gives
    more than 100 and is left to the bounds check.
    """
    ratio = safe_divide(conc * (feed - tail), feed * (conc - tail))
    return F.when((feed > tail) & (conc > tail), ratio * 100.0)


def round_half_up(x: Column, digits: int) -> Column:
    """Round half away from zero on x * 10^digits.

    ``F.round(x, n)`` works on the shortest decimal text of x, so 1.005 goes to 1.01; rounding the
    scaled double instead gives 1.0, which is what the warehouse's published numbers use. ``rint`` is
    corrected at exact halves, where the gap to x is exact; this avoids a decimal object per value.
    """
    scale = float(10**digits)
    scaled = x.cast("double") * scale
    even = F.rint(scaled)
    gap = scaled - even
    whole = (
        F.when((scaled > 0) & (gap == 0.5), even + 1.0).when((scaled < 0) & (gap == -0.5), even - 1.0).otherwise(even)
    )
    return whole / scale


def round_half_even(x: Column, digits: int) -> Column:
    """Round half to even on x * 10^digits, the rule of NumPy's ``round``."""
    scale = float(10**digits)
    return F.rint(x.cast("double") * scale) / scale


def clip_lower(x: Column, low: float) -> Column:
    """x, but at least low; null stays null (``greatest`` would turn it into low)."""
    return F.when(x < low, F.lit(low)).otherwise(x)


def cap(x: Column, high: float) -> Column:
    """least(x, high). A null x gives high: a truck with no nominal rate counts as 100%."""
    return F.least(x.cast("double"), F.lit(high))


def positive_flag(x: Column) -> Column:
    """1 where x > 0, otherwise 0 (also for null)."""
    return F.when(x > 0, 1).otherwise(0)


def tj_to_mwh(tj: Column) -> Column:
    return tj * 1e6 / 3600.0


def mj_to_kwh(mj: Column) -> Column:
    return mj / 3.6


def kt_to_t(kt: Column) -> Column:
    return kt * 1000.0


def implied_tonnage(tj: Column, kwh_per_t: Column) -> Column:
    """Million tonnes that tj of energy treats at kwh_per_t."""
    return safe_divide(tj * 1e6 / 3.6, kwh_per_t) / 1e6
