"""Sums and means of doubles that do not depend on the order of the rows.

A double is cut into whole numbers of 24 bits at fixed places, from 2^24 down to 2^-72. Sums of whole numbers are the same
in any order, however rows lie in tasks, and fit a long for 2^39 rows. The five sums are made one number at the end, after
carries. Below 2^-72 a value's bits are cut off, of each row alike. Values of 2^47 and more, and those that are not finite,
are summed as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 24
PLACE = float(1 << BITS)
#: Whole numbers below the point, and one above the lowest whole one.
LOWER = 3
TOP = float(1 << 47)


def limbs(x: Column) -> list[Column]:
    """Whole numbers of a double from the highest place to the lowest, all of its sign.

    Scaling by powers of two and remainders are exact. No place is taken from another one's expression, so that
    expressions stay short.
    """
    size, sign = F.abs(x), F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    places = [size / PLACE, *[(size * (PLACE**k)) % PLACE for k in range(LOWER + 1)]]
    return [sign * F.floor(part) for part in places]


def total(x: Column) -> Column:
    """Aggregate: the sum of the values that are not null; null if there is none."""
    x = x.cast("double")
    plain = F.abs(x) < TOP
    sums = [F.sum(F.when(plain, part)) for part in limbs(x)]
    return F.coalesce(_joined(sums) + F.coalesce(F.sum(F.when(~plain, x)), F.lit(0.0)), F.sum(F.when(~plain, x)))


def _joined(sums: list[Column]) -> Column:
    """One double from sums by place: each place keeps what is nearest to zero and carries the rest to the next."""
    carry, digits = F.lit(0).cast("long"), []
    for s in reversed(sums[1:]):
        own = s + carry
        carry = F.shiftright(own + F.lit(1 << (BITS - 1)).cast("long"), BITS)
        digits.append(own - carry * F.lit(1 << BITS).cast("long"))
    value = F.lit(0.0)
    for digit in digits:  # the lowest first
        value = (digit.cast("double") + value) / PLACE
    return (sums[0] + carry).cast("double") * PLACE + value * PLACE


def mean(x: Column) -> Column:
    """Aggregate: the mean of the values that are not null; null if there is none."""
    return total(x) / F.when(F.count(x) > 0, F.count(x))
