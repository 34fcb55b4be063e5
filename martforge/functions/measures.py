"""Numeric measures.

Money stays ``decimal(18,2)`` end to end (exact sums). Ratios are computed
on doubles (both operands cast), multiplied by 100 and rounded half-up;
a zero or NULL denominator yields NULL instead of an error or infinity.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martforge.schemas import MONEY, PCT_DISCOUNT


def discount(list_price: Column, unit_price: Column) -> Column:
    """List price minus unit price, 2 decimals (negative when sold above list)."""
    return (list_price - unit_price).cast(MONEY)


def ratio_pct(num: Column, den: Column) -> Column:
    """num / den * 100 as double; NULL when den is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double")) * F.lit(100.0)


def discount_pct(desc: Column, unit_price: Column, *, strict: bool = False) -> Column:
    """Discount as % of the unit price, NUMERIC(5,2). Values that do not fit
    become NULL (or raise with ``strict``)."""
    r = F.round(ratio_pct(desc, unit_price), 2)
    return r.cast(PCT_DISCOUNT) if strict else r.try_cast(PCT_DISCOUNT)


def pct_overflowed(pct: Column, num: Column, den: Column) -> Column:
    """Whether a stored percentage is NULL only because it did not fit its type."""
    return pct.isNull() & num.isNotNull() & (den != 0)


def attainment_pct(real: Column, expected: Column, digits: int = 1) -> Column:
    """Realised / expected * 100, rounded; NULL when expected is 0."""
    return F.round(ratio_pct(real, expected), digits)


def guarded_pct(real: Column, expected: Column) -> Column:
    """Realised / expected * 100, 0 when expected is 0 (KPI card)."""
    return F.coalesce(ratio_pct(real, expected), F.lit(0.0))


def avg_ticket(real: Column, qty: Column) -> Column:
    """Realised value per unit sold, 0 when nothing was sold."""
    return F.coalesce(F.try_divide(real.cast("double"), qty.cast("double")), F.lit(0.0))
