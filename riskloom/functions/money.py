"""Money arithmetic that does not depend on summation order.

Amounts are exact to a millionth. They are summed as two longs, whole units and
millionths: exact in any partial-aggregation order, a plain long addition in
generated code, and no overflow below 9 * 10^12 rows. The sum is put together
once, as a decimal. A NaN counts as missing, like null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000


def present(amount: Column) -> Column:
    """The amount, null where it is NaN."""
    return F.when(~F.isnan(amount), amount)


def micros(amount: Column) -> Column:
    """Nearest whole millionth, for sums that stay below 9 * 10^12 units."""
    return F.floor(present(amount)) * MILLION + _fraction(present(amount))


def _fraction(amount: Column) -> Column:
    return F.floor((amount - F.floor(amount)) * float(MILLION) + 0.5)


def summed(amount: Column) -> tuple[Column, Column]:
    """Sums of whole units and of millionths, which add up over partial results; null when no amount is present."""
    known = present(amount)
    return F.sum(F.floor(known)), F.sum(_fraction(known))


def joined(units: Column, millionths: Column) -> Column:
    """The amount of summed units and millionths, as double."""
    exact = units.cast("decimal(20,0)") + millionths.cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")
    return exact.cast("double")


def total(amount: Column) -> Column:
    """Exact sum of amounts, as double; null when no amount is present."""
    return joined(*summed(amount))


def total_where(condition: Column, amount: Column) -> Column:
    """Sum of the amounts of rows meeting ``condition``; 0.0 when none does."""
    return total(F.when(condition, amount).otherwise(F.lit(0.0)))


def mean(amount: Column) -> Column:
    """Unrounded mean; null when no amount is present."""
    return total(amount) / F.nullif(F.count(present(amount)), F.lit(0))


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half up at ``digits`` decimals with plain float arithmetic; NaN stays NaN."""
    scale = float(10**digits)
    return F.when(F.isnan(value), value).otherwise(F.floor(value * scale + 0.5) / F.lit(scale))


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, null when ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
