"""Money and ratios in decimals only; rounding is half-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(10, 2)  # one row: a price, a sale, a mean of sales
TOTAL = DecimalType(28, 2)  # sums; (18, 2) would overflow at 10^16, a few TB of sales
SHARE_SCALE = 6


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def line_total(quantity: Column, unit_price: Column) -> Column:
    return (quantity * unit_price).cast(MONEY)


def total(amount: Column) -> Column:
    """Aggregate: the sum of a money column."""
    return F.sum(amount).cast(TOTAL)


def mean_money(amount: Column) -> Column:
    """Aggregate: the mean of a money column, to the cent."""
    return F.round(F.avg(amount), 2).cast(MONEY)


def ratio(numerator: Column, denominator: Column, scale: int = SHARE_SCALE) -> Column:
    """numerator / denominator; NULL when the denominator is zero."""
    return F.round(F.try_divide(numerator, denominator), scale).cast(DecimalType(18 + scale, scale))


def pct_diff(value: Column, base: Column, scale: int = 2) -> Column:
    """How far `value` lies above (+) or below (-) `base`, in percent points."""
    return F.round((value - base) / base * 100, scale).cast(DecimalType(8 + scale, scale))


def is_below_share(value: Column, of: Column, share: str) -> Column:
    """value < share x of, compared in decimals; false when either is unknown.

    `share` is decimal text: as a double, 3.09 would count as less than
    0.6 x 5.15 although both are equal.
    """
    digits = len(share.partition(".")[2])
    limit = of * F.lit(share).cast(DecimalType(digits + 1, digits))
    return F.coalesce(value < limit, F.lit(False))
