"""Calendar parts, all in the session time zone (UTC)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday_number(day: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(day)


def weekday_name(number: Column, names: Sequence[str]) -> Column:
    """`names` starts with Sunday; NULL for NULL.

    `get`, not `element_at`: under ANSI rules Spark takes the element of a
    constant array for never NULL and reads one even for a NULL index.
    """
    return F.get(F.array(*[F.lit(n) for n in names]), number - 1)


def happened_before(moment: Column, reference: Column) -> Column:
    """moment < reference; false when either is unknown."""
    return F.coalesce(moment < reference, F.lit(False))


def parse_timestamp(text: Column, pattern: str) -> Column:
    return F.to_timestamp(text, pattern)
