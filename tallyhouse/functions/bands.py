"""Classifying numbers."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class PriceClasses(NamedTuple):
    dearest: str
    cheapest: str
    above_mean: str
    below_mean: str
    at_mean: str


def band(value: Column, limits: Sequence[tuple[str, str]], default: str, inclusive: bool = False) -> Column:
    """Label of the first limit that `value` exceeds (or reaches, if `inclusive`).

    `limits` holds (limit as decimal text, label) from the highest limit down.
    """
    label = None
    for limit, name in limits:
        bound = F.lit(limit).cast("decimal(28,2)")
        hit = value >= bound if inclusive else value > bound
        label = F.when(hit, name) if label is None else label.when(hit, name)
    return F.lit(default) if label is None else label.otherwise(default)


def price_class(ours: Column, lowest: Column, mean: Column, highest: Column, names: PriceClasses) -> Column:
    """Place of our price: the extremes decide first, then the mean."""
    return (
        F.when(ours > highest, names.dearest)
        .when(ours < lowest, names.cheapest)
        .when(ours > mean, names.above_mean)
        .when(ours < mean, names.below_mean)
        .otherwise(names.at_mean)
    )
