"""Filters shared by all questions on a dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Range = tuple[Any | None, Any | None]


def apply_filters(
    df: DataFrame,
    ranges: Mapping[str, Range] | None = None,
    selections: Mapping[str, Sequence[Any]] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Keep rows inside every inclusive range and every selection.

    An open end of a range is None; an empty selection means "all". Without any
    filter the whole period is used; there is no current date anywhere.
    """
    for column, (low, high) in (ranges or {}).items():
        if low is not None:
            df = df.filter(F.col(column) >= F.lit(low))
        if high is not None:
            df = df.filter(F.col(column) <= F.lit(high))
    for column, values in (selections or {}).items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df if where is None else df.filter(where)


def range_argument(low: Any, high: Any) -> Column:
    """A `:p.min` / `:p.max` parameter for `spark.sql(..., args={"p": ...})`."""
    return F.struct(F.lit(low).alias("min"), F.lit(high).alias("max"))


def list_argument(values: Sequence[str]) -> Column:
    """A text list parameter for `spark.sql(..., args=...)`; may be empty, never NULL.

    An empty list has no element type: read it in SQL as `CAST(:p AS ARRAY<STRING>)`.
    """
    return F.array(*[F.lit(v) for v in values])
