"""Named measures over a dataset, grouped by any of its columns."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from tallyhouse.operators.filters import Range, apply_filters


@dataclass(frozen=True)
class Measure:
    """An aggregate with a name; `sums` lists the columns it adds up."""

    name: str
    aggregate: Callable[[], Column]
    description: str
    sums: tuple[str, ...] = ()


@dataclass(frozen=True)
class Dataset:
    df: DataFrame
    measures: Mapping[str, Measure]
    non_additive: frozenset[str] = field(default_factory=frozenset)

    @classmethod
    def of(cls, df: DataFrame, measures: Sequence[Measure], non_additive: frozenset[str] = frozenset()) -> Dataset:
        for measure in measures:
            wrong = non_additive.intersection(measure.sums)
            if wrong:
                raise ValueError(f"measure {measure.name} sums non-additive columns: {sorted(wrong)}")
        return cls(df, {m.name: m for m in measures}, non_additive)


def evaluate(
    dataset: Dataset,
    dims: Sequence[str | Column] = (),
    measures: Sequence[str] = (),
    ranges: Mapping[str, Range] | None = None,
    selections: Mapping[str, Sequence[Any]] | None = None,
    where: Column | str | None = None,
    having: Column | str | None = None,
    order_by: Sequence[Column | str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Filter, group by `dims` (none: one row for everything), compute `measures`, order, limit.

    All measures of a call share one aggregation.
    """
    unknown = [m for m in measures if m not in dataset.measures]
    if unknown:
        raise KeyError(f"unknown measures: {unknown}")
    rows = apply_filters(dataset.df, ranges, selections, where)
    result = rows.groupBy(*dims).agg(*[dataset.measures[m].aggregate().alias(m) for m in measures])
    if having is not None:
        result = result.filter(having)
    if order_by:
        result = result.orderBy(*order_by)
    return result if limit is None else result.limit(limit)
