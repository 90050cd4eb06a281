"""Whole-table tests. Each counts problem rows; zero is a pass.

A test names the numbers it needs from each table and how to judge them. The
suite computes all numbers of one table in one aggregation, so the cost is one
pass per table and not one per test.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.contracts import is_documented

PASSED = "OK"
FAILED = "FALHOU"


class QualityFailed(AssertionError):
    pass


@dataclass(frozen=True)
class QualityTest:
    name: str
    numbers: tuple[tuple[str, str, Callable[[], Column]], ...]  # (table, short name, aggregate)
    problems: Callable[..., Column]  # receives the numbers in the same order


def _count_rows() -> Column:
    return F.count(F.lit(1))


def unique(name: str, table: str, keys: Sequence[str]) -> QualityTest:
    """Rows minus distinct keys; a key with a NULL part counts as a problem."""
    numbers = ((table, "rows", _count_rows), (table, "keys_" + "_".join(keys), lambda: F.countDistinct(*keys)))
    return QualityTest(name, numbers, lambda rows, distinct: rows - distinct)


def no_rows(name: str, table: str, predicate: str) -> QualityTest:
    """No row satisfies `predicate`."""
    return QualityTest(name, ((table, name, lambda: F.count_if(F.expr(predicate))),), lambda n: n)


def allowed(name: str, table: str, column: str, values: Sequence[str]) -> QualityTest:
    """`column` holds one of `values` and is never NULL."""
    number = (table, name, lambda: F.count_if(F.col(column).isNull() | ~F.col(column).isin(list(values))))
    return QualityTest(name, (number,), lambda n: n)


def not_null(name: str, table: str, columns: Sequence[str]) -> QualityTest:
    """No row has a NULL in any of `columns`."""
    return no_rows(name, table, " OR ".join(f"{c} IS NULL" for c in columns))


def ratio_below(name: str, table: str, predicate: str, percent: int) -> QualityTest:
    """Fewer than `percent` % of rows satisfy `predicate`; otherwise they all count as problems."""
    numbers = ((table, name, lambda: F.count_if(F.expr(predicate))), (table, "rows", _count_rows))
    return QualityTest(name, numbers, lambda hits, rows: F.when(hits * 100 >= rows * percent, hits).otherwise(0))


def reconciles(name: str, table: str, column: str, other: str, other_column: str) -> QualityTest:
    """Equal sums. Two empty tables have no sum, which is a failure."""
    numbers = (
        (table, f"sum_{column}", lambda: F.sum(column).cast("decimal(38,2)")),
        (other, f"sum_{other_column}", lambda: F.sum(other_column).cast("decimal(38,2)")),
    )
    return QualityTest(name, numbers, lambda a, b: F.when(a == b, 0).otherwise(1))


def same_row_count(name: str, table: str, other: str) -> QualityTest:
    numbers = ((table, "rows", _count_rows), (other, "rows", _count_rows))
    return QualityTest(name, numbers, lambda a, b: F.abs(a - b))


def documented(name: str, table: str) -> QualityTest:
    """Every row of a table of columns, as the catalog or a schema gives them, has a comment."""
    return QualityTest(name, ((table, name, lambda: F.count_if(~is_documented())),), lambda n: n)


def quality_suite(tables: Mapping[str, DataFrame], tests: Sequence[QualityTest], stop: bool = False) -> DataFrame:
    """(test, problem_rows, status), one row per test in the given order.

    With `stop` the query itself ends with an error that names every failed test and its problem rows,
    whoever runs it and wherever its rows go.
    """
    per_table: dict[str, dict[str, Column]] = {}
    for test in tests:
        for table, short, aggregate in test.numbers:
            numbers = per_table.setdefault(table, {})
            if short not in numbers:
                numbers[short] = aggregate().alias(f"{table}__{short}")
    # One row per table, side by side: stack the rows and keep the only value of each column.
    rows = [tables[table].agg(*numbers.values()) for table, numbers in per_table.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    numbers = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])

    results = []
    for test in tests:
        problems = test.problems(*[F.col(f"{table}__{short}") for table, short, _ in test.numbers]).cast("bigint")
        results.append(
            F.struct(
                F.lit(test.name).alias("test"),
                problems.alias("problem_rows"),
                F.when(problems == 0, PASSED).otherwise(FAILED).alias("status"),
            )
        )
    rows = F.array(*results)
    if stop:
        failed = F.filter(rows, lambda r: ~F.equal_null(r["status"], F.lit(PASSED)))
        named = F.transform(failed, lambda r: F.concat_ws(" ", r["test"], F.concat(F.lit("("), r["problem_rows"], F.lit(")"))))
        error = F.raise_error(F.concat(F.lit("quality tests failed: "), F.array_join(named, ", ")))
        rows = F.when(F.size(failed) == 0, rows).otherwise(error)
    return numbers.select(F.inline(rows))


def assert_quality(results: DataFrame) -> None:
    """Raise with the names of all failed tests; only those reach the driver."""
    failed = [r.test for r in results.filter(F.col("status") == FAILED).collect()]
    if failed:
        raise QualityFailed("quality tests failed: " + ", ".join(failed))
