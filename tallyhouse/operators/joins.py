"""Equi-joins that keep the grain of one side.

No side is hinted for broadcast here: lookup tables grow with the business, so
Spark decides from their measured size. Between large sides it is a sort-merge
join on which adaptive execution splits hot keys of the fact side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.helpers import free_name


def _join_facts(fact: DataFrame, dim: DataFrame, key: str, how: str) -> DataFrame:
    """Join facts, in which a key may be hot, to a table that is unique on `key`.

    Adaptive execution splits a hot key only if both inputs are shuffled for the
    join itself. A deduplicated table comes already partitioned by its key and
    would be joined as it lies, so one bit of the key's hash is made a second join
    key, which that partitioning does not cover and which hardly adds to the rows
    that are moved. If the table is small enough to be broadcast, nothing is
    shuffled anyway.
    """
    side = free_name([*fact.columns, *dim.columns], "key_hash")
    hashed = F.hash(key).bitwiseAND(1).alias(side)
    return fact.select("*", hashed).join(dim.select("*", hashed), [key, side], how).drop(side)


def lookup(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], grouped: bool = False) -> DataFrame:
    """Add `columns` of `dim` (unique on `key`) to every row of `fact`.

    `grouped` says that `fact` has one row per key, too: no key is hot, and both sides are
    joined as they are already partitioned.
    """
    chosen = dim.select(key, *columns)
    return fact.join(chosen, key, "left") if grouped else _join_facts(fact, chosen, key, "left")


def summarise_per_entity(
    dim: DataFrame,
    fact: DataFrame,
    key: str,
    aggregates: Mapping[str, Column],
    zero_fill: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Every row of `dim` with aggregates over its facts; `zero_fill` names those that default to 0.

    Facts are aggregated before the join: a hot key shrinks to one row per input
    partition before anything is shuffled.
    """
    per_key = fact.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])
    joined = dim.join(per_key, key, how)
    zero = {n: F.coalesce(F.col(n), F.lit(0).cast(per_key.schema[n].dataType)) for n in zero_fill}
    return joined.withColumns(zero) if zero else joined


def label_missing(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Replace NULL in the given columns by a label."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(label)) for c, label in labels.items()})


def unique_on(df: DataFrame, key: str) -> DataFrame:
    """`df` with a check, made while the query runs, that `key` never repeats.

    Rows are numbered per key and the second one raises, so nothing is aggregated or buffered and rows
    pass through as they are. The numbering needs rows partitioned and sorted by the key: a grouped
    frame is partitioned so already, and the join that follows takes over both.
    """
    nth = free_name(df.columns, "nth_row")
    message = F.concat(F.lit(f"{key} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
    numbered = df.withColumn(nth, F.row_number().over(Window.partitionBy(key).orderBy(key)))
    return numbered.filter(F.when(F.col(nth) == 1, True).otherwise(F.raise_error(message).cast("boolean"))).drop(nth)


def join_many_to_one(left: DataFrame, right: DataFrame, key: str, how: str = "left", grouped: bool = False) -> DataFrame:
    """Join on `key`, failing if `right` could multiply rows of `left`; `grouped` as in `lookup`."""
    checked = unique_on(right, key)
    return left.join(checked, key, how) if grouped else _join_facts(left, checked, key, how)


def join_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on `key`, failing if either side repeats it."""
    return unique_on(left, key).join(unique_on(right, key), key, "inner")
