"""Deterministic removal of repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.helpers import free_name


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key: the first by `order_by`, by default by all other columns.

    Meant for fact tables. Spark turns `row_number = 1` into a group limit that
    runs before the shuffle, so a key with very many copies leaves one row per
    input partition, and columns nobody asks for are pruned below the shuffle.
    `order_by`, when given, must be a total order within a key.
    """
    order = list(order_by) or [c for c in df.columns if c not in keys]
    first = Window.partitionBy(*keys).orderBy(*(order or keys))
    copy = free_name(df.columns, "copy_number")
    return df.withColumn(copy, F.row_number().over(first)).filter(F.col(copy) == 1).drop(copy)


def dedup_dimension(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Same survivor as `dedup`, written as an aggregate over the key.

    Meant for lookup tables. The optimizer knows that a grouped frame has unique
    keys and drops a left join to it whenever no column of it is used, so a mart
    that needs no product attribute never touches the product table.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    ordered = [*order_by, *(c for c in rest if c not in order_by)]
    row = free_name(df.columns, "first_row")
    survivor = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias(row))
    return survivor.select(*[F.col(c) if c in keys else F.col(row)[c].alias(c) for c in df.columns])
