"""Exact rankings without pulling a group, or the whole table, into one task.

`row_number() over (order by ...)` sends every row to a single task, and per
group it sends the largest group there. Instead the rows are sorted globally
over all tasks (range partitioning on the measure and the unique key, so ties
never gather in one partition) and written once with their place in the sorted
order. The rank is that place shifted by the number of rows in earlier
partitions. The order inside a group is the same order, so a rank within a group
follows from the same written table: rows of the group in earlier partitions
plus the row number inside one partition, which no group can make larger than
the partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.helpers import free_name
from tallyhouse.session import stage

_ROW_BITS = 33  # monotonically_increasing_id: partition number << 33 | row in the partition


def _rows_before(placed: DataFrame, part: str, group: Sequence[str]) -> DataFrame:
    """Per partition (and group): how many rows (of the group) lie in earlier partitions.

    Columns: of_part, of_0 (the group), rows_before.
    """
    parts = placed.groupBy(F.col(part).alias("of_part"), *[F.col(g).alias(f"of_{i}") for i, g in enumerate(group)])
    counted = parts.agg(F.count(F.lit(1)).alias("rows"))
    names = [f"of_{i}" for i in range(len(group))]
    earlier = Window.partitionBy(*names).orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("of_part", *names, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"))


def add_ranks(
    df: DataFrame, measure: str, key: str, out: str | None, group_outs: Mapping[str, str] | None = None
) -> DataFrame:
    """Add ranks 1, 2, ... by `measure` descending; equal measures by `key`, which must be unique.

    `out` names the rank over all rows, `group_outs` maps the name of a further
    rank to the column within whose values it counts (NULL is a value of its own).
    """
    columns = list(df.columns)
    names = [*columns, *(group_outs or {}), *([out] if out else [])]
    place, part, inside = (free_name(names, name) for name in ("sorted_place", "sorted_part", "place_in_part"))
    in_order = df.orderBy(F.col(measure).desc(), key)
    placed = stage(in_order.withColumn(place, F.monotonically_increasing_id()), f"ranked-by-{measure}")
    placed = placed.withColumn(part, F.shiftright(place, _ROW_BITS))
    ranked = placed

    def with_rank(rows: DataFrame, group: Sequence[str], row: Column, name: str) -> DataFrame:
        """`row` counts inside a partition; the rank is that many rows after those of earlier partitions."""
        before = _rows_before(placed, part, group).alias("before")
        same = F.col(f"rows.{part}") == F.col("before.of_part")
        for i, g in enumerate(group):
            same = same & F.col(f"rows.{g}").eqNullSafe(F.col(f"before.of_{i}"))
        joined = rows.withColumn(inside, row).alias("rows").join(before, same, "left")
        rank = (F.col("before.rows_before") + F.col(f"rows.{inside}")).cast("long").alias(name)
        return joined.select(*[F.col(f"rows.{c}") for c in (*columns, place, part)], rank)

    if out:
        # One row per written partition: the size is set by the shuffle, not by the data.
        ranked = with_rank(ranked, [], F.col(place) - F.shiftleft(part, _ROW_BITS) + 1, out)
        columns.append(out)
    for name, group in (group_outs or {}).items():
        ranked = with_rank(ranked, [group], F.row_number().over(Window.partitionBy(part, group).orderBy(place)), name)
        columns.append(name)
    return ranked.select(*columns)


def global_rank(df: DataFrame, measure: str, key: str, out: str) -> DataFrame:
    return add_ranks(df, measure, key, out)


def group_rank(df: DataFrame, group: str, measure: str, key: str, out: str) -> DataFrame:
    return add_ranks(df, measure, key, None, {out: group})


def top_k(df: DataFrame, order: Sequence[Column | str], k: int, out: str | None = None) -> DataFrame:
    """The first `k` rows in `order`, with their position in `out` if it is named.

    The limit comes first, so only k rows per task leave the tasks and only the
    k survivors are numbered.
    """
    best = df.orderBy(*order).limit(k)
    if out is None:
        return best
    return best.withColumn(out, F.row_number().over(Window.orderBy(*order)))
