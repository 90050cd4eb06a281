"""Subtotals with a total row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_total(df: DataFrame, key: str, aggregates: Mapping[str, Column], total_label: str) -> DataFrame:
    """One row per value of `key` and one for everything, which is there even if `df` is empty.

    Both come from one aggregation over grouping sets. Grouping sets of no rows give no total, so a
    row of NULLs is put in first; `aggregates` must leave NULLs out, as all but `count(*)` do.
    The total's key is `total_label`, told from a NULL key by `is_total`.
    """
    nothing = df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    rows = df.withColumn("is_filler", F.lit(False)).unionByName(nothing.withColumn("is_filler", F.lit(True)))
    sets = rows.rollup(key).agg(
        *[c.alias(n) for n, c in aggregates.items()],
        F.grouping(key).cast("boolean").alias("is_total"),
        F.bool_and("is_filler").alias("only_filler"),
    )
    label = F.when(F.col("is_total"), F.lit(total_label)).otherwise(F.col(key)).alias(key)
    return sets.filter("is_total OR NOT only_filler").select(label, *aggregates, "is_total")
