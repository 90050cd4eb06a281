"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, written


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the links (a, b); ids without links are absent.

    Alternates two local rewrites of the links until nothing changes: every id's larger
    neighbours, then its smaller ones, are attached to its smallest neighbour. Both are
    one grouped minimum and one join, so a hub with very many links is never collected;
    the number of rounds grows with the logarithm of a component's size.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = written(links, "links")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        down = large.join(small, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = written(down.unionByName(small.withColumnRenamed("m", "b")).distinct(), "links")
        same = after.count() == links.count() and after.join(links, ["a", "b"], "left_anti").isEmpty()
        discard(links)
        links = after
        if same:
            return links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
