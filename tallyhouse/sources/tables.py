"""Tables in folders and catalogs, and their translation between namings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.operators.contracts import TableContract, conform
from tallyhouse.operators.expectations import Rule, RuleCounts, abort_on_violation
from tallyhouse.operators.helpers import free_name
from tallyhouse.session import free_shuffles, stage


#: A bucket this many times the mean, and larger than `SMALL_BUCKET` rows, is a hot one.
HOT_BUCKET = 4
SMALL_BUCKET = 100_000
#: Rows of a range of a clustered table and of a bucket, of which there are as many as the table needs.
RANGE_ROWS = 500_000
BUCKET_ROWS = 500_000


class HotBucket(ValueError):
    pass


def read_folder(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def read_catalog(spark: SparkSession, database: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in names}


#: Adds columns of a table that is unique on a key to rows: (rows, table, key, columns), as `joins.lookup` does.
Look = Callable[[DataFrame, DataFrame, str, Sequence[str]], DataFrame]


def in_ranges(
    df: DataFrame,
    column: str,
    grain: Sequence[str],
    sized_by: DataFrame | None = None,
    look_up: Callable[[DataFrame, Look], DataFrame] | None = None,
) -> DataFrame:
    """`df` in equal ranges of `column`, one per task, sorted; a hot value is spread over several by the hash of its grain.

    Ranges are cut by the exact row counts of the column's values in `sized_by` (default: `df`), a frame with the same
    rows that is cheaper to read. So nothing is sampled, and `df` need not be written first.

    `look_up` adds columns of other tables, by a lookup that it is given, to rows that lie in their range already: the
    ranges in which a key occurs are sent to the table, and its columns come back to each of them once, however many rows
    of the range have the key. So rows themselves are moved once for the layout and all lookups; `df` is read once more
    for every lookup.
    """
    spark = df.sparkSession
    names = [free_name(df.columns, name) for name in ("of_value", "rows_of", "rows_before", "range_number", "in_ranges")]
    value, rows, before, number, numbers = names
    sizes = (df if sized_by is None else sized_by).groupBy(F.col(column).alias(value)).agg(F.count(F.lit(1)).alias(rows))
    sizes = stage(sizes, f"sizes-by-{column}")
    # the distinct values alone are put in one order
    earlier = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn(before, F.coalesce(F.sum(rows).over(earlier), F.lit(0)))
    total = sizes.agg(F.sum(rows)).first()[0] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_ROWS))
    share = F.pmod(F.xxhash64(*grain), F.lit(1 << 20)) / F.lit(1 << 20)
    place = (F.col(before) + F.col(rows) * share) * count / max(total, 1)
    sized = df.join(sizes, F.col(column).eqNullSafe(F.col(value)), "left")
    numbered = sized.select(*df.columns, F.coalesce(F.floor(place).cast("int"), F.lit(0)).alias(number))

    def look(rows: DataFrame, table: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
        wanted = numbered.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_set(number).alias(numbers))
        found = wanted.join(table.select(key, *columns), key).select(F.explode(numbers).alias(number), key, *columns)
        return rows.join(found.repartitionById(count, number), [number, key], "left")

    ranged = numbered.repartitionById(count, number)
    if look_up is not None:
        ranged = look_up(ranged, look)
    return ranged.sortWithinPartitions(column, *grain).drop(number)


def materialize(
    df: DataFrame,
    contract: TableContract,
    path: str,
    cluster_by: str | None = None,
    rules: Iterable[Rule] = (),
    counts: RuleCounts | None = None,
    sized_by: DataFrame | None = None,
    look_up: Callable[[DataFrame, Look], DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Write a table to `path` as its contract declares it and return the written table.

    Failure rules run inside the write, so a broken source leaves no finished
    table; `counts` takes the violations of all rules from the same pass. `cluster_by` lays rows out in ranges of that column, which lets later
    period filters skip files and row groups; the grain spreads one hot date over several files.
    `sized_by` and `look_up` as in `in_ranges`. `finish` adds columns that follow from a row's others, after rows were moved.
    """
    if cluster_by:
        df = in_ranges(df, cluster_by, contract.grain, sized_by, look_up)
    if finish is not None:
        df = finish(df)
    out = conform(abort_on_violation(df, list(rules), contract.name), contract)
    if counts is not None:
        out = counts.watch(out)
    out = out.to(contract.schema)
    out.write.mode("overwrite").parquet(path)
    free_shuffles(df.sparkSession)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def bucket_count(df: DataFrame, least: int) -> int:
    """How many buckets keep one bucket of `df` at about `BUCKET_ROWS` rows, however large `df` is; at least `least`."""
    return max(least, -(-df.count() // BUCKET_ROWS))


def save_bucketed(df: DataFrame, database: str, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write `df` to `path` in `buckets` sorted buckets of `key`, as the catalog table `database.name`.

    Tables with equal buckets are joined and grouped on the key where they lie, without a shuffle, in
    any later query. A key that alone fills several buckets' worth of rows would make one file and one
    task of it, so such a frame is refused; leave it to the skew join of plain tables.
    """
    per_bucket = df.groupBy(F.expr(f"pmod(hash(`{key}`), {buckets})")).agg(F.count(F.lit(1)).alias("n"))
    most, total = per_bucket.agg(F.max("n"), F.sum("n")).first()
    if most is not None and most > HOT_BUCKET * total / buckets + SMALL_BUCKET:
        raise HotBucket(f"a bucket of {name} by {key} holds {most} of {total} rows")
    spread = df.repartition(buckets, key)
    writer = spread.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet").option("path", path)
    writer.saveAsTable(f"{database}.{name}")
    return df.sparkSession.table(f"{database}.{name}")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(spark: SparkSession, contract: TableContract, path: str, database: str) -> None:
    """Expose a written table in the catalog under its name, with all comments.

    Only metadata changes, so readers switch from the old run to the new one at once.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = ", ".join(f"{c.name} COMMENT {_quoted(c.comment)}" for c in contract.columns)
    names = ", ".join(contract.column_names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {database}.{contract.name} ({columns}) "
        f"COMMENT {_quoted(contract.comment)} AS SELECT {names} FROM parquet.`{path}`"
    )


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """`df` with every column found in `names` renamed; comments stay."""
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def register_views(tables: Mapping[str, DataFrame], names: Mapping[str, Mapping[str, str]] | None = None) -> None:
    """Temporary views for SQL users; `names` maps table -> {"": view name, column: column name}."""
    for table, df in tables.items():
        mapping = (names or {}).get(table, {})
        renamed(df, mapping).createOrReplaceTempView(mapping.get("", table))
