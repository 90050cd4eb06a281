"""What is written and moved grows no faster than the rows."""

import datetime as dt
import os
import time

import pytest
from explain import SMALL, plan
from pyspark.sql import functions as F
from shop import PRESET, raw_shop

from tallyhouse.operators.joins import lookup
from tallyhouse.plans import silver, tables
from tallyhouse.plans.model import RetailModel
from tallyhouse.plans.refresh import dated, refresh
from tallyhouse.session import stage, stage_path
from tallyhouse.sources import tables as written_tables


def staged(spark, name):
    folder = stage_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    return [f for f in os.listdir(folder) if f.startswith(f"{name}-")] if os.path.exists(folder) else []


def test_sales_are_staged_in_the_columns_of_the_source(spark):
    model = RetailModel.from_folder(spark, SMALL, staged=["sales"])
    before = set(staged(spark, "sales"))
    model.sales_detail.count()
    (new,) = set(staged(spark, "sales")) - before
    kept = spark.read.parquet(f"{stage_path(spark, 'x').rsplit('/', 1)[0]}/{new}")
    assert kept.columns == silver.SALE_SOURCE


def test_the_detail_is_moved_without_what_can_be_derived(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(RetailModel(raw_shop(spark), PRESET).sales_detail)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = text.index("Join")
    assert "dayofweek" in text[:joins] and "dayofweek" not in text[joins:]


def test_a_refresh_writes_the_detail_once(spark, tmp_path):
    before = staged(spark, "sales_detail")
    refresh(raw_shop(spark), str(tmp_path / "run"), PRESET)
    assert staged(spark, "sales_detail") == before


def test_ranges_keep_all_rows(spark, monkeypatch):
    monkeypatch.setattr(written_tables, "RANGE_ROWS", 100)
    day = F.when(F.col("id") % 2 == 0, F.lit(dt.date(2026, 1, 1))).when(F.col("id") % 7 == 0, None)
    rows = spark.range(3000).select("id", day.otherwise(F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") % 50).cast("int"))).alias("day"))
    for sized_by in (None, rows, rows.where("day is not null")):  # sizes may miss a value
        ranged = written_tables.in_ranges(rows, "day", ["id"], sized_by)
        assert ranged.exceptAll(rows).count() == rows.exceptAll(ranged).count() == 0
    per_task = written_tables.in_ranges(rows, "day", ["id"]).groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.count("*")).first()
    assert per_task[0] < 200 and per_task[1] == 30
    assert written_tables.in_ranges(rows.limit(0), "day", ["id"]).count() == 0


def test_buckets_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(written_tables, "BUCKET_ROWS", 100)
    assert [written_tables.bucket_count(spark.range(n), 8) for n in (0, 700, 1001)] == [8, 8, 11]


def test_the_written_detail_equals_the_model(spark, tmp_path):
    raw = raw_shop(spark)
    model, run = RetailModel(raw, PRESET, staged=["sales"]), refresh(raw, str(tmp_path / "run"), PRESET)
    assert run.marts["sales_detail"].columns == tables.SALES_DETAIL.column_names
    assert run.marts["sales_detail"].exceptAll(model.sales_detail).count() == 0 and run.marts["sales_detail"].count() == 6


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return set(manager.getAllFiles().mkString("|").split("|")) - {""}


def test_a_stage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    for name in ("moved", "next"):  # what the first one moved is gone when the second one is written
        stage(spark.range(100_000).selectExpr("id", "sha(cast(id AS string)) AS t").repartition(4, "t"), name)
        seen = {f for f in shuffle_files(spark) - before if "shuffle_" in f} if name == "moved" else seen
    until = time.time() + 20
    while time.time() < until and (left := seen & shuffle_files(spark)):
        time.sleep(0.2)
    assert not left


@pytest.mark.parametrize("range_rows", [100, 1_000_000])
def test_lookups_in_ranges_find_what_a_join_finds(spark, monkeypatch, no_broadcast, range_rows):
    monkeypatch.setattr(written_tables, "RANGE_ROWS", range_rows)
    # a hot key, keys that the table lacks, no key, a day that is in no size
    rows = spark.range(3000).selectExpr(
        "id", "date_add(DATE '2026-01-01', cast(id % 50 AS int)) AS day",
        "if(id % 11 = 0, null, if(id % 3 = 0, 'hot', concat('k', id % 400))) AS k", "concat('p', id % 7) AS p",
    )
    one = spark.range(300).selectExpr("if(id = 0, 'hot', if(id = 1, null, concat('k', id))) AS k", "if(id % 5 = 0, null, id) AS a")
    two = spark.range(5).selectExpr("concat('p', id) AS p", "id AS b")

    def both(rows, look):
        return look(look(rows, one, "k", ["a"]), two, "p", ["b"])

    ranged = written_tables.in_ranges(rows, "day", ["id"], rows.where("id % 50 <> 3"), both)
    expected = both(rows, lookup)
    ranged = ranged.select(expected.columns)
    assert ranged.exceptAll(expected).count() == expected.exceptAll(ranged).count() == 0 and ranged.count() == 3000
    spans = ranged.groupBy(F.spark_partition_id()).agg(F.min("day").alias("first"), F.max("day").alias("last")).where("last > DATE '2026-01-04'")
    found = spans.orderBy("first", "last").collect()
    assert all(a.last <= b.first for a, b in zip(found[1:], found[2:]))


def test_lookups_in_ranges_move_rows_once(spark, no_broadcast):
    model = RetailModel.from_folder(spark, SMALL, staged=["sales"])
    ranged = written_tables.in_ranges(dated(model.source_sales), "sale_date", ["sale_id"], model.sales, model.labelled_sales)
    text = plan(ranged)
    assert text.count("shufflepartitionidpassthrough") == 3  # the rows, and what two lookups found
    assert "Exchange" not in text[: text.index("Exchange shufflepartitionidpassthrough")], text


def test_the_written_detail_of_a_folder_equals_the_model(spark, tmp_path, no_broadcast):
    model = RetailModel.from_folder(spark, SMALL, staged=["sales"])
    written = written_tables.materialize(
        dated(model.source_sales), tables.SALES_DETAIL, str(tmp_path / "detail"), cluster_by="sale_date",
        sized_by=model.sales, look_up=model.labelled_sales, finish=silver.derive_sale_columns,
    )
    assert written.exceptAll(model.sales_detail).count() == model.sales_detail.exceptAll(written).count() == 0
    assert written.count() > 5000


def test_a_lookup_moves_one_bit_beside_the_key(spark, no_broadcast):
    facts = spark.range(100).selectExpr("concat('k', id % 10) AS k", "id")
    text = plan(lookup(facts, spark.range(10).selectExpr("concat('k', id) AS k", "id AS x"), "k", ["x"]))
    assert "key_hash" in text and all("(hash(" in line and " & 1)" in line for line in text.splitlines() if "AS key_hash" in line), text
