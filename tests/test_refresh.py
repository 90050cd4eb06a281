import datetime as dt
import os
from dataclasses import replace
from decimal import Decimal as D

import pytest
from explain import plan
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from shop import CUSTOMERS, PRESET, raw_shop

from tallyhouse.operators.contracts import catalog_columns, is_documented
from tallyhouse.operators.quality import QualityFailed
from tallyhouse.plans import naming, suite, tables
from tallyhouse.plans.model import RetailModel
from tallyhouse.plans.refresh import refresh, refresh_and_verify
from tallyhouse.sources.tables import (
    HotBucket,
    materialize,
    publish,
    read_catalog,
    read_folder,
    register_views,
    renamed,
    save_bucketed,
)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    return refresh_and_verify(raw_shop(spark), str(tmp_path_factory.mktemp("run")), PRESET)


def test_refresh_writes_what_the_model_computes(spark, run):
    model = RetailModel(raw_shop(spark), PRESET)
    written = read_folder(spark, run.folder, [c.name for c in (*tables.SILVER, *tables.MARTS)])
    for name, frame in {**model.silver, **model.marts}.items():
        assert written[name].columns == frame.columns
        assert written[name].exceptAll(frame).count() == frame.exceptAll(written[name]).count() == 0
    assert run.quality.filter("status = 'OK'").count() == 22
    assert run.expectations.filter("severity = 'fail' AND violations > 0").count() == 0


def test_published_tables_carry_their_comments(spark, run):
    run.publish(spark, "shop_silver", "shop_marts")
    marts = read_catalog(spark, "shop_marts", [c.name for c in tables.MARTS])
    assert marts["sales_detail"].count() == 6
    assert undocumented(spark, "shop_marts") == undocumented(spark, "shop_silver") == []
    audit = {r.table_name: tuple(r)[1:] for r in suite.documentation_audit(spark, "shop_marts").collect()}
    assert audit["sales_detail"] == (6, 22, 22, 0) and audit["customer_segments"] == (4, 12, 12, 0) and len(audit) == 5
    passed = suite.published_quality(spark, "shop_silver", "shop_marts", PRESET, stop=True).collect()
    assert len(passed) == 22 and {r.status for r in passed} == {"OK"}


def undocumented(spark, database):
    rows = catalog_columns(spark, database).filter(~is_documented()).collect()
    return [(r.table_name, r.column_name) for r in rows]


def test_a_missing_comment_is_found_in_the_catalog(spark, run):
    run.publish(spark, "bare_silver", "bare_marts")
    contract = next(c for c in tables.MARTS if c.name == "sales_time")
    bare = replace(contract, columns=tuple(replace(c, comment=" ") if c.name == "revenue" else c for c in contract.columns))
    publish(spark, bare, run.path(contract), "bare_marts")
    spark.sql("CREATE OR REPLACE VIEW bare_marts.extra AS SELECT 1 AS n")
    spark.sql("CREATE OR REPLACE VIEW bare_marts.__internal AS SELECT 1 AS n")
    assert undocumented(spark, "bare_marts") == [("extra", "n"), ("sales_time", "revenue")]
    audit = {r.table_name: tuple(r)[1:] for r in suite.documentation_audit(spark, "bare_marts").collect()}
    assert audit["sales_time"][1:] == (9, 8, 1) and audit["extra"] == (1, 1, 0, 1)
    with pytest.raises(PySparkException, match=r"quality tests failed: mart_columns_documented \(2\)"):
        suite.published_quality(spark, "bare_silver", "bare_marts", PRESET, stop=True).collect()


def test_warnings_are_counted_by_the_writes(run):
    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    assert rows(run.expectations) == rows(suite.expectation_report(run.silver))
    warned = {r.rule: r.violations for r in run.expectations.filter("severity = 'warn'").collect()}
    assert warned == {"product_registered": 2, "sold_after_created": 1, "price_plausible": 1}


def test_bucketed_tables(spark, run, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_buckets")
    saved = save_bucketed(run.marts["sales_detail"], "shop_buckets", "detail", str(tmp_path / "d"), "customer_id", 4)
    assert saved.exceptAll(run.marts["sales_detail"]).count() == 0 and saved.count() == 6
    assert all(c.description for c in spark.catalog.listColumns("shop_buckets.detail"))
    empty = save_bucketed(run.marts["sales_detail"].limit(0), "shop_buckets", "none", str(tmp_path / "n"), "customer_id", 4)
    assert empty.count() == 0
    hot = spark.range(300_000).selectExpr("if(id % 2 = 0, 0, id) AS k")
    with pytest.raises(HotBucket, match="of hot by k holds"):
        save_bucketed(hot, "shop_buckets", "hot", str(tmp_path / "h"), "k", 64)


def test_a_broken_source_stops_the_refresh(spark, tmp_path):
    folder = str(tmp_path / "broken")
    raw = raw_shop(spark, customers=[*CUSTOMERS, ("c9", "A", "XX", "Brasil", dt.date(2025, 1, 1))])
    with pytest.raises(PySparkException, match="customers breaks region_present"):
        refresh(raw, folder, PRESET)
    assert os.path.exists(f"{folder}/products/_SUCCESS")
    assert not os.path.exists(f"{folder}/customers/_SUCCESS")
    assert not os.path.exists(f"{folder}/sales")


def test_a_failed_suite_is_raised_after_everything_is_written(spark, tmp_path):
    with pytest.raises(QualityFailed, match="sales_unregistered_below_share"):
        refresh_and_verify(raw_shop(spark), str(tmp_path / "run"), PRESET.with_limits(unregistered_percent=1))
    assert os.path.exists(f"{tmp_path}/run/price_position/_SUCCESS")


def test_clustered_layout_spreads_a_hot_date_and_lets_filters_skip(spark, tmp_path, small):
    hot = small.sales_detail.withColumn(
        "sale_date", F.when(F.crc32("sale_id") % 3 == 0, F.lit(dt.date(1997, 1, 1))).otherwise(F.col("sale_date"))
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        written = materialize(hot, tables.SALES_DETAIL, str(tmp_path / "detail"), cluster_by="sale_date")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = written.withColumn("file", F.input_file_name()).groupBy("file").agg(
        F.count("*").alias("n"), F.min("sale_date").alias("first"), F.max("sale_date").alias("last")
    )
    files = per_file.orderBy("first", "last").collect()
    assert len(files) == 8 and max(f.n for f in files) < 0.25 * written.count()
    assert all(a.last <= b.first for a, b in zip(files, files[1:]))
    narrow = written.filter(F.col("sale_date") < dt.date(1996, 1, 1)).agg(F.sum("revenue"))
    text = plan(narrow)
    assert "PushedFilters: [IsNotNull(sale_date), LessThan(sale_date,1996-01-01)]" in text
    assert "ReadSchema: struct<sale_date:date,revenue:decimal(10,2)>" in text


PORTUGUESE_RAW = {table: {ours: theirs for theirs, ours in columns.items()} for table, columns in naming.RAW.values()}


def test_a_shop_with_portuguese_tables_and_queries(spark):
    original = {}
    for name, (ours, columns) in naming.RAW.items():
        original[name] = renamed(raw_shop(spark)[ours], {v: k for k, v in columns.items()})
    assert "id_venda" in original["vendas"].columns
    model = RetailModel(naming.from_portuguese(original), PRESET)
    register_views(model.marts, naming.MART_VIEWS)
    got = spark.sql(
        """SELECT segmento_cliente, count(*) AS clientes, sum(receita) AS receita
           FROM clientes_segmentacao WHERE regiao <> 'Norte' GROUP BY segmento_cliente ORDER BY receita DESC"""
    ).collect()
    assert [tuple(r) for r in got] == [("VIP", 1, D("100.00")), ("TOP_TIER", 1, D("50.99")), ("REGULAR", 1, D("15.00"))]
    day = spark.sql("SELECT dia_semana, sum(receita) AS r FROM vendas_temporais GROUP BY 1 ORDER BY r DESC").first()
    assert tuple(day) == ("Domingo", D("100.00"))
    for table, mapping in naming.MART_VIEWS.items():
        contract = next(c for c in tables.MARTS if c.name == table)
        view = spark.table(mapping[""])
        assert not set(view.columns) & set(contract.column_names), table
        assert all(f.metadata["comment"] for f in view.schema.fields)
    register_views(model.silver, naming.SILVER_VIEWS)
    for table, mapping in naming.SILVER_VIEWS.items():
        contract = next(c for c in tables.SILVER if c.name == table)
        assert not set(spark.table(mapping[""]).columns) & set(contract.column_names), table
