"""Every rule and every test must pass on good data and fail on a defect made for it."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from shop import CUSTOMERS, PRESET, PRICES, PRODUCTS, SALES, raw_shop

from tallyhouse.operators.expectations import ExpectationFailed, Rule, abort_on_violation, check, enforce
from tallyhouse.operators.quality import QualityFailed, assert_quality, quality_suite, unique
from tallyhouse.plans import silver, suite
from tallyhouse.plans.model import ALL_TABLES, RetailModel


@pytest.fixture(scope="module")
def shop(spark):
    return RetailModel(raw_shop(spark), PRESET, ALL_TABLES)


def report(model):
    return {(r.table_name, r.rule): r.violations for r in suite.expectation_report(model.silver).collect()}


def test_good_data_breaks_no_failure_rule(shop):
    got = suite.expectation_report(shop.silver)
    assert got.count() == 18
    assert {r.severity for r in got.collect()} == {"warn", "fail"}
    assert got.filter("severity = 'fail' AND violations > 0").count() == 0
    assert {r.rule: r.violations for r in got.filter("severity = 'warn'").collect()} == {
        "product_registered": 2, "sold_after_created": 1, "price_plausible": 1,
    }


SALE = ("sx", dt.datetime(2025, 12, 14), "c1", "p1", "ecommerce", 1, "1.00")


def _sale(**changes):
    names = ["sale_id", "sold_at", "customer_id", "product_id", "channel", "quantity", "unit_price"]
    return tuple(changes.get(n, v) for n, v in zip(names, SALE))


@pytest.mark.parametrize(
    "rule, change",
    [
        ("sale_id_present", {"sale_id": None}),
        ("sold_at_present", {"sold_at": None}),
        ("customer_id_present", {"customer_id": None}),
        ("product_id_present", {"product_id": None}),
        ("quantity_present", {"quantity": None}),
        ("unit_price_present", {"unit_price": None}),
        ("quantity_positive", {"quantity": 0}),
        ("unit_price_positive", {"unit_price": "0.00"}),
        ("channel_known", {"channel": "fax"}),
    ],
)
def test_sales_failure_rules(spark, rule, change):
    model = RetailModel(raw_shop(spark, sales=[*SALES, _sale(**change)]), PRESET)
    violations = {r.rule: r.violations for r in check(model.sales, silver.RULES["sales"], "sales").collect()}
    assert violations[rule] == 1
    with pytest.raises(ExpectationFailed, match=rule):
        enforce(model.sales, silver.RULES["sales"], "sales")


@pytest.mark.parametrize(
    "table, rule, raw",
    [
        ("customers", "customer_id_present", {"customers": [*CUSTOMERS, (None, "A", "SP", "Brasil", None)]}),
        ("customers", "region_present", {"customers": [*CUSTOMERS, ("c9", "A", "XX", "Brasil", None)]}),
        ("products", "product_id_present", {"products": [*PRODUCTS, (None, "A", "T", "B", "1.00", None)]}),
        ("products", "current_price_positive", {"products": [*PRODUCTS, ("p9", "A", "T", "B", "0.00", None)]}),
        ("products", "current_price_positive", {"products": [*PRODUCTS, ("p9", "A", "T", "B", None, None)]}),
        ("competitor_prices", "product_id_present", {"prices": [*PRICES, (None, "A", "1.00", "2025-12-01 10:00:00")]}),
        ("competitor_prices", "competitor_price_positive", {"prices": [*PRICES, ("p3", "A", "-1", "2025-12-01 10:00:00")]}),
    ],
)
def test_other_failure_rules(spark, table, rule, raw):
    frame = RetailModel(raw_shop(spark, **raw), PRESET).silver[table]
    violations = {r.rule: r.violations for r in check(frame, silver.RULES[table], table).collect()}
    assert violations[rule] == 1


def test_abort_while_writing(spark):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None)], "k int, n int")
    rules = [Rule("n_positive", "n > 0"), Rule("k_small", "k < 2", "warn")]
    with pytest.raises(PySparkException, match="t breaks n_positive"):
        abort_on_violation(df, rules, "t").collect()
    assert abort_on_violation(df.filter("n > 0"), rules, "t").count() == 1
    assert enforce(df.filter("n > 0"), rules, "t").count() == 1


def test_good_data_passes_the_suite(shop):
    results = suite.retail_quality(shop.silver, shop.marts, PRESET)
    assert [r.test for r in results.filter("status <> 'OK'").collect()] == []
    assert results.count() == 22
    assert_quality(results)


def _null(df, column, where):
    return df.withColumn(column, F.when(F.expr(where), None).otherwise(F.col(column)))


def _set(df, column, where, value):
    return df.withColumn(column, F.when(F.expr(where), F.lit(value)).otherwise(F.col(column)).cast(df.schema[column].dataType))


def _twice(df):
    return df.unionByName(df.limit(1))


DEFECTS = {
    "products_key_unique": ("products", _twice),
    "customers_key_unique": ("customers", _twice),
    "competitor_prices_key_unique": ("competitor_prices", lambda d: _null(d, "competitor", "product_id = 'px'")),
    "sales_key_unique": ("sales", lambda d: _set(d, "sale_id", "sale_id = 's2'", "s1")),
    "sales_revenue_is_quantity_x_price": ("sales", lambda d: _set(d, "unit_price", "sale_id = 's2'", D("1.00"))),
    "sales_unregistered_below_share": ("sales", lambda d: _set(d, "is_registered", "sale_id <> 's1'", False)),
    "segments_revenue_equals_sales": ("customer_segments", lambda d: _set(d, "revenue", "customer_id = 'c3'", D("1.00"))),
    "segments_key_unique": ("customer_segments", _twice),
    "segments_segment_valid": ("customer_segments", lambda d: _null(d, "segment", "customer_id = 'c3'")),
    "segments_vip_reach_limit": ("customer_segments", lambda d: _set(d, "segment", "customer_id = 'c3'", "VIP")),
    "segments_top_tier_within_limits": ("customer_segments", lambda d: _set(d, "segment", "customer_id = 'c1'", "TOP_TIER")),
    "segments_regular_below_limit": ("customer_segments", lambda d: _set(d, "segment", "customer_id = 'c1'", "REGULAR")),
    "time_revenue_equals_sales": ("sales_time", lambda d: d.filter("sale_hour <> 9")),
    "time_grain_unique": ("sales_time", _twice),
    "product_revenue_equals_sales": ("product_sales", lambda d: d.filter("product_id <> 'ghost'")),
    "product_sales_key_unique": ("product_sales", _twice),
    "detail_revenue_equals_sales": ("sales_detail", lambda d: d.filter("sale_id <> 's1'")),
    "detail_rows_equal_sales": ("sales_detail", _twice),
    "detail_key_unique": ("sales_detail", _twice),
    "detail_has_segment_and_region": ("sales_detail", lambda d: _null(d, "region", "sale_id = 's1'")),
    "price_position_key_unique": ("price_position", _twice),
    "mart_columns_documented": ("price_position", lambda d: d.withColumn("surprise", F.lit(1))),
}


def test_there_is_a_defect_for_every_test(shop):
    assert list(DEFECTS) == [t.name for t in suite.retail_tests(PRESET)]


@pytest.mark.parametrize("test", DEFECTS)
def test_defects_are_found(shop, test):
    table, spoil = DEFECTS[test]
    silver_tables, marts = dict(shop.silver), dict(shop.marts)
    target = silver_tables if table in silver_tables else marts
    target[table] = spoil(target[table])
    results = suite.retail_quality(silver_tables, marts, PRESET)
    found = {r.test: r.problem_rows for r in results.filter("status = 'FALHOU'").collect()}
    assert found.get(test, 0) > 0


@pytest.mark.parametrize("test", ["segments_key_unique", "detail_has_segment_and_region", "mart_columns_documented"])
def test_a_failed_test_stops_the_query(shop, test):
    table, spoil = DEFECTS[test]
    marts = {**shop.marts, table: spoil(shop.marts[table])}
    with pytest.raises(PySparkException, match=rf"quality tests failed: .*{test} \([1-9]"):
        suite.retail_quality(shop.silver, marts, PRESET, stop=True).collect()


def test_a_passed_suite_returns_its_rows(shop):
    rows = suite.retail_quality(shop.silver, shop.marts, PRESET, stop=True).collect()
    assert len(rows) == 22 and {r.status for r in rows} == {"OK"}


def test_failed_tests_are_named(spark):
    results = spark.createDataFrame([("a", 0, "OK"), ("b", 2, "FALHOU"), ("c", 1, "FALHOU")], "test string, problem_rows bigint, status string")
    with pytest.raises(QualityFailed, match="quality tests failed: b, c"):
        assert_quality(results)


def test_keys_with_null_parts_are_problems(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 1)], "a int, b int")
    assert quality_suite({"t": df}, [unique("u", "t", ["a", "b"])]).first().problem_rows == 2


def test_empty_tables_fail_reconciliation_but_not_keys(shop):
    silver_tables = {n: d.limit(0) for n, d in shop.silver.items()}
    marts = {n: d.limit(0) for n, d in shop.marts.items()}
    got = {r.test: r.problem_rows for r in suite.retail_quality(silver_tables, marts, PRESET).collect()}
    assert got["segments_revenue_equals_sales"] == 1 and got["detail_revenue_equals_sales"] == 1
    assert got["sales_key_unique"] == 0 and got["sales_unregistered_below_share"] == 0


def test_reconciliation_table(shop):
    got = {r.table_name: (r.revenue, r.agrees) for r in suite.revenue_reconciliation(shop.silver, shop.marts).collect()}
    assert got == {
        t: (D("165.99"), True) for t in ("sales", "customer_segments", "sales_time", "product_sales", "sales_detail")
    }


def test_suite_reads_each_table_once(shop):
    from explain import optimized

    tables = {**shop.silver, **shop.marts}
    text = optimized(suite.retail_quality(shop.silver, shop.marts, PRESET))
    assert text.count("Relation ") == len(tables)
