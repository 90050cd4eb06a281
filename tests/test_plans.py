"""The plans Spark makes of the questions."""

import pytest
from explain import SMALL, optimized, plan

from tallyhouse.operators.dedup import dedup_dimension
from tallyhouse.operators.joins import lookup
from tallyhouse.plans.registry import QUERIES


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_questions_without_lookup_columns_have_no_lookup(spark):
    for name in ("commercial_kpis", "daily_revenue_by_channel", "hour_revenue", "gold_sales_time"):
        text = optimized(QUERIES[name](spark, SMALL))
        # Only the two tables that make up the raw sales; part and customer are gone.
        assert text.count("Join") == 1 and "p_partkey" not in text and "c_custkey" not in text, name


def test_region_questions_do_not_compute_segments(spark):
    text = optimized(QUERIES["best_sellers_by_dimension"](spark, SMALL))
    assert text.count("l_orderkey") > 0 and text.count("Relation [l_orderkey") == 1


def test_marts_aggregate_sales_before_the_join(spark):
    for name in ("near_vip_customers", "price_kpis"):
        text = optimized(QUERIES[name](spark, SMALL))
        assert text.count("Relation [l_orderkey") == 1


def test_unused_columns_are_not_read(spark):
    text = plan(QUERIES["commercial_kpis"](spark, SMALL))
    scan = next(line for line in text.splitlines() if "FileScan parquet [l_orderkey" in line)
    for column in ("l_discount", "l_tax", "l_returnflag", "l_linestatus"):
        assert column not in scan


def test_counts_and_total_share_one_shuffle(spark):
    text = optimized(QUERIES["above_market_counts"](spark, SMALL))
    # counts per status and the total are grouping sets: one aggregation over one reading of the offers
    assert text.count("Expand") == 1 and text.count("p_retailprice") == optimized(
        QUERIES["categories_above_market"](spark, SMALL)
    ).count("p_retailprice")


def test_top_products_clean_only_the_products_they_name(spark):
    text = optimized(QUERIES["top_products_all"](spark, SMALL))
    semi, aggregate = text.index("LeftSemi"), text.index("Aggregate")
    assert aggregate < semi < text.index("p_partkey"), text  # the semi join lies below the dedup
    assert "l_orderkey" not in text  # the ranked rows are read from their stage


def test_a_join_of_bucketed_tables_shuffles_nothing_but_its_result(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["bucketed_customer_profiles"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = text[text.index("SortMergeJoin") :]
    assert "Exchange" not in below and below.count("Bucketed: true") == 2, text


@pytest.fixture
def tiny_partitions(spark):
    """Make a few kilobytes count as a large partition, and no table small enough to broadcast."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_a_hot_key_is_split_in_a_lookup(spark, tiny_partitions):
    fact = spark.range(0, 60000, 1, 8).selectExpr(
        "concat('k', if(id % 3 = 0, 0, id % 500)) AS k", "id AS n", "sha(cast(id AS string)) AS t"
    )
    dim = dedup_dimension(spark.range(500).selectExpr("concat('k', id) AS k", "id AS x"), ["k"])
    joined = lookup(fact, dim, "k", ["x"])
    got = joined.collect()
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in text
    assert len(got) == 60000 and sum(r.n for r in got) == sum(range(60000))
    assert all(r.k == f"k{r.x}" for r in got)
