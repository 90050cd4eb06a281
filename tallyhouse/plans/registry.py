"""Every question by name, as a function of a session and a folder of sample tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import dedup
from tallyhouse.operators.measures import evaluate
from tallyhouse.plans import datasets, questions, silver, suite, tables
from tallyhouse.plans.model import RetailModel
from tallyhouse.plans.preset import SAMPLE
from tallyhouse.plans.refresh import Refresh, dated, refresh
from tallyhouse.session import configure, exists, stage_path
from tallyhouse.sources import raw as raw_source
from tallyhouse.sources.tables import bucket_count, materialize, save_bucketed

Query = Callable[[SparkSession, str], DataFrame]

PERIOD = (dt.date(1996, 1, 1), dt.date(1998, 12, 31))
ONLINE = ["E-commerce"]


def _on_model(build: Callable[[RetailModel], DataFrame], staged: Iterable[str] = ()) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(RetailModel.from_folder(configure(spark), folder, staged=staged))

    return run


# For questions that read the cleaned sales twice: once themselves, once for the customers' segments.
SALES_TWICE = ("sales",)
SOME_CUSTOMERS = (["VIP", "TOP_TIER"], ["Norte", "Sul"])
SOME_PRICES = (["ECONOMY", "PROMO"], ["Mais caro que todos", "Acima da média"])


def _sales(m: RetailModel, *filters):
    return datasets.sales_dataset(m.sales_detail, *filters)


def _customers(m: RetailModel, *filters):
    return datasets.customer_dataset(m.customer_segments_unranked, *filters)


def _prices(m: RetailModel, *filters):
    return datasets.price_dataset(m.price_position, *filters)


def _filtered_sales(question: Callable, *arguments) -> Query:
    return _on_model(lambda m: question(_sales(m, PERIOD, ONLINE), *arguments))


def _filtered_customers(question: Callable) -> Query:
    return _on_model(lambda m: question(_customers(m, *SOME_CUSTOMERS)))


def _filtered_prices(question: Callable) -> Query:
    return _on_model(lambda m: question(_prices(m, *SOME_PRICES)))


_RUNS: dict[tuple[str, str], Refresh] = {}


def _refreshed(spark: SparkSession, folder: str) -> Refresh:
    """A full refresh of a folder, made once per application for all questions about written tables."""
    key = spark.sparkContext.applicationId, folder
    if key not in _RUNS or not exists(spark, _RUNS[key].folder):
        raw = RetailModel.from_folder(configure(spark), folder).raw
        _RUNS[key] = refresh(raw, stage_path(spark, "refresh"), SAMPLE)
    return _RUNS[key]


@contextmanager
def _databases(spark: SparkSession, *names: str) -> Iterator[list[str]]:
    """New databases; frames that were made of their views can still be read after they are gone."""
    found = [f"{name}_{uuid.uuid4().hex}" for name in names]
    try:
        yield found
    finally:
        for database in found:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _refresh_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Write every table by a full refresh, then compare the revenue of the tables read back."""
    run = _refreshed(spark, folder)
    return suite.revenue_reconciliation(run.silver, run.marts)


def _refresh_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """The ranked customer mart as a full refresh writes it."""
    run = _refreshed(spark, folder)
    return spark.read.parquet(run.path(tables.CUSTOMER_SEGMENTS)).select("customer_id", "segment", "revenue", "revenue_rank")


def _published_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Publish a refresh and audit the marts as the catalog has them."""
    run = _refreshed(spark, folder)
    with _databases(spark, "silver", "marts") as (cleaned, marts):
        run.publish(spark, cleaned, marts)
        return suite.documentation_audit(spark, marts)


def _published_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Publish a refresh and run the suite on the published tables; a failed test is an error of the query."""
    run = _refreshed(spark, folder)
    with _databases(spark, "silver", "marts") as (cleaned, marts):
        run.publish(spark, cleaned, marts)
        return suite.published_quality(spark, cleaned, marts, SAMPLE, stop=True)


#: At least; a larger detail mart has more.
BUCKETS = 8


def _bucketed_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per customer profile from two tables in buckets of the customer, joined where they lie."""
    run = _refreshed(spark, folder)
    with _databases(spark, "buckets") as (database,):
        spark.sql(f"CREATE DATABASE {database}")
        buckets = bucket_count(run.marts["sales_detail"], BUCKETS)
        detail, segments = (
            save_bucketed(run.marts[name], database, name, stage_path(spark, name), "customer_id", buckets)
            for name in ("sales_detail", "customer_segments")
        )
        return questions.sales_by_customer_profile(detail, segments)


def _dedup_sales(m: RetailModel) -> DataFrame:
    return dedup(m.raw["sales"], ["sale_id"], SAMPLE.sale_order).select(
        "sale_id", "sold_at", "customer_id", "product_id", "channel", "quantity", F.col("unit_price").cast("decimal(14,2)")
    )


def _price_bands(m: RetailModel) -> DataFrame:
    return m.products.groupBy("price_band").agg(
        F.count(F.lit(1)).alias("products"),
        F.min("current_price").alias("lowest"),
        F.max("current_price").alias("highest"),
    )


def _customers_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    model = RetailModel.from_folder(configure(spark), folder)
    nations = raw_source.raw_states_by_nation(spark, folder)
    rows = silver.clean_customers_by_nation(model.raw["customers"], nations)
    return rows.select("customer_id", "customer_name", "nation_name", "region")


def _clustered_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Write the detail mart in date order, then answer a period question from the written files."""
    model = RetailModel.from_folder(configure(spark), folder, staged=SALES_TWICE)
    path = stage_path(spark, "sales_detail")
    written = materialize(
        dated(model.source_sales), tables.SALES_DETAIL, path, cluster_by="sale_date",
        sized_by=model.sales, look_up=model.labelled_sales, finish=silver.derive_sale_columns,
    )
    return written.filter(F.col("sale_date").between(*PERIOD)).groupBy("channel").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("revenue").cast("decimal(28,2)").alias("revenue")
    )


QUERIES: dict[str, Query] = {
    # Cleaned tables
    "dedup_sales": _on_model(_dedup_sales),
    "price_band": _on_model(_price_bands),
    "silver_products": _on_model(lambda m: m.products),
    "silver_customers": _on_model(lambda m: m.customers),
    "customers_by_nation": _customers_by_nation,
    "silver_sales": _on_model(lambda m: m.sales),
    "silver_competitor_prices": _on_model(lambda m: m.competitor_prices),
    "expectation_report": _on_model(lambda m: suite.expectation_report(m.silver)),
    # Marts
    "gold_customer_segments": _on_model(lambda m: m.customer_segments),
    "gold_sales_time": _on_model(lambda m: m.sales_time),
    "gold_product_sales": _on_model(lambda m: m.product_sales),
    "gold_sales_detail": _on_model(lambda m: m.sales_detail, SALES_TWICE),
    "gold_price_position": _on_model(lambda m: m.price_position),
    "rank_customers_by_revenue": _on_model(
        lambda m: m.customer_segments.select("customer_id", "revenue", "revenue_rank")
    ),
    "rank_products_in_category": _on_model(lambda m: questions.product_ranking_list(m.product_sales)),
    "clustered_sales_detail": _clustered_detail,
    # Quality
    "quality_suite": _on_model(lambda m: suite.retail_quality(m.silver, m.unranked_marts, m.preset), SALES_TWICE),
    "revenue_reconciliation": _on_model(lambda m: suite.revenue_reconciliation(m.silver, m.unranked_marts), SALES_TWICE),
    "column_comment_audit": _published_audit,
    "published_quality": _published_quality,
    "raw_coverage": _on_model(lambda m: suite.raw_coverage(m.silver)),
    "refresh_reconciliation": _refresh_reconciliation,
    "refresh_ranks": _refresh_ranks,
    "refresh_expectations": lambda spark, folder: _refreshed(spark, folder).expectations,
    "bucketed_customer_profiles": _bucketed_profiles,
    # Datasets
    "sales_dataset": _on_model(lambda m: datasets.sales_rows(m.sales_detail), SALES_TWICE),
    "customer_dataset": _on_model(lambda m: datasets.customer_rows(m.customer_segments)),
    "price_dataset": _on_model(lambda m: datasets.price_rows(m.price_position)),
    # Sales questions
    "commercial_kpis": _on_model(lambda m: questions.commercial_kpis(_sales(m))),
    "filtered_commercial_kpis": _filtered_sales(questions.commercial_kpis),
    "filtered_daily_revenue": _filtered_sales(questions.daily_revenue_by_channel),
    "filtered_weekday_revenue": _filtered_sales(questions.weekday_revenue),
    "filtered_hour_revenue": _filtered_sales(questions.hour_revenue),
    "filtered_category_revenue": _filtered_sales(questions.category_revenue),
    "filtered_region_category": _filtered_sales(questions.region_category_revenue),
    "filtered_best_sellers": _filtered_sales(questions.best_sellers, "state", SAMPLE.ranking_size),
    "daily_revenue_by_channel": _on_model(lambda m: questions.daily_revenue_by_channel(_sales(m))),
    "channel_revenue": _on_model(lambda m: questions.channel_revenue(_sales(m))),
    "filtered_channel_revenue": _on_model(
        lambda m: questions.channel_revenue(_sales(m, PERIOD, ["E-commerce", "Loja física"]))
    ),
    "weekday_mean_revenue": _on_model(lambda m: questions.weekday_revenue(_sales(m))),
    "best_weekday": _on_model(lambda m: questions.best_weekday(_sales(m))),
    "hour_revenue": _on_model(lambda m: questions.hour_revenue(_sales(m))),
    "category_revenue": _on_model(lambda m: questions.category_revenue(_sales(m))),
    "top_products_filtered": _on_model(
        lambda m: questions.top_products(m.sales, m.products_of, SAMPLE.ranking_size, PERIOD, ONLINE)
    ),
    "top_products_all": _on_model(lambda m: questions.top_products(m.sales, m.products_of, SAMPLE.ranking_size)),
    "sql_parameters": lambda spark, folder: questions.channel_sales_sql(
        spark, RetailModel.from_folder(configure(spark), folder).sales_detail, *PERIOD, ["loja_fisica"]
    ),
    "ticket_by_channel": _on_model(lambda m: questions.ticket_by_channel(datasets.time_dataset(m.sales_time))),
    "region_category_revenue": _on_model(lambda m: questions.region_category_revenue(_sales(m))),
    "best_sellers_by_dimension": _on_model(lambda m: questions.best_sellers(_sales(m), "region", SAMPLE.ranking_size)),
    "best_sellers_by_state": _on_model(lambda m: questions.best_sellers(_sales(m), "state", SAMPLE.ranking_size)),
    "best_sellers_by_segment": _on_model(
        lambda m: questions.best_sellers(_sales(m), "segment", SAMPLE.ranking_size), SALES_TWICE
    ),
    "best_sellers_by_category": _on_model(lambda m: questions.best_sellers(_sales(m), "category", SAMPLE.ranking_size)),
    "best_sellers_by_channel": _on_model(lambda m: questions.best_sellers(_sales(m), "channel", SAMPLE.ranking_size)),
    "distinct_products_by_category": _on_model(
        lambda m: questions.distinct_products_by_category(m.product_sales_unranked)
    ),
    "measure_sales": _on_model(
        lambda m: evaluate(
            _sales(m), ["channel", "weekday"], ["revenue", "sales", "avg_ticket", "items_sold", "revenue_per_day"]
        )
    ),
    # Customer questions
    "customer_kpis": _on_model(lambda m: questions.customer_kpis(_customers(m))),
    "filtered_customer_kpis": _filtered_customers(questions.customer_kpis),
    "filtered_segment_summary": _filtered_customers(questions.segment_summary),
    "filtered_region_segment": _filtered_customers(questions.region_segment_revenue),
    "filtered_customer_list": _on_model(lambda m: questions.customer_ranking_list(m.customer_segments, *SOME_CUSTOMERS)),
    "segment_summary": _on_model(lambda m: questions.segment_summary(_customers(m))),
    "region_segment_revenue": _on_model(lambda m: questions.region_segment_revenue(_customers(m))),
    "customer_ranking_list": _on_model(lambda m: questions.customer_ranking_list(m.customer_segments)),
    "avg_ticket_by_segment": _on_model(lambda m: questions.ticket_by_segment(_customers(m))),
    "top_tier_share": _on_model(lambda m: questions.top_tier_share(m.customer_segments_unranked)),
    "customers_region_segment": _on_model(lambda m: questions.customers_by_region_segment(_customers(m))),
    "near_vip_customers": _on_model(lambda m: questions.near_vip_customers(m.customer_segments_unranked, m.preset)),
    "sales_by_customer_profile": _on_model(
        lambda m: questions.sales_by_customer_profile(m.sales_detail, m.customer_segments_unranked), SALES_TWICE
    ),
    "measure_customers": _on_model(
        lambda m: evaluate(
            _customers(m), ["region"], ["customers", "vip_customers", "vip_revenue_share", "avg_ticket", "revenue"]
        )
    ),
    # Price questions
    "price_kpis": _on_model(lambda m: questions.price_kpis(_prices(m))),
    "filtered_price_kpis": _filtered_prices(questions.price_kpis),
    "filtered_price_classes": _filtered_prices(questions.products_by_price_class),
    "filtered_price_gap": _filtered_prices(questions.price_gap_by_category),
    "filtered_price_actions": _filtered_prices(questions.price_action_list),
    "products_by_price_class": _on_model(lambda m: questions.products_by_price_class(_prices(m))),
    "price_gap_by_category": _on_model(lambda m: questions.price_gap_by_category(_prices(m))),
    "price_action_list": _on_model(lambda m: questions.price_action_list(_prices(m))),
    "dearest_products_top": _on_model(lambda m: questions.price_action_list(_prices(m), SAMPLE.ranking_size)),
    "above_market_counts": _on_model(lambda m: questions.above_market_counts(m.price_position)),
    "categories_above_market": _on_model(lambda m: questions.categories_above_market(m.price_position)),
    "product_sales_with_price_position": _on_model(
        lambda m: questions.product_sales_with_price_position(m.product_sales_unranked, m.price_position)
    ),
    "measure_prices": _on_model(
        lambda m: evaluate(
            _prices(m),
            ["price_class_label"],
            ["products", "confirmed_dearest", "confirmed_dearest_revenue", "suspect_products", "avg_diff_vs_market", "revenue"],
        )
    ),
}
