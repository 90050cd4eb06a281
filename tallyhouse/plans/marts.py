"""Business marts over the cleaned tables.

Facts are always aggregated on the join key before they meet a lookup table;
the keys of the lookup tables are unique, so the result is the same and the
join moves one row per key instead of one per sale.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import bands, calendar, money
from tallyhouse.operators.joins import label_missing, lookup, summarise_per_entity
from tallyhouse.operators.ranking import add_ranks, global_rank
from tallyhouse.plans import preset as fixed
from tallyhouse.plans.preset import RetailPreset
from tallyhouse.plans.silver import PRODUCT_LABELS, SALE_DERIVED, derive_sale_columns, with_product


def customer_segments(customers: DataFrame, sales: DataFrame, preset: RetailPreset) -> DataFrame:
    """Customers with purchase totals and segment, still without rank."""
    revenue = F.col("revenue")
    rows = summarise_per_entity(
        customers.select("customer_id", "customer_name", "state", "state_name", "region"),
        sales,
        "customer_id",
        {
            "total_orders": F.count("sale_id"),
            "revenue": money.total(revenue),
            "avg_ticket": money.mean_money(revenue),
            "first_purchase": F.min("sold_at"),
            "last_purchase": F.max("sold_at"),
        },
        zero_fill=["total_orders", "revenue"],
    )
    return rows.withColumn("segment", bands.band(revenue, preset.segments, preset.lowest_segment, inclusive=True))


def rank_customers(segments: DataFrame) -> DataFrame:
    return global_rank(segments, "revenue", "customer_id", "revenue_rank")


def sales_time(sales: DataFrame) -> DataFrame:
    """Sales per date, hour and channel; the weekday is derived after grouping."""
    rows = sales.groupBy("sale_date", "sale_hour", "channel").agg(
        F.count(F.lit(1)).alias("total_sales"),
        F.sum("quantity").alias("items_sold"),
        money.total(F.col("revenue")).alias("revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    rows = rows.withColumn("weekday_num", calendar.weekday_number(F.col("sale_date")))
    return rows.withColumn("weekday", calendar.weekday_name(F.col("weekday_num"), fixed.WEEKDAYS))


def product_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales per sold product with catalogue labels, still without ranks."""
    revenue = F.col("revenue")
    per_product = sales.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_sales"),
        F.sum("quantity").alias("items_sold"),
        money.total(revenue).alias("revenue"),
        money.mean_money(revenue).alias("avg_ticket"),
    )
    rows = lookup(per_product, products, "product_id", ["created_at", *PRODUCT_LABELS], grouped=True)
    return label_missing(rows.withColumn("is_registered", F.col("created_at").isNotNull()), fixed.UNREGISTERED)


def rank_products(per_product: DataFrame) -> DataFrame:
    """Rank over all products and within the category; unregistered products are one category."""
    return add_ranks(per_product, "revenue", "product_id", "revenue_rank", {"category_rank": "category"})


def sales_detail_rows(sales: DataFrame, products: DataFrame, segments: DataFrame) -> DataFrame:
    """One row per sale with product labels and customer attributes, still without what follows from a row's own columns.

    `sales` are cleaned ones or `unique_sales`.
    """
    return labelled_sales(sales.drop(*SALE_DERIVED), products, segments)


def labelled_sales(
    sales: DataFrame, products: DataFrame, segments: DataFrame, look: Callable[..., DataFrame] = lookup
) -> DataFrame:
    """Sales with customer attributes and product labels, both looked up by `look`.

    Customers come first, because their attributes are narrower than the product labels; rows are moved for
    a lookup before anything that can be derived is added.

    Customer attributes stay NULL for an unknown customer, for the quality suite
    to find. Product labels are looked up only if `sales` does not carry them.
    """
    rows = look(sales, segments, "customer_id", ["customer_name", "state", "region", "segment"])
    if "is_registered" not in rows.columns:
        rows = with_product(rows, products, look)
    elif not set(PRODUCT_LABELS) <= set(rows.columns):
        rows = look(rows, products, "product_id", PRODUCT_LABELS)
    return label_missing(rows, fixed.UNREGISTERED)


def sales_detail(sales: DataFrame, products: DataFrame, segments: DataFrame) -> DataFrame:
    """One row per sale with product labels, customer attributes, calendar parts and revenue."""
    return derive_sale_columns(sales_detail_rows(sales, products, segments))


def price_position(
    products: DataFrame, competitor_prices: DataFrame, sales: DataFrame, preset: RetailPreset
) -> DataFrame:
    """Our price against all competitor prices, with revenue to set priorities.

    A product has a suspect price exactly when its lowest competitor price is
    suspect, so the flag is taken from the minimum and the prices are reduced to
    one row per product before the join.
    """
    price = F.col("competitor_price")
    rows = summarise_per_entity(
        products.select("product_id", "product_name", "category", "brand", F.col("current_price").alias("our_price")),
        competitor_prices,
        "product_id",
        {
            "avg_competitor_price": money.mean_money(price),
            "min_competitor_price": F.min(price),
            "max_competitor_price": F.max(price),
            "competitor_count": F.count(F.lit(1)),
        },
        how="inner",
    )
    rows = summarise_per_entity(
        rows,
        sales,
        "product_id",
        {"revenue": money.total(F.col("revenue")), "items_sold": F.sum("quantity")},
        zero_fill=["revenue", "items_sold"],
    )
    ours, lowest, mean = F.col("our_price"), F.col("min_competitor_price"), F.col("avg_competitor_price")
    return rows.withColumns(
        {
            "pct_vs_avg": money.pct_diff(ours, mean),
            "pct_vs_min": money.pct_diff(ours, lowest),
            "price_class": bands.price_class(ours, lowest, mean, F.col("max_competitor_price"), fixed.PRICE_CLASSES),
            "has_suspect": money.is_below_share(lowest, ours, preset.suspect_share),
        }
    )
