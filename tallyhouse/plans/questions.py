"""The analytical questions, each a function of a dataset or mart."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.functions import money, text
from tallyhouse.operators.filters import Range, apply_filters, list_argument, range_argument
from tallyhouse.operators.joins import join_many_to_one, join_one_to_one, label_missing, lookup
from tallyhouse.operators.measures import Dataset, evaluate
from tallyhouse.operators.ranking import top_k
from tallyhouse.operators.totals import with_total
from tallyhouse.plans import preset as fixed
from tallyhouse.plans.preset import RetailPreset
from tallyhouse.session import stage

# --- Sales: when, where, what -------------------------------------------------


def commercial_kpis(sales: Dataset, period: Range = (None, None), channels: Sequence[str] = ()) -> DataFrame:
    return evaluate(
        sales,
        measures=["revenue", "sales", "avg_ticket", "items_sold"],
        ranges={"sale_date": period},
        selections={"channel": channels},
    )


def daily_revenue_by_channel(sales: Dataset, period: Range = (None, None)) -> DataFrame:
    day = F.date_trunc("DAY", F.col("sale_date")).alias("day")
    return evaluate(sales, [day, "channel"], ["revenue"], {"sale_date": period}, order_by=["day", "channel"])


def channel_revenue(sales: Dataset, period: Range = (None, None), channels: Sequence[str] = ()) -> DataFrame:
    return evaluate(
        sales, ["channel"], ["revenue"], {"sale_date": period}, {"channel": channels},
        order_by=[F.desc("revenue"), "channel"],
    )


def weekday_revenue(sales: Dataset) -> DataFrame:
    """Revenue per day and in total by weekday, Sunday first."""
    rows = evaluate(sales, ["weekday"], ["revenue_per_day", "revenue"])
    place = text.ordinal(F.col("weekday"), fixed.WEEKDAYS)
    return rows.withColumn("weekday_num", place).orderBy("weekday_num")


def best_weekday(sales: Dataset) -> DataFrame:
    """The best weekday by mean per day, and by total; they may differ."""
    rows = weekday_revenue(sales)
    # Of equal weekdays the earlier one wins.
    by_mean = F.max_by("weekday", F.struct("revenue_per_day", -F.col("weekday_num")))
    by_total = F.max_by("weekday", F.struct("revenue", -F.col("weekday_num")))
    return rows.agg(
        by_mean.alias("best_by_mean"),
        F.max("revenue_per_day").alias("best_mean"),
        by_total.alias("best_by_total"),
        F.max("revenue").alias("best_total"),
    )


def hour_revenue(sales: Dataset) -> DataFrame:
    return evaluate(sales, ["hour_label"], ["revenue"], order_by=["hour_label"])


def category_revenue(sales: Dataset) -> DataFrame:
    return evaluate(sales, ["category"], ["revenue"], order_by=[F.desc("revenue"), "category"])


def top_products(
    sales: DataFrame,
    products_of: DataFrame | Callable[[DataFrame], DataFrame],
    k: int,
    period: Range = (None, None),
    channels: Sequence[str] = (),
) -> DataFrame:
    """The k best-selling products of a period and of chosen (displayed) channels.

    Grouped by product key before any label is looked up, so a hot product is reduced before the
    shuffle. The k rows are written once; their keys then restrict the raw catalogue, so that k
    products are deduplicated and cleaned and not all of them. Cleaned products can be given instead.
    """
    chosen = apply_filters(sales, {"sale_date": period}, {"channel": text.codes_of(channels, fixed.CHANNEL_LABELS)})
    per_product = chosen.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("sales"),
        F.sum("quantity").alias("items_sold"),
        money.total(F.col("revenue")).alias("revenue"),
        money.ratio(F.sum("revenue"), F.count(F.lit(1))).alias("avg_ticket"),
    )
    best = stage(top_k(per_product, [F.desc("revenue"), "product_id"], k, "position"), "top-products")
    products = products_of if isinstance(products_of, DataFrame) else products_of(best)
    labels = {c: fixed.UNREGISTERED[c] for c in ("product_name", "category")}
    named = label_missing(lookup(best, products, "product_id", list(labels), grouped=True), labels)
    return named.select(
        "position", "product_id", "product_name", "category", "sales", "items_sold", "revenue", "avg_ticket"
    ).orderBy("position")


def channel_sales_sql(
    spark: SparkSession, detail: DataFrame, low: Any, high: Any, channels: Sequence[str]
) -> DataFrame:
    """Sales per product category in SQL, with a date-range and a list parameter; an empty list means all."""
    return spark.sql(
        """
        SELECT category, count(*) AS sales, CAST(sum(revenue) AS DECIMAL(28,2)) AS revenue
        FROM {detail}
        WHERE sale_date BETWEEN :period.min AND :period.max
          AND (size(:channels) = 0 OR array_contains(CAST(:channels AS ARRAY<STRING>), channel))
        GROUP BY category
        ORDER BY revenue DESC, category
        """,
        args={"period": range_argument(low, high), "channels": list_argument(channels)},
        detail=detail,
    )


def ticket_by_channel(time: Dataset) -> DataFrame:
    return evaluate(time, ["channel"], ["revenue", "sales", "avg_ticket"], order_by=["channel"])


def region_category_revenue(sales: Dataset) -> DataFrame:
    return evaluate(
        sales, ["region", "category"], ["customers", "sales", "revenue", "ticket"],
        order_by=["region", F.desc("revenue"), "category"],
    ).withColumnRenamed("ticket", "avg_ticket")


# Dimensions that describe customers: their answers also count customers.
CUSTOMER_DIMENSIONS = ("region", "state", "segment")


def best_sellers(sales: Dataset, dimension: str, k: int) -> DataFrame:
    """What sells most along `dimension`: revenue, sales and ticket, and customers where they make sense."""
    measures = ["revenue", "sales", "ticket"] + (["customers"] if dimension in CUSTOMER_DIMENSIONS else [])
    rows = evaluate(sales, [dimension], measures, order_by=[F.desc("revenue"), dimension], limit=k)
    return rows.withColumnRenamed("ticket", "avg_ticket")


def distinct_products_by_category(product_mart: DataFrame) -> DataFrame:
    """Products per category, counted by key; the number of names shows why names must not be counted."""
    return (
        product_mart.groupBy("category")
        .agg(F.count("product_id").alias("products"), F.countDistinct("product_name").alias("names"))
        .orderBy("category")
    )


def product_ranking_list(product_mart: DataFrame) -> DataFrame:
    """Every sold product with its place in the category and overall."""
    return product_mart.select("category", "category_rank", "product_id", "product_name", "revenue", "revenue_rank")


# --- Customers ----------------------------------------------------------------


def customer_kpis(customers: Dataset, segments: Sequence[str] = (), regions: Sequence[str] = ()) -> DataFrame:
    return evaluate(
        customers,
        measures=["customers", "vip_customers", "vip_revenue_share", "avg_ticket"],
        selections={"segment": segments, "region": regions},
    )


def segment_summary(customers: Dataset) -> DataFrame:
    rows = evaluate(customers, ["segment"], ["customers", "revenue"])
    place = text.ordinal(F.col("segment"), fixed.SEGMENTS)
    return rows.withColumn("segment_place", place).orderBy("segment_place")


def region_segment_revenue(customers: Dataset) -> DataFrame:
    """Revenue by region and segment, regions by their total, which covers a few rows per region."""
    rows = evaluate(customers, ["region", "segment"], ["revenue"])
    region_total = F.sum("revenue").over(Window.partitionBy("region")).cast(money.TOTAL)
    return rows.withColumn("region_revenue", region_total).orderBy(
        F.desc("region_revenue"), "region", text.ordinal(F.col("segment"), fixed.SEGMENTS)
    )


def customer_ranking_list(segments: DataFrame, chosen: Sequence[str] = (), regions: Sequence[str] = ()) -> DataFrame:
    """Customers by their place over all customers, also when only some of them are shown."""
    return apply_filters(segments, None, {"segment": chosen, "region": regions}).select(
        "revenue_rank", "customer_name", "state", "region", "segment", "total_orders", "revenue", "last_purchase"
    ).orderBy("revenue_rank")


def ticket_by_segment(customers: Dataset) -> DataFrame:
    rows = evaluate(
        customers, ["segment"], ["customers", "sales", "revenue", "ticket"], order_by=[F.desc("revenue"), "segment"]
    )
    return rows.withColumnRenamed("ticket", "avg_ticket")


def top_tier_share(segments: DataFrame) -> DataFrame:
    top = F.col("segment") == fixed.TOP_TIER
    top_revenue = F.sum(F.when(top, F.col("revenue")).otherwise(0))
    return segments.agg(
        F.count_if(top).alias("top_tier_customers"),
        top_revenue.cast(money.TOTAL).alias("top_tier_revenue"),
        money.total(F.col("revenue")).alias("total_revenue"),
        money.ratio(100 * top_revenue, F.sum("revenue"), 1).alias("revenue_pct"),
    )


def customers_by_region_segment(customers: Dataset) -> DataFrame:
    place = text.ordinal(F.col("segment"), fixed.SEGMENTS)
    return evaluate(customers, ["region", "segment"], ["customers"], order_by=["region", place])


def near_vip_customers(segments: DataFrame, preset: RetailPreset) -> DataFrame:
    """TOP_TIER customers with the smallest gap to the VIP limit."""
    gap = (F.lit(preset.vip_limit).cast(money.TOTAL) - F.col("revenue")).cast(money.TOTAL)
    rows = segments.filter(F.col("segment") == fixed.TOP_TIER).withColumn("gap_to_vip", gap)
    return top_k(
        rows.select("customer_id", "customer_name", "state", "region", "revenue", "gap_to_vip"),
        ["gap_to_vip", "customer_id"],
        preset.ranking_size,
    )


def sales_by_customer_profile(detail: DataFrame, segments: DataFrame) -> DataFrame:
    """Sales joined many-to-one to the customer mart: state by name, not only by code.

    Sales are reduced to one row per customer first; the join is still checked
    for being many-to-one.
    """
    per_customer = detail.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("sales"), money.total(F.col("revenue")).alias("revenue")
    )
    profile = segments.select("customer_id", "state_name", "segment")
    rows = join_many_to_one(per_customer, profile, "customer_id", grouped=True)
    return (
        rows.groupBy("state_name", "segment")
        .agg(
            F.count("customer_id").alias("customers"),
            F.sum("sales").alias("sales"),
            money.total(F.col("revenue")).alias("revenue"),
        )
        .orderBy("state_name", text.ordinal(F.col("segment"), fixed.SEGMENTS))
    )


# --- Prices -------------------------------------------------------------------


def price_kpis(prices: Dataset, categories: Sequence[str] = (), classes: Sequence[str] = ()) -> DataFrame:
    return evaluate(
        prices,
        measures=["products", "confirmed_dearest", "confirmed_dearest_revenue", "suspect_products"],
        selections={"category": categories, "price_class_label": classes},
    )


def products_by_price_class(prices: Dataset) -> DataFrame:
    place = text.ordinal(F.col("price_class_label"), list(fixed.PRICE_CLASS_LABELS.values()))
    return evaluate(prices, ["price_class_label", "price_status"], ["products"], order_by=[place, "price_status"])


def price_gap_by_category(prices: Dataset) -> DataFrame:
    """Mean distance to the market per category, products with suspect prices left out."""
    return evaluate(
        prices, ["category"], ["avg_diff_vs_market"], where="NOT has_suspect",
        order_by=[F.desc("avg_diff_vs_market"), "category"],
    )


_ACTION_COLUMNS = (
    "product_name", "product_id", "category", "our_price", "avg_competitor_price", "min_competitor_price",
    "diff_vs_avg", "diff_vs_min", "revenue", "to_confirm",
)


def price_action_list(prices: Dataset, k: int | None = None) -> DataFrame:
    """Products dearer than all competitors, the largest revenue first; all of them or the first k."""
    rows = prices.df.filter(F.col("price_class") == fixed.PRICE_CLASSES.dearest).select(*_ACTION_COLUMNS)
    order = [F.desc("revenue"), "product_id"]
    return rows.orderBy(*order) if k is None else top_k(rows, order, k)


def above_market_counts(position: DataFrame) -> DataFrame:
    """Products dearer than the mean competitor, confirmed or with a suspect price, and in total.

    Counted per status and category first, so the list of categories is built from distinct
    values only; counts per status and the total are grouping sets of one aggregation.
    """
    status = text.yes_no(F.col("has_suspect"), *fixed.SUSPECT_COUNT_STATUS).alias("status")
    per_category = (
        position.filter("pct_vs_avg > 0").groupBy(status, "category").agg(F.countDistinct("product_id").alias("n"))
    )
    rows = with_total(
        per_category,
        "status",
        {"products": F.sum("n"), "categories": text.joined_set(F.col("category"))},
        fixed.TOTAL_LABEL,
    )
    listed = F.when(~F.col("is_total"), F.col("categories"))
    return rows.select("status", F.coalesce("products", F.lit(0)).alias("products"), listed.alias("categories"))


def categories_above_market(position: DataFrame) -> DataFrame:
    """Categories whose mean distance to the market is positive, with confirmed and suspect products apart."""
    mean = F.round(F.avg("pct_vs_avg"), 2).cast("decimal(10,2)")
    return (
        position.groupBy("category")
        .agg(
            mean.alias("avg_pct_vs_market"),
            F.count_if(~F.col("has_suspect")).alias("confirmed_products"),
            F.count_if(F.col("has_suspect")).alias("suspect_products"),
            F.count("product_id").alias("products"),
        )
        .filter("avg_pct_vs_market > 0")
        .orderBy(F.desc("avg_pct_vs_market"), "category")
    )


def product_sales_with_price_position(product_mart: DataFrame, position: DataFrame) -> DataFrame:
    """Sold products joined one-to-one to their price position."""
    left = product_mart.select("product_id", "product_name", "category", "total_sales", "revenue", "avg_ticket")
    right = position.select("product_id", "our_price", "avg_competitor_price", "pct_vs_avg", "price_class", "has_suspect")
    return join_one_to_one(left, right, "product_id")
