"""Datasets for analysis: a mart with display labels and its named measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import money, text
from tallyhouse.operators.filters import Range, apply_filters
from tallyhouse.operators.measures import Dataset, Measure
from tallyhouse.plans import preset as fixed
from tallyhouse.plans import tables


def _sum(name: str, column: str, description: str, type_: str = "decimal(28,2)") -> Measure:
    return Measure(name, lambda: F.sum(column).cast(type_), description, (column,))


REVENUE = _sum("revenue", "revenue", "Total revenue.")

SALES_MEASURES = (
    REVENUE,
    Measure("sales", lambda: F.count("sale_id"), "Number of sales."),
    Measure(
        "avg_ticket",
        lambda: money.ratio(F.sum("revenue"), F.count("sale_id")),
        "Revenue per sale, never a mean of means.",
        ("revenue",),
    ),
    Measure(
        "ticket",
        lambda: money.ratio(F.sum("revenue"), F.count("sale_id"), 2),
        "Revenue per sale to the cent.",
        ("revenue",),
    ),
    _sum("items_sold", "quantity", "Units sold.", "bigint"),
    Measure(
        "revenue_per_day",
        lambda: money.ratio(F.sum("revenue"), F.countDistinct("sale_date")),
        "Revenue per day with a sale, so that weekdays occurring more often do not win by that.",
        ("revenue",),
    ),
    Measure("customers", lambda: F.countDistinct("customer_id"), "Distinct customers."),
)

CUSTOMER_MEASURES = (
    REVENUE,
    Measure("customers", lambda: F.count("customer_id"), "Customers, also those who never bought."),
    _sum("vip_customers", "is_vip", "VIP customers.", "bigint"),
    Measure(
        "vip_revenue_share",
        lambda: money.ratio(F.sum("vip_revenue"), F.sum("revenue")),
        "Part of the revenue that comes from VIP customers, 0 to 1.",
        ("vip_revenue", "revenue"),
    ),
    _sum("sales", "total_orders", "Number of sales.", "bigint"),
    Measure(
        "avg_ticket",
        lambda: money.ratio(F.sum("revenue"), F.sum("total_orders")),
        "Revenue per sale, never a mean of means.",
        ("revenue", "total_orders"),
    ),
    Measure(
        "ticket",
        lambda: money.ratio(F.sum("revenue"), F.sum("total_orders"), 2),
        "Revenue per sale to the cent.",
        ("revenue", "total_orders"),
    ),
)

PRICE_MEASURES = (
    REVENUE,
    Measure("products", lambda: F.count("product_id"), "Products with a competitor price."),
    _sum("confirmed_dearest", "is_confirmed_dearest", "Dearer than all competitors, no suspect price.", "bigint"),
    Measure(
        "confirmed_dearest_revenue",
        lambda: money.total(F.when(F.col("is_confirmed_dearest") == 1, F.col("revenue")).otherwise(0)),
        "Revenue of the products dearer than all competitors, no suspect price.",
        ("revenue",),
    ),
    _sum("suspect_products", "suspect", "Products with a price to confirm.", "bigint"),
    Measure(
        "avg_diff_vs_market",
        lambda: F.round(F.avg("diff_vs_avg"), 6).cast("decimal(12,6)"),
        "Mean distance to the mean competitor price as a fraction, 0.01 = 1 % dearer.",
    ),
)

TIME_MEASURES = (
    REVENUE,
    _sum("sales", "total_sales", "Number of sales.", "bigint"),
    _sum("items_sold", "items_sold", "Units sold.", "bigint"),
    Measure(
        "avg_ticket",
        lambda: money.ratio(F.sum("revenue"), F.sum("total_sales"), 2),
        "Revenue per sale to the cent.",
        ("revenue", "total_sales"),
    ),
)


def sales_rows(detail: DataFrame) -> DataFrame:
    """Sales with the channel and hour as shown to people."""
    return detail.select(
        "sale_id",
        "sale_date",
        "weekday",
        "weekday_num",
        "sale_hour",
        text.hour_label(F.col("sale_hour")).alias("hour_label"),
        text.map_lookup(F.col("channel"), fixed.CHANNEL_LABELS).alias("channel"),
        "product_id",
        "category",
        "brand",
        "customer_id",
        "state",
        "region",
        "segment",
        "quantity",
        "revenue",
    )


def customer_rows(segments: DataFrame) -> DataFrame:
    """Customers with VIP indicator columns."""
    vip = F.col("segment") == fixed.VIP
    return segments.withColumns(
        {
            "vip_revenue": F.when(vip, F.col("revenue")).otherwise(0).cast(money.TOTAL),
            "is_vip": F.when(vip, 1).otherwise(0),
        }
    )


def price_rows(position: DataFrame) -> DataFrame:
    """Price positions with labels, fractions instead of percent points, and indicator columns."""
    suspect = F.col("has_suspect")
    dearest = F.col("price_class") == fixed.PRICE_CLASSES.dearest
    return position.select(
        "product_id",
        "product_name",
        "category",
        "brand",
        text.map_lookup(F.col("price_class"), fixed.PRICE_CLASS_LABELS).alias("price_class_label"),
        "price_class",
        "has_suspect",
        text.yes_no(suspect, *fixed.SUSPECT_STATUS).alias("price_status"),
        text.yes_no(suspect, *fixed.YES_NO).alias("to_confirm"),
        "our_price",
        "avg_competitor_price",
        "min_competitor_price",
        "competitor_count",
        (F.col("pct_vs_avg") / 100).cast("decimal(12,4)").alias("diff_vs_avg"),
        (F.col("pct_vs_min") / 100).cast("decimal(12,4)").alias("diff_vs_min"),
        "revenue",
        "items_sold",
        F.when(dearest & ~suspect, 1).otherwise(0).alias("is_confirmed_dearest"),
        F.when(suspect, 1).otherwise(0).alias("suspect"),
    )


# The filters of a dataset act on every question about it. Chosen labels are turned into the stored
# codes first, so that all filters can be pushed down to the scan.


def sales_dataset(detail: DataFrame, period: Range = (None, None), channels: Sequence[str] = ()) -> Dataset:
    chosen = apply_filters(detail, {"sale_date": period}, {"channel": text.codes_of(channels, fixed.CHANNEL_LABELS)})
    return Dataset.of(sales_rows(chosen), SALES_MEASURES, tables.SALES_DETAIL.non_additive)


def customer_dataset(segments: DataFrame, chosen: Sequence[str] = (), regions: Sequence[str] = ()) -> Dataset:
    rows = apply_filters(segments, None, {"segment": chosen, "region": regions})
    return Dataset.of(customer_rows(rows), CUSTOMER_MEASURES, tables.CUSTOMER_SEGMENTS.non_additive)


def price_dataset(position: DataFrame, categories: Sequence[str] = (), classes: Sequence[str] = ()) -> Dataset:
    codes = text.codes_of(classes, fixed.PRICE_CLASS_LABELS)
    rows = apply_filters(position, None, {"category": categories, "price_class": codes})
    return Dataset.of(price_rows(rows), PRICE_MEASURES, tables.PRICE_POSITION.non_additive)


def time_dataset(time_mart: DataFrame) -> Dataset:
    labelled = time_mart.withColumn("channel", text.map_lookup(F.col("channel"), fixed.CHANNEL_LABELS))
    return Dataset.of(labelled, TIME_MEASURES, tables.SALES_TIME.non_additive)
