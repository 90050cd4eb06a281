"""Cleaned tables: raw rows without repeats, with typed money and quality flags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import bands, calendar, money, text
from tallyhouse.operators.dedup import dedup, dedup_dimension
from tallyhouse.operators.expectations import WARN, Rule, required
from tallyhouse.operators.joins import lookup
from tallyhouse.plans import preset as fixed
from tallyhouse.plans.preset import RetailPreset

PRODUCT_LABELS = list(fixed.UNREGISTERED)


def clean_products(raw: DataFrame, preset: RetailPreset) -> DataFrame:
    """Unique products with a money price and its band."""
    rows = dedup_dimension(raw, ["product_id"])
    rows = rows.withColumns({"product_name": F.trim("product_name"), "current_price": money.money(F.col("current_price"))})
    return rows.withColumn(
        "price_band", bands.band(F.col("current_price"), preset.price_bands, preset.lowest_price_band)
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    """Unique customers with a display name and the state's name and region."""
    rows = dedup_dimension(raw, ["customer_id"]).withColumnRenamed("customer_name", "raw_name")
    rows = rows.withColumns(
        {
            "customer_name": text.display_name(F.col("raw_name"), fixed.HONORIFIC),
            "state": text.code(F.col("state")),
            "registered_on": F.to_date("registered_on"),
        }
    )
    return rows.withColumns(
        {
            "state_name": text.map_lookup(F.col("state"), fixed.STATE_NAMES),
            "region": text.map_lookup(F.col("state"), fixed.STATE_REGIONS),
        }
    )


def clean_customers_by_nation(raw: DataFrame, nations: DataFrame) -> DataFrame:
    """The same customers with geography from a lookup table instead of a constant map."""
    rows = dedup_dimension(raw, ["customer_id"])
    rows = rows.withColumn("customer_name", text.display_name(F.col("customer_name"), fixed.HONORIFIC))
    return lookup(rows, nations, "nation_key", ["nation_name", "region"])


#: Columns of a sale that the source sends, and those that follow from them alone: no shuffle need carry the latter.
SALE_SOURCE = ["sale_id", "sold_at", "customer_id", "product_id", "channel", "quantity", "unit_price"]
SALE_DERIVED = ["sale_date", "sale_hour", "weekday_num", "weekday", "revenue"]


def unique_sales(raw: DataFrame, preset: RetailPreset) -> DataFrame:
    """The first version of every sale, with the columns of the source."""
    return dedup(raw, ["sale_id"], preset.sale_order).select(*SALE_SOURCE)


def with_product(sales: DataFrame, products: DataFrame, look: Callable[..., DataFrame] = lookup) -> DataFrame:
    """Sales with the flags and the (possibly NULL) product labels, both from one product lookup, made by `look`."""
    rows = look(sales, products, "product_id", ["created_at", *PRODUCT_LABELS])
    flagged = rows.withColumns(
        {
            "unit_price": money.money(F.col("unit_price")),
            # A catalogued product without a creation date counts as unregistered.
            "is_registered": F.col("created_at").isNotNull(),
            "sold_before_created": calendar.happened_before(F.col("sold_at"), F.col("created_at")),
        }
    )
    return flagged.drop("created_at")


def derive_sale_columns(sales: DataFrame) -> DataFrame:
    """Sales with `SALE_DERIVED`: calendar parts and revenue."""
    rows = sales.withColumns(
        {
            "sale_date": F.to_date("sold_at"),
            "sale_hour": F.hour("sold_at"),
            "weekday_num": calendar.weekday_number(F.col("sold_at")),
            "revenue": money.line_total(F.col("quantity"), F.col("unit_price")),
        }
    )
    return rows.withColumn("weekday", calendar.weekday_name(F.col("weekday_num"), fixed.WEEKDAYS))


def clean_unique_sales(unique: DataFrame, products: DataFrame) -> DataFrame:
    """Unique sales with revenue, calendar parts, flags and product labels; who does not use these does not pay for them."""
    return derive_sale_columns(with_product(unique, products))


def clean_sales(raw: DataFrame, products: DataFrame, preset: RetailPreset) -> DataFrame:
    """The same from raw sales."""
    return clean_unique_sales(unique_sales(raw, preset), products)


def clean_competitor_prices(raw: DataFrame, products: DataFrame, preset: RetailPreset) -> DataFrame:
    """Unique competitor prices with a parsed time and the suspect flag."""
    unique = dedup(raw, ["product_id", "competitor"])
    rows = lookup(unique, products, "product_id", ["current_price"])
    price = money.money(F.col("competitor_price"))
    return rows.withColumns(
        {
            "competitor_price": price,
            "collected_at": calendar.parse_timestamp(F.col("collected_at"), fixed.COLLECTED_AT_FORMAT),
            "is_suspect": money.is_below_share(price, F.col("current_price"), preset.suspect_share),
        }
    )


RULES: dict[str, list[Rule]] = {
    "products": [*required("product_id"), Rule("current_price_positive", "current_price > 0")],
    "customers": required("customer_id", "region"),
    "sales": [
        *required("sale_id", "sold_at", "customer_id", "product_id", "quantity", "unit_price"),
        Rule("quantity_positive", "quantity > 0"),
        Rule("unit_price_positive", "unit_price > 0"),
        Rule("channel_known", "channel IN ('ecommerce', 'loja_fisica')"),
        Rule("product_registered", "is_registered", WARN),
        Rule("sold_after_created", "NOT sold_before_created", WARN),
    ],
    "competitor_prices": [
        *required("product_id"),
        Rule("competitor_price_positive", "competitor_price > 0"),
        Rule("price_plausible", "NOT is_suspect", WARN),
    ],
}
