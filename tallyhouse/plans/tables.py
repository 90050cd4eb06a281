"""Contracts of the cleaned tables and the marts."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DataType, DateType, IntegerType, LongType, StringType, TimestampType

from tallyhouse.functions.money import MONEY, TOTAL
from tallyhouse.operators.contracts import ColumnSpec, TableContract

TEXT, INT, LONG, FLAG = StringType(), IntegerType(), LongType(), BooleanType()
DATE, TIMESTAMP = DateType(), TimestampType()


def _c(name: str, type_: DataType, comment: str) -> ColumnSpec:
    return ColumnSpec(name, type_, comment)


def _not_additive(name: str, type_: DataType, comment: str) -> ColumnSpec:
    return ColumnSpec(name, type_, comment + " Never add this column up over rows.", additive=False)


_PRODUCT_ID = _c("product_id", TEXT, "Product key. Count products by it: names repeat.")
_PRODUCT_NAME = _c("product_name", TEXT, "Name for display; several products may share it.")
_CATEGORY = _c("category", TEXT, "Product category, or the label for products missing from the catalogue.")
_BRAND = _c("brand", TEXT, "Product brand, or the label for products missing from the catalogue.")
_BAND = _c("price_band", TEXT, "PREMIUM, MEDIO or BASICO by catalogue price, or the label for missing products.")
_CUSTOMER_ID = _c("customer_id", TEXT, "Customer key. Count customers by its distinct values.")
_CUSTOMER_NAME = _c("customer_name", TEXT, "Name in title case, without a leading form of address.")
_STATE = _c("state", TEXT, "Two-letter state code in upper case.")
_STATE_NAME = _c("state_name", TEXT, "Full name of the state.")
_REGION = _c("region", TEXT, "Region of Brazil the state belongs to.")
_SEGMENT = _c("segment", TEXT, "VIP, TOP_TIER or REGULAR, from the customer's total revenue.")
_SALE_DATE = _c("sale_date", DATE, "UTC calendar date of the sale.")
_WEEKDAY = _c("weekday", TEXT, "Weekday name in Portuguese; order by weekday_num.")
_WEEKDAY_NUM = _c("weekday_num", INT, "1 = Sunday to 7 = Saturday.")
_SALE_HOUR = _c("sale_hour", INT, "UTC hour of the sale, 0 to 23.")
_CHANNEL = _c("channel", TEXT, "ecommerce or loja_fisica, lower case.")
_REGISTERED = _c("is_registered", FLAG, "False when the sold product is missing from the catalogue.")
_BEFORE = _c("sold_before_created", FLAG, "True when the sale is dated before the product's creation.")
_TICKET = _not_additive("avg_ticket", MONEY, "Mean revenue per sale. For a group divide summed revenue by summed sales.")

PRODUCTS = TableContract(
    "products",
    "Product catalogue without repeated products.",
    ("product_id",),
    (
        _PRODUCT_ID,
        _PRODUCT_NAME,
        _c("category", TEXT, "Product category."),
        _c("brand", TEXT, "Product brand."),
        _c("current_price", MONEY, "Catalogue price."),
        _c("price_band", TEXT, "PREMIUM, MEDIO or BASICO by catalogue price."),
        _c("created_at", TIMESTAMP, "When the product was created, UTC."),
    ),
)

CUSTOMERS = TableContract(
    "customers",
    "Customers without repeats, with tidy names and geography.",
    ("customer_id",),
    (
        _CUSTOMER_ID,
        _c("raw_name", TEXT, "Name exactly as the source sent it."),
        _CUSTOMER_NAME,
        _STATE,
        _STATE_NAME,
        _c("region", TEXT, "Region of Brazil; NULL for an unknown state code, which stops a refresh."),
        _c("country", TEXT, "Country as sent by the source."),
        _c("registered_on", DATE, "Date of registration."),
    ),
)

SALES = TableContract(
    "sales",
    "One row per sale with revenue, calendar parts and quality flags; no sale is ever dropped.",
    ("sale_id",),
    (
        _c("sale_id", TEXT, "Sale key."),
        _c("sold_at", TIMESTAMP, "Moment of the sale, UTC."),
        _SALE_DATE,
        _SALE_HOUR,
        _WEEKDAY_NUM,
        _WEEKDAY,
        _CUSTOMER_ID,
        _PRODUCT_ID,
        _CHANNEL,
        _c("quantity", LONG, "Units sold."),
        _not_additive("unit_price", MONEY, "Price of one unit in this sale."),
        _c("revenue", MONEY, "Quantity times unit price."),
        _REGISTERED,
        _BEFORE,
    ),
)

COMPETITOR_PRICES = TableContract(
    "competitor_prices",
    "One price per product and competitor.",
    ("product_id", "competitor"),
    (
        _PRODUCT_ID,
        _c("competitor", TEXT, "Name of the competitor."),
        _not_additive("competitor_price", MONEY, "Price the competitor asks."),
        _c("collected_at", TIMESTAMP, "When the price was collected, UTC."),
        _c("is_suspect", FLAG, "True when the price is implausibly far below ours; the row still counts."),
    ),
)

CUSTOMER_SEGMENTS = TableContract(
    "customer_segments",
    "Who the best customers are, where they live and their segment. One row per customer, also for those who never bought.",
    ("customer_id",),
    (
        _CUSTOMER_ID,
        _CUSTOMER_NAME,
        _STATE,
        _STATE_NAME,
        _REGION,
        _c("total_orders", LONG, "Number of sales; 0 for a customer who never bought."),
        _c("revenue", TOTAL, "Revenue of all sales, catalogued product or not; 0 for a customer who never bought."),
        _TICKET,
        _c("first_purchase", TIMESTAMP, "First sale, UTC; NULL for a customer who never bought."),
        _c("last_purchase", TIMESTAMP, "Latest sale, UTC; NULL for a customer who never bought."),
        _SEGMENT,
        _not_additive("revenue_rank", LONG, "Place by revenue, 1 = highest, without ties."),
    ),
)

SALES_TIME = TableContract(
    "sales_time",
    "When and through which channel we sell. One row per date, hour and channel with a sale.",
    ("sale_date", "sale_hour", "channel"),
    (
        _SALE_DATE,
        _WEEKDAY,
        _WEEKDAY_NUM,
        _SALE_HOUR,
        _CHANNEL,
        _c("total_sales", LONG, "Number of sales."),
        _c("items_sold", LONG, "Units sold."),
        _c("revenue", TOTAL, "Revenue of all sales."),
        _not_additive("unique_customers", LONG, "Distinct customers in this date, hour and channel."),
    ),
)

PRODUCT_SALES = TableContract(
    "product_sales",
    "Which products sell. One row per sold product, also for products missing from the catalogue.",
    ("product_id",),
    (
        _PRODUCT_ID,
        _PRODUCT_NAME,
        _CATEGORY,
        _BRAND,
        _BAND,
        _REGISTERED,
        _c("total_sales", LONG, "Number of sales."),
        _c("items_sold", LONG, "Units sold."),
        _c("revenue", TOTAL, "Revenue of all sales."),
        _TICKET,
        _not_additive("revenue_rank", LONG, "Place by revenue over all products, 1 = highest, without ties."),
        _not_additive("category_rank", LONG, "Place by revenue within the category; products missing from the catalogue rank together."),
    ),
)

SALES_DETAIL = TableContract(
    "sales_detail",
    "One row per sale with its product and customer, for questions across departments.",
    ("sale_id",),
    (
        _c("sale_id", TEXT, "Sale key."),
        _c("sold_at", TIMESTAMP, "Moment of the sale, UTC."),
        _SALE_DATE,
        _WEEKDAY,
        _WEEKDAY_NUM,
        _SALE_HOUR,
        _CHANNEL,
        _PRODUCT_ID,
        _PRODUCT_NAME,
        _CATEGORY,
        _BRAND,
        _BAND,
        _CUSTOMER_ID,
        _CUSTOMER_NAME,
        _STATE,
        _REGION,
        _SEGMENT,
        _c("quantity", LONG, "Units sold."),
        _not_additive("unit_price", MONEY, "Price of one unit in this sale."),
        _c("revenue", MONEY, "Quantity times unit price."),
        _REGISTERED,
        _BEFORE,
    ),
)

PRICE_POSITION = TableContract(
    "price_position",
    "Our price against competitors. One row per catalogued product with a competitor price.",
    ("product_id",),
    (
        _PRODUCT_ID,
        _PRODUCT_NAME,
        _c("category", TEXT, "Product category."),
        _c("brand", TEXT, "Product brand."),
        _not_additive("our_price", MONEY, "Our catalogue price."),
        _not_additive("avg_competitor_price", MONEY, "Mean competitor price, to the cent, suspect prices included."),
        _not_additive("min_competitor_price", MONEY, "Lowest competitor price, suspect prices included."),
        _not_additive("max_competitor_price", MONEY, "Highest competitor price."),
        _c("competitor_count", LONG, "Competitors with a price for the product."),
        _not_additive("pct_vs_avg", MONEY, "Percent points above (+) or below (-) the mean: 10 = 10 % dearer. Use a mean for groups."),
        _not_additive("pct_vs_min", MONEY, "Percent points above (+) or below (-) the lowest price. Use a mean for groups."),
        _c("price_class", TEXT, "Place of our price: extremes first, then against the mean."),
        _c("has_suspect", FLAG, "True when a competitor price must be confirmed before reacting."),
        _c("revenue", TOTAL, "Revenue of the product, 0 if never sold. Not the company's total."),
        _c("items_sold", LONG, "Units sold, 0 if never sold."),
    ),
)

SILVER = (PRODUCTS, CUSTOMERS, SALES, COMPETITOR_PRICES)
MARTS = (CUSTOMER_SEGMENTS, SALES_TIME, PRODUCT_SALES, SALES_DETAIL, PRICE_POSITION)
