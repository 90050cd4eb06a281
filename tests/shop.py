"""A hand-made shop: small raw tables that hold every special case."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from tallyhouse.plans.preset import RetailPreset

PRESET = RetailPreset(segments=(("100", "VIP"), ("50", "TOP_TIER")), unregistered_percent=50)


def ts(day: int, hour: int = 0) -> dt.datetime:
    return dt.datetime(2025, 12, day, hour)


SALES = [
    # sale, moment, customer, product, channel, quantity, price
    ("s1", ts(14, 9), "c1", "p1", "ecommerce", 2, "30.00"),
    ("s1", ts(14, 9), "c1", "p1", "ecommerce", 2, "30.00"),  # exact repeat
    ("s2", ts(14, 9), "c1", "p2", "ecommerce", 1, "40.00"),
    ("s3", ts(15, 23), "c2", "p1", "loja_fisica", 1, "50.00"),
    ("s4", ts(16, 0), "c2", "ghost", "loja_fisica", 3, "0.33"),  # not in the catalogue
    ("s5", ts(16, 0), "c3", "p3", "ecommerce", 1, "10.00"),  # catalogued without creation date
    ("s6", ts(1, 1), "c3", "p2", "ecommerce", 1, "5.00"),  # before the product was created
]
PRODUCTS = [
    ("p1", "  Mouse ", "Tech", "Acme", "1000.01", ts(1)),
    ("p1", "  Mouse ", "Tech", "Acme", "1000.01", ts(1)),
    ("p2", "Mouse", "Tech", "Zeta", "500.01", ts(10)),
    ("p3", "Chair", "Home", "Acme", "500.00", None),
    ("p4", "Lamp", "Home", "Zeta", "10.00", ts(1)),  # never sold
]
CUSTOMERS = [
    ("c1", "Dra. ANA lima", " sp ", "Brasil", dt.date(2025, 1, 1)),
    ("c1", "Dra. ANA lima", " sp ", "Brasil", dt.date(2025, 1, 1)),
    ("c2", "JOÃO d'ávila", "ba", "Brasil", dt.date(2025, 1, 2)),
    ("c3", "Sr. Zé", "RS", "Brasil", dt.date(2025, 1, 3)),
    ("c4", "Lia", "AC", "Brasil", dt.date(2025, 1, 4)),  # never bought
]
PRICES = [
    ("p1", "A", "600.00", "2025-12-01 10:00:00"),  # suspect: below 60 %
    ("p1", "A", "600.00", "2025-12-01 10:00:00"),
    ("p1", "B", "900.00", "2025-12-01 10:00:00"),
    ("p2", "A", "500.01", "2025-12-01 10:00:00"),  # equal to ours
    ("p4", "A", "6.00", "2025-12-01 10:00:00"),  # exactly 60 %
    ("p4", "B", "12.00", "2025-12-01 10:00:00"),
    ("px", "A", "1.00", "2025-12-01 10:00:00"),  # listed by a competitor only
]


def raw_shop(spark, sales=SALES, products=PRODUCTS, customers=CUSTOMERS, prices=PRICES):
    money = lambda rows, i: [(*r[:i], None if r[i] is None else D(r[i]), *r[i + 1 :]) for r in rows]
    return {
        "sales": spark.createDataFrame(
            money(sales, 6),
            "sale_id string, sold_at timestamp, customer_id string, product_id string, channel string, "
            "quantity bigint, unit_price decimal(12,2)",
        ),
        "products": spark.createDataFrame(
            money(products, 4),
            "product_id string, product_name string, category string, brand string, current_price decimal(12,2), "
            "created_at timestamp",
        ),
        "customers": spark.createDataFrame(
            customers, "customer_id string, customer_name string, state string, country string, registered_on date"
        ),
        "competitor_prices": spark.createDataFrame(
            money(prices, 2), "product_id string, competitor string, competitor_price decimal(12,2), collected_at string"
        ),
    }
