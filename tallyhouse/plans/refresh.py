"""One full refresh: raw tables -> cleaned tables -> marts -> quality suite."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.contracts import TableContract
from tallyhouse.operators.expectations import RuleCounts, report
from tallyhouse.operators.quality import assert_quality
from tallyhouse.plans import marts, silver, tables
from tallyhouse.plans.preset import RetailPreset
from tallyhouse.plans.suite import retail_quality
from tallyhouse.sources.tables import materialize, publish

# Layout of the written tables: period filters are the most common ones.
CLUSTER_BY = {"sales_detail": "sale_date"}


def dated(sales: DataFrame) -> DataFrame:
    """Sales with the column of their layout, and no other that can be derived."""
    return sales.drop(*silver.SALE_DERIVED).withColumn("sale_date", F.to_date("sold_at"))


@dataclass(frozen=True)
class Refresh:
    folder: str
    silver: dict[str, DataFrame]
    marts: dict[str, DataFrame]
    expectations: DataFrame
    quality: DataFrame

    def path(self, contract: TableContract) -> str:
        return f"{self.folder}/{contract.name}"

    def publish(self, spark: SparkSession, silver_database: str, mart_database: str) -> None:
        """Point the catalog at this run; call it only after the suite has passed."""
        for contract in tables.SILVER:
            publish(spark, contract, self.path(contract), silver_database)
        for contract in tables.MARTS:
            publish(spark, contract, self.path(contract), mart_database)


def refresh(raw: Mapping[str, DataFrame], folder: str, preset: RetailPreset | None = None) -> Refresh:
    """Write every table of the model below `folder`, a new folder for each run.

    Every table is computed once and read back by its consumers. A broken
    failure rule stops the run while that table is written; the folder of the
    previous run is untouched and stays published. Warnings are counted by the
    same writes.
    """
    preset = preset or RetailPreset()
    counts: list[RuleCounts] = []

    def write(df: DataFrame, contract: TableContract, **layout) -> DataFrame:
        rules = silver.RULES.get(contract.name, ())
        counts.append(RuleCounts(contract.name, rules))
        path = f"{folder}/{contract.name}"
        return materialize(df, contract, path, CLUSTER_BY.get(contract.name), rules, counts[-1], **layout)

    products = write(silver.clean_products(raw["products"], preset), tables.PRODUCTS)
    customers = write(silver.clean_customers(raw["customers"]), tables.CUSTOMERS)
    sales = write(silver.clean_sales(raw["sales"], products, preset), tables.SALES)
    prices = write(
        silver.clean_competitor_prices(raw["competitor_prices"], products, preset), tables.COMPETITOR_PRICES
    )
    segments = write(
        marts.rank_customers(marts.customer_segments(customers, sales, preset)), tables.CUSTOMER_SEGMENTS
    )
    written_marts = {
        "customer_segments": segments,
        "sales_time": write(marts.sales_time(sales), tables.SALES_TIME),
        "product_sales": write(marts.rank_products(marts.product_sales(sales, products)), tables.PRODUCT_SALES),
        "sales_detail": write(
            dated(sales), tables.SALES_DETAIL, sized_by=sales,
            look_up=lambda rows, look: marts.labelled_sales(rows, products, segments, look),
            finish=silver.derive_sale_columns,
        ),
        "price_position": write(marts.price_position(products, prices, sales, preset), tables.PRICE_POSITION),
    }
    cleaned = {"products": products, "customers": customers, "sales": sales, "competitor_prices": prices}
    return Refresh(
        folder,
        cleaned,
        written_marts,
        report(products.sparkSession, counts),
        retail_quality(cleaned, written_marts, preset),
    )


def refresh_and_verify(raw: Mapping[str, DataFrame], folder: str, preset: RetailPreset | None = None) -> Refresh:
    """Refresh, then raise if any quality test fails."""
    run = refresh(raw, folder, preset)
    assert_quality(run.quality)
    return run
