"""The whole-table tests of the retail model."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.contracts import catalog_columns, frame_columns, is_documented
from tallyhouse.operators.expectations import check
from tallyhouse.operators.quality import (
    QualityTest,
    allowed,
    documented,
    no_rows,
    not_null,
    quality_suite,
    ratio_below,
    reconciles,
    same_row_count,
    unique,
)
from tallyhouse.plans import preset as fixed
from tallyhouse.plans import tables
from tallyhouse.plans.preset import RetailPreset
from tallyhouse.plans.silver import RULES
from tallyhouse.sources.tables import read_catalog


#: The table of all columns of the marts, beside the tables themselves.
COLUMNS = "mart_columns"


def retail_tests(preset: RetailPreset) -> list[QualityTest]:
    (vip, _), (top_tier, _) = preset.segments
    segment_bands = [
        no_rows("segments_vip_reach_limit", "customer_segments", f"segment = '{fixed.VIP}' AND revenue < {vip}"),
        no_rows(
            "segments_top_tier_within_limits",
            "customer_segments",
            f"segment = '{fixed.TOP_TIER}' AND (revenue < {top_tier} OR revenue >= {vip})",
        ),
        no_rows(
            "segments_regular_below_limit",
            "customer_segments",
            f"segment = '{fixed.REGULAR}' AND revenue >= {top_tier}",
        ),
    ]
    return [
        unique("products_key_unique", "products", ["product_id"]),
        unique("customers_key_unique", "customers", ["customer_id"]),
        unique("competitor_prices_key_unique", "competitor_prices", ["product_id", "competitor"]),
        unique("sales_key_unique", "sales", ["sale_id"]),
        no_rows(
            "sales_revenue_is_quantity_x_price",
            "sales",
            "revenue <> CAST(quantity * unit_price AS DECIMAL(10,2))",
        ),
        ratio_below("sales_unregistered_below_share", "sales", "NOT is_registered", preset.unregistered_percent),
        reconciles("segments_revenue_equals_sales", "customer_segments", "revenue", "sales", "revenue"),
        unique("segments_key_unique", "customer_segments", ["customer_id"]),
        allowed("segments_segment_valid", "customer_segments", "segment", fixed.SEGMENTS),
        *segment_bands,
        reconciles("time_revenue_equals_sales", "sales_time", "revenue", "sales", "revenue"),
        unique("time_grain_unique", "sales_time", ["sale_date", "sale_hour", "channel"]),
        reconciles("product_revenue_equals_sales", "product_sales", "revenue", "sales", "revenue"),
        unique("product_sales_key_unique", "product_sales", ["product_id"]),
        reconciles("detail_revenue_equals_sales", "sales_detail", "revenue", "sales", "revenue"),
        same_row_count("detail_rows_equal_sales", "sales_detail", "sales"),
        unique("detail_key_unique", "sales_detail", ["sale_id"]),
        not_null("detail_has_segment_and_region", "sales_detail", ["segment", "region"]),
        unique("price_position_key_unique", "price_position", ["product_id"]),
        documented("mart_columns_documented", COLUMNS),
    ]


def retail_quality(
    silver: Mapping[str, DataFrame], marts: Mapping[str, DataFrame], preset: RetailPreset, stop: bool = False
) -> DataFrame:
    """The suite over frames, whose schemas tell the comments."""
    columns = frame_columns(marts["sales_detail"].sparkSession, marts)
    return quality_suite({**silver, **marts, COLUMNS: columns}, retail_tests(preset), stop)


def published_quality(
    spark: SparkSession, silver_database: str, mart_database: str, preset: RetailPreset, stop: bool = False
) -> DataFrame:
    """The suite over published tables, read by name, with the columns the catalog has of the marts."""
    found = read_catalog(spark, silver_database, [c.name for c in tables.SILVER])
    found |= read_catalog(spark, mart_database, [c.name for c in tables.MARTS])
    found[COLUMNS] = catalog_columns(spark, mart_database)
    return quality_suite(found, retail_tests(preset), stop)


def revenue_reconciliation(silver: Mapping[str, DataFrame], marts: Mapping[str, DataFrame]) -> DataFrame:
    """Revenue per mart next to the revenue of the cleaned sales."""
    names = ["customer_segments", "sales_time", "product_sales", "sales_detail"]

    def total(table: str, df: DataFrame) -> DataFrame:
        return df.agg(F.sum("revenue").cast("decimal(28,2)").alias("revenue")).select(
            F.lit(table).alias("table_name"), "revenue"
        )

    rows = [total("sales", silver["sales"]), *[total(n, marts[n]) for n in names]]
    stacked = reduce(DataFrame.unionByName, rows)
    side_by_side = stacked.agg(
        *[F.max(F.when(F.col("table_name") == n, F.col("revenue"))).alias(n) for n in ["sales", *names]]
    )
    compared = [
        F.struct(F.lit(n).alias("table_name"), F.col(n).alias("revenue"), (F.col(n) == F.col("sales")).alias("agrees"))
        for n in ["sales", *names]
    ]
    return side_by_side.select(F.inline(F.array(*compared)))


def expectation_report(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of every row rule; each table is read once."""
    return reduce(DataFrame.unionByName, [check(silver[table], rules, table) for table, rules in RULES.items()])


def documentation_audit(spark: SparkSession, database: str) -> DataFrame:
    """Rows, columns, and columns with and without comment of every published table, as the catalog has them."""
    columns = catalog_columns(spark, database)
    per_table = columns.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.count_if(is_documented()).alias("documented_columns"),
        F.count_if(~is_documented()).alias("undocumented_columns"),
    )
    names = [r.table_name for r in per_table.select("table_name").sort("table_name").collect()]
    if not names:
        return per_table.select("table_name", F.lit(0).cast("bigint").alias("row_count"), *per_table.columns[1:])
    sizes = [
        spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, sizes).join(per_table, "table_name")


def raw_coverage(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every cleaned table and the items of all sales, to hold against the source."""
    rows = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            (F.sum("quantity") if name == "sales" else F.lit(None).cast("bigint")).alias("items"),
        ).select(F.lit(name).alias("table_name"), "row_count", "items")
        for name, df in silver.items()
    ]
    return reduce(DataFrame.unionByName, rows)
