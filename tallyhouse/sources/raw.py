"""The four raw tables, derived from the sample star schema.

Every expression is deterministic, so an independent engine can derive the same
rows. Every row of the given tables is used. The defects a real source has are
built into values or into added rows: repeated sales, exact or with differing
content, exact copies, stray spaces, honorifics, lower-case state codes, sales
of products that are not in the catalogue, customers without a sale, sales dated
before the product was created, implausibly low competitor prices.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One exact copy is added to the rows that meet the condition.
_COPIES = "explode(sequence(1, if({}, 2, 1))) AS copy"


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    sold = items.join(orders, items.l_orderkey == orders.o_orderkey)
    # A repeated sale is an exact copy (copy 0 again) or a later version with one item more.
    repeated = sold.withColumn(
        "copy", F.expr("explode(CASE l_orderkey % 16 WHEN 0 THEN array(0, 0) WHEN 8 THEN array(0, 1) ELSE array(0) END)")
    )
    return repeated.selectExpr(
        # The first two columns are no key of the sample table, and neither are the first four.
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity AS bigint),"
        " datediff(l_shipdate, DATE '1990-01-01')) AS sale_id",
        "cast(o_orderdate + make_dt_interval(0, cast((l_orderkey * 7 + l_linenumber * 5) % 24 AS int)) AS timestamp)"
        " AS sold_at",
        "cast(if(o_custkey % 50 = 49, o_custkey - 1, o_custkey) AS string) AS customer_id",
        "concat(if(l_partkey % 200 = 199, 'X', ''), l_partkey) AS product_id",
        "if(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), 'ecommerce', 'loja_fisica') AS channel",
        "cast(l_quantity AS bigint) + copy AS quantity",
        "cast(cast(round(l_extendedprice * 100) AS bigint) div cast(l_quantity AS bigint) AS decimal(12,0)) * 0.01"
        " AS unit_price",
        # Total order inside one repeated sale: the first version is kept.
        "copy AS source_version",
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    part = spark.read.parquet(f"{folder}/part.parquet")
    return part.selectExpr(
        "cast(p_partkey AS string) AS product_id",
        "concat(if(p_partkey % 3 = 0, ' ', ''), p_name) AS product_name",
        "p_type AS category",
        "p_brand AS brand",
        "cast(cast(round(p_retailprice * 100) AS bigint) AS decimal(12,0)) * 0.01 AS current_price",
        "cast(date_add(DATE '1995-01-01', cast(p_partkey * 37 % 1200 AS int)) AS timestamp) AS created_at",
        _COPIES.format("p_partkey % 25 = 0"),
    ).drop("copy")


def raw_customers(spark: SparkSession, folder: str, state_codes: Sequence[str]) -> DataFrame:
    codes = ", ".join(f"'{code}'" for code in state_codes)
    customer = spark.read.parquet(f"{folder}/customer.parquet").selectExpr(
        "*", f"array({codes})[cast(c_custkey % {len(state_codes)} AS int)] AS code"
    )
    return customer.selectExpr(
        "cast(c_custkey AS string) AS customer_id",
        "concat(coalesce(get(array('Sr. ', 'Sra. ', 'Srta. ', 'Dr. ', 'Dra. '), cast(c_custkey % 7 AS int)), ''), c_name)"
        " AS customer_name",
        "concat(if(c_custkey % 5 = 0, ' ', ''), if(c_custkey % 2 = 0, lower(code), code), if(c_custkey % 5 = 0, ' ', ''))"
        " AS state",
        "'Brasil' AS country",
        "date_add(DATE '1994-01-01', cast(c_custkey % 365 AS int)) AS registered_on",
        "c_nationkey AS nation_key",
        _COPIES.format("c_custkey % 10 = 0"),
    ).drop("copy")


def raw_competitor_prices(spark: SparkSession, folder: str) -> DataFrame:
    part = spark.read.parquet(f"{folder}/part.parquet")
    offers = part.selectExpr("p_partkey", "p_retailprice", "explode(sequence(0, 3)) AS k")
    priced = offers.selectExpr(
        "*",
        "cast(cast(round(p_retailprice * 100) AS bigint) AS decimal(12,0)) * 0.01 AS own_price",
        """CASE p_partkey div 4 % 7 WHEN 0 THEN 100 WHEN 1 THEN 115 + 5 * k WHEN 2 THEN 70 + 5 * k
           ELSE 55 + (p_partkey * 31 + 17 * k) % 70 END AS percent""",
    )
    return priced.selectExpr(
        "cast(p_partkey AS string) AS product_id",
        "array('Competitor A', 'Competitor B', 'Competitor C', 'Competitor D')[k] AS competitor",
        "cast(own_price * cast(percent AS decimal(3,0)) * 0.01 AS decimal(10,2)) AS competitor_price",
        "concat('2001-08-01 ', lpad(cast(p_partkey % 24 AS string), 2, '0'), ':00:00') AS collected_at",
        _COPIES.format("p_partkey % 40 = 0"),
    ).drop("copy")


def raw_states_by_nation(spark: SparkSession, folder: str) -> DataFrame:
    """A lookup table (nation_key, nation_name, region) for the table-driven geography variant."""
    nation = spark.read.parquet(f"{folder}/nation.parquet")
    region = spark.read.parquet(f"{folder}/region.parquet")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").selectExpr(
        "n_nationkey AS nation_key", "n_name AS nation_name", "r_name AS region"
    )


class RawTables(Mapping[str, DataFrame]):
    """The raw tables of a folder, each opened when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str, state_codes: Sequence[str]):
        self._open = {
            "sales": lambda: raw_sales(spark, folder),
            "products": lambda: raw_products(spark, folder),
            "customers": lambda: raw_customers(spark, folder, state_codes),
            "competitor_prices": lambda: raw_competitor_prices(spark, folder),
        }
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._open[name]()
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._open)

    def __len__(self) -> int:
        return len(self._open)
