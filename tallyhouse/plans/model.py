"""All tables of the retail model, built on demand from the raw tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.operators.contracts import TableContract, conform
from tallyhouse.operators.joins import lookup
from tallyhouse.plans import marts, silver, tables
from tallyhouse.plans import preset as fixed
from tallyhouse.plans.preset import SAMPLE, RetailPreset
from tallyhouse.session import stage
from tallyhouse.sources import raw as raw_source


ALL_TABLES = frozenset(contract.name for contract in (*tables.SILVER, *tables.MARTS))


class RetailModel:
    """Lazy frames for every cleaned table and mart.

    By default nothing is written except by the rankings, and each question
    becomes one plan down to the raw scan, from which Spark removes the joins
    and columns the question does not need. Tables named in `staged` are written
    once to the shared folder and read from there: right for a table that one
    question uses twice, and for all of them in the quality suite.
    """

    def __init__(
        self, raw: Mapping[str, DataFrame], preset: RetailPreset | None = None, staged: Iterable[str] = ()
    ):
        self.raw = raw
        self.preset = preset or RetailPreset()
        self.staged = frozenset(staged)

    @classmethod
    def from_folder(
        cls, spark: SparkSession, folder: str, preset: RetailPreset = SAMPLE, staged: Iterable[str] = ()
    ) -> RetailModel:
        return cls(raw_source.RawTables(spark, folder, list(fixed.STATES)), preset, staged)

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return stage(df, name) if name in self.staged else df

    def _table(self, df: DataFrame, contract: TableContract) -> DataFrame:
        return self._kept(conform(df, contract), contract.name)

    @cached_property
    def products(self) -> DataFrame:
        return self._table(silver.clean_products(self.raw["products"], self.preset), tables.PRODUCTS)

    def products_of(self, keys: DataFrame) -> DataFrame:
        """The cleaned products whose product_id is in `keys`; the others leave the raw table before its dedup."""
        raw = self.raw["products"].join(keys.select("product_id"), "product_id", "left_semi")
        return conform(silver.clean_products(raw, self.preset), tables.PRODUCTS)

    @cached_property
    def customers(self) -> DataFrame:
        return self._table(silver.clean_customers(self.raw["customers"]), tables.CUSTOMERS)

    @property
    def _whole_sales(self) -> bool:
        """Whether sales are staged as they are, to be read alone: only if products are staged, too."""
        return {tables.SALES.name, tables.PRODUCTS.name} <= self.staged

    @cached_property
    def source_sales(self) -> DataFrame:
        """Sales without repeats; if they alone are staged, in these few columns, as all others are cheap to add again."""
        rows = silver.unique_sales(self.raw["sales"], self.preset)
        return rows if self._whole_sales else self._kept(rows, tables.SALES.name)

    @cached_property
    def sales(self) -> DataFrame:
        rows = conform(silver.clean_unique_sales(self.source_sales, self.products), tables.SALES)
        return self._kept(rows, tables.SALES.name) if self._whole_sales else rows

    @cached_property
    def competitor_prices(self) -> DataFrame:
        cleaned = silver.clean_competitor_prices(self.raw["competitor_prices"], self.products, self.preset)
        return self._table(cleaned, tables.COMPETITOR_PRICES)

    @cached_property
    def customer_segments_unranked(self) -> DataFrame:
        """Segments for questions that do not need the rank."""
        rows = marts.customer_segments(self.customers, self.sales, self.preset)
        return conform(rows, tables.CUSTOMER_SEGMENTS.without("revenue_rank"))

    @cached_property
    def customer_segments(self) -> DataFrame:
        return self._table(marts.rank_customers(self.customer_segments_unranked), tables.CUSTOMER_SEGMENTS)

    @cached_property
    def sales_time(self) -> DataFrame:
        return self._table(marts.sales_time(self.sales), tables.SALES_TIME)

    @cached_property
    def product_sales_unranked(self) -> DataFrame:
        """Product sales for questions that do not need the ranks."""
        rows = marts.product_sales(self.sales, self.products)
        return conform(rows, tables.PRODUCT_SALES.without("revenue_rank", "category_rank"))

    @cached_property
    def product_sales(self) -> DataFrame:
        return self._table(marts.rank_products(self.product_sales_unranked), tables.PRODUCT_SALES)

    def labelled_sales(self, sales: DataFrame, look: Callable[..., DataFrame] = lookup) -> DataFrame:
        """Sales with customer attributes and product labels, looked up by `look`."""
        ranked = tables.CUSTOMER_SEGMENTS.name in self.staged
        segments = self.customer_segments if ranked else self.customer_segments_unranked
        return marts.labelled_sales(sales, self.products, segments, look)

    @cached_property
    def sales_detail_rows(self) -> DataFrame:
        """The detail mart without the columns that `silver.derive_sale_columns` adds."""
        return self.labelled_sales(self.sales.drop(*silver.SALE_DERIVED) if self._whole_sales else self.source_sales)

    @cached_property
    def sales_detail(self) -> DataFrame:
        return self._table(silver.derive_sale_columns(self.sales_detail_rows), tables.SALES_DETAIL)

    @cached_property
    def price_position(self) -> DataFrame:
        rows = marts.price_position(self.products, self.competitor_prices, self.sales, self.preset)
        return self._table(rows, tables.PRICE_POSITION)

    @property
    def silver(self) -> dict[str, DataFrame]:
        return {
            "products": self.products,
            "customers": self.customers,
            "sales": self.sales,
            "competitor_prices": self.competitor_prices,
        }

    @property
    def unranked_marts(self) -> dict[str, DataFrame]:
        """The marts for checks that read no rank: nothing is sorted or written for them."""
        return {
            **{name: getattr(self, name) for name in ("sales_time", "sales_detail", "price_position")},
            "customer_segments": self.customer_segments_unranked,
            "product_sales": self.product_sales_unranked,
        }

    @property
    def marts(self) -> dict[str, DataFrame]:
        return {
            "customer_segments": self.customer_segments,
            "sales_time": self.sales_time,
            "product_sales": self.product_sales,
            "sales_detail": self.sales_detail,
            "price_position": self.price_position,
        }
