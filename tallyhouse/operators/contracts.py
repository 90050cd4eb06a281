"""Declared tables: columns, types, comments, grain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: DataType
    comment: str
    additive: bool = True


@dataclass(frozen=True)
class TableContract:
    name: str
    comment: str
    grain: tuple[str, ...]
    columns: tuple[ColumnSpec, ...]

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c.name, c.type, True, {"comment": c.comment}) for c in self.columns])

    def without(self, *names: str) -> TableContract:
        return replace(self, columns=tuple(c for c in self.columns if c.name not in names))

    @property
    def non_additive(self) -> frozenset[str]:
        """Columns whose values must not be summed over rows."""
        return frozenset(c.name for c in self.columns if not c.additive)


def conform(df: DataFrame, contract: TableContract) -> DataFrame:
    """Select, cast and document exactly the contract's columns in one projection."""
    return df.to(contract.schema)


_COLUMNS = "table_name string, column_name string, data_type string, comment string"


def frame_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_type, comment) of frames; reads schemas only."""
    rows = [
        (name, field.name, field.dataType.simpleString(), (field.metadata or {}).get("comment"))
        for name, df in tables.items()
        for field in df.schema.fields
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def catalog_columns(spark: SparkSession, database: str, internal_prefix: str = "__") -> DataFrame:
    """The same for the published tables of a database as the catalog has them, leaving out internal ones."""
    rows = [
        (table.name, column.name, column.dataType, column.description)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary and not table.name.startswith(internal_prefix)
        for column in spark.catalog.listColumns(f"{database}.{table.name}")
    ]
    return spark.createDataFrame(rows, _COLUMNS)


def is_documented() -> Column:
    return F.trim(F.coalesce(F.col("comment"), F.lit(""))) != ""
