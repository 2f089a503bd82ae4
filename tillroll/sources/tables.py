"""Catalog tables by logical name, SQL text, and reuse of results."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Tables of the warehouse schema.
SOURCES = ("fact_orders", "dim_products", "ml_predictions")


class Warehouse:
    """The star schema of one catalog database."""

    def __init__(self, spark: SparkSession, database: str = "analytics") -> None:
        self.spark, self.database = spark, database

    def name(self, table: str) -> str:
        if table not in SOURCES:
            raise KeyError(f"unknown source table: {table}")
        return f"{self.database}.{table}"

    def source(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))


def run_query(
    spark: SparkSession, sql: str, args: dict[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """SQL text to DataFrame. Values go in as ``:name`` markers, frames as ``{name}``;
    neither is spliced into the text."""
    return spark.sql(sql, args=args, **frames)


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a result for several uses within a block, and drop it after."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
