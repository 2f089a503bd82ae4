"""The four marts over the newest clean snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import marts
from tillroll.schemas import DIM_PRODUCTS, FACT_ORDERS
from tillroll.sinks.files import write_marts
from tillroll.sources.snapshots import read_latest


def build_marts(fact: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    return {
        "revenue_by_category": marts.revenue_by_category(products),
        "dead_inventory": marts.dead_inventory(products),
        "discount_impact": marts.discount_impact(products),
        "order_analysis": marts.order_analysis(fact, products),
    }


def run_analytics(
    spark: SparkSession, processed: str, output: str, fmt: str = "csv"
) -> dict[str, str]:
    products = read_latest(spark, processed, "products_clean", DIM_PRODUCTS)
    fact = read_latest(spark, processed, "orders_clean", FACT_ORDERS)
    return write_marts(build_marts(fact, products), output, fmt)
