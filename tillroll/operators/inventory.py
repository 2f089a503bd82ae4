"""Stock listings, counts and distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import rules


def inventory_listing(products: DataFrame) -> DataFrame:
    """All products, emptiest shelf first. The product id as second key also lets the
    range sort cut through a stock level that very many products share."""
    return products.select(
        "product_id",
        "product_name",
        "category",
        "brand",
        "stock_quantity",
        F.col("price_usd").cast("double").alias("price_usd"),
        "avg_rating",
    ).orderBy(F.asc_nulls_last("stock_quantity"), F.asc_nulls_last("product_id"))


def out_of_stock(products: DataFrame) -> DataFrame:
    return inventory_listing(products.filter(rules.is_out_of_stock(F.col("stock_quantity"))))


def low_stock(products: DataFrame) -> DataFrame:
    """Nearly empty shelves; empty ones have a list of their own."""
    stock = F.col("stock_quantity")
    return inventory_listing(products.filter((stock > 0) & rules.is_low_stock(stock)))


def inventory_counts(products: DataFrame) -> DataFrame:
    """One row. ``low_stock`` includes the empty shelves."""
    stock = F.col("stock_quantity")
    return products.agg(
        F.count_if(rules.is_out_of_stock(stock)).alias("out_of_stock"),
        F.count_if(rules.is_low_stock(stock)).alias("low_stock"),
        F.count_if(~rules.is_low_stock(stock)).alias("healthy_stock"),
    )


def stock_histogram(products: DataFrame, bins: int = 30) -> DataFrame:
    """Number of products in ``bins`` equal steps from the smallest to the largest stock;
    steps without products are left out. Grouping by stock level first keeps the work
    behind it independent of the number of products."""
    levels = (
        products.filter(F.col("stock_quantity").isNotNull())
        .groupBy("stock_quantity")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ends = levels.agg(
        F.struct(
            F.min("stock_quantity").alias("low"), (F.max("stock_quantity") + 1).alias("high")
        ).alias("ends")
    )
    step = F.width_bucket(
        F.col("stock_quantity").cast("double"),
        F.col("ends.low").cast("double"),
        F.col("ends.high").cast("double"),
        F.lit(bins),
    )
    return (
        levels.withColumn("ends", ends.scalar())
        .groupBy(step.cast("bigint").alias("bin"))
        .agg(
            F.min("stock_quantity").alias("min_stock"),
            F.max("stock_quantity").alias("max_stock"),
            F.sum("n").alias("products"),
        )
        .orderBy("bin")
    )
