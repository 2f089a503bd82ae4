"""Nested carts -> one fact row per cart line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import numbers as num
from tillroll.schemas import MONEY, RATE


def explode_carts(carts: DataFrame) -> DataFrame:
    """One row per element of ``products``, the cart header repeated. A cart whose array
    is empty or missing gives no row. Values are still raw."""
    return carts.select(
        F.col("id").alias("order_id"),
        F.col("userId").alias("user_id"),
        F.col("total").alias("order_total_usd"),
        F.col("discountedTotal").alias("order_discounted_usd"),
        F.col("totalProducts").alias("order_total_products"),
        F.col("totalQuantity").alias("order_total_quantity"),
        F.explode("products").alias("line"),
    ).select(
        "order_id",
        "user_id",
        "order_total_usd",
        "order_discounted_usd",
        "order_total_products",
        "order_total_quantity",
        F.col("line.id").alias("product_id"),
        F.col("line.title").alias("product_name"),
        F.col("line.price").alias("unit_price_usd"),
        F.col("line.quantity").alias("quantity_ordered"),
        F.col("line.total").alias("line_total_usd"),
        F.col("line.discountPercentage").alias("discount_pct"),
        F.col("line.discountedTotal").alias("line_discounted_usd"),
    )


def coerce_line_numbers(lines: DataFrame) -> DataFrame:
    """Seven numeric columns: parsed, gaps set to 0, the five money columns in cents.
    Keys and header counters are left as they came."""

    def cents(name: str) -> Column:
        return num.or_zero(num.parse_money(F.col(name))).cast(MONEY)

    return lines.withColumns(
        {
            "order_total_usd": cents("order_total_usd"),
            "order_discounted_usd": cents("order_discounted_usd"),
            "unit_price_usd": cents("unit_price_usd"),
            "line_total_usd": cents("line_total_usd"),
            "line_discounted_usd": cents("line_discounted_usd"),
            "quantity_ordered": num.or_zero(num.parse_whole(F.col("quantity_ordered"))).cast(
                "bigint"
            ),
            "discount_pct": num.or_zero(num.parse_rate(F.col("discount_pct"))).cast(RATE),
        }
    )


def flatten_order_lines(carts: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The fact table. No shuffle: explode and arithmetic stay in the scan stage."""
    lines = coerce_line_numbers(explode_carts(carts))
    return lines.withColumn(
        "line_savings_usd", num.line_saving(F.col("line_total_usd"), F.col("line_discounted_usd"))
    ).withColumn("processed_at", F.current_timestamp() if run_ts is None else run_ts)
