"""Raw product documents -> the product dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import numbers as num
from tillroll.operators.dedup import first_per_key

# Source field -> column of the product dimension.
PRODUCT_COLUMNS = {
    "id": "product_id",
    "title": "product_name",
    "category": "category",
    "price": "price_usd",
    "discountPercentage": "discount_pct",
    "rating": "avg_rating",
    "stock": "stock_quantity",
    "brand": "brand",
}


def pick_product_fields(raw: DataFrame) -> DataFrame:
    """The eight fields in use, renamed. A field the input lacks raises on analysis."""
    keep = [*PRODUCT_COLUMNS, *(c for c in raw.columns if c == "ingest_pos")]
    return raw.select(*keep).withColumnsRenamed(PRODUCT_COLUMNS)


def coerce_product_numbers(products: DataFrame) -> DataFrame:
    """Text to numbers; what is no number becomes NULL instead of failing the job."""
    return products.withColumns(
        {
            "price_usd": num.parse_rate(F.col("price_usd")),
            "discount_pct": num.parse_rate(F.col("discount_pct")),
            "avg_rating": num.parse_double(F.col("avg_rating")),
            "stock_quantity": num.parse_whole(F.col("stock_quantity")),
        }
    )


def fill_product_gaps(products: DataFrame) -> DataFrame:
    """Price, discount and stock default to 0, the brand to 'Unknown'. The rating stays
    NULL (no rating is not a bad rating), and so do name and category."""
    return products.withColumns(
        {
            "price_usd": num.or_zero(F.col("price_usd")),
            "discount_pct": num.or_zero(F.col("discount_pct")),
            "stock_quantity": num.or_zero(F.col("stock_quantity")).cast("bigint"),
            "brand": F.coalesce("brand", F.lit("Unknown")),
        }
    )


def add_net_price(products: DataFrame) -> DataFrame:
    return products.withColumn(
        "actual_price_usd", num.net_price(F.col("price_usd"), F.col("discount_pct"))
    )


def clean_products(raw: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The whole cleaning step; empty input gives an empty frame with the full schema.

    ``ingest_pos`` says which of several rows of one product came first; it must be there.
    """
    picked = pick_product_fields(raw)
    if "ingest_pos" not in picked.columns:
        raise ValueError("raw products need ingest_pos, their arrival position")
    unique = first_per_key(picked, "product_id", "ingest_pos").drop("ingest_pos")
    cleaned = add_net_price(fill_product_gaps(coerce_product_numbers(unique)))
    return cleaned.withColumn("processed_at", F.current_timestamp() if run_ts is None else run_ts)
