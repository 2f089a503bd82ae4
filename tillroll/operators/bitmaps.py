"""Exact distinct orders by bitmaps: an order id is a bit, so partial results are a few bitmaps
and not a row per (group, order), they merge by OR, and a year follows from its months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import join_dimension
from tillroll.operators.marts import RATING, cents, rounded_mean


def bit_columns(key: Column) -> dict[str, Column]:
    """Where a whole number has its bit: ``bucket`` (32,768 numbers each) and ``bit``."""
    return {"bucket": F.bitmap_bucket_number(key), "bit": F.bitmap_bit_position(key)}


def key_bitmaps(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """Per group and ``word`` (64 numbers) the bitmap of the keys, one whole number. A missing
    key has no bit.

    Combined map-side: a task sends at most one word for each group and 64 ids of the id range,
    and never more words than it has rows. So groups may be many and hold few ids each, where
    bitmaps of a whole bucket would be empty but for a few bits.
    """
    number = F.col(key).cast("bigint")
    return (
        rows.filter(F.col(key).isNotNull())
        .withColumns({"word": F.shiftright(number, 6), "bits": _bit(number)})
        .groupBy(*by, "word")
        .agg(F.bit_or("bits").alias("bits"))
    )


def _bit(number: Column) -> Column:
    """The bit of a whole number in its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))


def merged_bitmaps(bitmaps: DataFrame, *by: str) -> DataFrame:
    """Bitmaps of finer groups, or of several loads, as those of the groups ``by``."""
    return bitmaps.groupBy(*by, "word").agg(F.bit_or("bits").alias("bits"))


def distinct_keys(bitmaps: DataFrame, *by: str, name: str = "n") -> DataFrame:
    """Exact distinct keys per group ``by``, which may be coarser than that of the bitmaps."""
    merged = merged_bitmaps(bitmaps, *by)
    return merged.groupBy(*by).agg(F.sum(F.bit_count("bits")).alias(name))


def category_revenue(fact: DataFrame, products: DataFrame, **join: int) -> DataFrame:
    """The category view of ``marts.category_revenue`` with bitmaps in place of (category,
    order) pairs: one scan, one shuffle of (category, bucket) rows, then one row a category."""
    joined = join_dimension(
        fact.select(
            "product_id", "order_id", "quantity_ordered", "line_discounted_usd", "line_savings_usd"
        ),
        products.select("product_id", "category", F.col("avg_rating").cast(RATING).alias("rating")),
        "product_id",
        **join,
    )
    sums = ("quantity_ordered", "line_discounted_usd", "line_savings_usd", "rating")
    return (
        joined.withColumns(bit_columns(F.col("order_id")))
        .groupBy("category", "bucket")
        .agg(
            F.bitmap_construct_agg("bit").alias("bits"),
            F.count("rating").alias("rated"),
            *(F.sum(c).alias(c) for c in sums),
        )
        .groupBy("category")
        .agg(
            F.sum(F.bitmap_count("bits")).alias("total_orders"),
            F.sum("quantity_ordered").alias("units_sold"),
            cents(F.sum("line_discounted_usd")).alias("total_revenue_usd"),
            cents(F.sum("line_savings_usd")).alias("total_savings_usd"),
            rounded_mean(F.sum("rating"), F.sum("rated")).alias("avg_rating"),
        )
    )


def overview_kpis(fact: DataFrame) -> DataFrame:
    """``reports.overview_kpis`` with both distinct counts from bitmaps, in one scan: every
    line sets one bit for its order and one for its product."""
    kinds = F.explode(
        F.array(
            F.struct(F.lit("order").alias("kind"), F.col("order_id").alias("key"), F.lit(1).alias("one")),
            F.struct(F.lit("product").alias("kind"), F.col("product_id").alias("key"), F.lit(0).alias("one")),
        )
    )
    line = F.col("k.one") == 1
    return (
        fact.select("line_total_usd", "discount_pct", kinds.alias("k"))
        .withColumns(bit_columns(F.col("k.key")))
        .groupBy("k.kind", "bucket")
        .agg(
            F.bitmap_construct_agg("bit").alias("bits"),
            F.sum(F.when(line, F.col("line_total_usd"))).alias("gross"),
            F.sum(F.when(line, F.col("discount_pct"))).alias("discount"),
            F.count(F.when(line, F.col("discount_pct"))).alias("discounts"),
        )
        .agg(
            F.coalesce(F.sum(F.when(F.col("kind") == "order", F.bitmap_count("bits"))), F.lit(0)).alias("total_orders"),
            F.coalesce(F.sum(F.when(F.col("kind") == "product", F.bitmap_count("bits"))), F.lit(0)).alias("total_products"),
            cents(F.sum("gross")).alias("total_revenue"),
            rounded_mean(F.sum("discount"), F.sum("discounts"), 1).alias("avg_discount_pct"),
        )
    )
