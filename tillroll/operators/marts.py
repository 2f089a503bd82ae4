"""Aggregates over the star schema.

Sums over the fact are first taken per product. That step combines map-side, so a product
with a third of all order lines costs one row per map task, and what then meets the
dimension has one row per product on both sides. Money is summed as decimal and turned
into DOUBLE in the last projection only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import numbers as num
from tillroll.functions import rules
from tillroll.operators.joins import join_dimension


#: Ratings are added as decimals, so that no order of adding changes the last digit.
RATING = "decimal(18,6)"


def cents(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")


def rounded_mean(total: Column, n: Column, digits: int = 2) -> Column:
    return F.round(num.mean(total, n), digits)


def sales_per_product(fact: DataFrame) -> DataFrame:
    """One row per product (a missing product id is a row too)."""
    return fact.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("order_id").alias("lines"),
        F.sum("quantity_ordered").alias("units"),
        F.count("quantity_ordered").alias("quantities"),
        F.sum("line_total_usd").alias("gross"),
        F.sum("line_discounted_usd").alias("net"),
        F.sum("line_savings_usd").alias("saved"),
    )


def revenue_by_category(products: DataFrame) -> DataFrame:
    """Catalogue value per category. ``total_stock_value_usd`` sums unit prices: stock on
    hand is not a factor in it."""
    return (
        products.groupBy("category")
        .agg(
            F.count("product_id").alias("total_products"),
            cents(F.sum("actual_price_usd")).alias("total_stock_value_usd"),
            rounded_mean(F.sum("actual_price_usd"), F.count("actual_price_usd")).alias(
                "avg_price_usd"
            ),
            rounded_mean(
                F.sum(F.col("avg_rating").cast(RATING)), F.count("avg_rating")
            ).alias("avg_rating"),
            F.sum("stock_quantity").alias("total_units_in_stock"),
        )
        .orderBy(F.desc_nulls_last("total_stock_value_usd"), F.asc_nulls_last("category"))
    )


def dead_inventory(products: DataFrame) -> DataFrame:
    """Much stock, poor rating (no rating does not count as poor), most money first."""
    return (
        products.filter(rules.is_dead_stock(F.col("stock_quantity"), F.col("avg_rating")))
        .withColumn("at_risk", num.stock_value(F.col("stock_quantity"), F.col("actual_price_usd")))
        .orderBy(F.desc_nulls_last("at_risk"), F.asc_nulls_last("product_id"))
        .select(
            "product_name",
            "category",
            "stock_quantity",
            "avg_rating",
            F.col("actual_price_usd").cast("double").alias("actual_price_usd"),
            F.col("at_risk").cast("double").alias("stock_value_at_risk_usd"),
        )
    )


def discount_impact(products: DataFrame) -> DataFrame:
    """List price minus net price over the catalogue, per category.
    ``products_discounted`` counts every product, also those without a discount."""
    return (
        products.groupBy("category")
        .agg(
            rounded_mean(F.sum("discount_pct"), F.count("discount_pct")).alias("avg_discount_pct"),
            cents(F.sum("price_usd") - F.sum("actual_price_usd")).alias("total_revenue_lost_usd"),
            F.count("product_id").alias("products_discounted"),
        )
        .orderBy(F.desc_nulls_last("total_revenue_lost_usd"), F.asc_nulls_last("category"))
    )


def order_analysis(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Order revenue per product category; lines without a known product form the group
    with category NULL. ``avg_qty_per_order`` is per order line."""
    per_product = sales_per_product(fact)
    return (
        per_product.join(products.select("product_id", "category"), "product_id", "left")
        .groupBy("category")
        .agg(
            F.sum("lines").alias("total_order_lines"),
            cents(F.sum("net")).alias("total_revenue_usd"),
            rounded_mean(F.sum("units"), F.sum("quantities")).alias("avg_qty_per_order"),
            cents(F.sum("saved")).alias("total_customer_savings_usd"),
        )
        .orderBy(F.desc_nulls_last("total_revenue_usd"), F.asc_nulls_last("category"))
    )


def per_category(
    fact: DataFrame, products: DataFrame, measures: dict[str, Column], **join: int
) -> DataFrame:
    """Per category the sums of ``measures`` (expressions over a line and its product) and
    ``orders``, the number of distinct orders, in one pass over the lines.

    Lines meet the dimension by a join that splits hot products. Sums are then taken by
    category and order, which splits hot categories as well, and added up per category.
    """
    joined = join_dimension(
        fact.select(
            "product_id",
            "order_id",
            "quantity_ordered",
            "line_total_usd",
            "line_discounted_usd",
            "line_savings_usd",
        ),
        products.select(
            "product_id",
            "category",
            "price_usd",
            F.col("discount_pct").alias("product_discount"),
            F.col("avg_rating").cast(RATING).alias("rating"),
        ),
        "product_id",
        **join,
    )
    return (
        joined.select("category", "order_id", *(e.alias(name) for name, e in measures.items()))
        .groupBy("category", "order_id")
        .agg(*(F.sum(name).alias(name) for name in measures))
        .groupBy("category")
        .agg(F.count("order_id").alias("orders"), *(F.sum(name).alias(name) for name in measures))
    )


def category_revenue(fact: DataFrame, products: DataFrame, **join: int) -> DataFrame:
    """Distinct orders, units, net revenue, savings and line-weighted rating per category,
    over lines with a known product."""
    measures = {
        "units": F.col("quantity_ordered"),
        "net": F.col("line_discounted_usd"),
        "saved": F.col("line_savings_usd"),
        "stars": F.col("rating"),
        "rated": F.col("rating").isNotNull().cast("long"),
    }
    return per_category(fact, products, measures, **join).select(
        "category",
        F.col("orders").alias("total_orders"),
        F.col("units").alias("units_sold"),
        cents(F.col("net")).alias("total_revenue_usd"),
        cents(F.col("saved")).alias("total_savings_usd"),
        rounded_mean(F.col("stars"), F.col("rated")).alias("avg_rating"),
    )


def product_performance(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Units and net revenue per product, unsold products with 0. Grouped by the six
    attributes and not by id: products equal in all six are one row."""
    attributes = [
        "product_name",
        "category",
        "brand",
        "avg_rating",
        "stock_quantity",
        "actual_price_usd",
    ]
    return (
        products.select("product_id", *attributes)
        .join(sales_per_product(fact).select("product_id", "units", "net"), "product_id", "left")
        .groupBy(*attributes)
        .agg(
            F.coalesce(F.sum("units"), F.lit(0)).alias("units_sold"),
            cents(F.coalesce(F.sum("net"), F.lit(0))).alias("revenue_usd"),
        )
        .withColumn("actual_price_usd", F.col("actual_price_usd").cast("double"))
    )


def prediction_quality(predictions: DataFrame) -> DataFrame:
    """Stored predictions with signed error, percent error and accuracy band."""
    predicted, actual = F.col("predicted_units"), F.col("actual_units")
    return predictions.select(
        "product_id",
        "category",
        "predicted_units",
        "actual_units",
        "run_date",
        "mae",
        "r2_score",
        rules.prediction_error(predicted, actual).alias("prediction_error"),
        rules.pct_error(predicted, actual).alias("pct_error"),
        rules.accuracy_band(predicted, actual).alias("accuracy_band"),
    )
