"""KPI, category and prediction reports over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import rules
from tillroll.operators.marts import (
    cents,
    per_category,
    rounded_mean,
    sales_per_product,
)


def overview_kpis(fact: DataFrame) -> DataFrame:
    """One row. Both distinct counts are combined map-side before they are shuffled."""
    return fact.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("product_id").alias("total_products"),
        cents(F.sum("line_total_usd")).alias("total_revenue"),
        rounded_mean(F.sum("discount_pct"), F.count("discount_pct"), 1).alias("avg_discount_pct"),
    )


def formatted_kpis(kpis: DataFrame) -> DataFrame:
    """The KPI row as display text."""
    return kpis.select(
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("total_products").cast("bigint").alias("total_products"),
        rules.usd_label(F.col("total_revenue")).alias("total_revenue"),
        rules.pct_label(F.col("avg_discount_pct")).alias("avg_discount"),
    )


def revenue_by_category_report(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Gross revenue per category, over lines with a known product."""
    return (
        sales_per_product(fact)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(cents(F.sum("gross")).alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("category"))
    )


def category_breakdown(fact: DataFrame, products: DataFrame, **join: int) -> DataFrame:
    """Orders, units, gross revenue and line-weighted averages per category, over lines
    with a known product. A missing price, discount or rating counts as 0 in its average."""

    measures = {
        "rows": F.lit(1),
        "units": F.col("quantity_ordered"),
        "gross": F.col("line_total_usd"),
        "price": F.col("price_usd"),
        "discount": F.col("product_discount"),
        "stars": F.col("rating"),
    }
    rows = F.col("rows")
    return (
        per_category(fact, products, measures, **join)
        .select(
            "category",
            "orders",
            F.col("units").alias("units_sold"),
            cents(F.col("gross")).alias("revenue"),
            rounded_mean(F.coalesce("price", F.lit(0)), rows).alias("avg_price"),
            rounded_mean(F.coalesce("discount", F.lit(0)), rows, 1).alias("avg_discount"),
            rounded_mean(F.coalesce("stars", F.lit(0)), rows).alias("avg_rating"),
        )
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("category"))
    )


def category_totals(breakdown: DataFrame) -> DataFrame:
    """One row over the category breakdown; revenues are added as already rounded."""
    revenue = F.sum(F.col("revenue").cast("decimal(38,2)"))
    return breakdown.agg(
        F.count(F.lit(1)).alias("total_categories"),
        revenue.cast("double").alias("total_revenue"),
        F.sum("units_sold").cast("bigint").alias("total_units_sold"),
        rules.usd_label(revenue).alias("total_revenue_label"),
    )


def units_by_category(breakdown: DataFrame) -> DataFrame:
    """The breakdown in display order, fewest units first."""
    return breakdown.orderBy(F.asc_nulls_last("units_sold"), F.asc_nulls_last("category"))


def prediction_by_category(predictions: DataFrame) -> DataFrame:
    predicted, actual = F.col("predicted_units"), F.col("actual_units")
    return (
        predictions.groupBy("category")
        .agg(
            F.round(F.avg(predicted), 2).alias("avg_predicted"),
            F.round(F.avg(actual), 2).alias("avg_actual"),
            F.round(F.avg(F.abs(predicted - actual)), 2).alias("avg_error"),
            F.count(F.lit(1)).alias("product_count"),
        )
        .orderBy(F.desc_nulls_last("avg_predicted"), F.asc_nulls_last("category"))
    )


def error_by_category(by_category: DataFrame) -> DataFrame:
    """The per-category report in display order, smallest error first."""
    return by_category.orderBy(F.asc_nulls_last("avg_error"), F.asc_nulls_last("category"))


def prediction_metrics(predictions: DataFrame) -> DataFrame:
    """Run metrics stored with the predictions, and the number of category groups (a
    missing category is a group)."""
    no_category = F.coalesce(F.max(F.col("category").isNull().cast("int")), F.lit(0))
    return predictions.agg(
        F.round(F.avg("mae"), 4).alias("mae"),
        F.round(F.avg("r2_score"), 4).alias("r2"),
        (F.count_distinct("category") + no_category).alias("categories"),
    )


def accuracy_bands(predictions: DataFrame) -> DataFrame:
    band = rules.accuracy_band(F.col("predicted_units"), F.col("actual_units"))
    return predictions.groupBy(band.alias("accuracy_band")).agg(
        F.count(F.lit(1)).alias("products")
    )
