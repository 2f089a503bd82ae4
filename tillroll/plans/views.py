"""The derived views: stored queries, evaluated when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators import marts


def view_definitions(
    fact: DataFrame, products: DataFrame, predictions: DataFrame
) -> dict[str, DataFrame]:
    return {
        "category_revenue": marts.category_revenue(fact, products),
        "product_performance": marts.product_performance(fact, products),
        "prediction_quality": marts.prediction_quality(predictions),
    }


def create_views(fact: DataFrame, products: DataFrame, predictions: DataFrame) -> list[str]:
    """Register the three views in the session; returns their names."""
    views = view_definitions(fact, products, predictions)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
