"""Data tests: each returns the failing rows, so an empty frame means passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import join_dimension


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number; missing values are no value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def is_missing(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphans(fact: DataFrame, dim: DataFrame, key: str, **join: int) -> DataFrame:
    """Fact rows whose key is not in the dimension, those without a key included."""
    return join_dimension(fact, dim.select(key), key, "left_anti", **join)


def checked(df: DataFrame, relation: str, unique: str | None, not_null: list[str]) -> DataFrame:
    """Failing rows per declared test of one relation (``unique``: values that repeat), in
    one pass: rows are counted by the unique column, gaps along with them."""
    gaps = [F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(not_null)]
    names = [f"_{i}" for i in range(len(not_null))]
    if unique:
        repeats = (F.col(unique).isNotNull() & (F.col("_n") > 1)).cast("long")
        df = df.groupBy(unique).agg(F.count(F.lit(1)).alias("_n"), *gaps)
        gaps = [F.sum(repeats).alias("_u"), *(F.sum(n).alias(n) for n in names)]
    tests = [("unique", unique, "_u")] if unique else []
    tests += [("not_null", c, n) for c, n in zip(not_null, names, strict=True)]
    rows = [
        F.struct(
            F.lit(test).alias("test"),
            F.lit(relation).alias("relation"),
            F.lit(column).alias("column_name"),
            F.coalesce(F.col(value), F.lit(0)).alias("failures"),
        )
        for test, column, value in tests
    ]
    return df.agg(*gaps).select(F.inline(F.array(*rows)))


def run_checks(
    products: DataFrame, category_revenue: DataFrame, product_performance: DataFrame
) -> DataFrame:
    """The declared tests of the star schema and its views: failing rows per test, one pass
    over each relation."""
    return (
        checked(products, "dim_products", "product_id", ["product_id"])
        .unionByName(
            checked(category_revenue, "category_revenue", "category", ["category", "total_revenue_usd"])
        )
        .unionByName(checked(product_performance, "product_performance", None, ["product_name"]))
    )
