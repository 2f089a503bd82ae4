from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions import rules
from tillroll.operators import inventory, lookup, marts, quality, reports
from tillroll.operators.evaluation import regression_metrics
from tillroll.schemas import DIM_PRODUCTS, ML_PREDICTIONS


def products(spark, *rows):
    base = dict(
        product_id=1,
        product_name="lamp",
        category="home",
        price_usd=None,
        discount_pct=None,
        avg_rating=3.0,
        stock_quantity=10,
        brand="b",
        actual_price_usd=None,
        processed_at=None,
    )
    data = [tuple({**base, **row}.values()) for row in rows]
    return spark.createDataFrame(data, DIM_PRODUCTS)


def predictions(spark, *pairs):
    data = [(i, "c", p, a, date(2025, 1, 1), 1.0, 0.5) for i, (p, a) in enumerate(pairs)]
    return spark.createDataFrame(data, ML_PREDICTIONS)


@pytest.mark.parametrize(
    "predicted, actual, error, pct, band",
    [
        (15.0, 10, 5.0, 50.0, "excellent"),
        (5.0, 20, -15.0, -75.0, "good"),
        (25.01, 10, 15.01, 150.1, "needs_review"),
        (3.0, 0, 3.0, None, "excellent"),
        (None, 4, None, None, "needs_review"),
    ],
)
def test_prediction_rules(spark, predicted, actual, error, pct, band):
    row = marts.prediction_quality(predictions(spark, (predicted, actual))).first()
    assert (row.prediction_error, row.pct_error, row.accuracy_band) == (error, pct, band)


def test_flags_count_unknown_as_zero(spark):
    df = spark.createDataFrame([(None,), (4.5,), (4.4,)], "r double")
    flags = df.select(rules.flag(F.col("r") >= rules.HIGH_RATING_FROM).alias("f")).collect()
    assert [r.f for r in flags] == [0, 1, 0]


def test_stock_rules_at_their_limits(spark):
    stocks = [0, 9, 10, 50, 51]
    dim = products(spark, *[dict(product_id=i, stock_quantity=s) for i, s in enumerate(stocks)])
    assert inventory.out_of_stock(dim).count() == 1
    assert [r.stock_quantity for r in inventory.low_stock(dim).collect()] == [9]
    assert tuple(inventory.inventory_counts(dim).first()) == (1, 2, 3)


def test_dead_inventory_limits(spark):
    dim = products(
        spark,
        dict(product_id=1, stock_quantity=51, avg_rating=3.4),
        dict(product_id=2, stock_quantity=50, avg_rating=3.4),
        dict(product_id=3, stock_quantity=51, avg_rating=3.5),
        dict(product_id=4, stock_quantity=51, avg_rating=None),
    )
    assert marts.dead_inventory(dim).count() == 1


def test_missing_category_is_a_group(spark):
    dim = products(spark, dict(category=None), dict(product_id=2))
    assert {r.category for r in marts.revenue_by_category(dim).collect()} == {None, "home"}
    assert quality.is_missing(marts.revenue_by_category(dim), "category").count() == 1


@pytest.mark.parametrize(
    "text, ids",
    [
        ("o'n", [1]),
        ("50%", [2]),
        ("_", [3]),
        ("42", [42]),
        ("LAMP", [1, 2]),
        ("", []),
        ("nothing", []),
    ],
)
def test_search_is_literal(spark, text, ids):
    dim = products(
        spark,
        dict(product_id=1, product_name="o'nix lamp"),
        dict(product_id=2, product_name="50% Lamp"),
        dict(product_id=3, product_name="a_b"),
        dict(product_id=42, product_name="desk"),
    )
    assert [r.product_id for r in lookup.search_products(dim, text).collect()] == ids


def test_search_with_wildcards(spark):
    dim = products(spark, dict(product_name="red lamp"), dict(product_id=2, product_name="redo\\"))
    hits = lookup.search_products(dim, "r_d%p", wildcards=True).collect()
    assert [r.product_id for r in hits] == [1]
    assert lookup.search_products(dim, "o\\", wildcards=True).count() == 1


def test_metrics_of_no_variation(spark):
    row = regression_metrics(predictions(spark, (1.0, 2), (3.0, 2)), "predicted_units", "actual_units")
    assert tuple(row.first()) == (1.0, None)


def test_prediction_metrics_count_missing_category(spark):
    df = predictions(spark, (1.0, 1), (2.0, 2)).withColumn(
        "category", F.when(F.col("product_id") == 0, "x")
    )
    assert reports.prediction_metrics(df).first().categories == 2


def test_product_performance_merges_equal_attributes(spark):
    dim = products(spark, {}, dict(product_id=2))
    fact = spark.createDataFrame(
        [], "order_id long, product_id long, quantity_ordered long, line_total_usd decimal(18,2), "
        "line_discounted_usd decimal(18,2), line_savings_usd decimal(18,2)"
    )
    rows = marts.product_performance(fact, dim).collect()
    assert [(r.units_sold, r.revenue_usd) for r in rows] == [(0, 0.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(0, 60), st.integers(0, 60)), max_size=15))
def test_bands_add_up_to_all_rows(spark, pairs):
    bands = reports.accuracy_bands(predictions(spark, *pairs)).collect()
    assert sum(r.products for r in bands) == len(pairs)


def test_histogram_covers_all_products(spark):
    dim = products(spark, *[dict(product_id=i, stock_quantity=i % 37) for i in range(200)])
    rows = inventory.stock_histogram(dim, bins=10).collect()
    assert sum(r.products for r in rows) == 200
    assert [r.bin for r in rows] == list(range(1, 11))
    assert inventory.stock_histogram(dim.limit(0)).count() == 0
