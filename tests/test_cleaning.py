from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillroll.functions.numbers import net_price
from tillroll.operators.dedup import first_per_key
from tillroll.operators.orders import flatten_order_lines
from tillroll.operators.products import clean_products
from tillroll.schemas import RAW_CART, RAW_PRODUCT, with_position

LAMP = dict(
    id=71,
    title="Desk lamp, brass",
    category="lighting",
    price="64.50",
    discountPercentage="20",
    rating="3.9",
    stock="7",
    brand="Halden",
)


def raw(spark, *rows):
    names = RAW_PRODUCT.fieldNames()
    data = [
        tuple({**LAMP, **row}[n] for n in names) + (row.get("ingest_pos", i),)
        for i, row in enumerate(rows)
    ]
    return spark.createDataFrame(data, with_position(RAW_PRODUCT))


def test_columns(spark):
    assert clean_products(raw(spark, {})).columns == [
        "product_id",
        "product_name",
        "category",
        "price_usd",
        "discount_pct",
        "avg_rating",
        "stock_quantity",
        "brand",
        "actual_price_usd",
        "processed_at",
    ]


def test_net_price_of_a_product(spark):
    assert clean_products(raw(spark, {})).first().actual_price_usd == Decimal("51.60")


@pytest.mark.parametrize(
    "price, discount, net",
    [("1.00", "0.5", "1.00"), ("1.00", "1.5", "0.99"), ("9.99", "12.96", "8.70"), ("0", "50", "0")],
)
def test_net_price_rounds_half_up(spark, price, discount, net):
    column = net_price(
        F.lit(price).cast("decimal(18,6)"), F.lit(discount).cast("decimal(18,6)")
    )
    assert spark.range(1).select(column.alias("n")).first().n == Decimal(net)


def test_missing_brand(spark):
    assert clean_products(raw(spark, {"brand": None})).first().brand == "Unknown"


def test_first_copy_is_kept(spark):
    rows = clean_products(raw(spark, {"title": "old"}, {"title": "new"})).collect()
    assert [r.product_name for r in rows] == ["old"]
    late_first = raw(
        spark, {"title": "late", "ingest_pos": 9}, {"title": "early", "ingest_pos": 3}
    )
    assert clean_products(late_first).first().product_name == "early"


def test_copies_without_position_are_refused(spark):
    with pytest.raises(ValueError):
        clean_products(raw(spark, {}, {}).drop("ingest_pos"))


def test_large_numbers_are_kept_and_never_taken_for_gaps(spark):
    rich = clean_products(raw(spark, {"stock": "1000000000000", "price": "1234567890123.5"})).first()
    assert rich.stock_quantity == 10**12 and rich.price_usd == Decimal("1234567890123.5")
    assert clean_products(raw(spark, {"stock": "9223372036854775807"})).first().stock_quantity == 2**63 - 1
    for field in ("stock", "price"):
        with pytest.raises(Exception, match="no (bigint|decimal)"):
            clean_products(raw(spark, {field: "1" + "0" * 30})).collect()


def test_first_copy_keeps_its_gaps(spark):
    """A NULL of the first row is not filled from a later one."""
    row = clean_products(raw(spark, {"rating": None}, {"rating": "4.0"})).first()
    assert row.avg_rating is None


def test_empty_input_keeps_the_schema(spark):
    assert clean_products(raw(spark)).count() == 0
    assert "actual_price_usd" in clean_products(raw(spark)).columns
    lines = flatten_order_lines(spark.createDataFrame([], RAW_CART))
    assert lines.count() == 0 and "line_savings_usd" in lines.columns


def test_missing_field_raises(spark):
    with pytest.raises(AnalysisException):
        clean_products(raw(spark, {}).drop("stock"))


@pytest.mark.parametrize("text", ["n/a", "", None, "12,5", "NaN"])
def test_unparsable_numbers(spark, text):
    bad = dict(price=text, discountPercentage=text, rating=text, stock=text)
    row = clean_products(raw(spark, bad)).first()
    assert (row.price_usd, row.discount_pct, row.stock_quantity) == (0, 0, 0)
    assert row.avg_rating is None and row.actual_price_usd == 0


def test_padded_and_whole_numbers(spark):
    row = clean_products(raw(spark, dict(price=" 12.5 ", stock="7.0", rating="1e0"))).first()
    assert (row.price_usd, row.stock_quantity, row.avg_rating) == (Decimal("12.5"), 7, 1.0)


def test_run_stamp_is_the_same_on_every_row(spark):
    stamp = datetime(2025, 1, 1, 6)
    rows = clean_products(raw(spark, {}, {"id": 2}), F.lit(stamp)).collect()
    assert {r.processed_at for r in rows} == {stamp}
    now = clean_products(raw(spark, {}, {"id": 2})).select("processed_at").distinct()
    assert now.count() == 1


def line(**over):
    base = dict(
        id=7,
        title="Thing",
        price="10.004",
        quantity="2",
        total="20.01",
        discountPercentage="10",
        discountedTotal="18.005",
    )
    return tuple({**base, **over}.values())


def cart(number, *lines):
    return (number, 5, "40.0", "36.0", 2, 4, list(lines))


def test_carts_flatten_to_lines(spark):
    carts = spark.createDataFrame(
        [cart(1, line(), line(id=8, quantity="x", total=None)), cart(2)], RAW_CART
    )
    rows = {r.product_id: r for r in flatten_order_lines(carts).collect()}
    assert sorted(rows) == [7, 8]
    first, second = rows[7], rows[8]
    assert (first.order_id, first.user_id, first.order_total_products) == (1, 5, 2)
    assert first.unit_price_usd == Decimal("10.00")
    assert first.line_discounted_usd == Decimal("18.01")
    assert first.line_savings_usd == Decimal("2.00")
    assert (second.quantity_ordered, second.line_total_usd) == (0, 0)
    assert second.line_savings_usd == Decimal("-18.01")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 3), max_size=6))
def test_line_count_is_the_sum_of_array_sizes(spark, sizes):
    carts = spark.createDataFrame(
        [cart(i, *[line(id=k) for k in range(n)]) for i, n in enumerate(sizes)], RAW_CART
    )
    assert flatten_order_lines(carts).count() == sum(sizes)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 99)), max_size=12))
def test_dedup_is_idempotent_and_takes_the_first(spark, pairs):
    rows = [(key, value, position) for position, (key, value) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "key long, value long, pos long")
    once = first_per_key(df, "key", "pos")
    expected = {}
    for key, value, position in rows:
        expected.setdefault(key, (key, value, position))
    assert sorted(map(tuple, once.collect())) == sorted(expected.values())
    assert sorted(first_per_key(once, "key", "pos").collect()) == sorted(once.collect())
