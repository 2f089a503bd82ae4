"""What the plans must and must not contain."""

from __future__ import annotations

import contextlib
import io

import pytest

from tillroll.operators import inventory, marts, reports
from tillroll.registry.queries import all_queries as queries
from tillroll.sample import star
from tillroll.session import materialise

MODEL = {"cv_metrics", "forecast", "model_metrics", "write_predictions"}


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(queries()) - MODEL))
def test_no_python_rows_no_cross_joins(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    dim = materialise(star.dim_products(spark, sf_dir), "dim")
    text = plan(marts.dead_inventory(dim))
    assert "GreaterThan(stock_quantity,50)" in text and "LessThan(avg_rating,3.5)" in text
    assert "EqualTo(stock_quantity,0)" in plan(inventory.out_of_stock(dim))
    counts = plan(inventory.inventory_counts(dim))
    assert "ReadSchema: struct<stock_quantity:bigint>" in counts


def test_small_dimension_is_broadcast(spark, sf_dir):
    fact = materialise(star.order_lines(spark, sf_dir), "fact")
    dim = materialise(star.dim_products(spark, sf_dir), "dim")
    text = plan(marts.category_revenue(fact, dim))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_large_dimension_is_sliced(spark, sf_dir):
    fact = materialise(star.order_lines(spark, sf_dir), "fact")
    dim = materialise(star.dim_products(spark, sf_dir), "dim")
    text = plan(marts.category_revenue(fact, dim, broadcast_limit=-1))
    assert "_slice" in text


def test_slices_follow_the_limit_of_the_session(spark, sf_dir):
    fact = materialise(star.order_lines(spark, sf_dir), "fact")
    dim = materialise(star.dim_products(spark, sf_dir), "dim")
    want = sorted(map(tuple, marts.category_revenue(fact, dim).collect()), key=str)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        sliced = marts.category_revenue(fact, dim, rows_per_slice=3)
        assert "_slice" in plan(sliced)
        assert sorted(map(tuple, sliced.collect()), key=str) == want
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("mart", [marts.category_revenue, reports.category_breakdown])
def test_category_marts_scan_the_lines_once(spark, sf_dir, mart):
    fact = materialise(star.order_lines(spark, sf_dir), "fact-lines")
    dim = materialise(star.dim_products(spark, sf_dir), "dim")
    text = plan(mart(fact, dim, broadcast_limit=1 << 30))
    scans = [line for line in text.splitlines() if line.startswith("Location") and "fact-lines" in line]
    assert len(scans) == 1
