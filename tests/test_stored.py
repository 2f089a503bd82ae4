"""Committed versions, incremental views, bitmaps and buckets."""

from __future__ import annotations

import contextlib
import io
import json
import random
import threading
import uuid
from pathlib import Path

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tillroll.operators import bitmaps, marts, reports
from tillroll.plans import incremental
from tillroll.registry.stored import stored_queries
from tillroll.registry.stored_oracles import stored_oracles
from tillroll.sample import star
from tillroll.session import scratch_dir
from tillroll.sinks import buckets, versions


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_query_has_a_counterpart():
    assert set(stored_queries()) == set(stored_oracles())


@pytest.mark.parametrize("name", sorted(stored_oracles()))
def test_same_rows(spark, sf_dir, con, name):
    assert difference(stored_queries()[name](spark, sf_dir), con, stored_oracles()[name]) is None


# -- committed versions -------------------------------------------------------------------


@pytest.mark.parametrize("fmt", versions.FORMATS)
def test_newest_committed_version_is_read(spark, fmt):
    base = scratch_dir(spark, "versions")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, base)
    first = versions.write_version(spark.range(5), base, fmt)
    second = versions.write_version(spark.range(7), base, fmt)
    versions.stage(spark.range(100), base, fmt)
    assert (first.number, second.number, second.rows) == (1, 2, 7)
    assert versions.read_version(spark, base).count() == 7
    assert versions.read_version(spark, base, 1).count() == 5
    assert versions.read_version(spark, base).dtypes == spark.range(1).dtypes
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, base, 3)
    assert [v.number for v in versions.expire(spark, base, 1)] == [2]
    assert versions.read_version(spark, base).count() == 7
    assert len(list(Path(base, "data").iterdir())) == 1


def test_a_write_that_dies_halfway_is_never_seen(spark):
    base = scratch_dir(spark, "versions")
    versions.write_version(spark.range(4), base)
    dies = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("killed"))).alias("id")
    )
    with pytest.raises(Exception, match="killed"):
        versions.write_version(dies, base)
    Path(base, "committed", ".half.json").write_text('{"number": 9')  # a manifest being written
    assert [v.number for v in versions.versions(spark, base)] == [1]
    assert rows(versions.read_version(spark, base)) == [(0,), (1,), (2,), (3,)]


def test_a_version_that_lost_a_file_is_not_read(spark):
    base = scratch_dir(spark, "versions")
    version = versions.write_version(spark.range(0, 100, 1, 4), base)
    path = Path(version.path)
    next(path.glob("part-*")).rename(path / "_aside")
    with pytest.raises(OSError, match="version 1"):
        versions.read_version(spark, base)


def test_writers_at_the_same_time_all_commit(spark):
    base = scratch_dir(spark, "versions")
    staged = [versions.stage(spark.range(n + 1), base) for n in range(6)]
    work = [threading.Thread(target=versions.commit, args=(spark, base, s)) for s in staged]
    for thread in work:
        thread.start()
    for thread in work:
        thread.join()
    known = versions.versions(spark, base)
    assert [v.number for v in known] == [1, 2, 3, 4, 5, 6]
    assert sorted(v.rows for v in known) == [1, 2, 3, 4, 5, 6]


def test_readers_of_a_view_see_one_version(spark):
    base, view = scratch_dir(spark, "versions"), f"published_{uuid.uuid4().hex}"
    odd = spark.range(3).select(F.col("id").alias("a b"), F.lit("x").alias("`"))
    opened = versions.publish(odd, base, view)
    versions.publish(odd.limit(0), base, view)
    assert spark.table(view).count() == 0 and spark.table(view).columns == ["a b", "`"]
    assert opened.count() == 3
    assert json.loads(versions.versions(spark, base)[0].schema)["fields"][0]["name"] == "a b"


# -- incremental views --------------------------------------------------------------------

LINE = (
    "order_id long, product_id long, quantity_ordered long, line_discounted_usd decimal(19,2), "
    "line_savings_usd decimal(19,2), line_total_usd decimal(19,2)"
)
PRODUCT = (
    "product_id long, product_name string, category string, brand string, avg_rating double, "
    "stock_quantity long, actual_price_usd decimal(19,2), price_usd decimal(28,10), "
    "discount_pct decimal(28,10)"
)


def _snapshot(spark, seed, n):
    from decimal import Decimal

    r = random.Random(seed)
    cents = lambda: None if r.random() < 0.1 else Decimal(r.randrange(5000)) / 100
    lines = [
        (r.choice([None, *range(9)]), r.choice([None, *range(8)]), r.choice([None, 1, 2]), cents(), cents(), cents())
        for _ in range(n)
    ]
    dim = [
        (i, f"p{i // 2}", r.choice([None, "a", "b", "c"]), "x", r.choice([None, 2.5, 4.1]), 5, cents(), None, None)
        for i in range(6)
    ]
    return spark.createDataFrame(lines, LINE), spark.createDataFrame(dim, PRODUCT)


@pytest.mark.parametrize("seed", range(4))
def test_changes_give_the_full_recomputation(spark, seed):
    base = {kind: scratch_dir(spark, f"{kind}-state") for kind in ("category", "product")}
    before, dim_before = _snapshot(spark, 0, 0)
    dim_before = dim_before.limit(0)
    for step in range(3):
        after, dim = _snapshot(spark, 10 * seed + step, 40 - 15 * step)
        moved = incremental.changes(before, after)
        kept = ["product_id", "category", "avg_rating"]
        regraded = incremental.changes(dim_before.select(kept), dim.select(kept))
        change = incremental.category_change(moved, before, regraded, dim)
        incremental.apply_change(base["category"], "category", change)
        incremental.apply_change(base["product"], "product", incremental.product_state(moved))
        before, dim_before = after, dim
        state = {kind: versions.read_version(spark, path) for kind, path in base.items()}
        assert rows(incremental.category_revenue(state["category"])) == rows(marts.category_revenue(after, dim))
        assert rows(incremental.product_performance(state["product"], dim)) == rows(
            marts.product_performance(after, dim)
        )


def test_hot_product_in_the_changes(spark):
    before, dim = _snapshot(spark, 3, 0)
    hot = spark.range(3000).selectExpr(
        "id % 50 AS order_id", "1L AS product_id", "2L AS quantity_ordered",
        "CAST(1.5 AS DECIMAL(19,2)) AS line_discounted_usd", "CAST(0.5 AS DECIMAL(19,2)) AS line_savings_usd",
        "CAST(2 AS DECIMAL(19,2)) AS line_total_usd",
    )
    state = incremental.category_state(incremental.signed(hot), dim, broadcast_limit=-1, rows_per_slice=100)
    assert rows(incremental.category_revenue(state)) == rows(marts.category_revenue(hot, dim))
    gone = incremental.merged("category", state, incremental.category_state(incremental.signed(hot, -1), dim))
    assert gone.count() == 0


# -- bitmaps ------------------------------------------------------------------------------


def test_bitmaps_count_any_whole_number(spark):
    r = random.Random(7)
    ids = [None, 0, 1, -1, 32767, 32768, 32769, -32768, 2**40, -(2**40)]
    data = [(r.choice("ab"), r.choice("xyz"), r.choice(ids)) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, day string, k long")
    fine = bitmaps.key_bitmaps(df, "k", "g", "day")
    want = df.groupBy("g").agg(F.count_distinct("k").alias("n"))
    assert rows(bitmaps.distinct_keys(fine, "g")) == rows(want)
    assert rows(bitmaps.distinct_keys(fine)) == rows(df.agg(F.count_distinct("k")))


def test_bitmap_marts_with_gaps(spark):
    lines, dim = _snapshot(spark, 5, 80)
    assert rows(bitmaps.category_revenue(lines, dim)) == rows(marts.category_revenue(lines, dim))
    fact = lines.withColumns({"discount_pct": F.col("line_savings_usd")})
    assert rows(bitmaps.overview_kpis(fact)) == rows(reports.overview_kpis(fact))
    assert rows(bitmaps.overview_kpis(fact.limit(0))) == rows(reports.overview_kpis(fact.limit(0)))


def test_no_order_id_is_shuffled(spark, sf_dir):
    text = plan(bitmaps.category_revenue(star.order_lines(spark, sf_dir), star.dim_products(spark, sf_dir)))
    keys = [line for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")]
    assert any("bucket" in line for line in keys) and not any("order_id" in line for line in keys)


# -- buckets ------------------------------------------------------------------------------


@pytest.mark.parametrize("rows_per_bucket_key", [10**9, 30])
def test_buckets_join_without_an_exchange_of_the_fact(spark, sf_dir, rows_per_bucket_key):
    fact = star.order_lines(spark, sf_dir).drop("cart").unionByName(
        star.order_lines(spark, sf_dir).drop("cart").limit(50).withColumn("product_id", F.lit(None).cast("long"))
    )
    dim = star.dim_products(spark, sf_dir)
    stored = buckets.save_star(
        fact, dim, f"s_{uuid.uuid4().hex}", buckets=4,
        rows_per_bucket_key=rows_per_bucket_key, path=scratch_dir(spark, "buckets"),
    )
    hot = spark.table(stored.hot)
    assert (hot.filter("product_id is not null").count() > 0) == (rows_per_bucket_key == 30)
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        for how in ("inner", "left"):
            got = stored.join(spark, ["category"], how)
            assert "Exchange" not in plan(got).replace("BroadcastExchange", "")
            assert rows(got.select("order_id", "product_id", "category")) == rows(
                fact.join(dim, "product_id", how).select("order_id", "product_id", "category")
            )
        cold = spark.table(stored.fact).groupBy("product_id").agg(F.sum("quantity_ordered"))
        assert "Exchange" not in plan(cold)
    finally:
        spark.conf.set(name, before)
    sums = [F.sum("quantity_ordered").alias("n")]
    assert rows(stored.per_key(spark, *sums)) == rows(fact.groupBy("product_id").agg(*sums))
