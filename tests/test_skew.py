"""One key with a third of all rows, missing keys, identical copies: same results by the
sliced path, and no task that gets a whole hot key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tillroll.operators import lookup, marts, quality, reports
from tillroll.operators.joins import join_dimension
from tillroll.operators.ordering import running_total
from tillroll.operators.orders import flatten_order_lines
from tillroll.sample import star
from tillroll.schemas import RAW_CART

SLICED = dict(broadcast_limit=-1, rows_per_slice=100)


@pytest.fixture(scope="module")
def fact(spark):
    """3,000 lines: a third on product 1, a third without product, a third on 2..51."""
    i = F.col("id")
    product = F.when(i % 3 == 0, F.lit(1)).when(i % 3 == 1, i % 50 + 2)
    return spark.range(3000, numPartitions=8).select(
        (i % 700).alias("order_id"),
        product.alias("product_id"),
        F.lit(2).cast("bigint").alias("quantity_ordered"),
        F.lit("10.00").cast("decimal(18,2)").alias("line_total_usd"),
        F.lit("5").cast("decimal(18,6)").alias("discount_pct"),
        F.lit("9.50").cast("decimal(18,2)").alias("line_discounted_usd"),
        F.lit("0.50").cast("decimal(18,2)").alias("line_savings_usd"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    """Products 1..40: product ids 41..51 of the fact are orphans."""
    i = F.col("id")
    return spark.range(1, 41).select(
        i.alias("product_id"),
        F.concat(F.lit("p"), i).alias("product_name"),
        F.when(i % 4 != 0, F.concat(F.lit("c"), i % 3)).alias("category"),
        F.lit("b").alias("brand"),
        F.lit("10.5").cast("decimal(18,6)").alias("price_usd"),
        F.lit("5").cast("decimal(18,6)").alias("discount_pct"),
        F.when(i % 5 != 0, (i % 5).cast("double")).alias("avg_rating"),
        (i % 60).alias("stock_quantity"),
        F.lit("9.98").cast("decimal(18,2)").alias("actual_price_usd"),
    )


def bag(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_plain_join(fact, dim, how):
    narrow = dim.select("product_id", "category", "avg_rating")
    assert bag(join_dimension(fact, narrow, "product_id", how, **SLICED)) == bag(
        fact.join(narrow, "product_id", how)
    )


def test_hot_key_is_spread(fact, dim):
    joined = join_dimension(fact, dim.select("product_id", "category"), "product_id", **SLICED)
    spark = fact.sparkSession
    keep = {
        name: spark.conf.get(name)
        for name in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    }
    try:
        for name, value in zip(keep, ("false", "-1"), strict=True):
            spark.conf.set(name, value)
        placed = joined.filter("product_id = 1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in keep.items():
            spark.conf.set(name, value)
    assert len(placed) >= 4
    assert sum(r["count"] for r in placed) == 1000


def test_unknown_join_type(fact, dim):
    with pytest.raises(ValueError):
        join_dimension(fact, dim, "product_id", "full")


def test_marts_by_the_sliced_path(fact, dim):
    for mart in (marts.category_revenue, reports.category_breakdown):
        assert bag(mart(fact, dim, **SLICED)) == bag(mart(fact, dim))


def test_category_revenue_against_brute_force(fact, dim):
    category = {r.product_id: r for r in dim.collect()}
    expected = {}
    for r in fact.collect():
        if r.product_id in category:
            product = category[r.product_id]
            group = expected.setdefault(product.category, [set(), 0, 0, []])
            group[0].add(r.order_id)
            group[1] += r.quantity_ordered
            group[2] += r.line_discounted_usd
            group[3] += [] if product.avg_rating is None else [product.avg_rating]
    got = {r.category: r for r in marts.category_revenue(fact, dim, **SLICED).collect()}
    assert None in got and set(got) == set(expected)
    for name, (orders, units, net, ratings) in expected.items():
        row = got[name]
        assert (row.total_orders, row.units_sold) == (len(orders), units)
        assert row.total_revenue_usd == float(net)
        assert row.avg_rating == pytest.approx(sum(ratings) / len(ratings), abs=0.0051)


def test_order_analysis_counts_unknown_products(fact, dim):
    rows = {r.category: r for r in marts.order_analysis(fact, dim).collect()}
    assert sum(r.total_order_lines for r in rows.values()) == 3000
    assert rows[None].total_order_lines >= 1000
    assert rows[None].avg_qty_per_order == 2.0


def test_orphans_by_the_sliced_path(fact, dim):
    expected = [r for r in fact.collect() if r.product_id is None or r.product_id > 40]
    assert quality.orphans(fact, dim, "product_id", **SLICED).count() == len(expected)


def test_copies_still_spread(spark):
    """Rows equal in every column, from several partitions."""
    copies = spark.range(4000, numPartitions=8).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    names = spark.createDataFrame([(1, "one"), (2, "two")], "k int, name string")
    joined = join_dimension(copies, names, "k", **SLICED)
    assert joined.count() == 4000
    assert joined.distinct().count() == 1


@pytest.mark.parametrize("buckets", [1, 7, 256])
def test_running_total_equals_a_global_window(spark, buckets):
    values = spark.range(500).select(
        F.concat(F.lit("k"), F.xxhash64("id")).alias("k"), (F.col("id") % 7 + 1).alias("n")
    )
    got = {
        r.k: r.upto for r in running_total(values, "k", "n", buckets).collect()
    }
    total, expected = 0, {}
    for r in sorted(values.collect(), key=lambda r: r.k):
        total += r.n
        expected[r.k] = total
    assert got == expected
    assert {r.k: r.upto for r in running_total(values, "k", "n").collect()} == expected


def test_running_total_without_rows(spark):
    none = spark.createDataFrame([], "k string, n long")
    assert running_total(none, "k", "n").count() == 0


def test_an_order_with_many_lines_keeps_them_all(spark, tmp_path):
    """One rule at any size, and large ids that stay apart."""
    keys = [97, 97_000_097, 194_000_097, 101]
    part = [(k, f"part {k}", "TYPE", 10.0, 3, "Brand#1") for k in keys]
    lines = [(7, keys[i % 4], i, 2.0, 20.0, 0.1) for i in range(3000)]
    spark.createDataFrame(
        part, "p_partkey long, p_name string, p_type string, p_retailprice double, p_size int, p_brand string"
    ).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, 1), (8, 1)], "o_orderkey long, o_custkey long").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    dim = star.dim_products(spark, str(tmp_path))
    assert dim.count() == 4 + 3  # every part, and an unsold product for three of them
    carts = star.carts_raw(spark, str(tmp_path))
    fact = flatten_order_lines(carts, star.run_ts())
    assert fact.count() == 3000
    assert {r.id for r in carts.collect()} == {28, 29, 30, 31, 32}
    assert {str(r.unit_price_usd) for r in fact.select("unit_price_usd").distinct().collect()} == {"10.00"}
    known = fact.join(dim, "product_id", "left_semi").count()
    assert known == 3000 * sum(k % 101 != 0 for k in keys) // 4

def test_lookup_pages_and_full_result(spark, dim):
    found = spark.range(300).select(
        (F.col("id") % 3 + 1).alias("product_id"),
        F.col("id").cast("double").alias("predicted_units"),
        F.lit(10).cast("bigint").alias("actual_units"),
    )
    every = lookup.product_lookup(dim, found, "p", limit=None)
    assert every.count() == 300 + 37
    page = lookup.product_lookup(dim, found, "p").collect()
    assert [r.predicted_units for r in page] == [float(3 * k) for k in range(20)]
    short = lookup.product_lookup(dim, found.filter("product_id = 2"), "p", limit=101)
    ids = [r.product_id for r in short.orderBy("product_id").collect()]
    assert ids == [1] + [2] * 100
