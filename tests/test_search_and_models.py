"""Trigram search, quantile brackets, and saved forests as node tables."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import lookup, quantiles, search_index
from tillroll.plans import forecast, forest_table
from tillroll.sample import star
from tillroll.session import scratch_dir

NAMES = [
    "Small Bolt", "small bolt bolt", "BOLT", "bo", "", None, "o'n% off_line", "Ölbehälter groß", "l b bol olt",
    "a%b", "100% wool", "x_y_z", "50", "İstanbul", "tab\there",
]


@pytest.fixture(scope="module")
def names(spark):
    rows = [(i, n) for i, n in enumerate(NAMES)] + [(100 + i, f"item {i} bolt") for i in range(300)]
    df = spark.createDataFrame(rows, "product_id long, product_name string").cache()
    return df, search_index.build_index(df, scratch_dir(spark, "trigrams"), rows_per_part=500)


@pytest.mark.parametrize("wildcards", [False, True])
@pytest.mark.parametrize(
    "text",
    ["bolt", "BOLT", "bo", "b", "", "bol olt", "öl", "ölbe", "GROß", "o'n", "%", "0%", "50", "100", "b_l%x",
     "b_lt", "it%bolt", "item 7 b", "nothing like it", "_", "x_y", "small%bolt", "a%", "\\", "tab\t", "i̇stanbul"],
)
def test_index_finds_what_a_scan_finds(names, text, wildcards):
    df, index = names
    got = search_index.search(df, index, text, wildcards).collect()
    want = lookup.search_products(df, text, wildcards).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_only_matching_postings_are_read(spark, names):
    df, index = names
    assert index.parts > 2
    found = index.postings(spark, ["ölb"])
    assert found.collect() == [("ölb", 7)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(gram" in plan or "EqualTo(gram" in plan


def test_no_products_at_all(spark):
    empty = spark.createDataFrame([], "product_id long, product_name string")
    index = search_index.build_index(empty, scratch_dir(spark, "trigrams"))
    assert search_index.search(empty, index, "bolt").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_edges_are_those_of_all_values(spark, monkeypatch, seed):
    r = random.Random(seed)
    monkeypatch.setattr(quantiles, "ACCURACY", 3)
    n = r.choice([1, 2, 3, 50, 2000])
    values = [r.choice([0.0, 1.5, r.uniform(-5, 5)]) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 3, "v double").repartition(5)
    parts = [Fraction(1, 4), Fraction(1, 2), Fraction(9, 10), Fraction(0), Fraction(1)]
    assert np.allclose(quantiles.quantile_edges(df, "v", parts), np.quantile(values, [float(p) for p in parts]))
    assert quantiles.quantile_edges(df.limit(0), "v", parts) == []


def test_tiers_of_repeated_prices(spark):
    for prices in ([5.0] * 10, [1.0] * 9 + [2.0], [1.0, 2.0, 3.0, 4.0]):
        df = spark.createDataFrame([(p,) for p in prices], "price_usd double")
        edges = sorted(set(np.quantile(prices, [0.25, 0.5, 0.75])) - {min(prices)})
        want = sorted((p, sum(p > e for e in edges)) for p in prices)
        assert sorted(map(tuple, quantiles.price_tiers(df).collect())) == want


@pytest.mark.parametrize("settings", [
    forecast.ForecastSettings(trees=7, depth=5, labelled_rows=1500),
    forecast.ForecastSettings(trees=1, depth=0, labelled_rows=500),
])
def test_node_table_predicts_what_the_loaded_model_does(spark, sf_dir, settings):
    from pyspark.ml import PipelineModel

    fact, dim = star.order_lines(spark, sf_dir).drop("cart"), star.dim_products(spark, sf_dir)
    rows = forecast.feature_table(fact, dim, settings)
    path = f"{scratch_dir(spark, 'forest')}/model"
    forecast.save_model(forecast.train(forecast.labelled(rows, settings), settings), path)
    nodes = forest_table.node_table(spark, path)
    both = forest_table.apply_nodes(
        PipelineModel.load(path).transform(rows).withColumnRenamed("prediction", "theirs"),
        nodes, settings.inputs, settings.depth,
    )
    seen = both.agg(
        F.count_if(F.col("prediction") != F.col("theirs")).alias("other"),
        F.count_distinct("prediction").alias("values"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    assert seen["other"] == 0 and seen["n"] == rows.count()
    assert seen["values"] > 30 if settings.depth else seen["values"] == 1
