from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tillroll.operators import features as feat
from tillroll.operators.evaluation import fold_of, is_training_row
from tillroll.plans import forecast
from tillroll.registry import queries as registry
from tillroll.sample import star
from tillroll.session import scratch_dir

SCHEMA = (
    "product_id long, category string, brand string, price_usd double, "
    "product_discount_pct double, avg_rating double, stock_quantity long, units_sold long, "
    "line_total_usd double, order_discount_pct double"
)
SMALL = forecast.ForecastSettings(trees=3, depth=3, folds=2)


@pytest.fixture(scope="module")
def rows(spark):
    """Three categories of unequal size, one of one row; brands across categories; a gap in
    each column that may have one; equal prices at the quartile edges."""
    kinds = ["garden"] * 13 + ["toys"] * 9 + ["music"] + [None] * 2
    data = [
        (
            1000 + i,
            kind,
            ["Halden", "Ostra", None, "Vim"][i % 4],
            [4.0, 4.0, 19.5, 120.25, 19.5][i % 5] + (i // 10),
            float(i % 3 * 15),
            None if i % 7 == 0 else 1.0 + i % 5,
            [0, 3, 9, 10, 700][i % 5],
            1 + (i * i) % 17,
            12.5 * (i + 1),
            float(i % 4),
        )
        for i, kind in enumerate(kinds)
    ]
    return spark.createDataFrame(data, SCHEMA)


def frame(spark, *rows):
    base = dict(
        product_id=1,
        category="c",
        brand="b",
        price_usd=1.0,
        product_discount_pct=0.0,
        avg_rating=4.0,
        stock_quantity=5,
        units_sold=3,
        line_total_usd=1.0,
        order_discount_pct=0.0,
    )
    data = [tuple({**base, "product_id": i, **row}.values()) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def test_shape(rows):
    out = feat.engineer_features(rows)
    assert out.count() == 25 and len(feat.FEATURES) == 18
    assert out.columns == ["product_id", "category", "units_sold", *feat.FEATURES]


def test_no_gaps(rows):
    gaps = [F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in feat.FEATURES]
    assert set(feat.engineer_features(rows).agg(*gaps).first()) == {0}


def test_group_of_one_and_constant_group(spark):
    out = feat.engineer_features(
        frame(
            spark,
            dict(category="one", units_sold=7),
            dict(category="flat", units_sold=4),
            dict(category="flat", units_sold=4),
            dict(category="pair", units_sold=1),
            dict(category="pair", units_sold=3),
        )
    )
    z = {(r.category, r.units_sold): r.category_sales_z for r in out.collect()}
    assert z["one", 7] == 0.0 and z["flat", 4] == 0.0
    assert z["pair", 3] == pytest.approx(0.70710678)


def test_missing_category_and_rating(spark):
    out = feat.engineer_features(
        frame(spark, dict(category=None, avg_rating=None), dict(category="unknown"), dict(category="A"))
    )
    r = {row.product_id: row for row in out.collect()}
    assert (r[0].category_enc, r[1].category_enc, r[2].category_enc) == (1, 1, 0)
    assert (r[0].avg_rating, r[0].is_high_rated) == (0.0, 0)


def test_codes_follow_code_points(spark):
    out = feat.engineer_features(frame(spark, *[dict(category=c) for c in ("b", "C", "a")]))
    assert {r.category: r.category_enc for r in out.collect()} == {"C": 0, "a": 1, "b": 2}


def brute_tiers(prices):
    ordered = sorted(prices)

    def edge(q):
        at = (len(ordered) - 1) * q
        low = int(at)
        high = min(low + 1, len(ordered) - 1)
        return ordered[low] + (ordered[high] - ordered[low]) * (at - low)

    edges = {edge(q) for q in (0.25, 0.5, 0.75)} - {ordered[0]}
    return [sum(price > e for e in edges) for price in prices]


@pytest.mark.parametrize(
    "prices",
    [
        [1.0, 2.0, 3.0, 4.0, 5.0],
        [5.0, 1.0, 2.0, 8.0, 3.0, 9.0],
        [1.0, 1.0, 1.0, 1.0, 9.0],
        [1.0, 2.0, 2.0, 2.0, 2.0, 2.0, 3.0],
        [4.0],
        [2.0, 2.0],
    ],
)
def test_price_tiers(spark, prices):
    out = feat.engineer_features(frame(spark, *[dict(price_usd=p) for p in prices]))
    tiers = {r.product_id: r.price_tier for r in out.collect()}
    assert [tiers[i] for i in range(len(prices))] == brute_tiers(prices)


def test_sliced_features_equal_plain_ones(spark, sf_dir):
    fact, dim = star.order_lines(spark, sf_dir), star.dim_products(spark, sf_dir)
    plain = feat.star_features(fact, dim)
    sliced = feat.star_features(fact, dim, broadcast_limit=-1, rows_per_slice=20)
    assert sliced.exceptAll(plain).count() == 0 and plain.exceptAll(sliced).count() == 0


def test_split_is_stable_under_repartitioning(spark):
    df = spark.range(2000).withColumn("x", F.col("id") % 97)
    side = is_training_row(42, F.col("id"), F.col("x"))
    first = {r.id for r in df.filter(side).collect()}
    again = {r.id for r in df.repartition(13, "x").filter(side).collect()}
    assert first == again and 1500 < len(first) < 1700
    folds = df.groupBy(fold_of(42, 5, F.col("id")).alias("f")).count().collect()
    assert sorted(r.f for r in folds) == [0, 1, 2, 3, 4]


def test_train_and_predict(rows):
    table = feat.engineer_features(rows, keep=["product_id", "category"]).withColumn(
        "is_train", F.col("product_id") % 5 != 0
    )
    model = forecast.train(table, SMALL)
    metrics = forecast.evaluate(model, table)
    assert forecast.predict(model, table).count() == 25
    assert set(metrics) == {"mae", "r2"} and metrics["r2"] <= 1.0


def test_leak_free_features(spark, sf_dir):
    settings = forecast.ForecastSettings(leak_free=True)
    assert not set(settings.inputs) & set(feat.LEAKING) and len(settings.inputs) == 16
    fact, dim = star.order_lines(spark, sf_dir), star.dim_products(spark, sf_dir)
    out = forecast.forecast_features(fact, dim, settings)
    means = out.filter("is_train").groupBy("category").agg(
        F.avg("units_sold").alias("m"), F.max("category_avg_sales").alias("f")
    )
    for r in means.collect():
        assert r.m == pytest.approx(r.f)


def test_whole_job_twice(spark, sf_dir):
    fact, dim = star.order_lines(spark, sf_dir), star.dim_products(spark, sf_dir)
    base = scratch_dir(spark, "job")
    spark.sql(f"CREATE DATABASE forecast_test LOCATION '{base}/db'")
    table = "forecast_test.ml_predictions"
    run = forecast.run_forecast(fact, dim, table, base, SMALL, date(2025, 1, 1))
    n = run.predictions.count()
    assert n == feat.training_rows(fact, dim).count()
    again = forecast.run_forecast(fact, dim, table, base, SMALL, date(2025, 1, 1))
    assert again.predictions.count() == n and again.metrics == run.metrics
    assert spark.table(table).columns == [
        "product_id",
        "category",
        "predicted_units",
        "actual_units",
        "run_date",
        "mae",
        "r2_score",
    ]
    saved = spark.read.json(f"{base}/metrics").first().asDict()
    assert saved == run.metrics
    assert PipelineModel.load(f"{base}/model").stages[1].getNumTrees == 3


def test_metrics_cover_all_lines_held_out(spark, sf_dir):
    fact, dim = star.order_lines(spark, sf_dir), star.dim_products(spark, sf_dir)
    settings = forecast.ForecastSettings(trees=3, depth=3, folds=2, labelled_rows=400)
    base = scratch_dir(spark, "job")
    run = forecast.run_forecast(fact, dim, "sampled_predictions", base, settings, date(2025, 1, 1))
    rows = forecast.forecast_features(fact, dim, settings)
    assert rows.count() > 2 * settings.labelled_rows
    held = run.model.transform(rows.filter("not is_train")).select("prediction", feat.LABEL).collect()
    mean = sum(y for _, y in held) / len(held)
    r2 = 1 - sum((y - p) ** 2 for p, y in held) / sum((y - mean) ** 2 for _, y in held)
    assert run.metrics["mae"] == pytest.approx(sum(abs(p - y) for p, y in held) / len(held), abs=1e-4)
    assert run.metrics["r2"] == pytest.approx(r2, abs=1e-4)
    (stored,) = run.predictions.select("mae", "r2_score").distinct().collect()
    assert tuple(stored) == (run.metrics["mae"], run.metrics["r2"])


def test_models_are_fitted_on_all_lines(spark):
    lines = spark.range(12_000).selectExpr(
        "if(id % 50 = 0, null, id div 2) AS order_id", "id % 7 AS product_id", "id % 9 AS units_sold",
        "cast(id % 90 AS double) AS line_total_usd", "0.5D AS order_discount_pct",
    )
    settings = forecast.ForecastSettings()
    fitted = forecast.labelled(lines, settings)
    assert fitted.count() == 12_000 and fitted.exceptAll(lines).count() == 0
    assert fitted.rdd.getNumPartitions() == settings.partitions
    assert forecast.labelled(lines, forecast.ForecastSettings(labelled_rows=3000)).count() < 4000
    counts = [forecast.fit_partitions(n, 4) for n in (0, 12_000, 600_000, 36_000_000, 216_000_000)]
    assert counts == [4, 4, 6, 48, 108]


def test_the_job_fits_and_validates_on_all_lines(spark, monkeypatch):
    fact = spark.range(9000).selectExpr(
        "id AS order_id", "id % 40 AS product_id", "id % 13 + 1 AS quantity_ordered",
        "cast(id % 500 + 1 AS decimal(19,2)) AS line_total_usd", "cast(id % 10 AS decimal(28,10)) AS discount_pct",
        "cast(id % 400 + 1 AS decimal(19,2)) AS line_discounted_usd", "cast(1 AS decimal(19,2)) AS line_savings_usd",
    )
    dim = spark.range(40).selectExpr(
        "id AS product_id", "concat('p', id) AS product_name", "concat('c', id % 3) AS category",
        "cast(id + 1 AS decimal(28,10)) AS price_usd", "cast(id % 5 AS decimal(28,10)) AS discount_pct",
        "cast(id % 5 AS double) AS avg_rating", "id % 30 AS stock_quantity", "concat('b', id % 4) AS brand",
    )
    seen = {}
    for name in ("train", "fold_scores"):
        whole = getattr(forecast, name)

        def spy(rows, settings, name=name, whole=whole):
            seen[name] = rows.count()
            return whole(rows, settings)

        monkeypatch.setattr(forecast, name, spy)
    run = forecast.run_forecast(fact, dim, "whole_predictions", scratch_dir(spark, "job"), SMALL)
    assert seen == {"train": 9000, "fold_scores": 9000} and run.predictions.count() == 9000
    assert registry.FORECAST.labelled_rows is None
