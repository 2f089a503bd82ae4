from __future__ import annotations

import json
from datetime import datetime, timedelta

from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tillroll.operators.products import clean_products
from tillroll.plans import analytics, ingest, views
from tillroll.sample import star
from tillroll.schemas import (
    DIM_PRODUCTS,
    FACT_ORDERS,
    RAW_CART,
    RAW_PRODUCT,
    as_doubles,
    with_position,
)
from tillroll.session import scratch_dir
from tillroll.sinks import files, tables
from tillroll.sources import landed, paged, snapshots
from tillroll.sources.tables import Warehouse, reused, run_query

RUN = datetime(2025, 1, 1, 6)


class ListPages:
    """Fetcher over documents made on the fly; page size is not its concern."""

    def __init__(self, total: int, grown: int | None = None) -> None:
        self.total, self.grown = total, grown

    def __call__(self, member, limit, skip):
        total = self.grown if self.grown and skip else self.total
        docs = [
            {"id": i, "title": f"t{i}", "price": 1.5, "stock": 3, "images": ["x"]}
            for i in range(skip, min(skip + limit, total))
        ]
        return {member: docs, "total": total}


@pytest.mark.parametrize("total", [0, 1, 100, 101, 200])
@pytest.mark.parametrize("max_tasks", [1, 64])
def test_page_arithmetic(spark, total, max_tasks):
    rows = paged.read_pages(spark, ListPages(total), "products", max_tasks=max_tasks).collect()
    assert sorted(r.id for r in rows) == list(range(total))
    assert all(r.ingest_pos == r.id for r in rows)
    assert all((r.price, r.stock, r.brand) == ("1.5", "3", None) for r in rows)


def test_collection_that_grows_while_it_is_read(spark):
    rows = paged.read_pages(spark, ListPages(150, grown=420), "products").collect()
    assert sorted(r.id for r in rows) == list(range(420))


class Broken:
    def __call__(self, member, limit, skip):
        return {"message": "no such collection"}


def test_page_without_records_raises(spark):
    with pytest.raises(Exception, match="total"):
        paged.read_pages(spark, Broken(), "products").collect()
    with pytest.raises(ValueError):
        paged.read_pages(spark, Broken(), "users")


class Reply:
    def __init__(self, status, body):
        self.status, self.body = status, body

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def read(self):
        return self.body


def test_http_fetcher(monkeypatch):
    seen = []

    def reply(status):
        def urlopen(url, timeout):
            seen.append(url)
            return Reply(status, b'{"carts": [], "total": 0}')

        return urlopen

    monkeypatch.setattr(paged.urllib.request, "urlopen", reply(200))
    assert paged.HttpPages("http://host/")("carts", 100, 200)["total"] == 0
    assert seen == ["http://host/carts?limit=100&skip=200"]
    monkeypatch.setattr(paged.urllib.request, "urlopen", reply(204))
    with pytest.raises(RuntimeError, match="204"):
        paged.HttpPages("http://host")("carts", 100, 0)


def test_array_file(spark, tmp_path):
    docs = [{"id": i, "title": f"n{i}", "price": 2, "rating": None, "extra": 1} for i in range(5)]
    (tmp_path / "raw.json").write_text(json.dumps(docs, indent=2))
    df = landed.read_landed_json(spark, str(tmp_path / "raw.json"), RAW_PRODUCT, array_file=True)
    rows = df.orderBy("ingest_pos").collect()
    assert [(r.id, r.price, r.brand) for r in rows] == [(i, "2", None) for i in range(5)]


def test_landed_rows_come_back(spark, sf_dir):
    carts = star.carts_raw(spark, sf_dir)
    path = files.land_json(carts, scratch_dir(spark, "t"), "orders_raw", RUN)
    assert path.endswith("orders_raw_20250101_060000.json")
    back = landed.read_landed_json(spark, path, RAW_CART).drop("ingest_pos")
    assert back.select(*carts.columns).exceptAll(carts).count() == 0
    assert back.count() == carts.count()


@pytest.mark.parametrize("name", ['say "hi"', "a,b", "line\nbreak", "back\\slash", "'q'", None])
def test_csv_keeps_text(spark, name):
    schema = with_position(RAW_PRODUCT)
    raw = spark.createDataFrame([(1, name, None, "2.5", "0", None, "1", None, 0)], schema)
    dim = clean_products(raw, F.lit(RUN).cast("timestamp"))
    path = files.write_csv(dim, scratch_dir(spark, "t"))
    assert snapshots.read_csv(spark, path, DIM_PRODUCTS).collect() == dim.collect()


def test_latest_snapshot(spark, tmp_path):
    base = scratch_dir(spark, "t")
    with pytest.raises(FileNotFoundError):
        snapshots.latest_path(spark, base, "products_clean")
    df = spark.range(2).select(F.lit("x").alias("product_name"))
    for day in (3, 1, 2):
        files.write_snapshot(df, base, "products_clean", RUN + timedelta(days=day))
    files.write_snapshot(df, base, "orders_clean", RUN + timedelta(days=9))
    newest = snapshots.latest_path(spark, base, "products_clean")
    assert newest.endswith("products_clean_20250104_060000.csv")
    files.write_snapshot(df, f"{base}/products_clean_archive", "products_clean", RUN)
    files.write_snapshot(df, base, "products_clean_old", RUN + timedelta(days=99))
    assert snapshots.latest_path(spark, base, "products_clean") == newest
    inner = snapshots.latest_path(spark, f"{base}/products_clean_archive", "products_clean")
    assert inner.endswith("products_clean_archive/products_clean_20250101_060000.csv")
    (tmp_path / "orders_clean_20240101_000000.csv").write_text("order_id\n1\n")
    (tmp_path / "orders_clean_20240201_000000.csv").write_text("order_id\n2\n")
    single = snapshots.latest_path(spark, str(tmp_path), "orders_clean")
    assert single.endswith("orders_clean_20240201_000000.csv")


def test_ingest_then_analytics(spark, sf_dir):
    """The whole batch: raw records -> snapshots -> marts, equal to the direct marts."""
    base = scratch_dir(spark, "t")
    raw, carts = star.products_raw(spark, sf_dir), star.carts_raw(spark, sf_dir)
    products = ingest.ingest_products(raw, base, RUN)
    orders = ingest.ingest_orders(carts, base, RUN)
    expected = {r.relation: r for r in ingest.row_counts(raw, carts).collect()}
    for name, report in (("products", products), ("orders", orders)):
        assert report.raw_rows == expected[name].raw_rows
        assert report.clean_rows == expected[name].clean_rows
    direct = analytics.build_marts(star.order_lines(spark, sf_dir), star.dim_products(spark, sf_dir))
    for fmt in ("parquet", "csv"):
        paths = analytics.run_analytics(spark, f"{base}/processed", f"{base}/{fmt}", fmt)
        assert set(paths) == set(direct)
        for name, df in direct.items():
            wanted = as_doubles(df)
            if fmt == "csv":
                back = snapshots.read_csv(spark, paths[name], wanted.schema)
            else:
                back = spark.read.parquet(paths[name])
            assert back.exceptAll(wanted).count() == 0 and back.count() == wanted.count(), name


def test_refresh_keeps_the_table_definition(spark):
    base = scratch_dir(spark, "t")
    spark.sql(f"CREATE TABLE kept (b string, a long) USING parquet LOCATION '{base}'")
    for n in (5, 3):
        rows = spark.range(n).select(F.col("id").alias("a"), F.lit("x").alias("b"))
        assert tables.full_refresh(rows, "kept").count() == n
    assert spark.table("kept").columns == ["b", "a"]
    assert spark.read.parquet(base).count() == 3
    assert spark.table("kept").agg(F.sum("a")).first()[0] == 3


def test_fact_schema(spark, sf_dir):
    from tillroll.operators.orders import flatten_order_lines

    fact = flatten_order_lines(star.carts_raw(spark, sf_dir), star.run_ts())
    assert fact.schema.simpleString() == FACT_ORDERS.simpleString()
    assert star.dim_products(spark, sf_dir).schema.simpleString() == DIM_PRODUCTS.simpleString()


def test_tables_views_and_queries(spark, sf_dir):
    base = scratch_dir(spark, "t")
    spark.sql(f"CREATE DATABASE analytics LOCATION '{base}'")
    spark.sql("USE analytics")
    try:
        house = Warehouse(spark)
        frames = {
            "fact_orders": star.order_lines(spark, sf_dir),
            "dim_products": star.dim_products(spark, sf_dir),
            "ml_predictions": star.predictions(spark, sf_dir),
        }
        counts = {}
        for name, df in frames.items():
            tables.full_refresh(df, house.name(name))
            counts[name] = tables.full_refresh(df, house.name(name)).count()
            assert counts[name] == df.count()
        with pytest.raises(KeyError):
            house.source("other")
        names = views.create_views(*(house.source(n) for n in frames))
        assert names == ["category_revenue", "product_performance", "prediction_quality"]
        assert run_query(spark, "SELECT * FROM prediction_quality").count() == counts["ml_predictions"]
        some = run_query(
            spark,
            "SELECT count(*) AS n FROM {dim} WHERE product_name = :name",
            {"name": "it's; DROP TABLE x"},
            dim=house.source("dim_products"),
        )
        assert some.first().n == 0
        with reused(house.source("dim_products")) as kept:
            assert kept.storageLevel.useMemory and kept.count() == counts["dim_products"]
        assert not kept.storageLevel.useMemory
    finally:
        spark.sql("USE default")


def test_money_keeps_its_cents_in_csv(spark):
    path = scratch_dir(spark, "cents")
    money = spark.sql("SELECT 1234567890123456.78BD AS paid, CAST(12345678.90 AS DECIMAL(19,2)) AS due")
    files.write_csv(money, path)
    assert [tuple(map(str, r)) for r in spark.read.option("header", True).csv(path).collect()] == [
        ("1234567890123456.78", "12345678.90")
    ]


def test_lost_page_is_an_error(spark):
    def lossy(member, limit, skip):
        records = [{"id": i, "title": "x"} for i in range(skip, min(skip + limit, 250))]
        return {member: records[: 40 if skip == 100 else None], "total": 250}

    with pytest.raises(Exception, match="has 40 of 100 records"):
        paged.read_pages(spark, lossy, "products").collect()


def test_refresh_refuses_other_columns(spark):
    tables.full_refresh(spark.range(3), "refresh_columns")
    with pytest.raises(ValueError):
        tables.full_refresh(spark.range(3).withColumn("more", F.lit(1)), "refresh_columns")
    spark.sql("DROP TABLE refresh_columns")


def test_scratch_goes_with_its_scope(spark, monkeypatch):
    from tillroll import session

    with session.scratch_scope(spark, keep=lambda purpose: purpose == "kept"):
        gone, kept = (session.materialise(spark.range(3), p) for p in ("gone", "kept"))
    paths = [df.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0] for df in (gone, kept)]
    assert [Path(p).exists() for p in paths] == [False, True]

    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda name, default=None: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "a"})

    with pytest.raises(ValueError):
        session.scratch_dir(Cluster(), "x")
