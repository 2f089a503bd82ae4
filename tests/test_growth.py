"""What must not grow faster than the input: pages, plans, sorts, shuffled and written bytes."""

from __future__ import annotations

import json
import random
import uuid
from datetime import datetime
from pathlib import Path

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillroll.operators import bitmaps
from tillroll.plans import forecast
from tillroll.registry.stored import stored_queries
from tillroll.sample import star
from tillroll.session import scratch_dir
from tillroll.sinks import buckets, files
from tillroll.sources import inference


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_page_is_read_without_the_rest_of_its_file(spark, monkeypatch):
    from pyarrow import parquet

    r = random.Random(1)
    text = ["".join(r.choices("abcdefghij", k=900)) for _ in range(5000)]
    records = spark.createDataFrame([(i * 7, t) for i, t in enumerate(text)], "ingest_pos long, t string")
    gap = spark.createDataFrame([(None, "no place")], records.schema)
    path = scratch_dir(spark, "pages")
    pages = files.land_records(records.unionByName(gap).repartition(3), path)
    assert pages.total == 5000
    part = next(p for p in Path(path).glob("part-*"))
    assert parquet.ParquetFile(part).num_row_groups > 1 or part.stat().st_size < 2 * files.ROW_GROUP_BYTES
    read = []
    whole = parquet.ParquetFile.read_row_group
    monkeypatch.setattr(
        parquet.ParquetFile, "read_row_group",
        lambda self, i, **k: read.append(self.metadata.row_group(i).num_rows) or whole(self, i, **k),
    )
    got = []
    for skip in range(0, 5100, 100):
        read.clear()
        page = pages("carts", 100, skip)
        assert page["total"] == 5000 and sum(read) < 4000
        got += [record["t"] for record in page["carts"]]
    assert got == text


def test_out_of_fold_means_read_the_lines_once(spark, sf_dir):
    got = stored_queries()["out_of_fold_features"](spark, sf_dir)
    assert optimized(got).count("[l_orderkey") <= 2


def test_one_shuffle_of_the_lines_of_carts(spark, sf_dir):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], "-1")
        spark.conf.set(names[1], "false")
        plan = star.carts_raw(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)
    assert plan.count("Exchange hashpartitioning") == 2  # the lines and the orders, once each


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_landed_text_is_compressed(spark, kind):
    df = spark.range(50).select("id", F.lit(None).cast("string").alias("gap"))
    base = scratch_dir(spark, "text")
    path = files.land_json(df, base, "t", datetime(2025, 1, 1)) if kind == "json" else files.write_csv(df, base)
    parts = [p for p in Path(path).glob("part-*")]
    assert parts and all(p.name.endswith(f".{kind}.gz") for p in parts)
    if kind == "json":
        lines = [r.value for r in spark.read.text(path).collect()]
        assert sorted(json.loads(x)["id"] for x in lines) == list(range(50)) and '"gap":null' in lines[0]
    else:
        assert inference.read_text_csv(spark, path).count() == 50


def test_types_of_many_columns_are_tried_by_the_same_casts(spark):
    wide = spark.createDataFrame([tuple(str(i) for i in range(40))], ", ".join(f"c{i} string" for i in range(40)))
    assert optimized(inference.infer_types(wide)).count("as timestamp") < 10


def test_sparse_bitmaps_are_words(spark):
    rows = spark.range(2000).selectExpr("id * 4096 - 1000000 AS k", "id % 50 AS g")
    words = bitmaps.key_bitmaps(rows, "k", "g")
    assert dict(words.dtypes)["bits"] == "bigint" and words.count() == 2000
    plan = bitmaps.distinct_keys(words, "g")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert bitmaps.distinct_keys(words).first().n == 2000


def test_buckets_grow_with_the_lines(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", 100)
    fact = spark.range(1050).selectExpr("id AS order_id", "id % 300 AS product_id")
    dim = spark.range(300).selectExpr("id AS product_id", "id % 7 AS category")
    stored = buckets.save_star(fact, dim, f"g_{uuid.uuid4().hex}", buckets=2, path=scratch_dir(spark, "buckets"))
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {stored.fact}").collect()}
    assert found["Num Buckets"] == "11"
    assert stored.join(spark, ["category"], "left").filter("category = product_id % 7").count() == 1050


def test_node_arrays_predict_as_the_model_does(spark):
    settings = forecast.ForecastSettings(trees=7, depth=6, only=("a", "b", "c"))
    r = np.random.default_rng(3)
    data = [(float(a), float(b), float(c), float(a * 3 + (b > 2) * 5 + c)) for a, b, c in r.integers(0, 9, (500, 3))]
    rows = spark.createDataFrame(data, "a double, b double, c double, units_sold double")
    model = forecast.forest(settings).fit(rows)
    both = forecast.predict(model, model.transform(rows).withColumnRenamed("prediction", "own").drop("features"))
    assert both.count() == 500 and both.filter("prediction <> own").count() == 0
    assert "MapInArrow" in both._jdf.queryExecution().executedPlan().toString() or "ArrowEvalPython" in (
        both._jdf.queryExecution().executedPlan().toString()
    )
    empty = forecast.predict(model, rows.limit(0))
    assert empty.count() == 0 and empty.collect() == []
    with pytest.raises(PySparkException, match="missing"):
        forecast.predict(model, rows.withColumn("b", F.lit(None).cast("double"))).collect()


def test_records_that_share_a_place(spark):
    records = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "ingest_pos long, t string")
    pages = files.land_records(records, scratch_dir(spark, "pages"))
    got = [record["t"] for record in pages("carts", 10, 0)["carts"]]
    assert sorted(got[:4]) == ["a", "a", "b", "b"] and got[4:] == ["c"] and pages.total == 5


def test_json_arrays_grow_in_number(spark, monkeypatch):
    monkeypatch.setattr(files, "ARRAY_CHARS", 2000)
    rows = [(i, "x" * (3000 if i == 7 else 20), None) for i in range(600)] + [(None, 'a "b"\n', None)]
    df = spark.createDataFrame(rows, "id long, t string, gap string").coalesce(1)
    path = files.land_json_arrays(df, scratch_dir(spark, "arrays"))
    parts = list(Path(path).glob("part-*"))
    assert len(parts) > 10 and all(p.name.endswith(".gz") for p in parts)
    arrays = [r.value for r in spark.read.text(path).collect()]
    assert len(arrays) == len(parts) and sorted(map(len, arrays))[-2] < 2200
    assert all('"gap":null' in a for a in arrays)
    back = spark.read.schema(df.schema).option("multiLine", True).json(path).collect()
    assert sorted(map(str, back)) == sorted(map(str, df.collect()))
    none = files.land_json_arrays(df.limit(0), scratch_dir(spark, "arrays"))
    assert spark.read.schema(df.schema).option("multiLine", True).json(none).count() == 0


def test_an_array_file_holds_one_array_whatever_the_partitions(spark, sf_dir, monkeypatch):
    carts = star.carts_raw(spark, sf_dir)
    monkeypatch.setattr(star, "carts_raw", lambda *_: carts.repartition(40))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = stored_queries()["scan_json_array"](spark, sf_dir)
        assert found.select("order_id").distinct().count() == found.count() == carts.count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
