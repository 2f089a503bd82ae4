"""Contiguous folds, out-of-fold means, inferred types and rejected values."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import folds
from tillroll.schemas import RAW_PRODUCT
from tillroll.session import scratch_dir
from tillroll.sources import inference


@pytest.mark.parametrize("n,k", [(0, 3), (2, 5), (10, 3), (103, 10), (100, 10)])
def test_fold_sizes_follow_the_remainder(spark, n, k):
    path = scratch_dir(spark, "rows")
    spark.range(0, n, 1, 4).write.option("maxRecordsPerFile", 7).parquet(path)
    rows = sorted(map(tuple, folds.with_contiguous_folds(spark, path, k).select("position", "fold").collect()))
    want = [f for f, part in enumerate(np.array_split(np.arange(n), k)) for _ in part]
    assert rows == list(enumerate(want))


def test_positions_do_not_depend_on_the_tasks(spark):
    path = scratch_dir(spark, "rows")
    spark.range(0, 5000, 1, 3).write.parquet(path)
    first = {tuple(r) for r in folds.stored_positions(spark, path).collect()}
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "2000")
    try:
        again = folds.stored_positions(spark, path)
        assert {tuple(r) for r in again.collect()} == first and len(first) == 5000
        assert "Sort" not in again.filter("position > 1")._jdf.queryExecution().optimizedPlan().toString().split("Window")[0]
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("join", [{}, {"broadcast_limit": -1, "rows_per_slice": 20}])
def test_no_label_is_in_its_own_mean(spark, join):
    r = random.Random(2)
    data = [(r.choice(["a", "b", None, f"one{i}"]), i % 3, r.choice([None, i])) for i in range(120)]
    df = spark.createDataFrame(data, "k string, fold int, y long")
    got = folds.out_of_fold_means(df, "k", "y", "fold", "m", **join).collect()

    def mean(values):
        return float(np.mean(values)) if values else None

    want = []
    for k, f, y in data:
        rest = [v for kk, ff, v in data if kk == k and ff != f and v is not None]
        want.append((k, f, y, mean(rest or [v for _, ff, v in data if ff != f and v is not None])))
    key = lambda row: str(row[:3])
    if join:  # rows without a group match nothing in the sliced join
        assert len(got) <= len(want)
    else:
        assert len(got) == len(want)
    for a in got:
        assert any(a[:3] == b[:3] and np.isclose(a[3], b[3]) for b in want if key(a) == key(b))


def test_types_hold_every_value(spark):
    rows = [(str(i), str(i * 2**33), f"{i}.5", "2025-01-0%d" % (i % 9 + 1), "true", "x", None, " ") for i in range(50)]
    names = [f"c {i}" for i in range(8)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    kinds = lambda d: [r["inferred"] for r in inference.infer_types(d).collect()]
    want = ["int", "bigint", "double", "timestamp", "boolean", "string", "string", "string"]
    assert kinds(df) == kinds(df.repartition(7)) == kinds(df.coalesce(1)) == want
    late = df.unionByName(spark.createDataFrame([("1.5", "x", "y", "z", "0", "1", "7", " 7 ")], df.schema))
    assert kinds(late) == ["double", "string", "string", "string", "boolean", "string", "int", "int"]
    assert [f.dataType.simpleString() for f in inference.inferred_schema(df)] == want
    assert kinds(df.limit(0)) == ["string"] * 8


def test_accepted_and_rejected_values_are_all(spark):
    values = ["1", " 2.5 ", "", "  ", "x", None, "1e3", "NaN", "12345678901234567890123"]
    raw = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "pos long, a string, b string")
    kinds = {"a": "double", "b": "bigint"}
    rejected = inference.rejected_values(raw, kinds, "pos")
    got = {(r["pos"], r["field"]): (r["raw"], r["reason"]) for r in rejected.collect()}
    for field, kind in kinds.items():
        cast = raw.select("pos", F.col(field).alias("v"), F.trim(field).try_cast(kind).alias("n")).collect()
        for r in cast:
            assert ((r["pos"], field) in got) == (r["v"] is not None and r["n"] is None)
    assert got[2, "a"] == ("", "blank") and got[4, "b"] == ("x", "not bigint")


def test_lines_that_are_no_records(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"id": 1, "title": "a"}\nnot json\n{"id": 2}\n{"id": \n')
    rows, corrupt = inference.read_json_and_rejects(spark, str(path), RAW_PRODUCT)
    assert sorted(r["id"] for r in rows.collect()) == [1, 2]
    assert sorted(r["raw"] for r in corrupt.collect()) == ["not json", '{"id": ']
