"""Importance resampling against plain Python and the SQL counterpart."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, lowered, prose, table

from tillroll.llm import importance, oracles
from tillroll.llm.importance import crc_words, features, importance_sample
from tillroll.llm.queries import op12_importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text, n):
    w = WORD.findall(lowered(text))
    return [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    place = lambda g: zlib.crc32(g.encode()) % buckets
    count = lambda texts: np.bincount(
        [place(g) for t in texts for g in grams(t, n)], minlength=buckets
    )
    s, t = count(x for _, x in docs), count(target)
    S, T = float(s.sum()), float(t.sum())
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets))))
        for b in range(buckets)
    ]
    rows = []
    for i, text in docs:
        f = grams(text, n)
        weight, score = sum(gain[place(g)] for g in f), None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(f), weight, score, len(grams(text, 1)) >= min_words and i is not None))
    pool = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0], r[1]))
    k = len(pool) * percent // 100
    drawn = [(*r[:4], at + 1) for at, r in enumerate(pool[:k])]
    rest = pool[k:] + [r for r in rows if not r[4]]
    return drawn + [(*r[:4], None) for r in rest]


def check(spark, docs, target, **more):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = importance_sample(table(spark, docs), texts, **more)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    names = {"max_n": "n"}
    want = plain(docs, target, **{names.get(k, k): v for k, v in more.items() if k != "accuracy"})
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


DOCS = EDGES + [(100 + i, " ".join(prose(i, 10 + i % 50, 200))) for i in range(150)]
TARGET = [None, "", *(" ".join(prose(1000 + i, 30, 90)) for i in range(10))]


@pytest.mark.parametrize("more", [{}, {"max_n": 3, "buckets": 257, "percent": 35}, {"percent": 100}])
def test_against_plain(spark, more):
    check(spark, DOCS, TARGET, **more)


def test_coarse_sketch_is_widened(spark):
    check(spark, DOCS, TARGET, percent=50, accuracy=3)


def test_bracket_falls_back_to_all_scores(spark, monkeypatch):
    monkeypatch.setattr(importance, "_bracket", lambda *a: (None, None, 0))
    check(spark, DOCS, TARGET)


def test_ties_repeated_ids_and_empty_tables(spark):
    text = " ".join(prose(1, 30))
    check(spark, [(1, text)] * 40 + [(2, text)] * 5 + [(3, "x")], [text], percent=50)
    check(spark, [(1, text)] * 9, [])
    check(spark, [], [text])
    check(spark, [(1, None), (2, "")], [None])


def test_long_text_in_blocks():
    r = random.Random(3)
    text = " ".join("é" * r.randrange(1, 9) if i % 7 else "b" * r.randrange(400) for i in range(900))
    for n in (1, 2, 3):
        for limit in (1, 50, 1000, 10**6):
            parts = list(features(pa.array([text]), n, 10_007, limit))
            got = sorted(b for p in parts for b in p.bucket.tolist())
            assert got == sorted(zlib.crc32(g.encode()) % 10_007 for g in grams(text, n))
            assert sum(int(p.words[0]) for p in parts) == len(grams(text, 1))


def test_crc_of_words():
    data = np.frombuffer(bytes(range(256)) * 3, np.uint8)
    start = np.array([0, 5, 5, 100, 300, 0, 7])
    end = np.array([0, 6, 53, 600, 348, 768, 56])
    got = crc_words(data, start, end, np.full(7, zlib.crc32(b"ab"), np.uint32))
    assert got.tolist() == [zlib.crc32(b"ab" + data[a:b].tobytes()) for a, b in zip(start, end)]


def test_sql_counterpart(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    from compare import difference

    assert difference(op12_importance(spark, sf_dir), con, oracles.op12()) is None
