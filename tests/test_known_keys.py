"""Key filters before anti joins, and a dimension in which the first row of a key stands."""

from __future__ import annotations

import random

import pytest

from tillroll.operators import known_keys, quality
from tillroll.registry.stored import stored_queries
from tillroll.session import scratch_dir
from tillroll.sinks import versions

ROW = "id long, pos long, said string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_no_key_is_missed_and_few_are_hit_falsely(spark):
    keys = spark.range(0, 20000, 2)
    known = known_keys.key_filter(keys, "id", 12)
    assert known.count() <= 2**12
    marked = known_keys.with_maybe(spark.range(20000), "id", known, "maybe", 12)
    assert marked.filter("id % 2 = 0 and not maybe").count() == 0
    assert marked.filter("id % 2 = 1 and maybe").count() < 300
    # merged from parts, and from keys of another type, it is the same filter
    parts = [known_keys.key_filter(keys.filter(f"id % 3 = {i}"), "id", 12) for i in range(3)]
    assert rows(known_keys.merged(*parts)) == rows(known)
    texts = keys.selectExpr("cast(id AS string) AS id")
    assert rows(known_keys.key_filter(texts, "id", 12)) == rows(known)
    assert rows(known_keys.key_filter(keys.selectExpr("cast(id AS int) AS id"), "id", 12)) == rows(known)
    with pytest.raises(ValueError):
        known_keys.key_filter(keys, "id", known_keys.MOST_LOG_WORDS + 1)


@pytest.mark.parametrize("log_words", [0, 6, 18])
def test_first_row_stands_whatever_the_filter_hits(spark, log_words):
    r = random.Random(7)
    kept, expected = known_keys.FirstWins(spark, scratch_dir(spark, "kept"), "id", "pos", log_words), {}
    with pytest.raises(FileNotFoundError):
        kept.rows()
    for turn in range(4):
        ids = [r.choice([None, 1, *range(60 * (turn + 1))]) for _ in range(80)] + [1] * 40
        said = [(key, pos, f"{turn}-{pos}") for pos, key in enumerate(ids)]
        for key, pos, text in said:
            expected.setdefault(key, (key, pos, text))
        kept.deliver(spark.createDataFrame(random.Random(turn).sample(said, len(said)), ROW))
        assert rows(kept.rows()) == sorted(expected.values(), key=str)
    kept.deliver(spark.createDataFrame([], ROW))
    assert kept.rows().count() == len(expected)


def test_killed_between_filter_and_rows(spark):
    kept = known_keys.FirstWins(spark, scratch_dir(spark, "killed"), "id", "pos")
    kept.deliver(spark.createDataFrame([(1, 0, "a")], ROW))
    more = spark.createDataFrame([(1, 0, "b"), (2, 0, "c")], ROW)
    keys = known_keys.merged(known_keys.key_filter(more, "id"), versions.read_version(spark, f"{kept.base}/keys"))
    versions.write_version(keys, f"{kept.base}/keys")  # and nothing after it
    versions.stage(more, f"{kept.base}/rows")
    assert rows(kept.rows()) == [(1, 0, "a")]
    kept.deliver(more)
    assert rows(kept.rows()) == [(1, 0, "a"), (2, 0, "c")]


def test_stored_rows_nobody_asked_for_meet_no_join(spark):
    stored = spark.range(50000)
    wanted = known_keys.key_filter(spark.range(100), "id")
    there = known_keys.with_maybe(stored, "id", wanted, "asked").filter("asked")
    assert 100 <= there.count() < 200


@pytest.mark.parametrize("log_words", [0, 18])
def test_orphans_equal_the_plain_join(spark, log_words):
    fact = spark.createDataFrame(
        [(k, i) for i, k in enumerate([None, None, 1, 1, 2, 3, 900] + [5] * 50 + [6] * 50)], "id long, n long"
    )
    dim = spark.createDataFrame([(1,), (5,), (None,), (7,)], "id long")
    got = known_keys.orphans_by_filter(fact, dim, "id", log_words)
    assert rows(got) == rows(quality.orphans(fact, dim, "id"))
    assert known_keys.orphans_by_filter(fact.limit(0), dim, "id").count() == 0
    assert known_keys.orphans_by_filter(fact, dim.limit(0), "id").count() == fact.count()


def test_fact_is_not_exchanged(spark, sf_dir):
    plan = stored_queries()["orphans_by_known_keys"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not any("l_orderkey" in line or "order_id" in line for line in moved)
