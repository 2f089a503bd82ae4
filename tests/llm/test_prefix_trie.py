"""The prefix trie against nested dictionaries and the SQL counterpart."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tillroll.llm import oracles, prefix_trie as module
from tillroll.llm.prefix_trie import Slots, prefix_trie
from tillroll.llm.queries import op11_prefix_trie

FIELDS = "conv_id long, turn long, role string, text string"
CLASHING = "conv long, depth long, shard long, k1 string, place string, one string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "k", "p", "1") for r in rows], f"{FIELDS}, {CLASHING}")


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            place = (turn is not None, turn or 0, role, digest)
            own.setdefault(conv, []).append((place, (role, text)))
    own = {c: [said for _, said in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        said = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
        ends.setdefault(tuple(said), []).append(c)
    children, leaves, saved = {}, {}, {}
    for path in members:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path in members:
        own_saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] = saved.get(path[:d], 0) + own_saved
            leaves[path[:d]] = leaves.get(path[:d], 0) + (path not in children)
    return sorted(
        (
            min(m),
            len(path),
            min(members[path[:-1]]) if path else -1,
            len(m),
            children.get(path, 0),
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, m in members.items()
    )


def check(spark, rows, **more):
    got = prefix_trie(table(spark, rows), **more)
    got = sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in got.collect())
    assert got == plain(rows)
    return got


def talk(seed, convs, length, said=3):
    r = random.Random(seed)
    return [
        (c, t, r.choice(["user", "assistant"]), f"é{r.randrange(said)}")
        for c in convs
        for t in range(r.randrange(1, length))
    ]


EDGES = [
    (0, 3, "user", "late"),
    (0, None, "system", None),
    (0, 1, None, "first"),
    (0, 1, None, "first"),
    (0, 1, "user", ""),
    (1, 0, "user", ""),
    (2, -5, "", "user"),
    (None, 0, "user", "nobody"),
    (13, 0, "ab", "c"),
    (14, 0, "a", "bc"),
    (17, None, None, None),
    *((25, t, "user", f"turn {t}") for t in range(40)),
    *((26, t, "user", f"turn {t}") for t in range(40)),
    (28, 0, "user", "long " * 50_000),
]


@pytest.mark.parametrize("more", [{}, {"band": 4, "shard_rows": 20}])
def test_edges(spark, more):
    check(spark, EDGES, **more)


@pytest.mark.parametrize("more", [{}, {"band": 3, "shard_rows": 50}, {"band": 5, "shard_rows": 10**6}])
def test_random(spark, more):
    check(spark, talk(1, range(80), 30, 2), **more)


def test_hot_conversation_and_hot_prefix(spark):
    hot = [(5, t, "user", f"{t % 3}") for t in range(600)]
    same = [(c, t, "user", "same") for c in range(100, 160) for t in range(3)]
    check(spark, hot + same, band=16, shard_rows=100)


def test_absent_base_and_empty_table(spark):
    check(spark, talk(2, range(3, 90, 7), 12), band=4)
    assert prefix_trie(table(spark, EDGES).limit(0)).collect() == []


def test_colliding_digests_are_digested_anew(spark, monkeypatch):
    whole = module._salted

    def weak(a, b, depth, salt):
        m1, m2 = whole(a, b, depth, salt)
        return (m1, m2) if salt else (m1 & np.uint64(1), m2 & np.uint64(1))

    rows = talk(3, range(40), 9)
    turns = module.turn_digests(table(spark, rows), "conv_id", "turn", "role", "text")
    parts = module.rebuilt_turns(turns)
    run = module.shard_nodes(8, 0)
    frame = parts[0].withColumns({"shard": module.F.lit(0).cast("long"), "p1": module.F.lit(0).cast("long")})
    frame = frame.withColumn("p2", frame.p1).toArrow()
    assert not any(run(frame).column("clash").to_pylist())
    monkeypatch.setattr(module, "_salted", weak)
    assert any(run(frame).column("clash").to_pylist())


def test_slots_are_minimal_perfect_and_verified():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = r.integers(0, 2**63, (2, n)).astype(np.uint64)
        slots = Slots(*keys)
        assert sorted(slots.find(*keys).tolist()) == list(range(n))
        other = r.integers(0, 2**63, (2, 5000)).astype(np.uint64)
        assert (slots.find(*other) == -1).all()


def test_sql_counterpart(spark, sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    from compare import difference

    assert difference(op11_prefix_trie(spark, sf_dir), con, oracles.op11()) is None
