"""Best-fit packing (1) and packed matrices (5)."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import EDGES, table
from tokenizers import Tokenizer

from tillroll.llm.packing import best_fit, pack, pack_documents, pieces
from tillroll.llm.token_output import Capacities, best_fit_decreasing, write_matrix
from tillroll.llm.tokens import cuts, encoder

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(text):
    exact = Tokenizer.from_file(PATH)
    return [*exact.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_are_those_of_the_tokenizers_library():
    r = random.Random(3)
    letters = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(160, 400), 0x2014, 0x1F600, 0x3042]]
    texts = ["".join(r.choices(letters, k=60)) for _ in range(300)]
    texts += [t for _, t in EDGES if t] + ["it's  we'll\n\n x", "a<|endoftext|>b", "x" * 5000]
    exact, ours = Tokenizer.from_file(PATH), encoder(PATH)
    for text in texts:
        assert ours(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def test_cuts_keep_everything():
    for total in (0, 1, 7, 8, 9, 16, 23):
        got = cuts(total, 8)
        assert sum(n for _, n in got) == total
        assert all(n == 8 for _, n in got[1:])
        assert [s for s, _ in got] == [sum(n for _, n in got[:k]) for k in range(len(got))]


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(score):
    r = np.random.default_rng(5)
    sizes = r.uniform(0.02, 0.6, (700, 3))
    bins, rank = best_fit(sizes, (1, 0.5, 0.2), score)
    load = np.zeros((bins.max() + 1, 3))
    np.add.at(load, bins, sizes)
    assert (load <= 1 + 1e-6).all()
    for b in range(bins.max() + 1):
        assert sorted(rank[bins == b]) == list(range((bins == b).sum()))
    assert bins.max() + 1 <= 1.25 * np.ceil(sizes.sum(axis=0).max())


def test_best_fit_against_trying_every_bin():
    r = np.random.default_rng(9)
    sizes = r.integers(1, 60, (120, 2)) / 100
    bins, _ = best_fit(sizes, (1, 0.3))
    order = np.lexsort((np.arange(120), -(sizes @ np.array([1, 0.3]))))
    left, want = [], {}
    for i in order:
        costs = [
            (float((np.array([1, 0.3]) * (np.array(x) - sizes[i]) ** 2).sum()), b)
            for b, x in enumerate(left)
            if (np.array(x) >= sizes[i] - 1e-9).all()
        ]
        b = min(costs)[1] if costs else len(left)
        if not costs:
            left.append([1.0, 1.0])
        left[b] = list(np.array(left[b]) - sizes[i])
        want[i] = b
    assert [want[i] for i in range(120)] == bins.tolist()


def check_places(rows, docs, limit):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for members in by_sequence.values():
        end = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= limit
    want = defaultdict(list)
    for doc_id, text in docs:
        ids = plain_ids(text)
        for k, (start, n) in enumerate(cuts(len(ids), limit)):
            raw = np.array(ids[start : start + n], "<u4").tobytes()
            want[doc_id].append((k, start, n, zlib.crc32(raw)))
    got = {
        d: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rs)
        for d, rs in by_doc.items()
    }
    assert got == {d: sorted(v) for d, v in want.items()}
    return by_sequence


def test_documents_packed_whole(spark):
    rows = pack_documents(table(spark, EDGES), PATH, limit=64).collect()
    sequences = check_places(rows, EDGES, 64)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-total // 64) + 1


def test_further_capacities_hold(spark):
    docs = [(i, "word " * (i % 9)) for i in range(300)]
    rows = pack_documents(
        table(spark, docs), PATH, limit=64, max_documents=3, attention=900.0
    ).collect()
    for members in check_places(rows, docs, 64).values():
        assert len(members) <= 3
        assert sum(r["length"] ** 2 for r in members) <= 900


def test_rounds_and_equal_rows(spark):
    rows = [(7, 100 + i % 5) for i in range(400)]
    items = spark.createDataFrame(rows, "name long, length long")
    packed = pack(items, sizes=["length"], capacities=[1000], weights=[1], round_items=50)
    out = packed.collect()
    assert len(out) == 400
    load = defaultdict(int)
    for r in out:
        load[r["sequence_id"]] += r["length"]
    assert max(load.values()) <= 1000
    with pytest.raises(ValueError):
        pack(items, sizes=["length"], capacities=[1], weights=[1], score="other")


def test_no_documents(spark):
    assert pack_documents(table(spark, []), PATH).count() == 0
    assert pieces(table(spark, []), PATH).count() == 0
    assert write_matrix(table(spark, []), PATH).count() == 0


def test_segment_tree_finds_the_least_capacity():
    r = random.Random(1)
    tree, plain = Capacities(50), []
    for step in range(2000):
        if r.random() < 0.5:
            free = r.randrange(51)
            tree.add(free, step)
            plain.append(free)
        else:
            need = r.randrange(1, 51)
            got = tree.take(need)
            want = min((f for f in plain if f >= need), default=None)
            assert (got[0] if got else None) == want
            if got:
                plain.remove(got[0])


def test_best_fit_decreasing_against_search():
    lengths = np.random.default_rng(2).integers(1, 64, 300)
    rows = best_fit_decreasing(lengths, 64)
    assert sorted(i for row in rows for i in row) == list(range(300))
    free, want = [], []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        fits = [f for f in free if f >= lengths[piece]]
        if fits:
            free[free.index(min(fits))] -= lengths[piece]
        else:
            free.append(64 - lengths[piece])
            want.append(piece)
    assert len(rows) == len(free)
    assert sorted(64 - sum(lengths[row]) for row in rows) == sorted(free)


def test_matrix_round_trip(spark):
    rows = write_matrix(table(spark, EDGES), PATH, slots=64).collect()
    found = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u2")
        places = np.frombuffer(bytes(r["positions"]), "<u2")
        assert len(ids) == len(places) == 64 and r["cu_seqlens"][-1] == r["n_tokens"]
        assert (ids[r["n_tokens"] :] == 50256).all()
        ends = r["cu_seqlens"]
        for owner, number, a, b in zip(r["doc_ids"], r["pieces"], ends, ends[1:], strict=False):
            assert places[a:b].tolist() == list(range(b - a))
            found[owner].setdefault(number, []).append(ids[a:b].tolist())
    assert len({r["row_id"] for r in rows}) == len(rows)
    for doc_id, text in EDGES:
        if doc_id not in (None, 7):
            got = [found[doc_id][k][0] for k in sorted(found[doc_id])]
            assert [i for piece in got for i in piece] == plain_ids(text)
    assert len(found[7][0]) == 2
