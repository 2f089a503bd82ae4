"""N-gram Jaccard join (3), substring dedup (2) and decontamination (10)."""

from __future__ import annotations

import random

import numpy as np
import pytest
from helpers import EDGES, prose, shingles, table, words

from tillroll.llm import chaining, jaccard_join
from tillroll.llm.components import components, merged_components
from tillroll.llm.decontaminate import contained_items, without_contained


def edited(base, seed, edits):
    r, w = random.Random(seed), list(base)
    for _ in range(edits):
        at = r.randrange(len(w))
        w[at : at + r.choice([0, 1])] = [f"e{r.randrange(10**6)}"]
    return w


def families():
    """Copies, near copies on both sides of the limit, and a large group of near copies."""
    docs, n = [], 0
    for f in range(12):
        base = prose(f, 40 + 37 * f)
        for v in range(6):
            docs.append((n, " ".join(edited(base, 100 * f + v, v * (f % 4)))))
            n += 1
    base = prose(77, 120)
    for v in range(150):
        docs.append((n, " ".join(edited(base, 5000 + v, v % 7))))
        n += 1
    docs += [(n + i, " ".join(prose(77, 120))) for i in range(30)]
    return docs


def common_passages():
    """Documents that share passages of every length, some of them to four fifths or so."""
    docs, notices = [], [prose(900 + k, 25 + 15 * k, 500) for k in range(4)]
    for i in range(160):
        r = random.Random(i)
        own = prose(10_000 + i, r.choice([6, 12, 30, 80]))
        for notice in r.sample(notices, r.randrange(1, 4)):
            at = r.randrange(len(own))
            own[at:at] = notice
        docs.append((20_000 + i, " ".join(own)))
    for i in range(60):  # a notice with little else: similar, and often not enough
        docs.append((30_000 + i, " ".join(edited(notices[3] + notices[1], i, 1 + i % 12))))
    return docs


def brute_components(docs, n, percent):
    sets = [shingles(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]) and both:
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(
        str((d, len(sets[i]), least[find(i)] if sets[i] else d)) for i, (d, _) in enumerate(docs)
    )


@pytest.mark.parametrize(
    "n,percent,block,frequent", [(3, 90, 256, 24), (5, 80, 8, 4), (3, 90, 16, 3), (5, 80, 256, 24)]
)
def test_jaccard_against_all_pairs(spark, monkeypatch, n, percent, block, frequent):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "PARTNERS", 5)
    docs = families() + common_passages() + [(d and d + 5000, t) for d, t in EDGES]
    out = jaccard_join.jaccard_components(table(spark, docs), n=n, percent=percent).collect()
    got = sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in out)
    assert got == brute_components(docs, n, percent)


def test_frequent_passages_build_no_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    docs = table(spark, [(i, " ".join(prose(1, 60) + prose(i, 120))) for i in range(120)])
    for known in (True, False):
        if not known:
            monkeypatch.setattr(jaccard_join, "FREQUENT", 10**9)
        held = jaccard_join._profiles(docs, "doc_id", "text", 5, 80).select("signatures")
        counts = held.selectExpr("explode(signatures) AS s").groupBy("s").count()
        most = counts.selectExpr("max(count)").first()[0]
        assert (most < 40) == known


def test_repeated_rows_of_two_linked_texts(spark):
    a, b = prose(3, 200), edited(prose(3, 200), 1, 3)
    docs = [(1, " ".join(a)), (2, " ".join(b))] * 40
    out = jaccard_join.jaccard_components(table(spark, docs)).collect()
    assert len(out) == 80 and {r["component_id"] for r in out} == {1}
    pairs = spark.createDataFrame([(1, 2, 3, 3)], "a long, b long, size_a long, size_b long")
    first = spark.createDataFrame([(1, (1, 0)), (2, (2, 0))], "key long, row struct<doc_id:long,text_hash:long>")
    assert jaccard_join._links(pairs, table(spark, docs), first, "doc_id", "text", 3, 90).count() == 0


def test_no_documents_to_join(spark):
    assert jaccard_join.jaccard_components(table(spark, [])).count() == 0
    only_empty = jaccard_join.jaccard_components(table(spark, [(3, None), (4, " ")])).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in only_empty) == [(3, 0, 3), (4, 0, 4)]


def test_linked_sets_share_a_signature():
    r = np.random.default_rng(8)
    for size in (3, 10, 40, 300, 2000):
        for _ in range(15):
            x = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
            drop = int(len(x) * 0.1)
            y = np.unique(np.concatenate([x[drop:], r.integers(0, 2**63, r.integers(0, 3)).astype(np.uint64)]))
            if 100 * len(np.intersect1d(x, y)) < 90 * len(np.union1d(x, y)) or np.array_equal(x, y):
                continue
            rows = np.repeat([0, 1], [len(x), len(y)])
            sizes = np.array([len(x), len(y)])
            every = np.unique(jaccard_join.signatures(rows, np.concatenate([x, y]), sizes, 90, None)[1])
            for share in (0.0, 0.5, 1.0):  # whatever the order, a shared one is left
                some = every[r.random(len(every)) < share]
                order = jaccard_join.Frequent(some, r.integers(1, 5, len(some)))
                row, sig = jaccard_join.signatures(rows, np.concatenate([x, y]), sizes, 90, order)
                assert set(sig[row == 0]) & set(sig[row == 1])
            bits = jaccard_join.parity_bitmaps(rows, np.concatenate([x, y]), 2)
            apart = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
            assert apart <= len(np.setxor1d(x, y))


def test_bitmaps_of_long_sets_tell_them_apart():
    r = np.random.default_rng(8)
    sizes = np.array([0, 900, 1500, 4000, 20000, 20000])
    rows = np.repeat(np.arange(6), sizes)
    hashes = r.integers(0, 2**63, len(rows)).astype(np.uint64)
    bits, at = jaccard_join.sized_bitmaps(rows, hashes, sizes)
    assert (np.diff(at) * 64).tolist() == [1024, 1024, 2048, 4096, 16384, 16384]
    short = jaccard_join.parity_bitmaps(rows, hashes, 6)
    for i in range(6):  # folded, they are the bitmaps of 1024 bits
        assert (np.bitwise_xor.reduce(bits[at[i] : at[i + 1]].reshape(-1, 16)) == short[i]).all()
    one, two = bits[at[4] : at[5]], bits[at[5] : at[6]]
    linked = 40000 * 20 // 180  # what two linked sets can differ by at 80 percent
    assert np.bitwise_count(one ^ two).sum() > linked > np.bitwise_count(short[4] ^ short[5]).sum()


def test_links_of_long_texts_with_bitmaps_of_two_lengths(spark):
    docs, base = [], prose(61, 1200, 10**6)
    for i in range(6):  # sets of 1,018 to 1,098 shingles, on both sides of 1,024
        docs.append((i, " ".join(edited(base[: 1020 + 16 * i], i, 2))))
        other = base[:60] + prose(70 + i, 950 + 20 * i, 10**6)
        docs.append((10 + i, " ".join(other)))  # the same beginning, otherwise unlike
    out = jaccard_join.jaccard_components(table(spark, docs), n=3, percent=80)
    got = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert got == {**{i: 0 for i in range(6)}, **{10 + i: 10 + i for i in range(6)}}


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (7, 7), (None, 3)]
    out = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {**{i: 0 for i in range(61)}, **{i: 100 for i in (100, 101, 102)}}
    assert {r["node"]: r["root"] for r in out} == want and len(out) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_more_links(spark):
    r = random.Random(5)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(260)] + [(0, i) for i in range(0, 400, 9)]
    kind, cuts, roots = "a long, b long", (0, 40, 150, len(links)), None
    for begin, stop in zip(cuts[:-1], cuts[1:], strict=True):
        new = spark.createDataFrame(links[begin:stop], kind)
        if roots is None:
            roots = components(new).withColumnRenamed("node", "key")
        else:
            roots = merged_components(roots, new, "key")
        whole = components(spark.createDataFrame(links[:stop], kind))
        assert sorted(map(tuple, roots.select("key", "root").collect())) == sorted(map(tuple, whole.collect()))
    same = merged_components(roots, spark.createDataFrame([], kind), "key")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, roots.select("key", "root").collect()))
    edges = {}
    for a, b in links:
        edges.setdefault(a, set()).add(b)
        edges.setdefault(b, set()).add(a)
    for node, root in map(tuple, roots.select("key", "root").collect()):
        seen, todo = {node}, [node]
        while todo:
            more = edges[todo.pop()] - seen
            seen |= more
            todo += more
        assert root == min(seen)


# -- substring dedup -----------------------------------------------------------------------


def brute_chain(a, b, k, gap_cost=chaining.GAP_COST):
    order = sorted(range(len(a)), key=lambda i: (a[i], -b[i]))
    score = {}
    for i in order:
        score[i] = float(k)
        for j in order:
            if j in score and j != i and a[j] < a[i] and b[j] < b[i]:
                gap = max(a[i] - a[j], b[i] - b[j]) - k
                drift = abs((a[i] - a[j]) - (b[i] - b[j]))
                gain = score[j] + min(k, a[i] - a[j], b[i] - b[j])
                score[i] = max(score[i], gain - gap_cost * (max(gap, 0) + drift))
    return max(score.values())


def test_chains_follow_both_texts():
    a = np.array([0, 6, 12, 18, 40, 3, 25])
    b = np.array([100, 106, 112, 118, 10, 300, 125])
    best = chaining.chain(a, b, 5)[0]
    assert best == [0, 1, 2, 3, 6]
    assert sorted(i for c in chaining.chain(a, b, 5) for i in c) == list(range(7))
    assert brute_chain(a, b, 5) == 5 + 5 * 4 - chaining.GAP_COST * (1 * 3 + 2)


def test_minimizers_promise_a_shared_seed():
    r = np.random.default_rng(1)
    k, window = 5, 12
    for _ in range(60):
        common = r.integers(0, 2**62, k + window - 1).astype(np.uint64)
        seeds = []
        for _ in range(2):
            ends = [r.integers(0, 2**62, r.integers(0, 30)).astype(np.uint64) for _ in range(2)]
            h = np.concatenate([ends[0], common, ends[1]])
            seeds.append(set(chaining.minimizers(h, np.zeros(len(h), int), k, window)[1].tolist()))
        assert seeds[0] & seeds[1]
    place, _ = chaining.minimizers(np.zeros(500, np.uint64), np.zeros(500, int), k, window)
    assert len(place) == 1  # one word over and over


def full_alignment(x, y):
    """The best local alignment's score by the whole matrix."""
    score = np.zeros((len(x) + 1, len(y) + 1), int)
    for i in range(1, len(x) + 1):
        for j in range(1, len(y) + 1):
            score[i, j] = max(
                0,
                score[i - 1, j - 1] + (chaining.MATCH if x[i - 1] == y[j - 1] else chaining.OTHER),
                score[i - 1, j] + chaining.SKIP,
                score[i, j - 1] + chaining.SKIP,
            )
    return score.max()


def test_banded_alignment_finds_the_best_local_one():
    for seed in range(12):
        base = np.random.default_rng(seed).integers(1, 10**6, 70)
        r = random.Random(seed)
        other = [int(v) for v in base]
        for _ in range(seed % 5):
            at = r.randrange(10, 60)
            other[at : at + r.choice([0, 1, 2])] = [r.randrange(10**7, 10**8)] * r.choice([0, 1])
        x = np.concatenate([np.arange(20), base, np.arange(30, 40)]).astype(np.uint32)
        y = np.concatenate([np.arange(200, 212), other, np.arange(300, 320)]).astype(np.uint32)
        anchors = (np.array([20, 85]), np.array([12, 12 + len(other) - 5]))
        a0, a1, b0, b1, n = chaining.align([x], [y], [anchors])[0]
        assert n == len(set(x[a0:a1].tolist()) & set(y[b0:b1].tolist()))
        edits = max(a1 - a0, b1 - b0) - n
        assert full_alignment(x, y) <= n and n >= 70 - 3 * (seed % 5) and edits <= 8


def test_a_straight_passage_is_what_the_matrix_finds():
    r = np.random.default_rng(5)
    left, right, shifts = [], [], []
    for i in range(400):
        size, before, after = r.integers(20, 150), r.integers(0, 100), r.integers(0, 100)
        vocabulary = (4, 30, 10**6)[i % 3]
        core = r.integers(0, vocabulary, size)
        x = np.concatenate([r.integers(0, vocabulary, before), core, r.integers(0, vocabulary, after)])
        head = r.integers(0, 100)
        y = np.concatenate([r.integers(0, vocabulary, head), core, r.integers(0, vocabulary, r.integers(0, 100))])
        wrong = r.integers(head, head + size, i % 9)
        y[wrong] = r.integers(0, 10**7, len(wrong))
        if i % 5 == 4:  # a word more, somewhere
            y = np.insert(y, head + size // 2, 7)
        left.append(x.astype(np.uint32))
        right.append(y.astype(np.uint32))
        shifts.append(int(before) - int(head))
    got, certain = chaining.straight(left, right, shifts)
    assert 100 < certain.sum() < 400
    at = [np.array([0, len(y) - 1]) for y in right]
    want = chaining.align(left, right, [(a + s, a) for a, s in zip(at, shifts, strict=True)])
    assert (got[certain] == want[certain]).all()
    assert chaining.straight([], [], [])[0].shape == (0, 5)


def test_repeated_passages_are_found_and_clean_texts_left(spark):
    passage = prose(1, 70)
    docs = [(i, " ".join(prose(1000 + i, 150 + i))) for i in range(40)]
    for i in range(0, 20):  # the passage, with up to four edits, in the middle of other text
        w = words(docs[i][1])
        w[50:50] = edited(passage, i, i % 5)
        docs[i] = (i, " ".join(w))
    docs += [(50, docs[39][1]), (51, docs[39][1].upper())]  # copies of a text
    short = " ".join(prose(5, 30))
    docs += [(60, short), (61, short)]
    docs += [(d and d + 900, t) for d, t in EDGES]
    out = chaining.repeated_passages(table(spark, docs)).collect()
    rows = {}
    for r in out:
        rows.setdefault(r["doc_id"], []).append(r)
    assert set(rows) == {*range(20), 39, 50, 51}
    texts = dict(docs)
    for i in range(20):
        (r,) = rows[i]
        inside = words(texts[i])[r["start_word"] : r["end_word"]]
        assert len(set(inside) & set(passage)) >= 60 and len(inside) <= 80
        assert r["partner_id"] in range(20) and r["class_id"] == i
    assert {(r["doc_id"], r["class_id"], r["partner_id"]) for d in (39, 50, 51) for r in rows[d]} == {
        (39, 39, 51), (50, 39, 39), (51, 39, 39)
    }
    assert chaining.repeated_passages(table(spark, [])).count() == 0


def test_passages_whose_parts_other_documents_hold(spark):
    docs = []
    for f in range(12):  # two documents share 60 words, two others have one half each
        base, n = prose(7000 + f, 60, 10**6), 10 * f
        for i, part in enumerate((base, base, base[:30], base[30:])):
            rest = prose(8000 + n + i, 120, 10**6)
            docs.append((n + i, " ".join(rest[:50] + part + rest[50:])))
    pieces = [prose(9000 + i, 26 + i % 9, 10**6) for i in range(24)]
    for i in range(60):  # three pieces in any order: most repeats are parts of several others
        r = random.Random(i)
        docs.append((500 + i, " ".join(prose(9500 + i, 40, 10**6) + sum(r.sample(pieces, 3), []))))
    docs += [(800, " ".join(["la"] * 70 + prose(1, 60, 10**6))), (801, " ".join(prose(2, 60, 10**6) + ["la"] * 55))]
    want = {}
    for d, t in docs:
        w = words(t)
        for p in range(len(w) - 49):
            want.setdefault(tuple(w[p : p + 50]), set()).add((d, p))
    want = [x for g in want.values() if len({d for d, _ in g}) > 1 for x in g]
    assert {d for d, _ in want} >= {10 * f + i for f in range(12) for i in range(2)}
    got = {}
    for r in chaining.repeated_passages(table(spark, docs)).collect():
        got.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"]))
        assert r["partner_id"] != r["doc_id"] and r["matched"] >= 40
    missed = [(d, p) for d, p in want if not any(a <= p and p + 50 <= b for a, b in got.get(d, []))]
    assert not missed
    assert not set(got) & {10 * f + i for f in range(12) for i in (2, 3)}


def test_edited_passages_whose_parts_other_documents_hold(spark):
    docs = []
    for f in range(8):  # no 50 equal words in a row, and three smaller or larger pivots for each half
        base, n = prose(17000 + f, 60, 10**6), 10 * f
        changed = [f"edit{i}" if i in (20, 40) else w for i, w in enumerate(base)]
        for i, part in enumerate((base, changed, *[base[:30], base[30:]] * 3)):
            rest = prose(18000 + n + i, 120, 10**6)
            docs.append((n + i, " ".join(rest[:50] + part + rest[50:])))
    rows = chaining.repeated_passages(table(spark, docs)).collect()
    got = {(r["doc_id"], r["start_word"], r["end_word"], r["partner_id"], r["matched"]) for r in rows}
    assert got == {(10 * f + i, 50, 110, 10 * f + 1 - i, 58) for f in range(8) for i in range(2)}


def test_edited_passages_of_a_large_group_meet_few_classes(spark, monkeypatch):
    docs = []
    for f in range(4):
        base, n = prose(27000 + f, 62, 10**6), 1000 * f
        for i in range(24):  # each with edits of its own, no 50 equal words in a row
            changed = [f"edit{n + i}x{j}" if j in (20, 41) else w for j, w in enumerate(base)]
            rest = prose(28000 + n + i, 120, 10**6)
            docs.append((n + i, " ".join(rest[:50] + changed + rest[50:])))
        for i in range(240):  # most seeds of a third have their pivot here, where no passage is
            third = base[21 * (i % 3) : 21 * (i % 3) + 20]
            docs.append((n + 100 + i, " ".join(prose(40000 + n + i, 30, 10**6) + third + prose(50000 + n + i, 30, 10**6))))
    made, plain = {}, chaining.materialise

    def counted(df, purpose):
        out = plain(df, purpose)
        made.setdefault(purpose, []).append(out.count())
        return out

    monkeypatch.setattr(chaining, "materialise", counted)
    rows = chaining.repeated_passages(table(spark, docs)).collect()
    assert {(r["doc_id"], r["start_word"], r["end_word"]) for r in rows} == {(1000 * f + i, 50, 112) for f in range(4) for i in range(24)}
    assert all(r["partner_id"] != r["doc_id"] and r["matched"] == 60 for r in rows)
    assert sum(made["chains"][2:]) <= 4 * 48  # up to 24 * 23 / 2 pairs a family otherwise


def test_places_as_lists_are_the_matches_of_all_places(spark):
    r = np.random.default_rng(3)
    one, rows = [], []
    for a, b in ((1, 2), (1, 3), (2, 3)):
        for _ in range(4):
            n, m = r.integers(1, 9, 2)
            ends = [
                [(int(x), int(x) + 20 + int(d), bool(f)) for x, d, f in zip(r.integers(0, 400, s), r.integers(0, 80, s), r.integers(0, 2, s))]
                for s in (n, m)
            ]
            one.append((a, b, *(tuple(map(list, zip(*e))) for e in ends)))
            rows += [(a, b, x[i], y[i]) for x in ends[0] for y in ends[1] if x[2] or y[2] for i in (0, 1)]
    at = "struct<one:array<int>,two:array<int>,open:array<boolean>>"
    lists = spark.createDataFrame(one, f"a long, b long, at_a {at}, at_b {at}")
    plain = spark.createDataFrame(rows, "a long, b long, pos_a int, pos_b int").distinct()
    got = [sorted(map(str, chaining._chains(m, 5, 25).collect())) for m in (lists, plain)]
    assert got[0] == got[1] and got[0]
    big = [np.arange(30), np.arange(30) + 25, np.ones(30, bool)]
    assert (chaining._met(big, big, 40) == chaining._met(big, big)).all()


# -- decontamination -----------------------------------------------------------------------


def test_containment_against_all_pairs(spark):
    items = [(i, " ".join(prose(300 + i, 8 + 9 * i))) for i in range(12)]
    items += [(90, None), (91, ""), (92, "a b"), (3, "another text under an id that is taken already"), items[5]]
    docs = []
    for i in range(80):
        w = prose(i, 400 if i % 9 else 4000)
        hit = words(items[i % 12][1])
        if i % 3 == 0:
            w[100:100] = hit
        elif i % 3 == 1:  # in two places, and with an edit
            w[300:300] = hit[len(hit) // 2 :]
            w[40:40] = edited(hit[: len(hit) // 2], i, i % 2)
        docs.append((i, " ".join(w)))
    docs += [(200, "A b"), (201, "a b c")] + [(d and d + 900, t) for d, t in EDGES]
    want = []
    for d, t in docs:
        for i, x in set(items):
            s = shingles(x, 5)
            both = len(s & shingles(t, 5))
            if s and 100 * both >= 80 * len(s):
                want.append((d, i, len(s), both, both / len(s)))
    frame = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, hashes int")
    for limit in (10**6, 60):
        out = contained_items(table(spark, docs), frame, block_shingles=limit).collect()
        assert sorted(map(tuple, out)) == sorted(want)
    clean = without_contained(table(spark, docs), frame)
    hit = {d for d, *_ in want}
    assert clean.columns == table(spark, docs).columns
    key = lambda v: (v is None, v or 0)
    assert sorted((r["doc_id"] for r in clean.collect()), key=key) == sorted(
        (d for d, _ in docs if d not in hit), key=key
    )
    assert contained_items(table(spark, []), frame).count() == 0
    assert contained_items(table(spark, docs), frame.limit(0)).count() == 0
