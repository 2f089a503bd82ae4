"""Context-tree weighting (9) against the definition."""

from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import EDGES, lowered, prose, table

from tillroll.llm import context_tree
from tillroll.llm.context_tree import DEPTH, context_tree_scores

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def learned(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 != 0


class Tree:
    def __init__(self, texts):
        self.n, self.kids = defaultdict(lambda: [0, 0]), defaultdict(set)
        for t in texts:
            for context, node, bit in self.decisions(t):
                for k in range(DEPTH + 1):
                    c = context[DEPTH - k :]
                    self.n[c, node][bit] += 1
                    if c:
                        self.kids[c[1:], node].add(c)
        self.weighted = functools.cache(self.weighted)

    @staticmethod
    def decisions(text):
        s = b"\xff" * DEPTH + lowered(text).encode() + b"\xff"
        for i in range(DEPTH, len(s)):
            for j in range(8):
                yield s[i - DEPTH : i], 1 << j | s[i] >> (8 - j), s[i] >> (7 - j) & 1

    def block(self, c, node):
        a, b = self.n[c, node]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def below(self, c, node):
        return sum(self.weighted(x, node) for x in self.kids[c, node])

    def weighted(self, c, node):
        own = self.block(c, node)
        if len(c) == DEPTH:
            return own
        low, high = sorted((own, self.below(c, node)))
        return high + math.log1p(math.exp(low - high)) - math.log(2)

    def one(self, context, node, k=0):
        c = context[DEPTH - k :]
        if (c, node) not in self.n:
            return 0.5
        a, b = self.n[c, node]
        own = (b + 0.5) / (a + b + 1)
        if k == DEPTH:
            return own
        share = 1 / (1 + math.exp(min(700, self.below(c, node) - self.block(c, node))))
        return share * own + (1 - share) * self.one(context, node, k + 1)

    def score(self, text):
        total = 0.0
        for context, node, bit in self.decisions(text):
            p = self.one(context, node)
            total += math.log10(p if bit else 1 - p)
        return total


@pytest.mark.parametrize("parts", [{}, {"part_contexts": 40, "hot_tokens": 20}])
def test_scores_against_the_definition(spark, parts):
    docs = [(i, " ".join(prose(i, 30, 60)).title()) for i in range(40)]
    docs += [(d and d + 700, (t or "")[:400] if t is not None else None) for d, t in EDGES]
    train = [t for d, t in docs if learned(d)]
    tree = Tree(train)
    count = Counter()
    for t in train:
        count.update(WORD.findall(lowered(t).encode()))
        count["end"] += 1
    total, kinds = sum(count.values()), len(count)
    out = context_tree_scores(table(spark, docs), **parts).collect()
    assert len(out) == len(docs)
    by_id = {}
    for r in out:
        by_id.setdefault(r["doc_id"], []).append(r)
    for d, t in docs:
        if d is None:
            continue
        for r in by_id[d]:
            tokens = [*WORD.findall(lowered(t).encode()), "end"]
            base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
            assert r["held_out"] == (not learned(d)) and r["train_tokens"] == total
            assert r["n_tokens"] == len(tokens) and r["n_known"] == sum(count[w] > 0 for w in tokens)
            assert r["base_score"] == pytest.approx(base, rel=1e-9)
            assert r["score"] == pytest.approx(tree.score(t), rel=1e-5)
            size = len((t or "").encode()) + 1
            assert r["bits_per_byte"] == pytest.approx(-r["score"] / math.log10(2) / size)


def test_nothing_to_learn_from(spark):
    assert context_tree_scores(table(spark, [])).count() == 0
    held = next(d for d in range(1000) if not learned(d))
    (r,) = context_tree_scores(table(spark, [(held, "abc d")])).collect()
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == pytest.approx(0)
    assert r["score"] == pytest.approx(6 * 8 * math.log10(0.5), rel=1e-5)


def test_texts_like_the_corpus_score_better(spark):
    docs = [(i, " ".join(prose(i, 80, 200))) for i in range(120)]
    docs.append((10_000, "".join(chr(33 + (i * i * 31 + i) % 90) for i in range(400))))
    rows = context_tree_scores(table(spark, docs)).collect()
    odd = [r["bits_per_byte"] for r in rows if r["doc_id"] == 10_000 and r["held_out"]]
    usual = [r["bits_per_byte"] for r in rows if r["held_out"] and r["doc_id"] != 10_000]
    assert usual and max(usual) < 4 and (not odd or min(odd) > max(usual))


def test_rare_bits_of_frequent_contexts(spark):
    # one context, so all depths have the same counts; the bytes differ in the sixth bit
    e, rare, context = 0x65, 0x61, 0x616263
    rows = [((context << 8) | e, 300_000_000), ((context << 8) | rare, 8)]
    tree = context_tree.context_tree(spark.createDataFrame(rows, "key long, n long"))
    logs, _, block, of_three = context_tree._tables(tree, 0, 1 << 16)
    assert np.isfinite(logs).all()
    own = logs[of_three[block[context & 0xFFFF] * 256 + (context >> 16)]].astype(float)
    # two more decisions follow, seen eight times each
    assert own[rare] == pytest.approx(math.log10(8.5 / 300_000_009) + 2 * math.log10(8.5 / 9), abs=1e-4)
    assert (10**own).sum() == pytest.approx(1, abs=1e-5)
