"""Line cleaning (7), secrets (4), toxicity (8) and preferences (6)."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import EDGES, prose, table

from tillroll.llm import secret_scan as secrets
from tillroll.llm import toxicity as tox
from tillroll.llm.line_cleaning import clean_lines
from tillroll.llm.preferences import format_preferences, swapped_answers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    often = Counter(windows)
    again = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": dup,
        "n_repeat_words": len(again),
        "base_failed": len(w) < 10 or 100 * len(again) > 20 * len(w),
    }


MENU = "Home | News | Sport | About | Contact | Help"
LINES = [
    (20, "A clean line of ten words that ends as it should do.\n" + MENU),
    (21, MENU + "\n" + MENU + "\nThree more words."),
    (22, "a b c d e f a b c d e f g a b c d e x\nsame\nsame\n\nsame "),
    (23, "x " * 12),
    (24, "WIN!! BIG!! NOW!! HERE!! FREE!! CASH!! CLICK!! FAST!! GO!! YES!!"),
    (25, "All rights reserved.\nThis text has quite a few words in it, and all of them stay."),
]


def test_line_cleaning_against_plain_python(spark):
    docs = EDGES + LINES
    out = clean_lines(table(spark, docs))
    assert not re.search("Python|Arrow", out._jdf.queryExecution().executedPlan().toString())
    got = sorted(
        (str(r["doc_id"]), *(r[c] for c in counted(""))) for r in out.collect()
    )
    want = sorted((str(d), *counted(t).values()) for d, t in docs)
    assert got == want
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[20]["kept"] and rows[20]["cleaned"].count("\n") == 0
    assert not rows[21]["kept"] and not rows[24]["kept"]
    assert rows[25]["kept"] and "rights" not in rows[25]["cleaned"]
    assert not rows[6]["kept"] and not rows[2]["kept"] and not rows[1]["kept"]
    assert clean_lines(table(spark, [])).count() == 0


KEY = "AKIA" + "B7" * 9
SECRETS = [
    (30, f"key {KEY} and api_key='abc/DEF+0123456' end"),
    (31, "token: secret: abcdefghijkl password=short " + "0123456789abcdef" * 3),
    (32, "ünï PassWord = \"aaaaaaaaaaaa\" Ⅷ deadbeefdeadbeef"),
    (33, "AKIASHORT deadbeef password ="),
]


def test_base_spans_are_exact():
    text = SECRETS[0][1]
    assert [(k, text[s:e]) for s, k, e in secrets.base_spans(text)] == [
        (1, KEY),
        (0, "api_key='abc/DEF+0123456"),
    ]
    # the first match takes "token: secret" and fails, and what it took is not looked at again
    assert [k for _, k, _ in secrets.base_spans(SECRETS[1][1])] == [2]
    assert secrets.base_spans(SECRETS[3][1]) == []


def brute_viterbi(emit, first, model):
    best = None
    for path in itertools.product(range(3), repeat=len(emit)):
        value = 0.0
        for t, s in enumerate(path):
            value += model.first[s] if first[t] else model.step[path[t - 1], s]
            value += emit[t, s]
        if best is None or value > best[0]:
            best = (value, path)
    return best[1]


def test_viterbi_is_exact_over_stretches_and_texts():
    r = np.random.default_rng(0)
    for n in (1, 2, 5, 7):
        model = secrets.Tagger(np.zeros((1, 3)), r.normal(size=(3, 3)), r.normal(size=3))
        emit = r.normal(size=(n, 3))
        first = np.array([t in (0, 3) for t in range(n)])
        for length in (1, 2, 3, 50):
            got = secrets.viterbi(emit, first, model, length)
            assert tuple(got) == brute_viterbi(emit, first, model)


def noise(seed):
    w = prose(seed, 40)
    hexed = "".join(np.random.default_rng(seed).choice(list("0123456789abcdef"), 40))
    return " ".join(w[:20] + ["token", "=", f'"{hexed}"'] + w[20:]) if seed % 3 == 0 else " ".join(w)


def test_tagger_adds_what_patterns_miss_and_spares_prose(spark):
    train = table(spark, [(i, noise(i)) for i in range(300)])
    model = secrets.fit_tagger(train)
    secret = "Zk3v9Qp1Lm8Xw2Rt7Yb4Nc6Hd5"
    docs = [
        (1, f'we set credentials = "{secret}" here'),
        (2, "plain words that hold nothing to hide at all"),
        *((100 + i, " ".join(prose(900 + i, 60))) for i in range(20)),
    ]
    found = {r["doc_id"]: r["spans"] for r in secrets.find_secrets(table(spark, docs), model).collect()}
    assert [(s["kind"], docs[0][1][s["start"] : s["end"]]) for s in found[1]] == [("crf", secret)]
    assert all(not s for d, s in found.items() if d != 1)


def test_repeated_ids_send_one_text_to_the_fit(spark, monkeypatch):
    docs = [(i, noise(i)) for i in range(40)]
    sizes = []
    monkeypatch.setattr(secrets, "fit", lambda x, y: sizes.append(x.shape))
    secrets.fit_tagger(table(spark, docs))
    secrets.fit_tagger(table(spark, docs + docs[:1] * 2000 + docs[3:4] * 500))
    assert sizes[0] == sizes[1]


def test_secrets_of_odd_rows(spark):
    docs = EDGES + SECRETS
    model = secrets.fit_tagger(table(spark, docs))
    out = secrets.find_secrets(table(spark, docs), model).collect()
    assert len(out) == len(docs)
    want = sorted(str((d, secrets.base_spans(t or ""))) for d, t in docs)
    kinds = secrets.KINDS
    got = sorted(
        str((r["doc_id"], [(s["start"], kinds.index(s["kind"]), s["end"]) for s in r["spans"] if s["kind"] != "crf"]))
        for r in out
    )
    assert got == want
    clean = secrets.redact_secrets(table(spark, docs), model)
    assert clean.columns == table(spark, docs).columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect() if r["doc_id"] != 7}
    assert KEY not in texts[30] and texts[1] is None and texts[2] == ""
    assert texts[30] == "key [SECRET] and [SECRET]' end"
    empty = table(spark, [])
    assert secrets.find_secrets(empty, secrets.fit_tagger(empty)).count() == 0


def labelled(spark):
    docs, labels = [], []
    for i in range(400):
        w = prose(i, 60)
        bad, worse = i % 4 == 0, i % 8 == 0
        if bad:
            w[10:10] = ["grumpy", "nasty"][i % 3 == 0 :]
        if worse:
            w[30:30] = ["threatful"]
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad), int(worse)))
    return docs, spark.createDataFrame(labels, "doc_id long, rude int, threat int")


def test_chain_learns_and_feeds_earlier_categories(spark):
    docs, labels = labelled(spark)
    held, seen = [d for d in docs if d[0] % 5 == 0], [d for d in docs if d[0] % 5]
    chain = tox.train_chain(table(spark, seen), labels, ["rude", "threat"])
    assert len(chain.links[1].earlier) == 1 and chain.links[1].earlier[0] > 0
    out = tox.score_toxicity(table(spark, held), chain, verdict="threat").collect()
    want = {d: d % 8 == 0 for d, _ in held}
    right = sum(r["is_toxic"] == want[r["doc_id"]] for r in out)
    assert right >= 0.95 * len(held)
    left = {r["doc_id"] for r in tox.without_toxic(table(spark, held), chain, verdict="threat").collect()}
    assert left == {r["doc_id"] for r in out if not r["is_toxic"]}


def test_out_of_fold_probabilities_are_not_those_of_the_fit():
    r = np.random.default_rng(4)
    # labels that nothing explains: a fit remembers them, held-out folds cannot
    texts = [(np.unique(r.integers(0, 400, 60)).astype(np.uint64), None) for _ in range(200)]
    texts = [(h, np.full(len(h), 0.02, np.float32)) for h, _ in texts]
    labels = r.integers(0, 2, (200, 2)).astype(float)
    chain = tox.fit_chain(texts, labels, np.arange(200) % 5, ["a", "b"], decay=0.01)
    assert 0.3 < chain.held_out[0][0] < 0.7


def test_repeated_rows_of_an_id_train_as_one(spark):
    docs, labels = labelled(spark)
    once = tox.train_chain(table(spark, docs), labels, ["rude", "threat"])
    many = table(spark, docs).unionByName(table(spark, docs[:1] * 3000))
    again = tox.train_chain(many, labels, ["rude", "threat"])
    for a, b in zip(once.links, again.links, strict=True):
        assert a.hashes.tolist() == b.hashes.tolist() and np.allclose(a.present, b.present)


def test_prediction_is_the_plain_sum_of_weights(spark):
    docs, labels = labelled(spark)
    chain = tox.train_chain(table(spark, docs), labels, ["rude", "threat"])
    texts = [t for _, t in docs[:20]] + ["", None, "Idiotically idiot's idiot ß é"]
    got = tox.predict(pa.array(texts, pa.string()), chain)
    one = lambda word: tox._features(pa.array([word]))[2].tolist()
    for row, text in enumerate(texts):
        found = re.findall(r"[A-Za-z'\x80-\U0010ffff]+", text or "")
        told = []
        for link in chain.links:
            z = link.bias + sum(w * p for w, p in zip(link.earlier, told))
            times = Counter(h for word in found for h in one(word))
            for h, k in times.items():
                at = np.flatnonzero(link.hashes == h)
                if len(at):
                    share = min(k / len(found) * tox.FULL, 2.0)
                    z += float(link.present[at[0]] + link.dense[at[0]] * share)
            told.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        assert np.allclose(got[row], told)


def test_toxicity_of_odd_rows(spark):
    docs, labels = labelled(spark)
    chain = tox.train_chain(table(spark, docs), labels, ["rude", "threat"])
    out = tox.score_toxicity(table(spark, EDGES), chain, verdict="rude").collect()
    assert len(out) == len(EDGES) and not any(r["is_toxic"] for r in out)
    assert len({r["p_rude"] for r in out if r["doc_id"] in (1, 2, 3)}) == 1
    twice = {r["p_rude"] for r in out if r["doc_id"] == 7}
    assert len(twice) == 1
    nothing = tox.train_chain(table(spark, []), labels.limit(0), ["rude"])
    scored = tox.score_toxicity(table(spark, EDGES), nothing, verdict="rude").collect()
    assert {r["p_rude"] for r in scored} == {0.5} and not any(r["is_toxic"] for r in scored)
    one_sided = tox.train_chain(table(spark, docs), labels.filter("rude = 0"), ["rude"])
    assert len(one_sided.links[0].hashes) == 0
    assert tox.score_toxicity(table(spark, []), chain, verdict="rude").count() == 0
    assert tox.predict(pa.array([None, ""]), chain).shape == (2, 2)


def test_preferences(spark):
    rows = [
        (1, "chosen", 0, "system", "s"), (1, "rejected", 0, "system", "s"),
        (1, "chosen", 1, "user", "q"), (1, "rejected", 1, "user", "q"),
        (1, "chosen", 2, "assistant", "good"), (1, "rejected", 2, "assistant", "bad"),
        (1, "chosen", 3, "user", "thanks"),
        (2, "chosen", 5, "user", "same"), (2, "rejected", 5, "user", "same"),
        (3, "chosen", 0, "assistant", "alone"),
        (4, "chosen", 0, None, None), (4, "rejected", 0, "user", ""),
        (4, "chosen", 0, None, None), (4, "rejected", 1, "assistant", "a"),
        (None, "chosen", 0, "user", "x"), (5, "chosen", None, "user", "x"), (6, "other", 0, "user", "x"),
    ]
    pairs = spark.createDataFrame(
        [(*r, "x", True) for r in rows],
        "pair_id long, side string, turn long, role string, text string, fork string, prompt boolean",
    )
    out = sorted(
        (r["pair_id"], r["section"], r["turn"], r["prompt_turns"], r["train"])
        for r in format_preferences(pairs).collect()
    )
    assert out == sorted([
        (1, "prompt", 0, 2, False), (1, "prompt", 1, 2, False),
        (1, "chosen", 2, 2, True), (1, "chosen", 3, 2, False), (1, "rejected", 2, 2, True),
        (2, "prompt", 5, 1, False),
        (3, "chosen", 0, 0, True),
        (4, "prompt", 0, 1, False), (4, "rejected", 1, 1, True),
    ])
    assert format_preferences(pairs.limit(0)).count() == 0


def test_swapped_answers(spark):
    rows = [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "bye"),
        (1, 0, "user", "q1"), (1, 1, "assistant", "x"), (1, 2, "user", "y"), (1, 3, "assistant", "a1"),
        (2, 0, "user", "an id further on"), (2, 1, "assistant", "a2"),
        (4, 0, "user", "none"), (5, 0, "user", "none"), (None, 0, "user", "x"), (7, None, "assistant", "x"),
        (90, 4, "assistant", "b"), (90, 4, "assistant", "a90"), (90, 4, "assistant", "a90"),
    ]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {
        (r["pair_id"], r["side"], r["turn"]): r["text"] for r in swapped_answers(talk).collect()
    }
    assert {k[0] for k in got} == {0, 1, 2, 90}
    assert got[0, "chosen", 1] == "a0" and got[0, "rejected", 1] == "a1"
    assert got[1, "rejected", 3] == "a2" and got[1, "rejected", 1] == "x"
    assert got[2, "rejected", 1] == "a90"
    assert got[90, "chosen", 4] == "a90" and got[90, "rejected", 4] == "a0"
    assert (0, "chosen", 2) not in got
    for few in ("conv_id = 1", "conv_id = 4", "false"):  # nobody else has an answer
        assert swapped_answers(talk.filter(few)).count() == 0
