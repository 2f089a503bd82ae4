"""The pipeline, stage by stage, against plain counterparts on a small corpus."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from helpers import prose, shingles, table, words
from test_packing import check_places
from test_pairs import edited
from test_text_operators import KEY

import corpus_pipeline
from tillroll.llm import secret_scan, toxicity
from tillroll.llm.queries import toxicity_chain


def corpus(spark, folder):
    items = [(i, " ".join(prose(500 + i, 20 + i))) for i in range(6)]
    docs, labels = [], []
    for i in range(260):
        w = prose(i // 4 if i % 4 < 2 and i >= 40 else 10_000 + i, 120)
        if i % 4 == 1:
            w = edited(w, i, i % 3)
        if i % 10 == 0:
            w[5:5] = ["grumpy", "nasty"]
        if i % 17 == 3:
            w[60:60] = words(items[i % 6][1])
        if i % 13 == 5:
            w[70:70] = [KEY, "token='abcdefghijkl0'"]
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 10 == 0)))
    docs += [(900, None), (901, ""), (None, "no id but some words"), (902, "x"), (902, "x")]
    folder = str(folder)
    table(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items, folder


def pairs_of(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=str)


def test_stages_against_plain_counterparts(spark, tmp_path):
    docs, items, folder = corpus(spark, tmp_path / "t")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "ngram_join", "decontamination", "secrets", "packing"]
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns

    chain = toxicity_chain(spark, frame, folder)
    p = toxicity.predict(pa.array([t for _, t in docs]), chain)[:, 1]
    docs = [d for d, toxic in zip(docs, p > 0.5, strict=True) if not toxic]
    assert {d for d, _ in docs} & {0, 10, 20, 30} == set() and len(docs) > 230
    frame = corpus_pipeline.materialise(stages["toxicity"](spark, frame, folder), "t")
    assert frame.columns == columns and pairs_of(frame) == sorted(docs, key=str)

    root = {i: i for i in range(len(docs))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [shingles(t, 5) for _, t in docs]
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    ids = [d for d, _ in docs]
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    docs = list(dict.fromkeys(x for i, x in enumerate(docs) if ids[i] is None or least[find(i)] == ids[i]))
    frame = corpus_pipeline.materialise(stages["ngram_join"](spark, frame, folder), "t")
    assert frame.columns == columns and pairs_of(frame) == sorted(docs, key=str)
    assert len(docs) < 215

    tests = [shingles(x, 5) for _, x in items]
    docs = [
        (d, t) for d, t in docs
        if not any(100 * len(s & shingles(t, 5)) >= 80 * len(s) for s in tests)
    ]
    frame = corpus_pipeline.materialise(stages["decontamination"](spark, frame, folder), "t")
    assert frame.columns == columns and pairs_of(frame) == sorted(docs, key=str)

    model = secret_scan.fit_tagger(frame)
    clean = []
    for d, t in docs:
        spans, _ = secret_scan._scan(pa.array([t], pa.string()), model)
        for start, _, end in sorted(spans.get(0, ()), reverse=True):
            t = t[:start] + "[SECRET]" + t[end:]
        clean.append((d, t))
    frame = corpus_pipeline.materialise(stages["secrets"](spark, frame, folder), "t")
    assert frame.columns == columns and pairs_of(frame) == sorted(clean, key=str)
    assert any("[SECRET]" in (t or "") for _, t in clean) and not any(KEY in (t or "") for _, t in clean)

    rows = stages["packing"](spark, frame, folder).collect()
    check_places(rows, clean, 1024)
    packed = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows}
    again = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert packed == again and np.unique([r["sequence_id"] for r in rows]).size > 0


def test_no_documents_at_all(spark, tmp_path):
    folder = str(tmp_path / "e")
    table(spark, []).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_near_copies_with_an_edit_in_fifty_words(spark):
    base = prose(1, 100, 10**6)
    other = [*base[:30], "x", *base[31:60], "y", *base[61:]]
    assert 100 * len(shingles(" ".join(base), 3) & shingles(" ".join(other), 3)) < 90 * 104
    frame = table(spark, [(1, " ".join(base)), (2, " ".join(other)), (3, " ".join(prose(2, 100)))])
    assert [d for d, _ in pairs_of(corpus_pipeline.near_duplicates(spark, frame, ""))] == [1, 3]


def test_rows_go_by_id_and_text(spark):
    a, b = " ".join(prose(1, 60)), " ".join(prose(2, 60))
    near = " ".join(edited(prose(1, 60), 3, 1))
    rows = [(3, a), (5, a), (5, b), (5, b), (3, near), (None, a), (7, b)]
    kept = pairs_of(corpus_pipeline.near_duplicates(spark, table(spark, rows), ""))
    assert len([r for r in kept if r[0] == 3]) == 1 and kept[0][1] in (a, near)
    assert kept[1:] == [(5, b), (None, a)]
