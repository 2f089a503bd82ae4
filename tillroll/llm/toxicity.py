"""Toxicity by a classifier chain: one linear model per category, in a fixed order, each fed
with the probabilities of the categories before it. Those are out-of-fold predictions while a
later model is trained, so it learns how far they can be trusted on new texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .rows import map_rows
from .words import Words, mix, slices, words

#: Bytes of the word beginnings that are features beside the words.
HEADS = (4, 5, 6)
#: A feature counts by presence, and by its share of a text's words in units of 2 %.
FULL = 50
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256), ord("'")]] = True


@dataclass(frozen=True)
class Link:
    """One category's model: weights of features by hash (sorted), for presence and for
    density, and of earlier probabilities."""

    hashes: np.ndarray
    present: np.ndarray
    dense: np.ndarray
    earlier: np.ndarray
    bias: float


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    links: tuple[Link, ...]
    #: Accuracy and recall of each category on held-out folds, for reports.
    held_out: tuple[tuple[float, float], ...]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, decay: float, rounds: int) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column is the bias."""
    ridge = np.full(x.shape[1], decay)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(curve, grad)
        w -= move * min(1.0, 5 / max(float(np.abs(move).max()), 1e-9))
        if np.abs(move).max() < 1e-4:
            break
    return w


def _telling(total: np.ndarray, both: np.ndarray, n: int, positive: float) -> np.ndarray:
    """How much features that ``total`` of ``n`` texts have, ``both`` of them positive ones,
    depend on the label (chi-squared)."""
    expect = total * positive / max(n, 1)
    spread = np.maximum(expect * (1 - total / max(n, 1)) * (1 - positive / max(n, 1)), 1e-9)
    return (both - expect) ** 2 / spread


def _values(density: np.ndarray) -> np.ndarray:
    """Model inputs of densities: presence, then density up to twice FULL's unit."""
    return np.hstack([density > 0, np.minimum(density * FULL, 2.0)]).astype(float)


def fit_chain(
    texts: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    folds: np.ndarray,
    categories: Sequence[str],
    *,
    features: int = 192,
    least_texts: int = 5,
    decay: float = 1.0,
    rounds: int = 25,
) -> Chain:
    """A chain over ``texts`` (for each the distinct feature hashes, and how large a share of
    its words has each), ``labels`` (texts, categories; NaN where not known) and ``folds``
    (from 0). Features are chosen inside each fit, from the texts it may see: of those in
    ``least_texts`` the ``features`` that depend most on the label."""
    n = len(texts)
    known, place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    share = np.zeros(0, np.float32)
    if n:
        known, place = np.unique(np.concatenate([h for h, _ in texts]), return_inverse=True)
        share = np.maximum(np.concatenate([s for _, s in texts]), 1e-4)
    text = np.repeat(np.arange(n), [len(h) for h, _ in texts])

    def dense(rows: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Densities of the ``chosen`` features in the texts ``rows``."""
        row, column = np.full(n, -1), np.full(len(known), -1)
        row[rows], column[chosen] = np.arange(len(rows)), np.arange(len(chosen))
        some = (row[text] >= 0) & (column[place] >= 0)
        out = np.zeros((len(rows), len(chosen)))
        out[row[text[some]], column[place[some]]] = share[some]
        return out

    earlier = np.zeros((n, 0))
    links, held_out = [], []

    def model(rows: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label = np.full(n, np.nan)
        label[rows] = y
        mine = ~np.isnan(label[text])
        score = np.zeros(len(known))
        for level in (0.0, 0.5 / FULL):
            at, with_it = place[mine & (share > level)], text[mine & (share > level)]
            total = np.bincount(at, minlength=len(known))
            both = np.bincount(at, label[with_it], minlength=len(known))
            told = _telling(total, both, len(rows), float(y.sum()))
            score = np.maximum(score, np.where(total >= least_texts, told, 0))
        chosen = np.argsort(-score, kind="stable")[:features]
        chosen = np.sort(chosen[score[chosen] > 0])
        inputs = [_values(dense(rows, chosen)), earlier[rows], np.ones((len(rows), 1))]
        return chosen, _logistic(np.hstack(inputs), y, decay, rounds)

    for k in range(len(categories)):
        y = labels[:, k]
        rows = np.flatnonzero(~np.isnan(y))
        prior = (np.nansum(y) + 1) / (len(rows) + 2)
        out = np.full(n, prior)
        none = np.zeros(0)
        link = Link(none.astype(np.uint64), none, none, np.zeros(k), float(np.log(prior / (1 - prior))))
        if len(rows) and y[rows].min() < y[rows].max():
            for fold in np.unique(folds):
                train, test = rows[folds[rows] != fold], np.flatnonzero(folds == fold)
                if len(train) and y[train].min() < y[train].max():
                    chosen, w = model(train, y[train])
                    inputs = np.hstack([_values(dense(test, chosen)), earlier[test]])
                    out[test] = _sigmoid(inputs @ w[:-1] + w[-1])
            chosen, w = model(rows, y[rows])
            m = len(chosen)
            link = Link(known[chosen], w[:m], w[m : 2 * m], w[2 * m : -1], float(w[-1]))
        links.append(link)
        right = (out[rows] > 0.5) == (y[rows] > 0.5)
        positive = y[rows] > 0.5
        held_out.append(
            (
                float(right.mean()) if len(rows) else 0.0,
                float(right[positive].mean()) if positive.any() else 0.0,
            )
        )
        earlier = np.hstack([earlier, out[:, None]])
    return Chain(tuple(categories), tuple(links), tuple(held_out))


def _features(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, and (text, hash) of every word and of the beginnings of every longer word."""
    w = words(column, _LETTERS)
    row, rows, hashes = w.row(), [], [w.hashes()]
    rows.append(row)
    for size in HEADS:
        longer = np.flatnonzero(w.end - w.start > size)
        heads = Words(w.data, w.at, w.start[longer], w.start[longer] + size, w.first)
        rows.append(row[longer])
        hashes.append(mix(heads.hashes() + np.uint64(size)))
    return w, np.concatenate(rows), np.concatenate(hashes)


def predict(column: pa.Array, chain: Chain) -> np.ndarray:
    """(texts, categories) of probabilities."""
    w, row, hashes = _features(column)
    total = np.maximum(w.counts(), 1)
    out = np.zeros((w.rows, len(chain.links)))
    for k, link in enumerate(chain.links):
        z, m = np.full(w.rows, link.bias), len(link.hashes)
        if m:
            place = np.minimum(np.searchsorted(link.hashes, hashes), m - 1)
            hit = link.hashes[place] == hashes
            pairs, times = np.unique(row[hit] * m + place[hit], return_counts=True)
            text, feature = pairs // m, pairs % m
            density = np.minimum(times / total[text] * FULL, 2.0)
            weight = link.present[feature] + link.dense[feature] * density
            z += np.bincount(text, weight, minlength=w.rows)
        out[:, k] = _sigmoid(z + out[:, :k] @ link.earlier)
    return out


def train_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = 4096,
    folds: int = 5,
    vocabulary: int = 8192,
    least_texts: int = 5,
    **how,
) -> Chain:
    """A chain over the label columns ``categories`` (0/1, in the order of the chain).

    At most ``sample_rows`` labelled ids, those that hash lowest, are used, each with one text
    (of rows that repeat an id the one whose text hashes lowest). The features of their texts
    are counted by label in Spark; the ``vocabulary`` that depend most on some label are
    candidates, and what texts have of those is what reaches the driver. Several labels of an
    id count as their maximum; a null label is unknown; labels without an id or a document
    are left out. A category without both labels gets a constant probability.
    """
    one = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(
        *(F.max(F.col(c).cast("double")).alias(f"__y{k}") for k, c in enumerate(categories))
    )
    order = F.xxhash64("__id")
    lowest = one.withColumn("__order", order).orderBy("__order", "__id").limit(sample_rows)
    y = F.array(*(F.col(f"__y{k}") for k in range(len(categories))))
    chosen = docs.join(F.broadcast(lowest), F.col(doc_id) == F.col("__id")).select(
        "__order", y.alias("y"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w, row, hashes = _features(part.column(3))
                order = np.lexsort((hashes, row))
                row, hashes = row[order], hashes[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
                at = np.flatnonzero(new)
                share = np.diff(np.append(at, len(row))) / np.maximum(w.counts(), 1)[row[at]]
                cut = pa.array(np.searchsorted(row[at], np.arange(part.num_rows + 1)), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(cut, pa.array(v))
                    for v in (hashes[at].view(np.int64), share.astype(np.float32))
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(1), *lists],
                    ["seed", "text_hash", "y", "hashes", "shares"],
                )

    schema = "seed long, text_hash long, y array<double>, hashes array<long>, shares array<float>"
    texts = materialise(chosen.mapInArrow(hashed, schema), "labelled")
    lowest_text = texts.groupBy("seed").agg(F.min("text_hash").alias("text_hash"))
    texts = texts.join(lowest_text, ["seed", "text_hash"]).dropDuplicates(["seed"])
    texts = materialise(texts, "labelled")

    # chi-squared by the counts of every feature: texts, texts with a known label, positive ones
    labelled = [F.col("y")[k] for k in range(len(categories))]
    counts = texts.select(F.explode("hashes").alias("hash"), "y").groupBy("hash").agg(
        F.count(F.lit(1)).alias("texts"),
        *(F.count(v).alias(f"n{k}") for k, v in enumerate(labelled)),
        *(F.sum(v).alias(f"p{k}") for k, v in enumerate(labelled)),
    )
    whole = texts.agg(*(f(v).alias(f"{f.__name__}{k}") for k, v in enumerate(labelled) for f in (F.count, F.sum)))
    whole = whole.first()
    told = [F.lit(0.0)]
    for k in range(len(categories)):
        n, positive = whole[f"count{k}"], whole[f"sum{k}"] or 0.0
        expect = F.col(f"n{k}") * (positive / max(n, 1))
        spread = expect * (1 - F.col(f"n{k}") / max(n, 1)) * (1 - positive / max(n, 1))
        told.append((F.coalesce(f"p{k}", F.lit(0.0)) - expect) ** 2 / F.greatest(spread, F.lit(1e-9)))
    best = (
        counts.filter(F.col("texts") >= least_texts)
        .select("hash", F.greatest(*told, F.lit(0.0)).alias("told"))
        .orderBy(F.desc("told"), "hash")
        .limit(vocabulary)
    )
    candidates = np.sort(np.array([r["hash"] for r in best.collect()], np.int64))

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, shares = [], []
            for h, v in zip(batch.column(2), batch.column(3), strict=True):
                h, v = h.values.to_numpy(), v.values.to_numpy()
                held = np.isin(h, candidates)
                hashes.append(h[held].tobytes())
                shares.append(v[held].tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(hashes, pa.binary()), pa.array(shares, pa.binary())],
                ["seed", "y", "hashes", "shares"],
            )

    rows = (
        texts.select("seed", "y", "hashes", "shares")
        .mapInArrow(narrowed, "seed long, y array<double>, hashes binary, shares binary")
        .collect()
    )
    rows.sort(key=lambda r: r["seed"])
    return fit_chain(
        [(np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["shares"], np.float32)) for r in rows],
        np.array(
            [[np.nan if v is None else v for v in r["y"]] for r in rows], float
        ).reshape(len(rows), len(categories)),
        np.array([r["seed"] // 8191 % folds for r in rows], np.int64),
        categories,
        least_texts=least_texts,
        **how,
    )


def score_toxicity(
    docs: DataFrame,
    chain: Chain,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    verdict: str = "toxic",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``p_<category>`` for every category, and
    ``is_toxic`` (the probability of ``verdict`` exceeds ``threshold``).

    Texts are read whole, as counts of lower-cased words and word beginnings. A null or empty text has no words and
    gets the probabilities of that; ids may be null or repeat. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    names = [f"p_{c}" for c in chain.categories]
    schema = f"doc_id {kind}, " + ", ".join(f"`{c}` double" for c in names) + ", is_toxic boolean"
    last = chain.categories.index(verdict)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                p = predict(part.column(1), chain)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c) for c in p.T), pa.array(p[:, last] > threshold)],
                    ["doc_id", *names, "is_toxic"],
                )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(score, schema)


def without_toxic(
    docs: DataFrame,
    chain: Chain,
    *,
    text: str = "text",
    verdict: str = "toxic",
    threshold: float = 0.5,
) -> DataFrame:
    """The rows of ``docs`` that :func:`score_toxicity` does not call toxic, all columns."""
    last = chain.categories.index(verdict)

    def keep(part: pa.RecordBatch, at: int) -> pa.RecordBatch:
        return part.filter(pa.array(predict(part.column(at), chain)[:, last] <= threshold))

    return map_rows(docs, text, lambda: keep)
