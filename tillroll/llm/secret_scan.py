"""Secrets in whole texts: exact patterns, and a linear-chain CRF that adds what they miss.

The CRF tags runs of characters as B (begin of a secret), I (inside) or O. Its features are
the run's shape, its neighbours, what stands between them, and shares of the whole text. It is
fitted on a bounded sample of documents, whose labels are the pattern matches; as the shape
and the context of a match are features of their own, either can be enough elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .rows import map_rows
from .words import Words, slices, words

KINDS = ("assign", "access", "hex", "crf")
SPANS = "array<struct<kind: string, start: long, end: long>>"

# The three kinds of base matches and what a match must reach.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
#: Finds every text with a base match, and few others; run on whole columns.
_MAYBE = (
    r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=]"""
    r"|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in code points, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


# -- runs and their features ---------------------------------------------------------------

_CLASS = {
    "digit": b"0123456789",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "hexed": b"0123456789abcdef",
    "joint": b"+/_-",
    "wide": bytes(range(128, 256)),
    "assign": b"=:",
    "quote": b"\"'`",
    "line": b"\n",
    "odd": b"#$%&*<>{}|;",
}
_IN = {name: np.isin(np.arange(256), list(members)) for name, members in _CLASS.items()}
_RUN = _IN["digit"] | _IN["upper"] | _IN["lower"] | _IN["joint"] | _IN["wide"]
_RUN[ord(".")] = True
_KEYWORDS = (
    "password passwd pwd passphrase secret token key apikey api_key api-key access_key "
    "secret_key auth authorization bearer credential credentials private"
).split()
_LENGTHS = np.array([4, 8, 12, 16, 24, 40])
FEATURES = 44


def _runs(column: pa.Array) -> Words:
    return words(column, _RUN)


def _keyword_hashes() -> np.ndarray:
    return np.sort(_runs(pa.array(_KEYWORDS)).hashes())


def _features(w: Words) -> np.ndarray:
    """(runs, FEATURES) of zeros and ones."""
    n, data = len(w.start), w.data
    out = np.zeros((n, FEATURES), np.float32)
    if not n:
        return out
    total = {}
    for name in _CLASS:
        total[name] = np.zeros(len(data) + 1, np.int32)
        np.cumsum(_IN[name][data], out=total[name][1:], dtype=np.int32)
    inside = {name: t[w.end] - t[w.start] for name, t in total.items()}
    size = w.end - w.start
    row = w.row()
    first = np.zeros(n, bool)
    first[w.first[:-1][w.counts() > 0]] = True
    gap_from = np.where(first, w.at[row], np.concatenate([[0], w.end[:-1]]))
    gap = {name: total[name][w.start] - total[name][gap_from] for name in ("assign", "quote", "line")}
    letters = inside["upper"] + inside["lower"]
    digit = _IN["digit"][data].astype(np.int8)
    turns = np.zeros(len(data) + 1, np.int32)
    np.cumsum(np.abs(np.diff(digit, prepend=digit[:1])), out=turns[1:], dtype=np.int32)
    turn = turns[w.end] - turns[np.minimum(w.start + 1, w.end)]
    hashes, known = w.hashes(), _keyword_hashes()
    keyword = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
    plain = (inside["lower"] + inside["wide"] + (inside["upper"] > 0) >= size - 1) & (
        inside["upper"] <= 1
    )

    def before(flag: np.ndarray, steps: int = 1) -> np.ndarray:
        moved = np.zeros(n, bool)
        moved[steps:] = flag[:-steps] & (row[steps:] == row[:-steps])
        return moved

    def after(flag: np.ndarray) -> np.ndarray:
        moved = np.zeros(n, bool)
        moved[:-1] = flag[1:] & (row[1:] == row[:-1])
        return moved

    mixed = (inside["digit"] > 0) & (letters > 0)
    head = np.zeros(n, bool)
    long = np.flatnonzero(size >= 18)
    head[long] = (data[w.start[long, None] + np.arange(4)] == np.frombuffer(b"AKIA", np.uint8)).all(1)
    bucket = np.searchsorted(_LENGTHS, size, side="right")
    length = np.maximum(np.diff(w.at), 1)
    share = lambda name: (total[name][w.at[1:]] - total[name][w.at[:-1]]) / length
    flags = [
        np.ones(n, bool),
        *(bucket == k for k in range(len(_LENGTHS) + 1)),
        inside["digit"] == size,
        (inside["hexed"] == size) & mixed,
        inside["lower"] == size,
        (inside["upper"] == 1) & (inside["lower"] == size - 1),
        (inside["upper"] == size) & (size > 1),
        mixed,
        mixed & (inside["upper"] > 0) & (inside["lower"] > 0),
        inside["wide"] > 0,
        inside["joint"] > 0,
        turn >= 3,
        turn * 3 > size,
        plain,
        keyword,
        before(keyword),
        before(keyword, 2),
        gap["assign"] > 0,
        gap["quote"] > 0,
        (gap["assign"] > 0) & before(keyword),
        (gap["assign"] > 0) & before(keyword) & (size >= 12),
        gap["line"] > 0,
        before(plain),
        after(plain),
        before(mixed),
        after(mixed),
        head,
        mixed & (size >= 16),
        mixed & (size >= 32),
        (size >= 16) & plain,
        (inside["digit"] == size) & (size >= 16),
        first,
        share("digit")[row] > 0.02,
        share("odd")[row] > 0.05,
        share("upper")[row] > 0.3,
        length[row] < 500,
    ]
    for k, flag in enumerate(flags):
        out[:, k] = flag
    return out


# -- the model -----------------------------------------------------------------------------

_FORBIDDEN = -1e4  # O to I, and I at the start


@dataclass(frozen=True)
class Tagger:
    """Weights of features by state (B, I, O), of transitions and of the first state."""

    emit: np.ndarray
    step: np.ndarray
    first: np.ndarray

    @staticmethod
    def silent() -> Tagger:
        """Tags nothing: what is fitted where no example is at hand."""
        emit = np.zeros((FEATURES, 3), np.float32)
        emit[0, 2] = 50
        return Tagger(emit, np.zeros((3, 3)), np.zeros(3))


def viterbi(emit: np.ndarray, first: np.ndarray, model: Tagger, length: int = 160) -> np.ndarray:
    """The best state of every run; ``first`` marks where texts begin. Exact: stretches of
    ``length`` runs are solved side by side for each state before them, then chained."""
    n = len(emit)
    if not n:
        return np.zeros(0, np.int64)
    count = -(-n // length)
    padded = np.zeros((count * length, 3))
    padded[:n] = emit
    fresh = np.zeros(count * length, bool)
    fresh[:n] = first
    padded, fresh = padded.reshape(count, length, 3), fresh.reshape(count, length)
    score = np.full((3, count, 3), -np.inf)
    for s in range(3):
        score[s, :, s] = 0
    back = np.zeros((length, 3, count, 3), np.int8)
    begin = np.broadcast_to(model.first, (3, 3))
    stay = np.where(np.eye(3, dtype=bool), 0.0, -np.inf)  # what fills the last stretch
    ends = np.arange(count * length).reshape(count, length) >= n
    for t in range(length):
        move = np.where(fresh[:, t, None, None], begin, model.step)
        move = np.where(ends[:, t, None, None], stay, move)
        option = score[..., None] + move[None]
        back[t] = option.argmax(axis=2)
        score = option.max(axis=2) + padded[None, :, t]
    value, entry = np.zeros(3), np.zeros((count, 3), np.int64)
    for k in range(count):
        option = value[:, None] + score[:, k]
        entry[k] = option.argmax(axis=0)
        value = option.max(axis=0)
        value -= value.max()
    state = np.zeros(count, np.int64)
    source = np.zeros(count, np.int64)
    last = int(value.argmax())
    for k in range(count - 1, -1, -1):
        state[k], source[k] = last, entry[k, last]
        last = int(source[k])
    path = np.zeros((count, length), np.int64)
    every = np.arange(count)
    for t in range(length - 1, -1, -1):
        path[:, t] = state
        state = back[t, source, every, state].astype(np.int64)
    return path.reshape(-1)[:n]


def fit(windows: np.ndarray, labels: np.ndarray, rounds: int = 60, decay: float = 1e-3) -> Tagger:
    """Maximum likelihood of ``labels`` (windows, length; -1 beyond the end) given
    ``windows`` (windows, length, FEATURES), by gradient ascent with a decay of weights."""
    if not len(labels) or not (labels == 0).any():
        return Tagger.silent()
    count, length = labels.shape
    real = labels >= 0
    x = windows.astype(np.float64)
    gold = np.eye(3)[np.maximum(labels, 0)] * real[..., None]
    theta = np.zeros(FEATURES * 3 + 9 + 3)
    fixed = np.zeros_like(theta)
    fixed[FEATURES * 3 + 2 * 3 + 1] = _FORBIDDEN
    fixed[FEATURES * 3 + 9 + 1] = _FORBIDDEN
    free = fixed == 0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    flat = x.reshape(-1, FEATURES)
    pairs = np.einsum("ntp,ntq->pq", gold[:, :-1], gold[:, 1:])
    for step in range(1, rounds + 1):
        full = theta + fixed
        emit = full[: FEATURES * 3].reshape(FEATURES, 3)
        move = full[FEATURES * 3 : FEATURES * 3 + 9].reshape(3, 3)
        begin = full[-3:]
        e = (flat @ emit).reshape(count, length, 3)
        alpha = np.zeros((length, count, 3))
        beta = np.zeros((length, count, 3))
        alpha[0] = begin + e[:, 0]
        for t in range(1, length):
            new = np.logaddexp.reduce(alpha[t - 1][:, :, None] + move, axis=1) + e[:, t]
            alpha[t] = np.where(real[:, t, None], new, alpha[t - 1])
        for t in range(length - 2, -1, -1):
            new = np.logaddexp.reduce(move + (e[:, t + 1] + beta[t + 1])[:, None, :], axis=2)
            beta[t] = np.where(real[:, t + 1, None], new, 0)
        norm = np.logaddexp.reduce(alpha[-1], axis=1)
        post = np.exp(alpha + beta - norm[None, :, None]).transpose(1, 0, 2) * real[..., None]
        link = np.zeros((3, 3))
        for t in range(length - 1):
            joint = alpha[t][:, :, None] + move + (e[:, t + 1] + beta[t + 1])[:, None, :]
            link += (np.exp(joint - norm[:, None, None]) * real[:, t + 1, None, None]).sum(axis=0)
        grad = np.concatenate(
            [
                (flat.T @ (gold - post).reshape(-1, 3)).ravel(),
                (pairs - link).ravel(),
                (gold[:, 0] - post[:, 0]).sum(axis=0),
            ]
        ) / count - decay * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        rise = 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        theta += np.where(free, rise, 0)
    full = theta + fixed
    return Tagger(
        full[: FEATURES * 3].reshape(FEATURES, 3).astype(np.float32),
        full[FEATURES * 3 : FEATURES * 3 + 9].reshape(3, 3),
        full[-3:],
    )


# -- Spark ---------------------------------------------------------------------------------


def _points(data: np.ndarray) -> np.ndarray:
    """Code points before every byte."""
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=total[1:])
    return total


def _base_by_row(column: pa.Array) -> dict[int, list[tuple[int, int, int]]]:
    maybe = pc.fill_null(pc.match_substring_regex(column, _MAYBE), False)
    rows = np.flatnonzero(maybe.to_numpy(zero_copy_only=False))
    return {int(r): s for r in rows if (s := base_spans(column[int(r)].as_py()))}


def _labels(w: Words, base: dict[int, list[tuple[int, int, int]]]) -> np.ndarray:
    """B, I or O (0, 1, 2) of every run: the values of base matches are secrets."""
    labels = np.full(len(w.start), 2, np.int8)
    if not base:
        return labels
    points = _points(w.data)
    for row, spans in base.items():
        a, b = w.first[row], w.first[row + 1]
        left, right = points[w.start[a:b]] - points[w.at[row]], points[w.end[a:b]] - points[w.at[row]]
        for start, kind, end in spans:
            hit = np.flatnonzero((left < end) & (right > start))
            if kind == 0:  # the name before the value is not the secret
                hit = hit[right[hit] - left[hit] >= 8] if len(hit) > 1 else hit
            if len(hit):
                labels[a + hit[0]] = 0
                labels[a + hit[1:]] = 1
    return labels


def fit_tagger(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_docs: int = 4000,
    window: int = 24,
    windows_per_doc: int = 8,
) -> Tagger:
    """A tagger fitted on windows of ``window`` runs from at most ``sample_docs`` documents
    (those whose id hashes lowest), up to ``windows_per_doc`` around base matches and one
    elsewhere from each. These bounds are what reaches the driver: of rows that repeat an id
    one counts, the text that hashes lowest. A sample without base matches, as of an empty
    table, gives a tagger that tags nothing."""
    order = F.xxhash64(doc_id)
    lowest = (
        docs.filter(F.col(doc_id).isNotNull())
        .select(F.col(doc_id).alias("__id"), order.alias("__order"))
        .distinct()
        .orderBy("__order", "__id")
        .limit(sample_docs)
    )
    chosen = docs.join(F.broadcast(lowest), F.col(doc_id) == F.col("__id"))
    chosen = chosen.select("__order", F.col(text).alias("text"), F.xxhash64(text).alias("hash"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                column = part.column(1)
                w = _runs(column)
                x, y = _features(w).astype(np.uint8), _labels(w, _base_by_row(column))
                out = []
                for row in range(part.num_rows):
                    a, b = w.first[row], w.first[row + 1]
                    if a == b:
                        continue
                    order, text_hash = part.column(0)[row].as_py(), part.column(2)[row].as_py()
                    seed = order % (1 << 31)
                    centres = a + np.flatnonzero(y[a:b] == 0)[:windows_per_doc]
                    others = a + np.array([seed]) % (b - a)
                    for k, centre in enumerate([*centres, *others]):
                        i = max(a, min(centre - window // 2, b - window))
                        j = min(b, i + window)
                        out.append((order, text_hash, k, seed, x[i:j].tobytes(), y[i:j].tobytes()))
                if out:
                    columns = [pa.array(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        columns, ["order", "hash", "k", "seed", "x", "y"]
                    )

    schema = "`order` long, hash long, k long, seed long, x binary, y binary"
    windows = materialise(chosen.mapInArrow(cut, schema), "windows")
    lowest_text = windows.groupBy("order").agg(F.min("hash").alias("hash"))
    once = windows.join(lowest_text, ["order", "hash"]).dropDuplicates(["order", "k"])
    rows = sorted(once.select("seed", "x", "y").collect())
    x = np.zeros((len(rows), window, FEATURES), np.uint8)
    y = np.full((len(rows), window), -1, np.int8)
    for k, row in enumerate(rows):
        labels = np.frombuffer(row["y"], np.int8)
        y[k, : len(labels)] = labels
        x[k, : len(labels)] = np.frombuffer(row["x"], np.uint8).reshape(-1, FEATURES)
    return fit(x, y)


def _scan(column: pa.Array, model: Tagger) -> tuple[dict[int, list], Words]:
    """(start, kind, end) spans by row: the base ones, and tagged ones that touch none."""
    found = _base_by_row(column)
    w = _runs(column)
    first = np.zeros(len(w.start), bool)
    first[w.first[:-1][w.counts() > 0]] = True
    state = viterbi(_features(w) @ model.emit, first, model)
    begin = np.flatnonzero(state == 0)
    if len(begin):
        points, row = _points(w.data), w.row()
        other = np.flatnonzero((state != 1) | first)  # where a secret before it has ended
        stop = np.append(other, len(state))[np.searchsorted(other, begin, side="right")]
        for b, e in zip(begin.tolist(), stop.tolist(), strict=True):
            r = int(row[b])
            base = points[w.at[r]]
            start, end = int(points[w.start[b]] - base), int(points[w.end[e - 1]] - base)
            spans = found.setdefault(r, [])
            if all(end <= s or start >= t for s, kind, t in spans):
                spans.append((start, 3, end))
        for r in {int(row[b]) for b in begin}:
            found[r].sort()
    return found, w


def find_secrets(
    docs: DataFrame, model: Tagger, *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans``, an array of (kind, start, end)
    in code points, end exclusive, by start, then kind (assign, access, hex, crf). The base
    kinds are exact; ``crf`` are the tagger's further spans, which overlap none of them.

    A null or empty text has no spans; ids may be null or repeat. Texts are read whole, in
    slices of about a megabyte. Other columns, whatever their names, are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found, _ = _scan(part.column(1), model)
                spans = [
                    [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found.get(r, ())]
                    for r in range(part.num_rows)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(spans, _SPAN_TYPE)], ["doc_id", "spans"]
                )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(scan, f"doc_id {kind}, spans {SPANS}")


_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def redact_secrets(
    docs: DataFrame, model: Tagger, *, text: str = "text", mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with every span of :func:`find_secrets` in ``text`` replaced by ``mark``; all
    columns and rows stay, and a null text stays null."""

    def clean(part: pa.RecordBatch, at: int) -> pa.RecordBatch:
        found, _ = _scan(part.column(at), model)
        if not found:
            return part
        texts = part.column(at).to_pylist()
        for row, spans in found.items():
            pieces, done = [], 0
            for start, _, end in spans:
                if start >= done:
                    pieces += [texts[row][done:start], mark]
                done = max(done, end)
            texts[row] = "".join([*pieces, texts[row][done:]])
        return part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))

    return map_rows(docs, text, lambda: clean)
