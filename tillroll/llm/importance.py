"""Target-distribution importance resampling: documents are scored by hashed n-gram features
against a target corpus, and the highest scores (with Gumbel noise, so that the draw follows
the weights) are drawn. The cutoff is found between two quantiles of a sketch, which exact
counts outside of them validate; only what lies between is sorted."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import running_total
from ..session import materialise
from .words import _LOWER, SLICE_BYTES, slices, sums, text_buffers

_INSIDE = np.zeros(256, bool)
_INSIDE[0x80:] = True
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_U32 = np.uint32
#: Words longer than this go through zlib one by one.
_LONG = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=_U32)
    for _ in range(8):
        table = np.where(table & _U32(1), (table >> _U32(1)) ^ _U32(0xEDB88320), table >> _U32(1))
    return table


_CRC = _crc_table()


def crc_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """crc32 of what each value of ``crc`` stands for, followed by ``data[start:end]``."""
    size = end - start
    out = crc.astype(_U32)
    for i in np.flatnonzero(size > _LONG):
        out[i] = zlib.crc32(data[start[i] : end[i]], int(out[i]))
    order = np.argsort(-size, kind="stable")
    order = order[size[order] <= _LONG]
    state, at = ~out[order], start[order]
    live = np.searchsorted(-size[order], -np.arange(_LONG), side="left")  # words longer than k
    for k in range(_LONG):
        n = live[k]
        if not n:
            break
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + k]) & _U32(255)] ^ (state[:n] >> _U32(8))
    out[order] = ~state
    return out


@dataclass
class Features:
    """Features of some rows: ``row`` and ``bucket`` of each, and words per row."""

    row: np.ndarray
    bucket: np.ndarray
    words: np.ndarray


def _block(data: np.ndarray, at: np.ndarray, done: int, n: int, buckets: int):
    """Features of texts that lie in ``data`` (lower case) at ``at``; those that end within
    the first ``done`` words have been counted before. Also returns the words' starts."""
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    start = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
    end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
    first = np.searchsorted(start, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    rows, out = [], []
    crc = crc_words(data, start, end, np.zeros(len(start), _U32))
    space = np.frombuffer(b" ", np.uint8)
    for k in range(1, n + 1):
        if k > 1:
            crc = crc[:-1]
            if not len(crc):
                break
            none = np.zeros(len(crc), np.int64)
            crc = crc_words(space, none, none + 1, crc)
            crc = crc_words(data, start[k - 1 :], end[k - 1 :], crc)
        last = np.arange(k - 1, len(start))
        new = (row[: len(crc)] == row[last]) & (last >= done)
        rows.append(row[last][new])
        out.append((crc[new] % _U32(buckets)).astype(np.int64))
    words = np.diff(first)
    words[:1] -= done
    return Features(np.concatenate(rows), np.concatenate(out), words), start


def features(column: pa.Array, n: int, buckets: int, limit: int = SLICE_BYTES) -> Iterator[Features]:
    """Features of a slice of texts; those of a text above ``limit`` bytes come block by block,
    with the last ``n - 1`` words of a block again in front of the next."""
    data, at = text_buffers(column)
    if len(data) <= limit or len(at) > 2:
        yield _block(_LOWER[data], at, 0, n, buckets)[0]
        return
    begin = stop = done = 0
    while stop < len(data):
        stop = min(stop + limit, len(data))
        while stop < len(data) and _INSIDE[data[stop]]:
            gap = np.flatnonzero(~_INSIDE[data[stop : stop + limit]])
            stop = stop + int(gap[0]) if len(gap) else min(stop + limit, len(data))
        block = _LOWER[data[begin:stop]]
        found, start = _block(block, np.array([0, len(block)]), done, n, buckets)
        yield found
        done = min(n - 1, len(start))
        begin = begin + int(start[len(start) - done]) if done else stop


def bucket_counts(texts: DataFrame, text: str, n: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for found in features(part.column(0), n, buckets):
                    total += np.bincount(found.bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    rows = (
        texts.select(F.col(text).alias("text"))
        .mapInArrow(run, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much more frequent a bucket is in the target, add-one smoothed."""
    s, t, more = source.astype(float), target.astype(float), float(len(source))
    ratio = (t + 1) * (s.sum() + more) / ((s + 1) * (t.sum() + more))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(docs: DataFrame, gains: np.ndarray, n: int) -> DataFrame:
    schema = T.StructType(
        [docs.schema["doc_id"]]
        + [T.StructField(c, T.LongType()) for c in ("n_features", "n_words", "weight")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                totals = np.zeros((3, part.num_rows), np.int64)
                for found in features(part.column(1), n, len(gains)):
                    order = np.argsort(found.row, kind="stable")
                    first = np.searchsorted(found.row[order], np.arange(part.num_rows + 1))
                    totals[0] += np.diff(first)
                    totals[1] += found.words
                    totals[2] += sums(gains[found.bucket[order]], first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, totals)], [f.name for f in schema]
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _noise(doc_id: Column, seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _bracket(pool: DataFrame, n: int, k: int, accuracy: int) -> tuple[int | None, int | None, int]:
    """(low, high, above): the ``k``-th highest of ``n`` scores is within [low, high] and
    ``above`` scores are higher than ``high``; None stands for no bound. The sketch errs by
    ``n / accuracy`` places or so; the counts are exact, and a bracket that misses the place
    gives way to a wider one of the same sketch, in the end to all scores."""
    place, widths = 1 - k / n, [2 / accuracy * 8**i for i in range(4)]
    wanted = [min(max(place + side * w, 0.0), 1.0) for w in widths for side in (-1, 1)]
    edges = pool.agg(F.percentile_approx("score", wanted, accuracy).alias("q")).first()["q"]
    for low, high in zip(edges[::2], edges[1::2], strict=True):
        above, upto = pool.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score") >= low)
        ).first()
        if above < k <= upto:
            return low, high, above
    return None, None, 0


def _drawn(pool: DataFrame, n: int, k: int, accuracy: int) -> Column:
    """Whether a row of ``pool`` is among the ``k`` least ``place`` values."""
    low, high, above = _bracket(pool, n, k, accuracy)
    inside = pool if low is None else pool.filter(F.col("score").between(low, high))
    ranked = running_total(inside.select("place", F.lit(1).alias("one")), "place", "one")
    last = ranked.filter(F.col("upto") == k - above).select("place.*").first()
    fields = zip(last, pool.schema["place"].dataType, strict=True)
    cut = F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in fields))
    return F.col("place") <= cut


def importance_sample(
    docs: DataFrame,
    target: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    max_n: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    accuracy: int = 10_000,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank``.

    Words are runs of 0-9, a-z (A-Z lower-cased) and all code points from 0x80 on; features
    are runs of 1 to ``max_n`` words, hashed into ``buckets`` by crc32. A bucket's gain is its
    log ratio between ``target`` and ``docs``; ``weight`` sums the gains of a document and
    ``score`` adds Gumbel noise of its id. Of the documents with ``min_words`` words ``percent``
    of 100 (floor) are drawn by descending score, ties to the smaller id, and get ranks from 1;
    the rank of the others is null.

    A null text is empty; a document without words has weight 0. A row without an id has no
    score, is not counted among those drawn from and never drawn. Rows with a repeated id are
    documents of their own; if score and id tie, fewer features go first, then any. Other
    columns are not read. An empty ``docs`` gives no rows, an empty ``target`` works.

    Bounds: ``buckets`` counts a task and on the driver; a text is read in blocks, however
    long; the rows are sorted in pieces, drawn ones only, and the cutoff in its bracket only.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    gains = bucket_gains(
        bucket_counts(own, "text", max_n, buckets),
        bucket_counts(target, target_text, max_n, buckets),
    )
    scored = _weights(own, gains, max_n).withColumns(
        {
            "score": F.col("weight") + _noise(F.col("doc_id"), seed),
            "row": F.monotonically_increasing_id(),
        }
    )
    scored = materialise(scored, "importance")
    place = F.struct((-F.col("score")).alias("down"), "doc_id", "n_features", "row")
    scored = scored.withColumn("place", place)
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    pool = scored.filter(fit)
    n = pool.count()
    k = n * percent // 100
    shown = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*shown, F.lit(None).cast("long").alias("rank"))
    drawn = _drawn(pool, n, k, accuracy)
    ranked = running_total(pool.filter(drawn).withColumn("one", F.lit(1)), "place", "one")
    rest = scored.filter(~(fit & drawn))
    return ranked.select(*shown, F.col("upto").alias("rank")).unionByName(
        rest.select(*shown, F.lit(None).cast("long").alias("rank"))
    )
