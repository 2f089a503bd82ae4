"""Vector best-fit packing: several capacities at once, residuals choose the bin."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import materialise
from .tokens import cuts, encoder

#: Items that one round of best fit sees together; the last bin of a round may stay half full.
ROUND_ITEMS = 16_384


def best_fit(
    sizes: np.ndarray, weights: Sequence[float], score: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """(bin, rank inside the bin) of every item of one round.

    ``sizes`` are shares of each capacity, (items, dimensions). Items go largest first
    (weighted sum of shares, then their order). Of the open bins whose residual holds the
    item in every dimension, ``norm`` takes the least weighted norm of what would remain,
    ``dot`` the greatest weighted dot-product of item and residual; ties go to the oldest
    bin. An item larger than a capacity stands alone.
    """
    n, dims = sizes.shape
    weight = np.asarray(weights, float)
    order = np.lexsort((np.arange(n), -(sizes @ weight)))
    least = np.minimum.accumulate(sizes[order][::-1], axis=0)[::-1]  # of what is still to come
    left = np.empty((dims, n))
    name = np.empty(n, np.int64)
    open_, made = 0, 0
    bin_of, rank = np.empty(n, np.int64), np.empty(n, np.int64)
    held = np.zeros(n, np.int64)
    slack = 1e-9
    for step, item in enumerate(order):
        size = sizes[item]
        if step % 512 == 0 and open_:  # bins that can take nothing more are closed
            useful = (left[:, :open_] >= least[step][:, None] - slack).all(axis=0)
            keep = np.flatnonzero(useful)
            left[:, : len(keep)] = left[:, keep]
            name[: len(keep)] = name[keep]
            open_ = len(keep)
        fits = left[0, :open_] >= size[0] - slack
        for d in range(1, dims):
            fits &= left[d, :open_] >= size[d] - slack
        some = np.flatnonzero(fits)
        if len(some):
            residual = left[:, some]
            if score == "norm":
                value = -(weight[:, None] * (residual - size[:, None]) ** 2).sum(axis=0)
            else:
                value = (weight[:, None] * residual * size[:, None]).sum(axis=0)
            slot = some[np.argmax(value)]
        else:
            slot = open_
            left[:, slot], name[slot] = 1.0, made
            open_, made = open_ + 1, made + 1
        left[:, slot] -= size
        bin_of[item] = name[slot]
        rank[item] = held[name[slot]]
        held[name[slot]] += 1
    return bin_of, rank


def pack(
    items: DataFrame,
    *,
    sizes: Sequence[str],
    capacities: Sequence[float],
    weights: Sequence[float],
    score: str = "norm",
    round_items: int = ROUND_ITEMS,
) -> DataFrame:
    """``items`` with ``sequence_id`` (long, unique per bin) and ``offset`` (long: sum of the
    first size over the items before it in the bin).

    Items that fill the first capacity alone stand alone and do not move. The others are
    dealt by a hash of all their columns and packed in rounds of ``round_items``, so a task
    holds one round however many items there are, and equal rows cannot crowd a task's
    memory. Only the columns given are moved: pass ids and sizes, not texts.

    A null size counts as 0. A row larger than a capacity stands alone. Equal rows are
    items of their own. An empty input gives no rows. ``items`` is evaluated twice, so write
    it first if it is costly. Columns named sequence_id or offset are replaced.
    """
    if score not in ("norm", "dot") or not len(sizes) == len(capacities) == len(weights):
        raise ValueError("score is norm or dot; sizes, capacities and weights go together")
    items = items.drop("sequence_id", "offset")
    columns = items.columns
    size = F.coalesce(F.col(sizes[0]), F.lit(0))
    alone = items.filter(size >= capacities[0]).select(
        *columns,
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = items.filter(size < capacities[0])
    deal = F.xxhash64(*columns)
    rounds = max(1, -(-rest.count() // round_items))
    dealt = rest.repartition(rounds, deal).sortWithinPartitions(deal, *columns)
    schema = alone.schema
    arrow = to_arrow_schema(schema)

    def rounds_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, count = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, round_items - count)
                held.append(part)
                count += part.num_rows
                batch = batch.slice(part.num_rows)
                if count == round_items:
                    yield pa.Table.from_batches(held)
                    held, count = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        for table in rounds_of(batches):
            raw = np.stack(
                [table.column(c).fill_null(0).to_numpy().astype(float) for c in sizes], axis=1
            )
            bins, rank = best_fit(raw / np.asarray(capacities, float), weights, score)
            order = np.lexsort((rank, bins))
            length = raw[order, 0].astype(np.int64)
            before = np.cumsum(length) - length
            start = np.searchsorted(bins[order], bins[order])
            table = table.take(pa.array(order))
            table = table.append_column("sequence_id", pa.array(first + bins[order]))
            table = table.append_column("offset", pa.array(before - before[start]))
            yield from table.cast(arrow).to_batches()
            first += int(bins.max()) + 1

    return alone.unionByName(dealt.mapInArrow(packed, schema))


def pieces(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 1024,
    end_id: int = 2,
) -> DataFrame:
    """The token pieces of every text: ``doc_id``, ``piece`` (int, from 0), ``start`` (ids
    before it), ``length``, ``ids_crc32`` (unsigned, of the little-endian 32-bit ids) and
    ``ids`` (those bytes). A text's ids are followed by ``end_id``; only more than ``limit``
    ids are cut, and only the first piece may then be shorter. A null text is empty: its one
    piece is ``end_id``. Drop ``ids`` where only sizes are needed; whole texts stay in a task
    one batch at a time."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                row, piece, start, length, crc, data = [], [], [], [], [], []
                for r, value in enumerate(part.column(1)):
                    ids = np.append(ids_of(value.as_py()), np.uint32(end_id)).astype("<u4")
                    for k, (s, n) in enumerate(cuts(len(ids), limit)):
                        raw = ids[s : s + n].tobytes()
                        for out, x in zip(
                            (row, piece, start, length, crc, data),
                            (r, k, s, n, zlib.crc32(raw), raw),
                            strict=True,
                        ):
                            out.append(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                        pa.array(data, pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return chosen.mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    limit: int = 1024,
    max_documents: int = 1024,
    attention: float | None = None,
    weights: Sequence[float] = (1.0, 0.01, 0.01),
    score: str = "norm",
    **how,
) -> DataFrame:
    """Every piece of :func:`pieces` (without its ids) with its place in a sequence of at
    most ``limit`` tokens, ``max_documents`` pieces and ``attention`` units of attention cost
    (sum of squared lengths; by default what one full piece costs)."""
    cut = pieces(docs, tokenizer, limit=limit, **how).drop("ids")
    sized = materialise(cut, "pieces").select(
        "*",
        F.lit(1).cast("long").alias("__one"),
        (F.col("length") * F.col("length")).alias("__cost"),
    )
    return pack(
        sized,
        sizes=("length", "__one", "__cost"),
        capacities=(limit, max_documents, attention or float(limit) ** 2),
        weights=weights,
        score=score,
    ).drop("__one", "__cost")
