"""Short test items inside long documents: size-partitioned MinHash containment search.

A containment of 0.8 is a tiny Jaccard similarity when the document is long. So both sides
are partitioned by size: items by the power of two above their shingle count, and for each
such partition a document is the set of windows of at most two such lengths, half of them
overlapping. In a window the Jaccard similarity of a contained item stays above a third, and
one equal MinHash value makes a candidate. Values are taken by one permutation in ``bins``
bins, so the chance that an item in a window shares none is about ``0.5 ** (number of filled
bins)``. Each candidate is then verified: the share of the item's distinct shingles that
occur anywhere in the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .rows import map_rows
from .words import distinct, shingles, slices, words

#: Shingles of items held by a task at once (8 bytes each); more are searched block by block.
BLOCK_SHINGLES = 2_000_000


class ItemIndex:
    """Sorted MinHash values of a block of items, by size partition."""

    def __init__(self, sets: list[np.ndarray], bins: int):
        self.sets, self.shift = sets, np.uint64(64 - (bins - 1).bit_length())
        sizes = np.array([len(s) for s in sets], np.int64)
        self.parts = []
        partition = np.array([int(max(n - 1, 0)).bit_length() for n in sizes])
        for p in sorted(set(partition[sizes > 0].tolist())):
            value, owner = [], []
            for i in np.flatnonzero((partition == p) & (sizes > 0)):
                s = sets[i]  # sorted, so the first of each bin is its minimum
                bin_of = s >> self.shift
                new = np.ones(len(s), bool)
                new[1:] = bin_of[1:] != bin_of[:-1]
                value.append(s[new])
                owner.append(np.full(int(new.sum()), i))
            value, owner = np.concatenate(value), np.concatenate(owner)
            order = np.argsort(value, kind="stable")
            self.parts.append((1 << p, value[order], owner[order]))

    def candidates(self, row_of: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Distinct (row, item) pairs with an equal MinHash value in some window."""
        found = []
        begin = np.searchsorted(row_of, row_of, side="left")  # of the text of each shingle
        stop = np.searchsorted(row_of, row_of, side="right")
        for length, value, owner in self.parts:
            low = np.searchsorted(value, hashes)
            hit = np.flatnonzero(value[np.minimum(low, len(value) - 1)] == hashes)
            for shift in (0, 1):  # the two windows over the place
                least = np.zeros(len(hit), bool)
                for some in np.array_split(np.arange(len(hit)), max(1, len(hit) * length >> 20)):
                    h = hit[some]
                    block = (h - begin[h]) // length - shift
                    left = begin[h] + np.maximum(block, 0) * length
                    right = np.minimum(begin[h] + (block + 2) * length, stop[h])
                    place = left[:, None] + np.arange(2 * length)
                    inside = place < right[:, None]
                    near = hashes[np.minimum(place, len(hashes) - 1)]
                    mine = hashes[h][:, None]
                    less = inside & (near < mine) & (near >> self.shift == mine >> self.shift)
                    least[some] = ~less.any(axis=1)
                h = hit[least]
                last = np.searchsorted(value, hashes[h], side="right")
                times = last - low[h]
                at = np.repeat(low[h], times) + (
                    np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                )
                found.append(np.stack([np.repeat(row_of[h], times), owner[at]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _item_sets(items: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    kind = dict(items.dtypes)[item_id]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                rows, hashes = distinct(*shingles(words(part.column(1)), n))
                cut = np.searchsorted(rows, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(cut)),
                        pa.array(
                            [hashes[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)],
                            pa.binary(),
                        ),
                    ],
                    ["item_id", "n", "hashes"],
                )

    chosen = items.select(F.col(item_id).alias("item_id"), F.col(text).alias(text)).distinct()
    return chosen.mapInArrow(sets, f"item_id {kind}, n long, hashes binary").filter("n > 0")


def _blocks(items: DataFrame, item_id: str, text: str, n: int, limit: int) -> list:
    """Broadcast blocks of (id, sorted shingle hashes), each within ``limit`` shingles."""
    blocks: list[list] = [[]]
    held = 0
    for item in _item_sets(items, item_id, text, n).collect():
        if held and held + item["n"] > limit:
            blocks.append([])
            held = 0
        blocks[-1].append((item["item_id"], bytes(item["hashes"])))
        held += item["n"]
    return [items.sparkSession.sparkContext.broadcast(block) for block in blocks]


def _searcher(block, n: int, percent: int, bins: int):
    """A function of a text column: (row, item id, item shingles, shared) of every hit."""
    ids = [i for i, _ in block.value]
    sets = [np.frombuffer(h, np.uint64) for _, h in block.value]
    index = ItemIndex(sets, bins)

    def search(column: pa.Array) -> list[tuple]:
        rows, hashes = shingles(words(column), n)
        got = []
        for row, item in index.candidates(rows, hashes).tolist():
            a, b = np.searchsorted(rows, [row, row + 1])
            both = int(np.isin(sets[item], hashes[a:b]).sum())
            if 100 * both >= percent * len(sets[item]):
                got.append((row, ids[item], len(sets[item]), both))
        return got

    return search


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    n: int = 5,
    percent: int = 80,
    bins: int = 64,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per row of ``docs`` and item that it contains.

    Columns: the two ids, ``item_shingles`` (distinct ``n``-word shingles of the item),
    ``shared`` (those found in the document) and ``containment``. An item is contained when
    ``100 * shared >= percent * item_shingles``.

    The items are a query set: they are sent to the tasks in blocks of at most
    ``block_shingles`` shingles (an item with more stands alone), each block against all
    documents. Documents never move.

    Null or empty texts contain nothing; null or empty items are contained nowhere. An item
    of fewer than ``n`` words is one shingle, its whole sequence, and is found in documents
    of just these words. Equal rows of ``items`` count once; rows of ``items`` with one id
    and other texts are items of their own. Repeated rows of ``docs`` give repeated rows,
    null ids are carried. Other columns, whatever their names, are not read.
    """
    kinds = [(doc_id, docs.schema[doc_id].dataType), (item_id, items.schema[item_id].dataType)]
    schema = (
        f"`{doc_id}` {kinds[0][1].simpleString()}, `{item_id}` {kinds[1][1].simpleString()}, "
        "item_shingles long, shared long, containment double"
    )
    out_schema = pa.schema(
        [(name, to_arrow_type(kind)) for name, kind in kinds]
        + [("item_shingles", pa.int64()), ("shared", pa.int64()), ("containment", pa.float64())]
    )
    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))

    def passed(block):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            search = _searcher(block, n, percent, bins)
            for batch in batches:
                for part in slices(batch, "text"):
                    if got := search(part.column(1)):
                        row, item, size, both = zip(*got, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(0).take(pa.array(row)).cast(out_schema.field(0).type),
                                pa.array(item, out_schema.field(1).type),
                                pa.array(size, pa.int64()),
                                pa.array(both, pa.int64()),
                                pa.array(np.array(both) / np.array(size)),
                            ],
                            schema=out_schema,
                        )

        return chosen.mapInArrow(find, schema)

    out = None
    for block in _blocks(items, item_id, text, n, block_shingles):
        out = passed(block) if out is None else out.unionByName(passed(block))
    return out


def without_contained(
    docs: DataFrame,
    items: DataFrame,
    *,
    item_id: str = "item_id",
    text: str = "text",
    n: int = 5,
    percent: int = 80,
    bins: int = 64,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; the rules of
    :func:`contained_items` hold. Rows are judged where they lie, without a shuffle."""
    out = docs
    for block in _blocks(items, item_id, text, n, block_shingles):

        def opened(block=block):
            search = _searcher(block, n, percent, bins)

            def clean(part: pa.RecordBatch, at: int) -> pa.RecordBatch:
                keep = np.ones(part.num_rows, bool)
                keep[[row for row, *_ in search(part.column(at))]] = False
                return part.filter(pa.array(keep))

            return clean

        out = map_rows(out, text, opened)
    return out
