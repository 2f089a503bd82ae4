"""Packed token matrices on disk: best-fit-decreasing with a segment tree over capacities.

Texts are tokenized, cut and packed where they lie, a round of pieces at a time, so ids are
never shuffled. The rows of the matrix are written as Parquet: ids in a fixed number of
little-endian slots, the cumulative lengths of the segments in them, and positions that
start again at 0 in each segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .tokens import cuts, encoder

#: Pieces shorter than a row that one round packs together.
ROUND_PIECES = 16_384

MATRIX = (
    "row_id long, ids binary, n_tokens int, cu_seqlens array<int>, positions binary, "
    "doc_ids array<{kind}>, pieces array<int>"
)


class Capacities:
    """Counts of open rows by free slots, in a segment tree: the least capacity that holds a
    piece is found in log(slots) steps."""

    def __init__(self, slots: int):
        self.base = 1 << slots.bit_length()
        self.count = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(slots + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        at = self.base + free
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, row) of the row with the least capacity of ``need`` or more, removed."""
        at = self.base + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.base:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.base
        while at:
            self.count[at] -= 1
            at >>= 1
        return free, self.rows[free].pop()


def best_fit_decreasing(lengths: np.ndarray, slots: int) -> list[list[int]]:
    """Rows of piece numbers: the longest piece first, each into the fullest row it fits in."""
    open_rows, rows = Capacities(slots), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        found = open_rows.take(need)
        free, row = found or (slots, len(rows))
        if found is None:
            rows.append([])
        rows[row].append(piece)
        open_rows.add(free - need, row)
    return rows


def packed_matrix(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    slots: int = 1024,
    end_id: int = 2,
    pad_id: int = 50256,
    round_pieces: int = ROUND_PIECES,
) -> DataFrame:
    """The rows of the packed matrix.

    ``row_id`` (unique), ``ids`` (``slots`` little-endian unsigned 16-bit ids, or 32-bit if the
    tokenizer has more than 65,536; ``pad_id`` fills the end), ``n_tokens``, ``cu_seqlens`` (0,
    then the end of every segment), ``positions`` (16-bit, from 0 in each segment, 0 in the
    padding), ``doc_ids`` and ``pieces`` (the segments' documents and piece numbers).

    A text's ids are followed by ``end_id``; more than ``slots`` ids are cut without loss into
    full pieces, the first of which may be shorter. A null text is empty. Repeated rows and
    null ids are kept. A round packs at most ``round_pieces`` shorter pieces, so memory is
    bounded, and only a round's last rows have room left. An empty table gives no rows.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = MATRIX.format(kind=kind)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        wide = np.dtype("<u4") if ids_of.exact.get_vocab_size() > 1 << 16 else np.dtype("<u2")
        next_row = TaskContext.get().partitionId() << 36
        held: list[tuple] = []

        def matrix(rows: list[list[tuple]]) -> pa.RecordBatch:
            nonlocal next_row
            ids, total, ends, positions, owners, numbers = [], [], [], [], [], []
            for row in rows:
                line, place = np.full(slots, pad_id, wide), np.zeros(slots, "<u2")
                end = [0]
                for _, _, piece in row:
                    line[end[-1] : end[-1] + len(piece)] = piece
                    place[end[-1] : end[-1] + len(piece)] = np.arange(len(piece))
                    end.append(end[-1] + len(piece))
                ids.append(line.tobytes())
                positions.append(place.tobytes())
                total.append(end[-1])
                ends.append(end)
                owners.append([owner for owner, _, _ in row])
                numbers.append([number for _, number, _ in row])
            names = next_row + np.arange(len(rows))
            next_row += len(rows)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(total, pa.int32()),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array(positions, pa.binary()),
                    pa.array(owners, pa.list_(kind_of)),
                    pa.array(numbers, pa.list_(pa.int32())),
                ],
                ["row_id", "ids", "n_tokens", "cu_seqlens", "positions", "doc_ids", "pieces"],
            )

        def round_() -> Iterator[pa.RecordBatch]:
            rows = best_fit_decreasing(np.array([len(p) for *_, p in held], np.int64), slots)
            for begin in range(0, len(rows), 512):
                yield matrix([[held[i] for i in row] for row in rows[begin : begin + 512]])
            held.clear()

        for batch in batches:
            kind_of = batch.schema.field(0).type
            full = []
            for owner, value in zip(batch.column(0), batch.column(1), strict=True):
                owner = owner.as_py()
                ids = np.append(ids_of(value.as_py()), np.uint32(end_id)).astype(wide)
                for number, (start, length) in enumerate(cuts(len(ids), slots)):
                    piece = ids[start : start + length]
                    (full if length == slots else held).append((owner, number, piece))
                if len(full) >= 512:
                    yield matrix([[piece] for piece in full])
                    full = []
                if len(held) >= round_pieces:
                    yield from round_()
            if full:
                yield matrix([[piece] for piece in full])
        if held:
            yield from round_()

    chosen = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return chosen.mapInArrow(pack, schema)


def write_matrix(docs: DataFrame, tokenizer: str, path: str | None = None, **how) -> DataFrame:
    """:func:`packed_matrix` written as Parquet to ``path`` (a new folder below the shared
    one, if none is given), and read back from there."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "matrix")
    rows = packed_matrix(docs, tokenizer, **how)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)

