"""Words and shingles of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z are lower-cased. Word and
shingle hashes are 64-bit. Nothing here knows of Spark: these are the helpers that the
operators call inside ``mapInArrow``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BACK = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit over all others."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


# One value for each byte (lower-cased), so that sums over bytes identify words.
_BYTE = mix(_LOWER.astype(_U) + _U(1))
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for k, base in enumerate((_STEP, _BACK)):
            p = np.full(size, base, _U)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=_U)
    return _POWERS[0][:n], _POWERS[1][:n]


@dataclass
class Words:
    """The words of some texts. ``first[r]:first[r + 1]`` are the words of text ``r``;
    ``start`` and ``end`` are byte places in ``data``; ``at[r]`` is where text ``r`` begins."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts())

    def hashes(self) -> np.ndarray:
        """uint64 per word, the same for the same word in any text."""
        power, back = _powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, _U)
        np.cumsum(_BYTE[self.data] * power[:-1], out=total[1:])
        return mix((total[self.end] - total[self.start]) * back[self.start])


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text; a longer text stands alone."""
    if not batch.num_rows:
        return
    _, at = text_buffers(batch.column(batch.schema.get_field_index(text)))
    begin = 0
    while begin < batch.num_rows:
        stop = int(np.searchsorted(at, at[begin] + limit, side="right")) - 1
        stop = min(max(stop, begin + 1), batch.num_rows)
        yield batch.slice(begin, stop - begin)
        begin = stop


def words(column: pa.Array, inside: np.ndarray = ~_SPACE) -> Words:
    """The runs of bytes of every text for which ``inside`` (256 flags) holds."""
    data, at = text_buffers(column)
    inside = inside[data]
    edge = np.zeros(len(data) + 1, np.int8)  # where a text begins, a word ends
    edge[at] = 1
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | (edge[:-1] == 1)))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | (edge[1:] == 1))) + 1
    return Words(data, at, start, end, np.searchsorted(start, at).astype(np.int64))


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every ``n``-word window, in reading order. A text with fewer words
    has its whole sequence as its one shingle; a text without words has none."""
    h = w.hashes()
    counts = w.counts()
    windows = np.maximum(counts - n + 1, 0)
    total = len(h) - n + 1
    if total > 0:
        rolled = np.zeros(total, _U)
        for k in range(n):
            rolled = rolled * _STEP + h[k : k + total]
        row = w.row()
        whole = row[:total] == row[n - 1 :]
        rows, out = row[:total][whole], mix(rolled[whole] + _U(n))
    else:
        rows, out = np.zeros(0, np.int64), np.zeros(0, _U)
    short = np.flatnonzero((counts > 0) & (windows == 0))
    if len(short):
        extra = np.zeros(len(short), _U)
        size = counts[short]
        for k in range(n - 1):
            live = size > k
            extra[live] = extra[live] * _STEP + h[w.first[short[live]] + k]
        rows = np.concatenate([rows, short])
        out = np.concatenate([out, mix(extra + size.astype(_U))])
        order = np.argsort(rows, kind="stable")
        rows, out = rows[order], out[order]
    return rows, out


def distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, hash) pairs, by row, then hash."""
    if not len(rows):
        return rows, hashes
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(rows[order], kind="stable")]
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums (wrapping for uint64) of ``values[first[i]:first[i + 1]]``, 0 for an empty run."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
