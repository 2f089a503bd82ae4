"""Exact Jaccard join of n-gram sets by vertical partitioning, down to components.

The global order of n-grams is the order of their 64-bit hashes. It is cut into fragments,
so a document is one segment per fragment.

* Candidates: two linked documents differ in at most ``d`` n-grams, so of more than ``d``
  fragments some segment is the same in both. Documents are put into size classes such that
  linked ones lie in the same or in neighbouring classes; each writes the signatures of its
  segments for its own class, and for the next if it is large enough to link with one there.
  A pair is a candidate when a signature is equal.
* Common passages: a document is cut into ``s`` segments more than that and leaves out its
  ``s`` most frequent signatures, by one order of all signatures (frequency, then hash). Two
  linked documents share ``s + 1`` segments or more, and the first of these in that order is
  among those left out on neither side; so passages that many documents share build no
  groups, and no link is lost. Any order does for that: only the most frequent signatures
  are counted, the others count as equally rare.
* Count: the n-grams of candidates are shuffled fragment by fragment; a task counts the
  overlaps of one fragment of a pivot with some of its partners, and they are summed per pair.

Nothing is lost, as the only filters are bounds: equal segments, sizes, and a parity bitmap
whose Hamming distance never exceeds the number of n-grams in which two sets differ.

Copies (equal sets) are one class from the start. A group of equal signatures is never
expanded into all pairs: its members are first compared with one pivot. Where the links
found leave a group in several components, members of different components meet, in blocks
of bounded size. First only the closest pair of two components is counted, until that links
nothing more; at last every pair that the bitmaps cannot exclude.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, scratch_scope
from .components import components, merged_components
from .sieve import sieve
from .words import distinct, mix, shingles, slices, sums, words

_U = np.uint64
#: Bits of a set's parity bitmap: the next power of two from its size on, within these bounds.
BITS, MOST_BITS = 1024, 16384
#: Parts of the signatures that are shuffled one after the other.
PASSES = 4
#: Fragments for counting overlaps of a pair: a row holds one, so rows of long texts are short.
FRAGMENTS = 32
#: Fragments (from, up to) that are counted before the others are.
FRAGMENT_STEPS = ((0, 8), (8, FRAGMENTS))
#: Partners of a pivot that are counted together.
PARTNERS = 64
#: Members of a signature that meet those of another block in one row.
BLOCK = 256
#: A signature is frequent from so many classes on, and so many at most are known to be.
FREQUENT, MOST_FREQUENT = 24, 200_000
#: Signatures a task counts at once.
COUNTED = 1 << 19


#: Each size class reaches so many times further than the one before.
CLASS_GROWTH = 1.6


def size_classes(percent: int, largest: int) -> np.ndarray:
    """Upper bounds of the size classes: linked sets are at most one class apart."""
    bounds, growth = [1], max(CLASS_GROWTH, 100 / percent)
    while bounds[-1] < largest:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * growth)))
    bounds.append(max(bounds[-1] + 1, int(bounds[-1] * growth)))
    return np.array(bounds, np.int64)


@dataclass(frozen=True)
class Frequent:
    """The most frequent signatures (sorted) and how often they were seen."""

    signature: np.ndarray
    count: np.ndarray

    def of(self, signature: np.ndarray) -> np.ndarray:
        if not len(self.signature):
            return np.zeros(len(signature), np.int64)
        place = np.minimum(np.searchsorted(self.signature, signature), len(self.signature) - 1)
        return np.where(self.signature[place] == signature, self.count[place], 0)


NONE = Frequent(np.zeros(0, _U), np.zeros(0, np.int64))


def signatures(
    rows: np.ndarray,
    hashes: np.ndarray,
    sizes: np.ndarray,
    percent: int,
    frequent: Frequent | None = NONE,
) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the segments, of both size classes, that can prove a link.
    ``rows`` and ``hashes`` are the distinct n-grams by row, then hash. With ``frequent``
    None those of all segments that are not empty, to be counted."""
    bounds = size_classes(percent, int(sizes.max(initial=1)))
    own = np.searchsorted(bounds, np.maximum(sizes, 1))
    value = mix(hashes ^ _U(0xA5A5A5A5A5A5A5A5))
    found_rows, found = [], []
    reaches = sizes * 100 >= (bounds[own] + 1) * percent  # some larger class
    for level, some in ((own, sizes > 0), (own + 1, reaches)):
        differ = (100 - percent) * 2 * bounds[level] // (100 + percent)
        spare = differ + 1
        pieces = np.where((differ > 0) & some, differ + 1 + spare, 0)
        live = pieces[rows] > 0
        r, h, v = rows[live], hashes[live], value[live]
        if not len(r):
            continue
        piece = ((h >> _U(32)) * pieces[r].astype(_U)) >> _U(32)
        first = np.ones(len(r), bool)
        first[1:] = (r[1:] != r[:-1]) | (piece[1:] != piece[:-1])
        start = np.flatnonzero(first)
        total = sums(v, np.append(start, len(r)))
        tag = lambda row, p: mix((level[row].astype(_U) << _U(32)) + p.astype(_U))  # noqa: B023, E731
        row = r[start]
        sign = mix(total + tag(row, piece[start]))
        if frequent is None:
            found_rows.append(row)
            found.append(sign)
            continue
        # empty segments are the most frequent of all, so they are left out first
        filled = np.bincount(row, minlength=len(sizes))
        empty = pieces - filled
        order = np.lexsort((sign, frequent.of(sign), row))
        before = np.concatenate([[0], np.cumsum(filled)])
        place = np.arange(len(order)) - before[row[order]]
        left = filled - np.maximum(spare - empty, 0)
        kept = order[place < left[row[order]]]
        found_rows.append(row[kept])
        found.append(sign[kept])
        for i in np.flatnonzero(empty > spare):
            a, b = np.searchsorted(row, [i, i + 1])
            gaps = np.setdiff1d(np.arange(pieces[i]), piece[start][a:b].astype(np.int64))
            found_rows.append(np.full(len(gaps), i))
            found.append(mix(tag(np.full(len(gaps), i), gaps)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    found_rows, found = np.concatenate(found_rows), np.concatenate(found)
    order = np.argsort(found_rows, kind="stable")
    return found_rows[order], found[order]


def _frequent(docs: DataFrame, text: str, n: int, percent: int) -> Frequent:
    """The signatures that most classes have. A task counts its own and sends those it has
    seen three times or more; at most ``MOST_FREQUENT`` counts reach the driver."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = np.zeros(0, _U), np.zeros(0, np.int64)
        waiting: list[np.ndarray] = []
        for batch in batches:
            seen: set[int] = set()
            for part in slices(batch, "text"):
                rows, hashes, sizes, _, old = _sets(part.column(0), n, seen)
                fresh = ~old[rows]
                sizes = np.where(old, 0, sizes)
                waiting.append(signatures(rows[fresh], hashes[fresh], sizes, percent, None)[1])
            if sum(map(len, waiting)) > COUNTED:
                known, times = _merged(known, times, waiting)
                if len(known) > COUNTED:
                    known, times = known[times > 1], times[times > 1]
                waiting = []
        known, times = _merged(known, times, waiting)
        often = times > 2
        yield pa.RecordBatch.from_arrays(
            [pa.array(known[often].view(np.int64)), pa.array(times[often])], ["signature", "n"]
        )

    top = (
        docs.select(F.col(text).alias("text"))
        .mapInArrow(counts, "signature long, n long")
        .groupBy("signature")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .orderBy(F.desc("n"), "signature")
        .limit(MOST_FREQUENT)
        .toArrow()
    )
    signature = top.column("signature").to_numpy().view(_U)
    order = np.argsort(signature)
    return Frequent(signature[order], top.column("n").to_numpy()[order])


def _merged(
    known: np.ndarray, times: np.ndarray, more: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Counts of values, with those of ``more`` added."""
    values = np.concatenate([known, *more])
    weights = np.concatenate([times, *(np.ones(len(m), np.int64) for m in more)])
    out, place = np.unique(values, return_inverse=True)
    return out, np.bincount(place, weights, minlength=len(out)).astype(np.int64)


def _sets(column: pa.Array, n: int, seen: set[int]) -> tuple[np.ndarray, ...]:
    """(row, hash) of the distinct n-grams, set sizes and keys, and which rows are empty or
    have a key that was ``seen`` before."""
    rows, hashes = distinct(*shingles(words(column), n))
    cut = np.searchsorted(rows, np.arange(len(column) + 1))
    sizes = np.diff(cut)
    key = mix(sums(mix(hashes + _U(1)), cut) + sizes.astype(_U)).view(np.int64)
    old = np.zeros(len(column), bool)
    for i, k in enumerate(key.tolist()):
        old[i] = k in seen or not sizes[i]
        seen.add(k)
    return rows, hashes, sizes, key, old


def parity_bitmaps(
    rows: np.ndarray, hashes: np.ndarray, count: int, bits: int = BITS
) -> np.ndarray:
    """(count, bits / 64) uint64: each n-gram of a set flips one bit. The two halves of a
    bitmap, one flipped by the other, are the set's bitmap of half as many bits."""
    out = np.zeros((count, bits // 8), np.uint8)
    bit = (mix(hashes + _U(0x5BF03635)) % _U(bits)).astype(np.int64)
    step = max(1024 * BITS // bits, 1)
    for begin in range(0, count, step):
        stop = min(begin + step, count)
        a, b = np.searchsorted(rows, [begin, stop])
        flips = np.bincount((rows[a:b] - begin) * bits + bit[a:b], minlength=(stop - begin) * bits)
        out[begin:stop] = np.packbits((flips & 1).astype(np.uint8).reshape(-1, bits), axis=1)
    return out.view(_U)


def sized_bitmaps(
    rows: np.ndarray, hashes: np.ndarray, sizes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmaps as long as their sets ask for: the words of all, and where each begins."""
    bits = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    bits = np.clip(bits, BITS, MOST_BITS)
    at = np.concatenate([[0], np.cumsum(bits // 64)])
    out = np.zeros(at[-1], _U)
    for n in np.unique(bits).tolist():
        some = np.flatnonzero(bits == n)
        mine = bits[rows] == n
        made = parity_bitmaps(np.searchsorted(some, rows[mine]), hashes[mine], len(some), n)
        out[at[some][:, None] + np.arange(n // 64)] = made
    return out, at


def _lists(values: np.ndarray, first: np.ndarray, null: np.ndarray | None = None) -> pa.Array:
    mask = None if null is None else pa.array(null)
    flat = pa.array(np.ascontiguousarray(values).view(np.int64))
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), flat, mask=mask)


def _profiles(docs: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    """One row per document: id, text hash, set size, set key; signatures and bitmap are
    null where the batch has an earlier copy."""
    frequent = _frequent(docs, text, n, percent)
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (
        f"doc_id {kind}, text_hash long, size long, key long, "
        "signatures array<long>, bitmap array<long>"
    )

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for part in slices(batch, "text"):
                rows, hashes, sizes, key, old = _sets(part.column(2), n, seen)
                fresh = ~old[rows]
                sig_rows, sigs = signatures(
                    rows[fresh], hashes[fresh], np.where(old, 0, sizes), percent, frequent
                )
                bits, at = sized_bitmaps(rows[fresh], hashes[fresh], np.where(old, 0, sizes))
                steps = np.arange(part.num_rows + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(key),
                        _lists(sigs, np.searchsorted(sig_rows, steps), old),
                        _lists(bits, at, old),
                    ],
                    ["doc_id", "text_hash", "size", "key", "signatures", "bitmap"],
                )

    chosen = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")
    )
    return chosen.mapInArrow(profile, schema)


def _stars(classes: DataFrame) -> DataFrame:
    """(signature, a, b) for every class ``b`` with a signature that a class ``a`` has, so
    that the links hold every group of equal signatures together. Groups are first reduced
    inside each batch; the shuffle sees one row per signature and batch, and one part of the
    signatures at a time, so that the disk holds the shuffle files of that part only."""
    spark = classes.sparkSession

    def reduced(part: int | None) -> DataFrame:
        """Of each batch the pivots of a part of the signatures; without one the other members."""

        def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(1)
                sig = lists.flatten().to_numpy()
                key = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
                if part is not None:
                    mine = (sig.view(_U) % _U(PASSES)) == _U(part)
                    sig, key = sig[mine], key[mine]
                order = np.lexsort((key, sig))
                sig, key = sig[order], key[order]
                new = np.ones(len(sig), bool)
                new[1:] = sig[1:] != sig[:-1]
                pivot = key[np.flatnonzero(new)][np.cumsum(new) - 1] if len(sig) else key
                rows = pivot != key if part is None else new
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sig[rows]), pa.array(pivot[rows]), pa.array(key[rows])],
                    ["signature", "a", "b"],
                )

        return classes.select("key", "signatures").mapInArrow(
            reduce, "signature long, a long, b long"
        )

    least = F.first("b").over(Window.partitionBy("signature").orderBy("b"))
    stars = materialise(reduced(None), "stars")
    for part in range(PASSES):
        across = reduced(part).select("signature", least.alias("a"), "b").filter("a <> b")
        stars = stars.unionByName(materialise(across, "stars"))
        spark._jvm.System.gc()  # executors learn that the part's shuffle files can go
    return stars


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) with their sizes, without those that sizes or bitmaps exclude."""
    side = classes.select("key", "size", "bitmap")
    for end in ("a", "b"):
        pairs = pairs.join(
            side.select(
                F.col("key").alias(end),
                F.col("size").alias(f"size_{end}"),
                F.col("bitmap").alias(f"bitmap_{end}"),
            ),
            end,
        )
    flip = lambda x, y: x.bitwiseXOR(y)
    words_a, words_b = F.size("bitmap_a"), F.size("bitmap_b")
    half = lambda c, n: F.zip_with(F.slice(c, 1, n), F.slice(c, n + 1, n), flip)
    flips = (
        F.when(words_a == words_b, F.zip_with("bitmap_a", "bitmap_b", flip))
        .when(words_a == 2 * words_b, F.zip_with(half("bitmap_a", words_b), "bitmap_b", flip))
        .when(words_b == 2 * words_a, F.zip_with("bitmap_a", half("bitmap_b", words_a), flip))
        .otherwise(F.array().cast("array<long>"))  # too different in size to say
    )
    apart = F.aggregate(
        flips, F.lit(0).cast("long"), lambda total, x: total + F.bit_count(x).cast("long")
    )
    both = F.col("size_a") + F.col("size_b")
    return pairs.filter(
        (F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent)
        & (apart * (100 + percent) <= both * (100 - percent))
    ).select("a", "b", "size_a", "size_b")


def _links(
    pairs: DataFrame, docs: DataFrame, first: DataFrame, doc_id: str, text: str, n: int, percent: int
) -> DataFrame:
    """Those of ``pairs`` (a, b, size_a, size_b) that reach the similarity: overlaps are
    counted in fragments of the global order and summed per pair. A few fragments go first,
    and a pair that the rest cannot bring to the similarity any more goes no further. What
    the count needs is deleted after it."""
    spark = pairs.sparkSession
    with scratch_scope(spark, keep=lambda purpose: purpose == "links"):
        texts = _texts(pairs, docs, first, doc_id, text)
        zero = F.lit(0).cast("long")
        open_ = pairs.select(*_PAIR, zero.alias("shared"))
        for part in FRAGMENT_STEPS:
            counted = _counted(open_, texts, n, part)
            shared, rest_a, rest_b = (
                F.col("shared") + F.coalesce("overlap", zero),
                F.col("size_a") - F.coalesce("here_a", zero),
                F.col("size_b") - F.coalesce("here_b", zero),
            )
            last = part is FRAGMENT_STEPS[-1]
            most = shared if last else shared + F.least(rest_a, rest_b)
            both = F.col("size_a") + F.col("size_b")
            reach = most * 100 >= (both - most) * percent
            open_ = open_.join(counted, ["a", "b"], "left").filter(reach)
            open_ = open_.select(*_PAIR, shared.alias("shared"))
            open_ = materialise(open_, "links" if last else "open")
    spark._jvm.System.gc()  # the driver tells executors of shuffle files nobody needs any more
    return open_.select("a", "b")


def _texts(pairs: DataFrame, docs: DataFrame, first: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, text) of the classes that occur in ``pairs``, each once."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    wanted = first.join(needed, "key").select("key", "row.doc_id", "row.text_hash")
    wanted = materialise(wanted, "wanted")
    source = docs.select(
        F.col(doc_id).alias("__id"), F.col(text).alias("text"), F.xxhash64(text).alias("__hash")
    )
    texts = sieve(source, F.col("__hash"), wanted, "text_hash").join(
        wanted,
        F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash")),
    ).select("key", "text")
    return materialise(texts.dropDuplicates(["key"]), "texts")


def _counted(pairs: DataFrame, texts: DataFrame, n: int, part: tuple[int, int]) -> DataFrame:
    """(a, b, overlap, here_a, here_b): what a and b share in the fragments ``part`` (from, up
    to), and how many n-grams they have there (not counted where one of them has none)."""
    # a pivot's fragments go to every slice of its partners once, not to every partner
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("slices"))
    sliced = pairs.select("a", "b").join(degree, "a")
    sliced = sliced.withColumn("slice", F.pmod(F.xxhash64("b"), F.col("slices"))).drop("slices")
    sliced = materialise(sliced, "sliced")
    ends = sliced.select("a", "slice").distinct()

    def fragments(keys: DataFrame, key: str) -> DataFrame:
        chosen = texts.join(keys.select(F.col(key).alias("key")).distinct(), "key", "left_semi")
        cut = chosen.mapInArrow(lambda batches: _fragments(batches, n, part), _FRAGMENT)
        return cut.withColumnRenamed("key", key)

    pivots = fragments(ends, "a").join(ends, "a").select(
        "a", "slice", "fragment", F.lit(None).cast("long").alias("b"), "hashes"
    )
    partners = fragments(sliced, "b").join(sliced, "b").select(*pivots.columns)
    group = ["a", "slice", "fragment"]
    met = pivots.unionByName(partners).repartition(*group).sortWithinPartitions(*group, F.asc_nulls_first("b"))
    sums_ = [F.sum(c).alias(c) for c in ("overlap", "here_a", "here_b")]
    return met.mapInArrow(_overlaps, "a long, b long, overlap long, here_a long, here_b long").groupBy("a", "b").agg(*sums_)


_FRAGMENT = "key long, fragment int, hashes binary"


def _fragments(
    batches: Iterator[pa.RecordBatch], n: int, span: tuple[int, int]
) -> Iterator[pa.RecordBatch]:
    """(key, text) to the sorted n-grams of some fragments of the global order."""
    for batch in batches:
        for part in slices(batch, "text"):
            rows, hashes = distinct(*shingles(words(part.column(1)), n))
            piece = ((hashes >> _U(32)) * _U(FRAGMENTS) >> _U(32)).astype(np.int64)
            mine = (piece >= span[0]) & (piece < span[1])
            rows, hashes, piece = rows[mine], hashes[mine], piece[mine]
            place = rows * FRAGMENTS + piece
            first = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
            offsets = (np.append(first, len(place)) * 8).astype(np.int32)
            buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(hashes.tobytes())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(rows[first])),
                    pa.array(piece[first].astype(np.int32)),
                    pa.Array.from_buffers(pa.binary(), len(first), buffers),
                ],
                ["key", "fragment", "hashes"],
            )


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of groups, each the fragment of a pivot (no b) and then those of partners,
    to the number of n-grams that each partner's fragment shares with the pivot's."""
    group, pivot = None, np.zeros(0, _U)
    for batch in batches:
        if not batch.num_rows:
            continue
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        keys = np.stack([column[c].to_numpy().astype(np.int64) for c in ("a", "slice", "fragment")])
        partner = column["b"].is_valid().to_numpy(zero_copy_only=False)
        hashes = column["hashes"]
        at = np.frombuffer(hashes.buffers()[1], np.int32)[hashes.offset : hashes.offset + batch.num_rows + 1]
        at = at.astype(np.int64)
        data = np.frombuffer(hashes.buffers()[2], _U, (at[-1] - at[0]) // 8, at[0])
        at = (at - at[0]) // 8
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        overlap, here_a = np.zeros((2, batch.num_rows), np.int64)
        for begin, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            this = tuple(keys[:, begin])
            if not partner[begin]:
                pivot, begin = data[at[begin] : at[begin + 1]], begin + 1
            elif this != group:
                pivot = np.zeros(0, _U)  # the pivot has nothing in this fragment
            group = this
            if begin == stop or not len(pivot):
                continue
            values = data[at[begin] : at[stop]]
            hit = pivot[np.minimum(np.searchsorted(pivot, values), len(pivot) - 1)] == values
            overlap[begin:stop] = np.add.reduceat(hit.astype(np.int64), at[begin:stop] - at[begin])
            here_a[begin:stop] = len(pivot)
        rows = np.flatnonzero(partner)
        yield pa.RecordBatch.from_arrays(
            [column["a"].take(pa.array(rows)), column["b"].take(pa.array(rows))]
            + [pa.array(v[rows]) for v in (overlap, here_a, np.diff(at))],
            ["a", "b", "overlap", "here_a", "here_b"],
        )


_PAIR = ("a", "b", "size_a", "size_b")


def _rooted(links: DataFrame) -> DataFrame:
    """``key`` and ``root`` for every class that has a link."""
    return materialise(components(links), "roots").select(F.col("node").alias("key"), "root")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component."""
    for end in ("a", "b"):
        named = roots.select(F.col("key").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(named, end, "left")
    return pairs.filter(
        F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    ).drop("root_a", "root_b")


def _groups(stars: DataFrame) -> DataFrame:
    """(signature, n, key): the members of every group of three or more. Of groups with the
    same members one stands for all; groups of two are pairs of stars already."""
    members = (
        stars.select("signature", F.explode(F.array("a", "b")).alias("key")).distinct()
    )
    same = members.groupBy("signature").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("key").alias("x"), F.sum(F.hash("key")).alias("h")
    )
    kept = same.filter("n > 2").groupBy("n", "x", "h").agg(F.min("signature").alias("signature"))
    return members.join(kept.select("signature", "n"), "signature")


def _met_across(
    groups: DataFrame, small: DataFrame, roots: DataFrame, percent: int, nearest: bool
) -> DataFrame:
    """Pairs of one group but different components that bounds don't exclude; with
    ``nearest`` only, for each component, the pair with another whose bitmaps are closest."""
    rooted = groups.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    blocks = F.ceil(F.col("n") / BLOCK)
    several = (
        rooted.groupBy("signature", "n")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high")
        .select("signature", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"))
    )
    # joined and gathered by signature and block, so that a large group is many tasks' work
    placed = (
        rooted.withColumn("block", F.pmod(F.xxhash64("key"), blocks))
        .join(small.select("key", "size", "bitmap"), "key")
        .join(several, ["signature", "block"], "left_semi")
        .select(
            "signature",
            blocks.alias("blocks"),
            "block",
            F.struct("key", "root", "size", "bitmap").alias("m"),
        )
        .groupBy("signature", "block", "blocks")
        .agg(F.collect_list("m").alias("members"))
    )
    placed = materialise(placed, "blocks")
    # a group of one block meets itself where it is
    alone = placed.filter("blocks = 1").select(F.col("members").alias("left"), F.col("members").alias("right"))
    placed = placed.filter("blocks > 1")
    left = placed.select(
        "signature",
        F.col("block").alias("left_block"),
        F.col("members").alias("left"),
        F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block"),
    )
    meet = left.join(
        placed.select("signature", "block", F.col("members").alias("right")), ["signature", "block"]
    ).select("left", "right").unionByName(alone)

    def unpack(column: pa.Array) -> tuple[np.ndarray, ...]:
        flat = column.flatten()
        field = lambda name: flat.field(flat.type.get_field_index(name))
        numbers = [field(name).to_numpy(zero_copy_only=False) for name in ("key", "root", "size")]
        bitmap = field("bitmap")
        bits = bitmap.flatten().to_numpy().view(_U), bitmap.offsets.to_numpy() - bitmap.offsets[0].as_py()
        return column.offsets.to_numpy() - column.offsets[0].as_py(), *numbers, bits

    def by_length(bits: tuple[np.ndarray, np.ndarray], members: slice) -> dict[int, tuple]:
        """Words of a bitmap to (members with so many, their bitmaps)."""
        values, at = bits
        long = np.diff(at)[members]
        out = {}
        for n in np.unique(long).tolist():
            some = np.flatnonzero(long == n)
            out[n] = some, values[(at[some + members.start])[:, None] + np.arange(n)]
        return out

    def distances(left: dict[int, tuple], right: dict[int, tuple], shape: tuple[int, int]) -> np.ndarray:
        """Hamming distances of bitmaps; 0, which excludes nothing, where one is over twice as long."""
        apart = np.zeros(shape, np.int64)
        for n, (x, p) in left.items():
            for m, (y, q) in right.items():
                if max(n, m) > 2 * min(n, m):
                    continue
                u = p if n <= m else p[:, :m] ^ p[:, m:]
                v = q if m <= n else q[:, :n] ^ q[:, n:]
                total = np.zeros((len(x), len(y)), np.int64)
                for w in range(u.shape[1]):
                    total += np.bitwise_count(u[:, None, w] ^ v[None, :, w])
                apart[np.ix_(x, y)] = total
        return apart

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, key, root, size, bits = unpack(batch.column(0))
            at2, key2, root2, size2, bits2 = unpack(batch.column(1))
            out = []
            for i in range(batch.num_rows):
                p, q = slice(at[i], at[i + 1]), slice(at2[i], at2[i + 1])
                both = size[p, None] + size2[None, q]
                apart = distances(by_length(bits, p), by_length(bits2, q), both.shape)
                fits = (
                    (root[p, None] != root2[None, q])
                    & (apart * (100 + percent) <= both * (100 - percent))
                    & (
                        100 * np.minimum(size[p, None], size2[None, q])
                        >= percent * np.maximum(size[p, None], size2[None, q])
                    )
                )
                if nearest:
                    cost = np.where(fits, apart, 1 << 40)
                    x, y = np.arange(len(fits)), np.arange(fits.shape[1])
                    x = np.concatenate([x, cost.argmin(axis=0)])
                    y = np.concatenate([cost.argmin(axis=1), y])
                    x, y = x[fits[x, y]], y[fits[x, y]]
                else:
                    x, y = np.nonzero(fits)
                apart = apart[x, y]
                x, y = x + at[i], y + at2[i]
                swap = key[x] > key2[y]
                pick = lambda u, v: np.where(swap, v[y], u[x])  # noqa: B023, E731
                flip = lambda u, v: np.where(swap, u[x], v[y])  # noqa: B023, E731
                pair = [pick(key, key2), flip(key, key2), pick(size, size2), flip(size, size2)]
                for owner in (root[x], root2[y]) if nearest else (np.zeros_like(apart),):
                    out.append(np.stack([owner, apart, *pair]))
            if out:
                found = np.concatenate(out, axis=1)
                found = found[:, np.lexsort(found[::-1])]
                new = np.ones(found.shape[1], bool)
                by = found[:1] if nearest else found  # one pair a component, or each pair once
                new[1:] = (by[:, 1:] != by[:, :-1]).any(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found[:, new]], names)

    names = ["root", "apart", *_PAIR]
    met = meet.mapInArrow(compare, ", ".join(f"{c} long" for c in names))
    if nearest:
        met = met.groupBy("root").agg(F.min(F.struct("apart", *_PAIR)).alias("x")).select("x.*")
    return met.select(*_PAIR).distinct()


def jaccard_components(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    n: int = 3,
    percent: int = 90,
    least: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` (its distinct n-word
    shingles), ``component_id`` (the smallest doc_id reachable by links, its own included).

    Two documents link when ``100 * intersection >= percent * union`` of their sets. A text
    of fewer than ``n`` words has its whole sequence as its one shingle.

    A null or empty text, or one without words, has an empty set and its own id as component;
    empty sets link with nothing. Equal sets link. Rows that repeat an id are documents of
    their own. Null ids count in no minimum: a component of rows without ids has a null id.
    An empty table gives no rows. Other columns, whatever their names, are not read.
    Sets are compared as 64-bit hashes.

    With ``least`` also ``text_hash`` (xxhash64 of the text) and ``is_least``: whether this is
    the text of its component with the smallest id, of one id's texts the one that hashes
    lowest. Rows that are in no group, or have no id, are least.

    Work grows with the documents and their links; only in groups of similar documents that
    do not link does it grow with the square of the group, as bitmap comparisons in blocks.
    """
    spark = docs.sparkSession
    with scratch_scope(spark, keep=lambda purpose: purpose != "profiles"):  # the signatures
        described = materialise(_profiles(docs, doc_id, text, n, percent), "profiles")
        profiles = materialise(described.select("doc_id", "text_hash", "size", "key"), "rows")
        described = described.filter("signatures is not null")
        small = described.select("key", "size", "bitmap").dropDuplicates(["key"])
        small = materialise(small, "bitmaps")
        stars = _stars(described)
    first = profiles.filter("size > 0").groupBy("key").agg(
        F.coalesce(
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))),
            F.min(F.struct("doc_id", "text_hash")),
        ).alias("row"),
        F.min("doc_id").alias("least_id"),
    )
    first = materialise(first, "classes")
    near = materialise(_bounded(stars.select("a", "b").distinct(), small, percent), "pairs")
    best = near.groupBy("b").agg(F.min(F.struct("a", "size_a", "size_b")).alias("x"))
    once = best.select("x.a", "b", "x.size_a", "x.size_b")
    links = _links(once, docs, first, doc_id, text, n, percent)
    roots = _rooted(links)
    groups = materialise(_groups(stars), "groups")
    nearest, more = True, _apart(near, roots)
    while True:
        with scratch_scope(spark, keep=lambda purpose: purpose != "blocks"):
            met = _met_across(groups, small, roots, percent, nearest)
            more = materialise(met if more is None else more.unionByName(met).distinct(), "across")
        if not more.isEmpty():
            found = _links(more, docs, first, doc_id, text, n, percent)
            more = None if found.isEmpty() else found
        else:
            more = None
        if more is not None:
            roots = materialise(merged_components(roots, more, "key"), "roots")
        if not nearest:  # every pair that was still open has been counted
            break
        nearest, more = more is not None, None
    named = first.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = named.groupBy("root").agg(
        F.min("least_id").alias("component_id"),
        F.min(F.when(F.col("row.doc_id").isNotNull(), F.col("row"))).alias("lowest"),
    )
    component = named.join(lowest, "root").select("key", "component_id", "lowest")
    placed = profiles.join(component, "key", "left")
    alone = F.col("size") == 0
    found = [
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    ]
    if least:
        same = (F.col("doc_id") == F.col("lowest.doc_id")) & (F.col("text_hash") == F.col("lowest.text_hash"))
        found += ["text_hash", (alone | F.col("doc_id").isNull() | same).alias("is_least")]
    return placed.select(*found)
