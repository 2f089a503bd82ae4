"""Fuzzy passages that repeat across documents, by collinear chaining.

* Seeds: of every ``window`` neighbouring k-word grams of a text the one with the least hash.
  Two texts with ``k + window - 1`` words in common share one. Texts with the same words are
  one class.
* Matches: every seed of a class is matched with the class that is the pivot of the seed's
  group. Groups are reduced inside each batch before the shuffle, and never to all pairs.
* Chains: matches of two classes are chained in order of both texts, with a cost for gaps;
  the best predecessor of a match is looked up in a Fenwick tree.
* Alignment: around each chain the words of both texts are aligned in a band, many chains
  side by side, and the best local alignment is the passage. Where all matches lie on one
  diagonal and nothing else in the band is alike, the diagonal alone gives the same result.
* Exact repeats: seeds of one passage may have different pivots that each hold a part of it.
  So where a stretch that is not in a passage yet is shared, the group that gets a pivot is
  that of ``min_words`` equal words. Anchors (grams that are least in a wide window, with the
  words that follow) tell which stretches to look at, so that few texts are read again.
* What is left over: seeds that lie in no passage by then meet a class that has the same two
  seeds in the same order, as far apart as a chain must reach, and where that gives no passage
  over them every class that has. Those matches are chained and aligned like the first ones;
  until then the places of two seeds travel as lists, not as pairs of places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .sieve import sieve
from .words import mix, slices, sums, words

_U = np.uint64
#: What a word of gap costs a chain, and words around a chain that the alignment may reach.
GAP_COST = 0.25
REACH = 96
#: Classes with the same two seeds that one task compares with another class.
MEMBERS = 256
#: Half the width of the alignment's band, and its scores.
BAND = 12
MATCH, OTHER, SKIP = 1, -2, -2


def _grams(h: np.ndarray, k: int) -> np.ndarray:
    total = max(len(h) - k + 1, 0)
    out = np.zeros(total, _U)
    for j in range(k):
        out = out * _U(0x9E3779B97F4A7C15) + h[j : j + total]
    return mix(out)


def _stretches(h: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the ``length`` words from each place on, from sums over all words."""
    base = 0x9E3779B97F4A7C15
    at = np.zeros(len(h) + 1, _U)
    power = np.full(len(h), base, _U)
    np.cumprod(power, out=power)
    np.cumsum(mix(h) * power, out=at[1:])
    back = np.full(len(h) + 1, pow(base, -1, 2**64), _U)
    back[:1] = 1
    np.cumprod(back, out=back)
    return mix((at[place + length] - at[place]) * back[place])


def _anchoring(k: int, min_words: int) -> tuple[int, int]:
    """(window, length): every stretch of ``min_words`` words holds the ``length`` words from a
    gram on that is the least of ``window`` neighbours in the stretch."""
    window = max(min(min_words // 2 + 1, min_words - k + 1), 1)
    return window, min_words - window + 1


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of every ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[: len(out) - step], out[step:])
        have += step
    return out


def minimizers(
    hashes: np.ndarray, row: np.ndarray, k: int, window: int, thin: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of the grams that are least in some window of one text."""
    g = _grams(hashes, k)
    if not len(g):
        return np.zeros(0, np.int64), g
    whole = row[: len(g)] == row[k - 1 :]
    g = np.where(whole, g, _U(0xFFFFFFFFFFFFFFFF))
    width = min(window, len(g))
    low = _slide(g, width, np.minimum)
    inside = row[: len(low)] == row[width + k - 2 :]
    padded = np.zeros(len(low) + 2 * (width - 1), _U)
    padded[width - 1 : width - 1 + len(low)] = np.where(inside, low, _U(0))
    chosen = np.flatnonzero((g == _slide(padded, width, np.maximum)) & whole)
    h, r = g[chosen], row[chosen]
    if not thin:
        return chosen, h
    # of a run of one gram only the first place
    keep = np.ones(len(chosen), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return chosen[keep], h[keep]


def chain(
    pos_a: np.ndarray, pos_b: np.ndarray, k: int, gap_cost: float = GAP_COST
) -> list[list[int]]:
    """Chains of matches, best first; every match is in at most one. A chain's score is k
    for each match, less what overlaps and less ``gap_cost`` for each word between."""
    order = np.lexsort((-pos_b, pos_a))
    a, b = pos_a[order].tolist(), pos_b[order].tolist()
    ranks = {p: i + 1 for i, p in enumerate(sorted(set(b)))}
    size = len(ranks)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, back = [0.0] * len(a), [-1] * len(a)
    for i, (x, y) in enumerate(zip(a, b, strict=True)):
        best, j = (-1e18, -1)
        at = ranks[y] - 1
        while at > 0:
            if tree[at][0] > best:
                best, j = tree[at]
            at &= at - 1
        score[i] = float(k)
        if j >= 0:
            gap = max(x - a[j], y - b[j]) - k
            drift = abs((x - a[j]) - (y - b[j]))
            gain = score[j] + min(k, x - a[j], y - b[j]) - gap_cost * (max(gap, 0) + drift)
            if gain > score[i]:
                score[i], back[i] = gain, j
        entry = (score[i] + gap_cost * (x + y) / 2, i)
        at = ranks[y]
        while at <= size:
            if entry[0] > tree[at][0]:
                tree[at] = entry
            at += at & -at
    used = [False] * len(a)
    chains = []
    for i in sorted(range(len(a)), key=lambda i: (-score[i], i)):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(int(order[i]))
            i = back[i]
        if links:
            chains.append(links[::-1])
    return chains


def align(
    left: list[np.ndarray], right: list[np.ndarray], anchors: list[tuple[np.ndarray, np.ndarray]]
) -> np.ndarray:
    """(pairs, 5): start and end of the best local alignment in left and right words, and how
    many words match. The band follows the anchors; pairs are solved side by side.

    A cell takes the best of a match or mismatch, a right word left out and up to three left
    words left out, in this order where they tie. All scores are even, so a cell's candidates
    are numbers whose lowest four bits say which one it is, and one maximum chooses."""
    count = len(left)
    rows = max((len(r) for r in right), default=0)
    longest = max((len(x) for x in left), default=0)
    width = 2 * BAND + 1
    out = np.zeros((count, 5), np.int64)
    if not rows:
        return out
    # values that no word has, not the same on both sides, around every pair
    around = 2 * BAND + 1
    a = np.full((count, longest + 2 * around + 1), -1, np.int64)
    b = np.full((rows, count, 1), -2, np.int64)
    centre = np.zeros((count, rows), np.int64)
    at = np.arange(rows)
    for p, (x, y, (pa_, pb_)) in enumerate(zip(left, right, anchors, strict=True)):
        a[p, around : around + len(x)], b[: len(y), p, 0] = x, y
        middle = np.interp(at, pb_, pa_)
        middle += np.where(at < pb_[0], at - pb_[0], 0) + np.where(at > pb_[-1], at - pb_[-1], 0)
        centre[p] = np.rint(middle)
    offset = np.arange(width) - BAND
    moves = np.diff(centre, axis=1, prepend=centre[:, :1] - 1)
    bent = (moves != 1).any(axis=0)
    line = np.arange(count)[:, None]
    looked = np.clip(centre, -BAND - 1, longest + BAND) + around + line * a.shape[1]
    looked, centre = np.ascontiguousarray(looked.T), np.ascontiguousarray(centre.T)
    words_ = a.reshape(-1)
    # the state of a row: scores times 16, where the alignment began, words that match; the
    # cell that a match comes from has the same place, the one above has the next
    score = np.zeros((count, width + 1), np.int32)
    begun, hits = np.zeros((count, width + 1), np.int64), np.zeros((count, width + 1), np.int32)
    cell = line * (width + 1) + np.arange(width)
    code = np.arange(16)
    source = (code >> 2) - 3 + 1 - (code >> 1 & 1)
    best = np.zeros(count, np.int32)
    equal, unequal = np.int32(16 * MATCH + 15), np.int32(16 * OTHER + 14)
    for t in range(rows):
        if bent[t]:
            turned = np.flatnonzero(moves[:, t] != 1)
            index = moves[turned, t, None] - 1 + np.arange(width + 1)
            ok = (index >= 0) & (index < width)
            index = np.clip(index, 0, width - 1)
            for state in (score, begun, hits):
                state[turned] = np.where(ok, np.take_along_axis(state[turned], index, 1), 0)
        there = words_.take(looked[t, :, None] + offset)
        fresh = score[:, :width] == 0
        np.copyto(begun[:, :width], ((centre[t, :, None] + offset) << 32) + t, where=fresh)
        np.copyto(hits[:, :width], 0, where=fresh)
        one = np.maximum(
            score[:, :width] + np.where(there == b[t], equal, unequal),
            score[:, 1:] + np.int32(16 * SKIP + 12),
        )
        value = one.copy()
        for step in (1, 2, 3):  # words of the left text left out
            side = one[:, :-step] + np.int32(step * (16 * SKIP - 4))
            np.maximum(value[:, step:], side, out=value[:, step:])
        come = cell + source.take(value & 15)
        begun[:, :width] = begun.take(come)
        hits[:, :width] = hits.take(come) + (value & 1)
        np.maximum(value & ~15, 0, out=value)
        score[:, :width] = np.where(there >= 0, value, 0)
        score[:, width] = 0
        high = score.max(axis=1)
        better = np.flatnonzero(high > best)
        if len(better):
            best[better] = high[better]
            c = score[better].argmax(axis=1)
            first = begun[better, c]
            ends = (first >> 32, centre[t, better] + offset[c] + 1, first & 0xFFFFFFFF, t + 1, hits[better, c])
            for i, end in enumerate(ends):
                out[better, i] = end
    return out


def straight(
    left: list[np.ndarray], right: list[np.ndarray], shift: list[int]
) -> tuple[np.ndarray, np.ndarray]:
    """What ``align`` finds, without its matrix, and for which pairs that is certain. The
    matches of pair ``p`` all lie where left place = right place + ``shift[p]``.

    Certain is the best stretch of that diagonal if its mismatches are two matches or more
    apart, and neither the rest of the diagonal nor the other diagonals of the band hold
    three equal words in a row. A detour over other diagonals then scores -2 at most (every
    step aside or mismatch costs 2, every run between them brings 2), as much as the diagonal
    itself has there; beyond the ends it brings nothing for the same reason."""
    sizes = np.array([len(r) + 2 * BAND for r in right], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    # values that no word has, not the same on both sides, around every pair
    a, b = np.full(first[-1], 1 << 33, np.int64), np.full(first[-1], 1 << 34, np.int64)
    for i, x, y, d in zip(first[:-1], left, right, shift, strict=True):
        b[i + BAND : i + BAND + len(y)] = y
        low, high = max(-BAND, -d), min(len(y) + BAND, len(x) - d)
        if low < high:
            a[i + BAND + low : i + BAND + high] = x[low + d : high + d]
    aside = np.zeros(len(a), bool)
    for step in [*range(-BAND, 0), *range(1, BAND + 1)]:
        same = b[max(-step, 0) : len(b) - max(step, 0)] == a[max(step, 0) : len(a) - max(-step, 0)]
        run = same[2:] & same[1:-1] & same[:-2]
        at = max(-step, 0)
        aside[at : at + len(run)] |= run
    equal = a == b
    out, certain = np.zeros((len(right), 5), np.int64), np.zeros(len(right), bool)
    for p, (i, j) in enumerate(zip(first[:-1], first[1:], strict=True)):
        if aside[i:j].any():
            continue
        hit = equal[i + BAND : j - BAND]
        total = np.concatenate([[0], np.cumsum(np.where(hit, MATCH, OTHER))])
        least = np.minimum.accumulate(total)
        stop = int((total - least).argmax())
        if not stop:
            continue
        start = int(np.flatnonzero(total[:stop] == least[stop])[-1])
        wrong = np.flatnonzero(~hit[start:stop])
        outside = hit.copy()
        outside[start:stop] = False
        threes = outside[2:] & outside[1:-1] & outside[:-2]
        certain[p] = not threes.any() and not (np.diff(wrong) < 3).any()
        out[p] = start + shift[p], stop + shift[p], start, stop, stop - start - len(wrong)
    return out, certain


# -- Spark ---------------------------------------------------------------------------------


def _profiles(docs: DataFrame, k: int, window: int, least: int) -> DataFrame:
    """One row per text: id, text hash, key of its word sequence, number of words; seeds,
    anchors and their places are null for short texts and for copies within a batch."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, text_hash long, key long, n_words long, "
        "seeds array<long>, places array<int>, anchors array<long>, spots array<int>"
    )
    wide, length = _anchoring(k, least)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            for part in slices(batch, "text"):
                w = words(part.column(2))
                h, row, counts = w.hashes(), w.row(), w.counts()
                nth = np.arange(len(h)) - w.first[row]
                key = mix(sums(mix(h + nth.astype(_U)), w.first) + counts.astype(_U)).view(np.int64)
                old = np.zeros(w.rows, bool)
                for i, x in enumerate(key.tolist()):
                    old[i] = x in seen or counts[i] < least
                    seen.add(x)
                place, seed = minimizers(h, row, k, window)
                spot, _ = minimizers(h, row, k, wide, thin=False)
                spot = spot[spot + length <= w.first[row[spot] + 1]]
                place_fresh, spot_fresh = ~old[row[place]], ~old[row[spot]]
                place, seed, spot = place[place_fresh], seed[place_fresh], spot[spot_fresh]
                mask = pa.array(old)
                lists = []
                for at, hashed in ((place, seed), (spot, _stretches(h, spot, length))):
                    cut = pa.array(np.searchsorted(row[at], np.arange(w.rows + 1)).astype(np.int32))
                    lists += [
                        pa.ListArray.from_arrays(cut, pa.array(v), mask=mask)
                        for v in (hashed.view(np.int64), nth[at].astype(np.int32))
                    ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(key), pa.array(counts), *lists],
                    ["doc_id", "text_hash", "key", "n_words", "seeds", "places", "anchors", "spots"],
                )

    chosen = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return chosen.mapInArrow(profile, schema)


def _shared(profiles: DataFrame) -> DataFrame:
    """(seed, b, pos_b, a, pos_a): every place of a seed that several classes have, with the
    class that is the pivot of the seed's group (of its batch, if that has a smaller one) and
    its first place there."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            seed = lists.flatten().to_numpy()
            place = batch.column(2).flatten().to_numpy()
            key = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
            order = np.lexsort((place, key, seed))
            seed, key, place = seed[order], key[order], place[order]
            new = np.ones(len(seed), bool)
            new[1:] = seed[1:] != seed[:-1]
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)[group] if len(seed) else order
            inner = key[first] != key
            met = np.bincount(group, inner, minlength=1)[group] > 0
            pivots = ~inner  # the pivot's own places are all that other batches need
            for rows, is_inner in ((pivots, False), (inner, True)):
                n = int(rows.sum())
                at = first[rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seed[rows]),
                        pa.array(key[rows]),
                        pa.array(place[rows]),
                        pa.array(key[at]) if is_inner else pa.nulls(n, pa.int64()),
                        pa.array(place[at]) if is_inner else pa.nulls(n, pa.int32()),
                        pa.array(met[rows]),
                    ],
                    ["seed", "b", "pos_b", "a", "pos_a", "met"],
                )

    seeded = profiles.filter("seeds is not null").select("key", "seeds", "places")
    reduced = seeded.mapInArrow(reduce, "seed long, b long, pos_b int, a long, pos_a int, met boolean")
    group = Window.partitionBy("seed")
    ordered = group.orderBy("b", "pos_b")
    across = (
        reduced.filter("a is null")
        .withColumns({
            "a": F.first("b").over(ordered),
            "pos_a": F.first("pos_b").over(ordered),
            "met": F.max("met").over(group) | (F.min("b").over(group) < F.max("b").over(group)),
        })
        .filter("met")
    )
    return across.unionByName(reduced.filter("a is not null")).drop("met")


def _met(one: list[np.ndarray], other: list[np.ndarray], most: int = 1 << 20) -> np.ndarray:
    """(2, matches): all places of two seeds in one class with all in the other, where either
    is open, each pair of places once. ``one`` and ``other``: places of the two seeds, open."""
    step = max(most // max(len(other[0]), 1), 1)
    out = np.zeros(0, np.int64)
    for i in range(0, len(one[0]), step):
        x, y = np.nonzero(one[2][i : i + step, None] | other[2])
        places = [(a[x + i].astype(np.int64) << 32) + b[y] for a, b in zip(one[:2], other[:2], strict=True)]
        out = np.unique(np.concatenate([out, *places]))
    return np.stack([out >> 32, out & 0xFFFFFFFF])


def _chains(matches: DataFrame, k: int, least_span: int) -> DataFrame:
    """(chain, a, b, places_a, places_b): chains that span ``least_span`` words or more. A row
    of ``matches`` is one match, or all places of two seeds in both classes."""
    lists = "at_a" in matches.columns

    def of_lists(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        a, b = (c.to_numpy() for c in batch.columns[:2])
        ends = [[batch.column(c).field(n) for n in ("one", "two", "open")] for c in (2, 3)]
        at = [e[0].offsets.to_numpy() for e in ends]
        values = [[f.values.to_numpy(zero_copy_only=False) for f in e] for e in ends]
        single = (np.diff(at[0]) == 1) & (np.diff(at[1]) == 1)  # such a place is open in one of the two
        cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        for i, j in zip(cut, np.append(cut[1:], len(a)), strict=True):
            rows = np.flatnonzero(single[i:j]) + i
            yield int(a[i]), int(b[i]), np.stack([np.concatenate([v[0][o[rows]], v[1][o[rows]]]) for v, o in zip(values, at, strict=True)])
            for row in np.flatnonzero(~single[i:j]) + i:
                yield int(a[i]), int(b[i]), _met(*([f[o[row] : o[row + 1]] for f in v] for v, o in zip(values, at, strict=True)))

    def of_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        a, b, x, y = (c.to_numpy() for c in batch.columns)
        cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        for i, j in zip(cut, np.append(cut[1:], len(a)), strict=True):
            yield int(a[i]), int(b[i]), np.stack([x[i:j], y[i:j]])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
        held, name = [], None

        def whole() -> np.ndarray:
            x, y = np.concatenate(held, axis=1)
            if not lists:
                return np.stack([x, y])
            each = np.unique((x.astype(np.int64) << 32) + y)
            return np.stack([each >> 32, each & 0xFFFFFFFF])

        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, places in (of_lists if lists else of_rows)(batch):
                if (a, b) != name and held:
                    yield *name, whole()
                    held = []
                name = (a, b)
                held.append(places)
        if held:
            yield *name, whole()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def full() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out, strict=True)]
            out.clear()
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["a", "b", "places_a", "places_b"],
            )

        for a, b, places in pairs(batches):
            if places.shape[1] < 2 or np.ptp(places[1]) + k < least_span:
                continue
            for links in chain(places[0], places[1], k):
                x, y = places[0][links], places[1][links]
                if len(links) > 1 and min(x[-1] - x[0], y[-1] - y[0]) + k >= least_span:
                    out.append((a, b, x.tolist(), y.tolist()))
            if len(out) >= 2000:
                yield full()
        if out:
            yield full()

    if lists:  # few bytes for the work that they are, so no partitions are put together
        parts = int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ordered = matches.repartition(parts, "a", "b").sortWithinPartitions("a", "b")
    else:
        ordered = matches.repartition("a", "b").sortWithinPartitions("a", "b", "pos_a", "pos_b")
    found = ordered.mapInArrow(link, "a long, b long, places_a array<int>, places_b array<int>")
    return found.select(F.xxhash64("a", "b", "places_a", "places_b").alias("chain"), "*")


def _texts(keys: DataFrame, docs: DataFrame, first: DataFrame) -> DataFrame:
    """``keys`` with the text of each class."""
    wanted = materialise(
        first.join(keys, "key").select(*keys.columns, "row.doc_id", "row.text_hash"), "wanted"
    )
    source = docs.select(
        F.col("doc_id").alias("__id"), "text", F.xxhash64("text").alias("__hash")
    )
    texts = sieve(source, F.col("__hash"), wanted, "text_hash").join(
        wanted, F.col("__id").eqNullSafe(F.col("doc_id")) & (F.col("__hash") == F.col("text_hash"))
    )
    return texts.select(*keys.columns, "text")


def _passages(
    chains: DataFrame, docs: DataFrame, first: DataFrame, min_words: int, percent: int
) -> DataFrame:
    """(a, b, start_a, end_a, start_b, end_b, matched): aligned passages of two classes."""
    sides = [
        chains.select(
            F.col(end).alias("key"),
            "chain",
            F.lit(end == "b").alias("right"),
            *(F.col(c) if end == "b" else F.lit(None).cast(t).alias(c) for c, t in (
                ("a", "long"), ("b", "long"), ("places_a", "array<int>"), ("places_b", "array<int>"))),
            (F.element_at(f"places_{end}", 1) - REACH).alias("low"),
            (F.element_at(f"places_{end}", -1) + REACH).alias("high"),
        )
        for end in ("a", "b")
    ]
    asked = sides[0].unionByName(sides[1])
    texts = _texts(asked.select("key").distinct(), docs, first)
    joined = asked.join(texts, "key").select(
        "chain", "right", "a", "b", "places_a", "places_b", "low", "high", "text"
    )
    schema = (
        "chain long, right boolean, a long, b long, places_a array<int>, places_b array<int>, "
        "low int, words binary"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column(8))
                h = (w.hashes() >> _U(32)).astype(np.uint32)
                low = np.maximum(part.column(6).to_numpy(), 0)
                high = part.column(7).to_numpy()
                windows = [
                    h[i + x : min(i + y, j)].tobytes()
                    for i, j, x, y in zip(w.first[:-1], w.first[1:], low, high, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:6], pa.array(low, pa.int32()), pa.array(windows, pa.binary())],
                    ["chain", "right", "a", "b", "places_a", "places_b", "low", "words"],
                )

    windows = joined.mapInArrow(cut, schema)
    ordered = windows.repartition("chain").sortWithinPartitions("chain", "right")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left, size = [], None, 0

        def solved() -> pa.RecordBatch:
            even = [len(set((x[4][0] - x[4][1]).tolist())) == 1 for x in held]
            plain = [x for x, e in zip(held, even, strict=True) if e]
            bent = [x for x, e in zip(held, even, strict=True) if not e]
            got, certain = straight(
                [x[2] for x in plain], [x[3] for x in plain], [int(x[4][0][0] - x[4][1][0]) for x in plain]
            )
            solved_ = [([x for x, c in zip(plain, certain, strict=True) if c], got[certain])]
            bent += [x for x, c in zip(plain, certain, strict=True) if not c]
            bent.sort(key=lambda x: len(x[3]))
            for i in range(0, len(bent), 256):
                part = bent[i : i + 256]
                got = align([x[2] for x in part], [x[3] for x in part], [x[4] for x in part])
                solved_.append((part, got))
            rows = []
            for part, got in solved_:
                for (a, b, *_, low), r in zip(part, got, strict=True):
                    length = max(r[1] - r[0], r[3] - r[2])
                    if min(r[1] - r[0], r[3] - r[2]) >= min_words and 100 * r[4] >= percent * length:
                        rows.append((a, b, r[0] + low[0], r[1] + low[0], r[2] + low[1], r[3] + low[1], r[4]))
            held.clear()
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py()
                data = np.frombuffer(batch.column(7)[i].as_py(), np.uint32)
                low = batch.column(6)[i].as_py()
                if not batch.column(1)[i].as_py():
                    left = (name, data, low)
                elif left and left[0] == name:
                    x = np.array(batch.column(4)[i].as_py()) - left[2]
                    y = np.array(batch.column(5)[i].as_py()) - low
                    a, b = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                    held.append((a, b, left[1], data, (x, y), (left[2], low)))
                    left = None
                    size += len(data)
                    if size > 400_000 or len(held) >= 2048:
                        yield solved()
                        size = 0
        if held:
            yield solved()

    names = ["a", "b", "start_a", "end_a", "start_b", "end_b", "matched"]
    return ordered.mapInArrow(aligned, ", ".join(f"{c} long" for c in names))


def _sides(found: DataFrame) -> DataFrame:
    """(key, start_word, end_word, other, matched): each passage from both of its classes."""
    return found.select(
        F.col("b").alias("key"), "start_b", "end_b", F.col("a").alias("other"), "matched"
    ).unionAll(
        found.select(F.col("a"), "start_a", "end_a", F.col("b"), "matched")
    ).toDF("key", "start_word", "end_word", "other", "matched")


def _islands(spans: DataFrame, *values: Column) -> DataFrame:
    """Spans of a class that overlap become one."""
    by_start = Window.partitionBy("key").orderBy("start_word", "end_word")
    reach = F.max("end_word").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.coalesce((F.col("start_word") >= reach).cast("int"), F.lit(1)))
    return (
        opened.withColumn("island", F.sum("new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("key", "island")
        .agg(F.min("start_word").alias("start_word"), F.max("end_word").alias("end_word"), *values)
    )


def _exact(
    profiles: DataFrame, docs: DataFrame, first: DataFrame, found: DataFrame, k: int, min_words: int
) -> DataFrame:
    """(a, b, pos_a, pos_b, size): equal words of two classes, ``min_words`` or more, for every
    stretch of so many that a class shares and that ``found`` does not cover."""
    wide, _ = _anchoring(k, min_words)
    group = Window.partitionBy("anchor")
    met = profiles.filter("anchors is not null").select(
        "key", F.explode(F.arrays_zip("anchors", "spots")).alias("at")
    ).select("key", F.col("at.anchors").alias("anchor"), F.col("at.spots").alias("spot"))
    shared = materialise(
        met.withColumns({"low": F.min("key").over(group), "high": F.max("key").over(group)})
        .filter("low < high")
        .select("key", "anchor", "spot"),
        "anchors",
    )
    held = _held(found)
    covered = F.exists(
        "held",
        lambda s: (s["start_word"] <= F.greatest(F.col("spot") - (wide - 1), F.lit(0)))
        & (s["end_word"] >= F.least(F.col("spot") + min_words, F.col("n_words"))),
    )
    marked = (
        shared.join(first.select("key", "n_words"), "key")
        .join(held, "key", "left")
        .select("key", "anchor", "spot", F.coalesce(~covered, F.lit(True)).alias("open"))
    )
    # a covered stretch is wanted too where another of its group is not
    asked = (
        marked.withColumn("open", F.max("open").over(group))
        .filter("open")
        .groupBy("key")
        .agg(F.collect_set("spot").alias("spots"))
    )

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                w = words(part.column(2))
                h = w.hashes()
                lists = part.column(1)
                row = np.repeat(np.arange(w.rows), np.diff(lists.offsets.to_numpy()))
                spot = lists.flatten().to_numpy() + w.first[row]
                begin = (spot[:, None] - np.arange(wide)).ravel()
                row = np.repeat(row, wide)
                fits = (begin >= w.first[row]) & (begin + min_words <= w.first[row + 1])
                begin = np.unique(begin[fits])
                row = np.searchsorted(w.first, begin, "right") - 1
                places = (begin - w.first[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_stretches(h, begin, min_words).view(np.int64)),
                        pa.array(part.column(0).to_numpy()[row]),
                        pa.array(places),
                    ],
                    ["stretch", "key", "pos"],
                )

    found_in = _texts(asked, docs, first).mapInArrow(stretches, "stretch long, key long, pos int")
    equal = Window.partitionBy("stretch")
    place = F.struct("key", "pos")
    at = found_in.withColumns({"low": F.min(place).over(equal), "high": F.max(place).over(equal)})
    own = F.col("key") == F.col("low.key")  # the pivot meets another class where it has more places
    other = lambda c: F.when(own, F.col(f"high.{c}")).otherwise(F.col(f"low.{c}"))
    same = at.filter((F.col("low.key") < F.col("high.key")) & (~own | (F.col("pos") > F.col("low.pos")))).select(
        other("key").alias("a"), F.col("key").alias("b"), other("pos").alias("pos_a"), F.col("pos").alias("pos_b")
    )
    shift = (F.col("pos_b") - F.col("pos_a")).alias("shift")
    along = Window.partitionBy("a", "b", "shift").orderBy("pos_b")
    before = F.lag("pos_b").over(along)
    new = F.coalesce((F.col("pos_b") > before + min_words).cast("int"), F.lit(1))
    return (
        same.distinct()
        .select("*", shift)
        .withColumn("new", new)
        .withColumn("run", F.sum("new").over(along))
        .groupBy("a", "b", "shift", "run")
        .agg(
            F.min("pos_a").alias("pos_a"),
            F.min("pos_b").alias("pos_b"),
            (F.max("pos_b") - F.min("pos_b") + min_words).alias("size"),
        )
        .select("a", "b", "pos_a", "pos_b", "size")
    )


def _held(found: DataFrame) -> DataFrame:
    """(key, held): the stretches of a class that lie in passages."""
    return _islands(_sides(found)).groupBy("key").agg(
        F.collect_list(F.struct("start_word", "end_word")).alias("held")
    )


def _loose(shared: DataFrame, found: DataFrame, k: int, min_words: int) -> DataFrame:
    """(both, key, at, open, other, classes): the places of two seeds in the same order, as far
    apart as a chain must reach, that several classes have and that some class has outside of
    all passages of ``found``; ``open`` where this class has. ``other`` is the class with the
    fewest such places, for that class itself another one."""
    near, far = max(min_words // 2 - k, 1), 2 * min_words
    outside = ~F.exists(
        "held",
        lambda s: (s["start_word"] <= F.col("place")) & (s["end_word"] >= F.col("place") + k),
    )
    seeds = shared.select("seed", F.col("b").alias("key"), F.col("pos_b").alias("place")).distinct()
    placed = seeds.join(_held(found), "key", "left").select(
        "seed", "key", "place", F.coalesce(outside, F.lit(True)).alias("open")
    )
    lists = (
        placed.withColumn("wanted", F.max("open").over(Window.partitionBy("seed")))
        .filter("wanted")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("place", "seed", "open"))).alias("at"))
    )

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = batch.column(1)[row].values
                place, seed, free = (at.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                low = np.searchsorted(place, place + near)
                high = np.searchsorted(place, place + far, "right")
                count = np.maximum(high - low, 0)
                for i, j in _bounded_runs(count):
                    left = np.repeat(np.arange(i, j), count[i:j])
                    nth = np.arange(len(left)) - np.repeat(np.cumsum(count[i:j]) - count[i:j], count[i:j])
                    right = low[left] + nth
                    both = mix(mix(seed[left].view(_U)) + seed[right].view(_U))
                    order = np.argsort(both, kind="stable")
                    both, left, right = both[order], left[order], right[order]
                    cut = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
                    ends = pa.array(np.append(cut, len(both)).astype(np.int32))
                    free_ = free[left] | free[right]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(both[cut].view(np.int64)),
                            batch.column(0)[row : row + 1].take(pa.array(np.zeros(len(cut), np.int64))),
                            *(pa.ListArray.from_arrays(ends, pa.array(v)) for v in (place[left], place[right], free_)),
                            pa.array(np.logical_or.reduceat(free_, cut)),
                        ],
                        ["both", "key", "one", "two", "opens", "open"],
                    )

    kinds = "both long, key long, one array<int>, two array<int>, opens array<boolean>, open boolean"
    pairs = lists.mapInArrow(paired, kinds).select(
        "both", "key", "open", F.struct("one", "two", F.col("opens").alias("open")).alias("at")
    )
    group = Window.partitionBy("both")
    member = F.struct(F.size("at.one").alias("n"), "key", "at")
    return (
        pairs.withColumns({
            "low": F.min(member).over(group),
            "high": F.max(F.struct("key", "at")).over(group),
            "least": F.min(F.struct("key", "at")).over(group),
            "wanted": F.max("open").over(group),
            "classes": F.count(F.lit(1)).over(group),
        })
        .filter("wanted and least.key < high.key")
        .withColumn(
            "other",
            F.when(F.col("key") != F.col("low.key"), F.struct("low.key", "low.at"))
            .when(F.col("key") != F.col("high.key"), F.col("high"))
            .otherwise(F.col("least")),
        )
        .select("both", "key", "at", "open", "other", "classes")
    )


def _between(asks: DataFrame) -> DataFrame:
    """(a, b, at_a, at_b) of (key, at) and (other.key, other.at), the smaller class first, each
    once for two seeds."""
    first = F.col("key") < F.col("other.key")
    ends = [F.struct("key", "at"), F.col("other")]
    return asks.select(
        F.when(first, ends[0]).otherwise(ends[1]).alias("x"),
        F.when(first, ends[1]).otherwise(ends[0]).alias("y"),
    ).select(
        F.col("x.key").alias("a"), F.col("y.key").alias("b"), F.col("x.at").alias("at_a"), F.col("y.at").alias("at_b")
    )


def _still_open(loose: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The rows of ``loose`` with places open as of ``found``; open in groups of two classes
    no more, as these have met."""
    covered = lambda x: F.exists(
        F.coalesce("held", F.array()), lambda s: (s["start_word"] <= x) & (s["end_word"] >= x + k)
    )
    opens = F.transform(
        F.arrays_zip("at.one", "at.two", "at.open"),
        lambda p: p["open"] & ~(covered(p["one"]) & covered(p["two"])),
    )
    return (
        loose.join(_held(found), "key", "left")
        .withColumn("at", F.col("at").withField("open", opens))
        .withColumn("open", F.exists("at.open", lambda x: x) & (F.col("classes") > 2))
        .drop("held")
    )


def _all_met(loose: DataFrame) -> DataFrame:
    """(a, b, at_a, at_b): every open row of ``loose`` and every other class of its group."""
    group = Window.partitionBy("both")
    several = materialise(
        loose.withColumn("wanted", F.max("open").over(group))
        .filter("wanted")
        .withColumn("blocks", F.ceil(F.col("classes") / MEMBERS))
        .withColumn("block", F.pmod(F.xxhash64("key"), "blocks"))
        .select("both", "key", "at", "open", "blocks", "block"),
        "open",
    )
    asks = several.filter("open").select(
        "both",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.struct("key", "at").alias("other"),
    )
    met = several.join(asks, ["both", "block"]).filter(
        "key <> other.key and not (open and key > other.key)"  # two that ask meet once
    )
    return _between(met)


def _bounded_runs(count: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[int, int]]:
    """Runs of ``count`` that add up to about ``most`` at most."""
    total = np.cumsum(count)
    begin = 0
    while begin < len(count):
        before = total[begin - 1] if begin else 0
        stop = max(int(np.searchsorted(total, before + most, "right")), begin + 1)
        if total[stop - 1] > before:
            yield begin, stop
        begin = stop


def _exact_passages(
    runs: DataFrame, docs: DataFrame, first: DataFrame, k: int, min_words: int, percent: int
) -> DataFrame:
    """The runs as passages, aligned beyond their ends; those the alignment leaves, as they are."""
    ends = runs.select("a", "b", "pos_a", "pos_b").unionAll(
        runs.select("a", "b", F.col("pos_a") + F.col("size") - k, F.col("pos_b") + F.col("size") - k)
    )
    chains = materialise(_chains(ends.distinct(), k, min_words // 2), "chains")
    found = materialise(_passages(chains, docs, first, min_words, percent), "passages")
    kind = dict(found.dtypes)
    plain = runs.select(
        *(e.cast(kind[c]).alias(c) for c, e in (
            ("a", F.col("a")), ("b", F.col("b")),
            ("start_a", F.col("pos_a")), ("end_a", F.col("pos_a") + F.col("size")),
            ("start_b", F.col("pos_b")), ("end_b", F.col("pos_b") + F.col("size")),
            ("matched", F.col("size"))))
    )
    p, f = plain.alias("p"), found.alias("f")
    inside = (F.col("p.a") == F.col("f.a")) & (F.col("p.b") == F.col("f.b"))
    for end in ("a", "b"):
        inside &= F.col(f"f.start_{end}") <= F.col(f"p.start_{end}")
        inside &= F.col(f"f.end_{end}") >= F.col(f"p.end_{end}")
    return found.unionByName(p.join(f, inside, "left_anti").select(found.columns))


def repeated_passages(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    k: int = 5,
    window: int = 12,
    min_words: int = 50,
    percent: int = 80,
) -> DataFrame:
    """One row per document and passage that another document has as well.

    Columns: ``doc_id``, ``class_id`` (the smallest id with the same words), ``start_word``
    and ``end_word`` (places of lower-cased words, end exclusive), ``partner_id`` (the
    smallest class that the passage was aligned with) and ``matched`` (words equal there).
    A passage has ``min_words`` words or more in both texts, ``percent`` of which match;
    passages of a document that overlap are one. Texts with the same ``min_words`` words or
    more are copies: each has one row for its whole text, whose partner is the class, or a
    copy for the class itself; only the class carries further passages.

    Null, empty and shorter texts have no passages and give no rows. Rows without an id count
    as documents but name no class; ties go to the smaller id. Other columns are not read.

    A stretch of ``min_words`` equal words is always found, whatever other documents hold of
    it. A shared stretch of ``k + window - 1`` words is sure to share a seed; passages without
    ``min_words`` equal words are found wherever two seeds of theirs are in both texts,
    ``min_words // 2 - k`` to ``2 * min_words`` words apart, whatever others hold of them. They
    can be missed if they have more edits than one in so many words, so that there are no two
    such seeds. Work grows with texts and matches; texts in a passage that their pivot has too
    are not compared all with all. Two seeds outside of all passages meet one class of those that
    have both, and every one, in pieces of bounded size, only where that gave no passage; what
    no class shares further than those two seeds thus still costs a pair for each class.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    profiles = materialise(_profiles(chosen, k, window, min_words), "profiles")
    long_ones = profiles.filter(F.col("n_words") >= min_words)
    first = materialise(
        long_ones.groupBy("key").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("row"),
            F.min("doc_id").alias("class_id"),
            F.max("doc_id").alias("last_id"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_words").alias("n_words"),
        ),
        "classes",
    )
    shared = materialise(_shared(profiles), "seeds")
    matches = shared.filter("a <> b").select("a", "b", "pos_a", "pos_b")
    chains = materialise(_chains(matches, k, min_words // 2), "chains")
    found = materialise(_passages(chains, chosen, first, min_words, percent), "passages")
    runs = materialise(_exact(profiles, chosen, first, found, k, min_words), "runs")
    found = found.unionByName(_exact_passages(runs, chosen, first, k, min_words, percent))
    loose = materialise(_loose(shared, found, k, min_words), "loose")
    for asked in (lambda: _between(loose.filter("open")), lambda: _all_met(_still_open(loose, found, k))):
        chains = materialise(_chains(asked(), k, min_words // 2), "chains")
        late = materialise(_passages(chains, chosen, first, min_words, percent), "passages")
        found = found.unionByName(late)
    both = _sides(found)
    ids = first.select("key", "class_id")
    named = (
        both.join(ids.select(F.col("key").alias("other"), F.col("class_id").alias("partner_id")), "other")
        .groupBy("key", "start_word", "end_word")
        .agg(F.min(F.struct("partner_id", "matched")).alias("p"))
    )
    islands = _islands(named, F.min("p").alias("p"))
    out = ["doc_id", "class_id", "start_word", "end_word", "partner_id", "matched"]
    of_classes = islands.join(first, "key").select(
        F.col("row.doc_id").alias("doc_id"), "class_id", "start_word", "end_word",
        "p.partner_id", "p.matched",
    )
    copied = first.filter("copies > 1").select("key", "class_id", "last_id")
    whole = long_ones.join(copied, "key").select(
        "doc_id",
        "class_id",
        F.lit(0).cast("long").alias("start_word"),
        F.col("n_words").alias("end_word"),
        F.when(F.col("doc_id").eqNullSafe(F.col("class_id")), F.col("last_id"))
        .otherwise(F.col("class_id"))
        .alias("partner_id"),
        F.col("n_words").alias("matched"),
    )
    return of_classes.select(out).unionByName(whole.select(out))
