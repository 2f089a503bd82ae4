"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions. A decision is predicted in the context of the last 0
to DEPTH bytes; each context has a Krichevsky-Trofimov estimate from its counts, and a
context's weighted probability is the even mixture of its own block probability and the
product of its children's. The counts, the weights from the deepest contexts upwards and
the predictions from the root downwards are group-bys and joins over one table per depth.

Scoring reads whole texts where they lie. The tree is broadcast in parts of bounded size; if
there are several, the texts pass through one after the other. Token counts are broadcast
for the most frequent tokens, up to a fixed number; the others are met by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .words import slices, text_buffers, words

DEPTH = 3
#: Ends every text and stands before its first byte; no UTF-8 text has it.
END = 0xFF
#: Contexts of full depth in one part of the tree (1 KB each): more are scored part by part.
PART_CONTEXTS = 100_000
#: Tokens whose counts are broadcast (16 bytes each): the most frequent. Others are joined.
HOT_TOKENS = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GRAM, _TOKEN = 0, 1


def _bytes_in_context(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code, first): for every byte of every text and its END, the three bytes before it and
    itself as one number; ``first[r]:first[r + 1]`` are those of text ``r``."""
    data, at = text_buffers(column)
    rows = len(at) - 1
    out = np.full(len(data) + rows * (DEPTH + 1), END, np.uint32)  # DEPTH before, one after
    shift = np.repeat(np.arange(rows) * (DEPTH + 1) + DEPTH, np.diff(at))
    out[np.arange(len(data)) + shift] = _LOWER[data]
    code = out.copy()
    for k in range(1, DEPTH + 1):
        code[k:] |= out[:-k] << np.uint32(8 * k)
    real = np.ones(len(out), bool)
    begin = at[:-1] + np.arange(rows) * (DEPTH + 1)
    for k in range(DEPTH):
        real[begin + k] = False
    return code[real], at + np.arange(rows + 1)


def _tallied(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(new)
    return values[at], np.diff(np.append(at, len(values)))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], np.concatenate([c for _, c in parts])[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(n, at)


def _counts(docs: DataFrame, held_keys: int = 4_000_000) -> DataFrame:
    """(kind, key, n): counts of byte grams and of word hashes, summed inside each task first;
    a task hands on what it has when it holds ``held_keys`` keys."""

    def rows(kind: int, parts: list) -> pa.RecordBatch:
        keys, n = _summed(parts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(keys), kind, np.int32)),
                pa.array(keys.astype(np.uint64).view(np.int64)),
                pa.array(n),
            ],
            ["kind", "key", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {_GRAM: [], _TOKEN: []}
        for batch in batches:
            for part in slices(batch, "text"):
                code, _ = _bytes_in_context(part.column(0))
                for kind, values in ((_GRAM, code), (_TOKEN, words(part.column(0)).hashes())):
                    if len(values):
                        held[kind].append(_tallied(values))
                    if sum(len(k) for k, _ in held[kind]) > held_keys:
                        held[kind] = [_summed(held[kind])]
                        if len(held[kind][0][0]) > held_keys // 2:
                            yield rows(kind, held[kind])
                            held[kind] = []
        for kind, parts in held.items():
            if parts:
                yield rows(kind, parts)

    counted = docs.select("text").mapInArrow(count, "kind int, key long, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


# -- the tree ------------------------------------------------------------------------------


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: Stirling's series above 8, by recurrence below."""
    y = x + 8
    below = F.lit(0.0)
    for k in range(8):
        below = below + F.log(x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series - below


def _block(n0: str, n1: str) -> Column:
    """ln of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    a, b = F.col(n0).cast("double"), F.col(n1).cast("double")
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1) - 1.1447298858494002


def _log_sum(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def context_tree(grams: DataFrame) -> DataFrame:
    """(depth, context, node, p, q): the probabilities that the decision ``node`` (1, then the
    bits so far) is 1 and 0 when ``context`` is the deepest one of the text seen there.
    ``grams`` has key (three context bytes and the byte, nearest context last) and n."""
    bits = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(1 << j).bitwiseOR(F.shiftright(F.col("key").bitwiseAND(255), 8 - j)).alias("node"),
                    F.shiftright("key", 7 - j).bitwiseAND(1).alias("bit"),
                )
                for j in range(8)
            )
        )
    )
    level = (
        grams.select(F.shiftright("key", 8).alias("context"), "n", bits.alias("d"))
        .groupBy("context", "d.node")
        .agg(
            F.sum(F.when(F.col("d.bit") == 0, F.col("n")).otherwise(0)).alias("n0"),
            F.sum(F.when(F.col("d.bit") == 1, F.col("n")).otherwise(0)).alias("n1"),
        )
        .withColumn("weighted", _block("n0", "n1"))
    )
    levels = [materialise(level, "contexts")]
    for depth in range(DEPTH - 1, -1, -1):
        parent = F.col("context").bitwiseAND((1 << (8 * depth)) - 1)
        level = (
            levels[0]
            .groupBy(parent.alias("context"), "node")
            .agg(
                F.sum("n0").alias("n0"),
                F.sum("n1").alias("n1"),
                F.sum("weighted").alias("below"),
            )
            .withColumn("own", _block("n0", "n1"))
            .withColumn("weighted", _log_sum(F.col("own"), F.col("below")) - 0.6931471805599453)
            .withColumn("share", 1 / (1 + F.exp(F.col("below") - F.col("own"))))
            .withColumn("lower", 1 / (1 + F.exp(F.col("own") - F.col("below"))))
        )
        levels.insert(0, materialise(level, "contexts"))
    one, zero = ((F.col(c) + 0.5) / (F.col("n0") + F.col("n1") + 1) for c in ("n1", "n0"))
    done, above = None, None
    for depth, level in enumerate(levels):
        if above is None:
            level = level.withColumns({"sum": F.lit(0.0), "sum0": F.lit(0.0), "rest": F.lit(1.0)})
        else:
            parent = F.col("context").bitwiseAND((1 << (8 * (depth - 1))) - 1)
            up = above.select(F.col("context").alias("up"), F.col("node").alias("up_node"), "sum", "sum0", "rest")
            level = level.join(up, (parent == F.col("up")) & (F.col("node") == F.col("up_node")))
        last = depth == DEPTH
        share = F.lit(1.0) if last else F.col("share")
        lower = F.lit(0.0) if last else F.col("lower")
        level = level.select(
            "context",
            "node",
            (F.col("sum") + F.col("rest") * share * one).alias("sum"),
            # the same for a bit that is 0: 1 - sum would lose what is close to 1
            (F.col("sum0") + F.col("rest") * share * zero).alias("sum0"),
            (F.col("rest") * lower).alias("rest"),
        )
        # a decision not seen any deeper is even there
        p, q = (F.col(c) + F.col("rest") * 0.5 for c in ("sum", "sum0"))
        rows = level.select(F.lit(depth).alias("depth"), "context", "node", p.alias("p"), q.alias("q"))
        done = rows if done is None else done.unionByName(rows)
        above = level
    return materialise(done, "tree")


@dataclass(frozen=True)
class Part:
    """What one pass over the texts needs: log10 probabilities of all bytes in the contexts
    whose last two bytes lie in [low, high), and in the first part those of hot tokens."""

    low: int
    high: int
    table: np.ndarray  # (contexts, 256) float32
    of_pair: np.ndarray  # last two bytes -> row, when the third is new
    block: np.ndarray  # last two bytes -> block of 256 rows in of_three, or -1
    of_three: np.ndarray
    tokens: np.ndarray  # sorted hashes
    token_log: np.ndarray


def _byte_logs(bits: np.ndarray) -> np.ndarray:
    """(contexts, 256) log10 probabilities of bytes from those of decisions' zeros and ones,
    (contexts, 256, 2) in double: finished logs alone are rounded."""
    out = np.empty((len(bits), 256), np.float32)
    for begin in range(0, len(bits), 4096):
        some = np.log10(bits[begin : begin + 4096])
        logs = np.zeros((len(some), 512))
        for node in range(1, 256):
            logs[:, 2 * node] = logs[:, node] + some[:, node, 0]
            logs[:, 2 * node + 1] = logs[:, node] + some[:, node, 1]
        out[begin : begin + 4096] = logs[:, 256:]
    return out


def _tables(tree: DataFrame, low: int, high: int) -> tuple[np.ndarray, ...]:
    pair = F.col("context").bitwiseAND(0xFFFF)
    rows = tree.filter((F.col("depth") < 2) | ((pair >= low) & (pair < high))).select(
        F.col("depth").cast("tinyint"), F.col("context").cast("int"), F.col("node").cast("short"), "p", "q"
    )
    rows = rows.toArrow()
    depth, context, node, p, q = (rows.column(c).to_numpy() for c in ("depth", "context", "node", "p", "q"))
    del rows
    p = np.stack([q, p], axis=1)
    root = np.full((1, 256, 2), 0.5)
    root[0, node[depth == 0]] = p[depth == 0]
    # by depth: the contexts seen, their decisions' probabilities, their rows in the table
    names, above, rows_of = {0: np.zeros(1, np.int64)}, root, {}
    tables, used = [_byte_logs(root)], 1
    for d in range(1, DEPTH + 1):
        seen = depth == d
        name, place = np.unique(context[seen].astype(np.int64), return_inverse=True)
        up = name & ((1 << (8 * (d - 1))) - 1)
        own = above[np.searchsorted(names[d - 1], up)] if len(name) else root[:0]
        own[place, node[seen]] = p[seen]  # what is not seen here is as without the last byte
        names[d], above = name, own
        rows_of[d] = used + np.arange(len(name))
        used += len(name)
        tables.append(_byte_logs(own))
    every = np.arange(1 << 16)
    of_pair = np.zeros(1 << 16, np.int32)
    for d in (1, 2):
        name = names[d]
        if len(name):
            got = every & ((1 << (8 * d)) - 1)
            at = np.minimum(np.searchsorted(name, got), len(name) - 1)
            of_pair = np.where(name[at] == got, rows_of[d][at], of_pair).astype(np.int32)
    pairs = np.unique(names[3] & 0xFFFF)
    block = np.full(1 << 16, -1, np.int32)
    block[pairs] = np.arange(len(pairs))
    of_three = np.repeat(of_pair[pairs], 256)
    of_three[block[names[3] & 0xFFFF].astype(np.int64) * 256 + (names[3] >> 16)] = rows_of[3]
    return np.concatenate(tables), of_pair, block, of_three


def _pair_ranges(tree: DataFrame, limit: int) -> list[tuple[int, int]]:
    """Ranges of the last two bytes with at most ``limit`` full contexts in each, or one pair."""
    pair = F.col("context").bitwiseAND(0xFFFF).alias("pair")
    full = tree.filter(F.col("depth") == DEPTH).select("context", pair).distinct()
    counts = {r["pair"]: r["count"] for r in full.groupBy("pair").count().collect()}
    ranges, low, held = [], 0, 0
    for p in sorted(counts):
        if held and held + counts[p] > limit:
            ranges.append((low, p))
            low, held = p, 0
        held += counts[p]
    return [*ranges, (low, 1 << 16)]


def context_tree_scores(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    part_contexts: int = PART_CONTEXTS,
    hot_tokens: int = HOT_TOKENS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out`` (crc32 of the id as text is
    divisible by 10: not learned from), ``n_tokens`` (words and one end), ``n_known`` (those
    among the training tokens), ``train_tokens``, ``base_score`` (log10 probability by smoothed
    token counts), ``score`` (log10 probability of the lower-cased text and its end by the
    tree) and ``bits_per_byte`` (its code length per byte, the end counted as a byte).

    A null text is empty: one token, its end. A row without an id is held out. Repeated rows
    are learned and scored as often as they come. Where nothing is learned every byte has
    probability 1/256 and every token a base score of 0. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    name = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0))
    chosen = docs.select(
        F.col(doc_id).alias("doc_id"),
        (name % 10 == 0).alias("held_out"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    train = chosen.filter(~F.col("held_out"))
    counts = materialise(_counts(train), "counts")
    tokens = counts.filter(F.col("kind") == _TOKEN)
    distinct, total = tokens.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # a text's end byte follows its last byte, so ends are counted by the grams
    ends = (
        counts.filter((F.col("kind") == _GRAM) & (F.col("key").bitwiseAND(255) == END))
        .agg(F.coalesce(F.sum("n"), F.lit(0)))
        .first()[0]
    )
    distinct, total = distinct + (ends > 0), total + ends
    unknown, end_log = np.log10(0.1), float(np.log10(ends + 0.1))
    below = float(np.log10(total + 0.1 * (distinct + 1)))
    tree = context_tree(counts.filter(F.col("kind") == _GRAM))
    ranges = _pair_ranges(tree, part_contexts)
    least = _hot_count(tokens, hot_tokens)
    scored = chosen.select(
        "*",
        *(F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known", "n_bytes")),
        *(F.lit(0.0).alias(c) for c in ("base_score", "score")),
        F.lit(None).cast("array<long>").alias("rare"),
        F.lit(None).cast("array<int>").alias("times"),
    )
    schema = scored.schema
    for k, (low, high) in enumerate(ranges):
        keys, logs = np.zeros(0, np.uint64), np.zeros(0)
        if k == 0:
            hot = tokens.filter(F.col("n") >= least).select("key", "n").toArrow()
            keys = hot.column("key").to_numpy().view(np.uint64)
            order = np.argsort(keys)
            keys, logs = keys[order], np.log10(hot.column("n").to_numpy()[order] + 0.1)
        part = spark.sparkContext.broadcast(Part(low, high, *_tables(tree, low, high), keys, logs))
        rest = (k == 0, least > 1, end_log, unknown, ends > 0, below)
        scored = scored.mapInArrow(_pass(part, *rest), schema)
    scored = scored.drop("text")
    if least > 1:
        scored = _with_rare(scored, tokens.filter(F.col("n") < least), float(unknown))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        (-F.col("score") / float(np.log10(2)) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def _hot_count(tokens: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` tokens are as frequent."""
    size = F.floor(F.log2("n")).cast("int")
    sizes = {r["size"]: r["count"] for r in tokens.groupBy(size.alias("size")).count().collect()}
    held = 0
    for s in range(max(sizes, default=0), -1, -1):
        held += sizes.get(s, 0)
        if held > limit:
            return 1 << (s + 1)
    return 1


def _with_rare(scored: DataFrame, counts: DataFrame, unknown: float) -> DataFrame:
    """Adds what tokens that were not broadcast gain over unknown ones. No such token is
    frequent, so no key of the join is."""
    rows = scored.withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "scored")  # from here on the row numbers stay as they are
    met = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("key"), F.col("r.times").alias("times")
    )
    gained = (
        met.join(counts.select("key", "n"), "key")
        .groupBy("row")
        .agg(
            F.sum("times").alias("more_known"),
            F.sum(F.col("times") * (F.log10(F.col("n") + 0.1) - unknown)).alias("more_score"),
        )
    )
    return rows.drop("rare", "times").join(gained, "row", "left").select(
        *(c for c in rows.columns if c not in ("rare", "times", "n_known", "base_score")),
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("more_score", F.lit(0.0))).alias("base_score"),
    )


def _pass(part, opens: bool, lists: bool, end_log: float, unknown: float, end_known: bool, below: float):
    """Adds one part's logs to the scores of every text; the first pass adds what needs none."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = part.value
        for whole in batches:
            for batch in slices(whole, "text"):
                column = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
                code, first = _bytes_in_context(column("text"))
                pair = ((code >> np.uint32(8)) & np.uint32(0xFFFF)).astype(np.int64)
                here = slice(None)
                if (m.low, m.high) != (0, 1 << 16):
                    here = np.flatnonzero((pair >= m.low) & (pair < m.high))
                pair, codes = pair[here], code[here]
                row = m.of_pair[pair]
                block = m.block[pair]
                deep = block >= 0
                third = (codes[deep] >> np.uint32(24)).astype(np.int64)
                row[deep] = m.of_three[block[deep].astype(np.int64) * 256 + third]
                logs = np.zeros(len(code))
                logs[here] = m.table[row, codes & np.uint32(255)]
                # each text by itself; none is empty, as every text has its end
                score = np.add.reduceat(logs, first[:-1]) if len(logs) else logs
                if not opens:
                    held = [column(c) for c in batch.schema.names]
                    at = batch.schema.get_field_index("score")
                    held[at] = pa.array(held[at].to_numpy() + score)
                    yield pa.RecordBatch.from_arrays(held, schema=batch.schema)
                    continue
                w = words(column("text"))
                value, place = np.unique(w.hashes(), return_inverse=True)
                at = np.searchsorted(m.tokens, value)
                known = np.zeros(len(value), bool)
                inside = at < len(m.tokens)
                known[inside] = m.tokens[at[inside]] == value[inside]
                gain = np.zeros(len(value))
                gain[known] = m.token_log[at[known]] - unknown
                row = w.row()
                base = np.bincount(row, gain[place], minlength=w.rows)
                base += w.counts() * unknown + end_log - (w.counts() + 1) * below
                n_known = np.bincount(row, known[place], minlength=w.rows).astype(np.int64)
                n_known += int(end_known)
                rare, times = column("rare"), column("times")
                if lists:
                    other = ~known[place]
                    pairs, n = np.unique(row[other] * len(value) + place[other], return_counts=True)
                    size = max(len(value), 1)
                    cut = pa.array(
                        np.searchsorted(pairs // size, np.arange(w.rows + 1)).astype(np.int32)
                    )
                    rare = pa.ListArray.from_arrays(cut, pa.array(value[pairs % size].view(np.int64)))
                    times = pa.ListArray.from_arrays(cut, pa.array(n.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [
                        column("doc_id"),
                        column("held_out"),
                        column("text"),
                        pa.array(w.counts() + 1),
                        pa.array(n_known),
                        pa.array(np.diff(first)),
                        pa.array(base),
                        pa.array(score),
                        rare,
                        times,
                    ],
                    batch.schema.names,
                )

    return add
