"""The trie of conversation prefixes, shared out over shards.

Every prefix has a 128-bit digest: two sums of position-salted turn digests, so a conversation
can be cut anywhere and its parts digested apart. Conversations are cut into bands of turns
and the bands dealt to shards. A shard enumerates its distinct prefixes, gives each a slot by
a minimal perfect hash whose table holds the digests to verify it, scatters counts into flat
arrays and adds them up through the array of parent slots, deepest first. What shards hold of
the same prefix is merged by an aggregate; a second pass does the same for subtree sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_dimension
from ..operators.ordering import running_total
from ..session import materialise, scratch_scope
from .words import mix

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
#: Turns of one conversation in one shard, and rows a shard has on average.
BAND, SHARD_ROWS = 1024, 200_000
#: Ids of one node's ends that are joined into one text before they are hashed.
CHUNK = 16_384


class Slots:
    """Minimal perfect hash of distinct 128-bit keys: a key has the slot of its bit in the
    first level where no other key falls on the same place. The keys stand in their slots, so
    a key that isn't in the table is told from those that are."""

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.k1, self.k2 = np.empty_like(k1), np.empty_like(k2)
        left, used = np.arange(len(k1)), 0
        while len(left):
            size = 2 * len(left) + 1
            at = self._place(k1[left], k2[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            slot = np.full(size, -1)
            taken = np.sort(at[alone])
            slot[taken] = used + np.arange(len(taken))
            mine = slot[at[alone]]
            self.k1[mine], self.k2[mine] = k1[left[alone]], k2[left[alone]]
            self.levels.append(slot)
            used += len(taken)
            left = left[~alone]

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(k1 ^ mix(k2 + _U(level + 1))) % _U(size)).astype(np.int64)

    def find(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 for one that is not in the table."""
        out = np.full(len(k1), -1)
        open_ = np.arange(len(k1))
        for level, slot in enumerate(self.levels):
            got = slot[self._place(k1[open_], k2[open_], level, len(slot))]
            hit = got >= 0
            out[open_[hit]] = got[hit]
            open_ = open_[~hit]
        out[open_] = -1
        known = out >= 0
        known[known] = (self.k1[out[known]] == k1[known]) & (self.k2[out[known]] == k2[known])
        return np.where(known, out, -1)


def _upwards(depth: np.ndarray, parent: np.ndarray, band: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(slots, their parents' slots) of one depth after the other, deepest first. The top
    row of a band hands nothing on: what lies below it has been counted at the seam."""
    moving = np.flatnonzero((parent >= 0) & (depth % band != 0))
    moving = moving[np.argsort(-depth[moving], kind="stable")]
    cuts = np.flatnonzero(np.diff(depth[moving])) + 1
    for run in np.split(moving, cuts):
        yield run, parent[run]


def _salted(a: np.ndarray, b: np.ndarray, depth: np.ndarray, salt: int):
    """What a turn at a depth adds to the two sums; the root adds nothing."""
    place = mix(depth.astype(_U) * _STEP + _U(salt))
    live = (depth > 0).astype(_U)
    return mix(a.view(_U) + place) * live, mix(b.view(_U) ^ mix(place)) * live


def _digest(s1: np.ndarray, s2: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = depth.astype(_U)
    return mix(s1 + d * _STEP), mix(s2 ^ mix(d + _STEP))


_NODE = (
    "kind string, shard long, conv long, depth long, k1 long, k2 long, pk1 long, pk2 long, "
    "a long, b long, bytes long, n long, slot long, parent long, clash boolean"
)
_NAMES = [f.split()[0] for f in _NODE.split(", ")]


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in table.column_names}


def shard_nodes(band: int, salt: int) -> Callable[[pa.Table], pa.Table]:
    """Rows of a shard to its nodes (kind node; seen for the parent of a band's first turn),
    to where conversations end (end) and where they go on in the next band (seam)."""

    def run(table: pa.Table) -> pa.Table:
        c = _columns(table)
        order = np.lexsort((c["depth"], c["conv"]))
        c = {name: values[order] for name, values in c.items()}
        conv, depth, shard = c["conv"], c["depth"], int(c["shard"][0])
        new = np.ones(len(conv), bool)
        new[1:] = (conv[1:] != conv[:-1]) | (depth[1:] // band != depth[:-1] // band)
        m1, m2 = _salted(c["a"], c["b"], depth, salt)
        s1, s2 = np.cumsum(m1, dtype=_U), np.cumsum(m2, dtype=_U)
        first = np.flatnonzero(new)
        piece = np.cumsum(new) - 1
        s1 += (c["p1"].view(_U)[first] - (s1 - m1)[first])[piece]
        s2 += (c["p2"].view(_U)[first] - (s2 - m2)[first])[piece]
        k1, k2 = _digest(s1, s2, depth)
        up = np.maximum(depth - 1, 0)
        pk1, pk2 = _digest(s1 - m1, s2 - m2, up)
        pk1[depth == 0] = pk2[depth == 0] = 0

        seen = first[depth[first] > 0]
        all1, all2 = np.concatenate([k1, pk1[seen]]), np.concatenate([k2, pk2[seen]])
        sort = np.lexsort((all2, all1))
        d1, d2 = all1[sort], all2[sort]
        distinct = np.ones(len(d1), bool)
        distinct[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
        slots = Slots(d1[distinct], d2[distinct])
        size = len(slots.k1)
        slot = slots.find(k1, k2)

        row = np.full(size, -1)
        row[slot[::-1]] = np.arange(len(slot))[::-1]
        real = row >= 0
        at = row[real]
        node = {name: np.zeros(size, np.int64) for name in ("depth", "pk1", "pk2", "a", "b", "bytes")}
        mine = {"depth": depth, "pk1": pk1.view(np.int64), "pk2": pk2.view(np.int64)}
        mine |= {name: c[name] for name in ("a", "b", "bytes")}
        clash = np.zeros(size, bool)
        for name, values in mine.items():
            node[name][real] = values[at]
            clash[slot[values != node[name][slot]]] = True
        parent = np.full(size, -1)
        parent[real] = np.where(depth[at] > 0, slots.find(pk1[at], pk2[at]), -1)

        bottom = np.append(new[1:], True)
        count = np.bincount(slot[bottom], minlength=size).astype(np.int64)
        least = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(least, slot[bottom], conv[bottom])
        for run_, above in _upwards(np.where(real, node["depth"], 0), parent, band):
            np.add.at(count, above, count[run_])
            np.minimum.at(least, above, least[run_])

        nodes = {"kind": np.where(real, "node", "seen"), "conv": least, **node, "n": count}
        nodes |= {"k1": slots.k1.view(np.int64), "k2": slots.k2.view(np.int64), "clash": clash}
        nodes |= {"slot": np.arange(size), "parent": parent}
        stop = np.flatnonzero(bottom)
        zero = np.zeros(len(stop), np.int64)
        ends = {"kind": np.where(depth[stop] == c["length"][stop], "end", "seam")}
        ends |= {"conv": conv[stop], "depth": depth[stop], "clash": np.zeros(len(stop), bool)}
        ends |= {"k1": k1[stop].view(np.int64), "k2": k2[stop].view(np.int64)}
        out = {}
        for name in _NAMES:
            if name == "shard":
                out[name] = pa.array(np.full(size + len(stop), shard))
            else:
                out[name] = pa.array(np.concatenate([nodes[name], ends.get(name, zero)]))
        return pa.table(out)

    return run


_SUBTREE = (
    "k1 long, k2 long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long"
)


def shard_subtrees(band: int) -> Callable[[pa.Table], pa.Table]:
    """The shard's part of every node's subtree sums: a node's own values are scattered in the
    shard of its smallest member, which holds all of its ancestors in the band."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        real = table.column("real").to_numpy(zero_copy_only=False)
        c = _columns(table.drop_columns(["real"]))
        own = real & (c["conv"] == c["conv_id"])
        saved = c["seam_saved"] + np.where(own, (c["n_convs"] - 1) * c["bytes"], 0)
        leaves = c["seam_leaves"] + np.where(own & (c["n_children"] == 0), 1, 0)
        for run_, above in _upwards(np.where(real, c["depth"], 0), c["parent"], band):
            np.add.at(saved, above, saved[run_])
            np.add.at(leaves, above, leaves[run_])
        top = c["parent"] < 0
        parent = pa.array(c["conv_id"][c["parent"]], mask=top)
        out = {n: pa.array(c[n]) for n in ("k1", "k2", "conv_id", "depth", "n_convs", "n_children")}
        out |= {"parent_conv_id": parent, "n_leaves": pa.array(leaves)}
        out |= {"saved_tokens": pa.array(saved)}
        names = [f.split()[0] for f in _SUBTREE.split(", ")]
        return pa.table({n: out[n] for n in names}).filter(pa.array(real))

    return run


def turn_digests(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, rank (1, 2, ... over all turns in order of conversation, then turn, null first,
    then role and digest), a, b (digests of role and text) and bytes. Ranks are taken in
    pieces of the key range, so a conversation of any length is spread."""
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.struct(F.col(turn).alias("turn"), who.alias("role"), digest.alias("digest")).alias("said"),
        F.octet_length(said).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
        F.lit(1).alias("one"),
    )
    turns = materialise(turns, "turns")
    ranked = running_total(
        turns.withColumn("place", F.struct("conv", "said", "row")), "place", "one"
    )
    return ranked.select(
        "conv",
        F.col("upto").alias("rank"),
        F.xxhash64("said.digest").alias("a"),
        F.xxhash64("said.digest", F.lit("b")).alias("b"),
        "bytes",
    )


def crc_head(conv: Column) -> Column:
    """How many turns a conversation takes from its base: 0 to 8."""
    return F.pmod(F.crc32(conv.cast("string")), F.lit(9))


def rebuilt_turns(
    turns: DataFrame, group: int = 5, head: Callable[[Column], Column] = crc_head, most: int = 8
) -> tuple[DataFrame, DataFrame]:
    """(turns with conv, depth, length, a, b, bytes; conversations with conv, length).

    Conversation c becomes the first ``head(c)`` turns (at most ``most``) of the conversation
    c - c mod ``group`` (all if it has fewer, none if there is none), then its own turns after
    its first ``head(c)``. ``turns`` are those of ``turn_digests``."""
    turns = materialise(turns, "ranked")
    own = turns.groupBy("conv").agg(
        (F.min("rank") - 1).alias("start"), F.count(F.lit(1)).alias("n")
    )
    own = materialise(own, "conversations")
    base = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    take = F.least("head", F.coalesce("base_n", F.lit(0)))
    convs = (
        own.withColumns(
            {"head": head(F.col("conv")), "base": F.col("conv") - F.pmod("conv", F.lit(group))}
        )
        .join(base, "base", "left")
        .withColumn("take", take)
        .withColumn("length", F.col("take") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
        .select("conv", "start", "head", "take", "length")
    )
    convs = materialise(convs, "rebuilt")
    placed = join_dimension(turns, convs, "conv", counts=own.select("conv", "n")).withColumn(
        "pos", F.col("rank") - F.col("start")
    )
    told = ["a", "b", "bytes"]
    after = placed.filter(F.col("pos") > F.col("head")).select(
        "conv", (F.col("pos") - F.col("head") + F.col("take")).alias("depth"), "length", *told
    )
    members = F.sequence(F.col("conv"), F.col("conv") + (group - 1))
    before = (
        placed.filter((F.col("pos") <= most) & (F.pmod("conv", F.lit(group)) == 0))
        .select(F.explode(members).alias("conv"), F.col("pos").alias("depth"), *told)
        .filter(F.col("depth") <= head(F.col("conv")))
        .join(convs.select("conv", "length"), "conv")
        .select("conv", "depth", "length", *told)
    )
    return after.unionByName(before), convs.select("conv", "length")


def _carried(rows: DataFrame, band: int, salt: int) -> DataFrame:
    """Adds ``p1`` and ``p2``: the sums of all turns before the band. Only conversations with
    more than one band have any, and per conversation only one row a band is gathered."""
    rows = rows.withColumn("band", F.floor(F.col("depth") / band))

    def band_sums(table: pa.Table) -> pa.Table:
        c = _columns(table)
        m1, m2 = _salted(c["a"], c["b"], c["depth"], salt)
        sums = (m.sum(dtype=_U).reshape(1).view(np.int64) for m in (m1, m2))
        keys = (c[name][:1] for name in ("conv", "band"))
        return pa.table([pa.array(x) for x in (*keys, *sums)], ["conv", "band", "p1", "p2"])

    def before(table: pa.Table) -> pa.Table:
        c = _columns(table.sort_by("band"))
        for name in ("p1", "p2"):
            sums = c[name].view(_U)
            c[name] = (np.cumsum(sums, dtype=_U) - sums).view(np.int64)
        return pa.table({name: pa.array(c[name]) for name in ("conv", "band", "p1", "p2")})

    schema = "conv long, band long, p1 long, p2 long"
    long = rows.filter(F.col("length") >= band)
    sums = long.groupBy("conv", "band").applyInArrow(band_sums, schema)
    sums = sums.groupBy("conv").applyInArrow(before, schema)
    zero = F.lit(0).cast("long")
    return rows.filter(F.col("length") < band).withColumns({"p1": zero, "p2": zero}).unionByName(
        long.join(sums, ["conv", "band"])
    )


def _ends_sha256(ends: DataFrame) -> DataFrame:
    """k1, k2 and the SHA-256 of the ascending, comma-joined ids of the conversations that
    end there. Ids are joined in chunks first; then a task streams over the chunks."""
    chunks = (
        ends.groupBy("k1", "k2", F.floor(F.col("conv") / CHUNK).alias("chunk"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))
        .repartition("k1", "k2")
        .sortWithinPartitions("k1", "k2", "chunk")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            rows = zip(*(batch.column(n).to_pylist() for n in ("k1", "k2", "ids")), strict=True)
            for k1, k2, ids in rows:
                if (k1, k2) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    done.append((*key, state.hexdigest()))
                key, state = (k1, k2), hashlib.sha256(ids.encode())
            yield _hashed(done)
        if key:
            yield _hashed([(*key, state.hexdigest())])

    return chunks.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def _hashed(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = [("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())]
    arrays = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in kinds])


def _below_seams(seams: DataFrame, nodes: DataFrame, band: int) -> DataFrame:
    """Per shard and node: what conversations that go on in the next band own below it."""
    where = ["conv", "band"]
    in_band = F.floor(F.col("depth") / band).alias("band")
    owned = nodes.filter(F.col("depth") >= band).select(
        F.col("conv_id").alias("conv"), in_band, F.col("saved").alias("s"), F.col("leaf").alias("l")
    )
    zero = F.lit(0).cast("long")
    marks = seams.select("conv", in_band, zero.alias("s"), zero.alias("l"))
    sums = owned.unionByName(marks).groupBy(where).agg(F.sum("s").alias("s"), F.sum("l").alias("l"))
    deeper = Window.partitionBy("conv").orderBy(F.desc("band")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = sums.select(
        *where, F.sum("s").over(deeper).alias("seam_saved"), F.sum("l").over(deeper).alias("seam_leaves")
    )
    return (
        seams.select("shard", "k1", "k2", "conv", in_band)
        .join(sums, where)
        .groupBy("shard", "k1", "k2")
        .agg(F.sum("seam_saved").alias("seam_saved"), F.sum("seam_leaves").alias("seam_leaves"))
    )


def trie_nodes(
    rows: DataFrame, convs: DataFrame, *, band: int = BAND, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """The nodes of the trie over ``rows`` (conv, depth from 1 on without gaps, length, a, b,
    bytes) of the conversations ``convs`` (conv, length; those of length 0 as well)."""
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), "length", *(zero.alias(c) for c in ("a", "b", "bytes")))
    rows = materialise(rows.unionByName(roots), "prefixes")
    shards = rows.count() // shard_rows + 1
    salt = 0
    while True:
        sharded = _carried(rows, band, salt).withColumn(
            "shard", F.pmod(F.xxhash64("conv", "band"), F.lit(shards))
        )
        parts = sharded.groupBy("shard").applyInArrow(shard_nodes(band, salt), _NODE)
        parts = materialise(parts, "shards")
        same = [F.min(c) != F.max(c) for c in ("depth", "pk1", "pk2", "a", "b", "bytes")]
        merged = (
            parts.filter("kind = 'node'")
            .groupBy("k1", "k2")
            .agg(
                F.min("conv").alias("conv_id"),
                *(F.min(c).alias(c) for c in ("depth", "pk1", "pk2", "bytes")),
                F.sum("n").alias("n_convs"),
                F.max(F.col("clash")).alias("clash"),
                F.greatest(*(s for s in same)).alias("differ"),
            )
        )
        merged = materialise(merged, "merged")
        if merged.filter("clash or differ").isEmpty():
            break
        salt += 1  # two prefixes have one digest: digest them anew

    children = (
        merged.filter("depth > 0")
        .groupBy(F.col("pk1").alias("k1"), F.col("pk2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = merged.join(children, ["k1", "k2"], "left").select(
        "k1", "k2", "conv_id", "depth", "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        F.col("n_children").isNull().cast("long").alias("leaf"),
    )
    nodes = materialise(nodes, "nodes")
    below = _below_seams(parts.filter("kind = 'seam'"), nodes, band)
    placed = (
        parts.filter("kind in ('node', 'seen')")
        .select("shard", "slot", "parent", "conv", "k1", "k2", "bytes", (F.col("kind") == "node").alias("real"))
        .join(nodes.drop("saved", "leaf"), ["k1", "k2"])
        .join(below, ["shard", "k1", "k2"], "left")
        .na.fill(0, ["seam_saved", "seam_leaves"])
    )
    summed = placed.groupBy("shard").applyInArrow(shard_subtrees(band), _SUBTREE)
    once = [c for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children")]
    total = summed.groupBy("k1", "k2").agg(
        *(F.min(c).alias(c) for c in once),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
    )
    ends = _ends_sha256(parts.filter("kind = 'end'"))
    nothing = hashlib.sha256(b"").hexdigest()
    return total.join(ends, ["k1", "k2"], "left").select(
        *once, "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")
    )


def prefix_trie(
    conversations: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    band: int = BAND,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see ``rebuilt_turns``): per
    distinct sequence of their first turns, from the root (depth 0) on.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes in the subtree, the
    node included), ``saved_tokens`` (over the subtree, a node's members less one times the
    UTF-8 bytes of its last text) and ``ends_sha256`` (SHA-256 of the comma-joined, ascending
    ids of members that end there).

    A null role or text is empty; rows without a conversation id are left out. Turns go by
    their number, null first; several with one number by role, then by digest, and each
    counts. Conversations without turns are members of the root alone. An empty table has no
    nodes. Other columns are not read. Texts are digested where they are read and not kept.

    Bounds: a shard has about ``shard_rows`` turns and of one conversation at most ``band``;
    a frequent prefix is one row a shard before it is merged.
    """
    with scratch_scope(conversations.sparkSession, keep=lambda purpose: purpose == "trie"):
        turns = turn_digests(conversations, conv_id, turn, role, text)
        rows, convs = rebuilt_turns(turns)
        nodes = trie_nodes(rows, convs, band=band, shard_rows=shard_rows)
        return materialise(nodes, "trie")
