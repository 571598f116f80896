"""Prefix statistics of conversations through double-array tries.

A conversation is a path of turns; equal paths are counted once. Distinct
paths are range-sorted, so a shard (a run of neighbouring paths) holds whole
subtrees, and only the nodes on its first and last path can occur in another
shard. Each shard packs its paths into BASE and CHECK arrays over dense turn
ids, walks them for its nodes, and finishes every node that is its own; the
few border nodes are merged over all shards.

A node's identity is the sum of one 128-bit hash for each (depth, turn) on its
path. Paths longer than ``levels`` turns are cut into bands; the node at a cut
is the top of the tries of the band below.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage

#: Turns of a path that one trie holds, and paths of one shard.
LEVELS, SHARD_PATHS = 256, 4096
#: Conversation ids of one row while the ids that end at a node are joined.
ENDS = 1 << 14
_TURN = 24  # bytes of a turn in a path: 16 of its digest, 8 of its code points
_LANES = 4
_MASK = (1 << 32) - 1
_KEY = ["depth", "a", "b"]
_NODE = "struct<depth:long,a:long,b:long>"


# -- double arrays -------------------------------------------------------------

class DoubleArray:
    """States in BASE and CHECK: the child of s by id i is t = BASE[s] + i, if
    CHECK[t] == s. State 0 is the root; ids are 1..n_ids."""

    def __init__(self, n_ids: int):
        self.n_ids, self.low = n_ids, n_ids + 1
        self.base = np.zeros(2 * n_ids + 64, np.int64)
        self.check = np.full(2 * n_ids + 64, -1, np.int64)
        self.used = np.zeros(2 * n_ids + 64, bool)
        self.used[:self.low] = True  # so that no BASE is below 1

    def _grow(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.used = np.concatenate([self.used, np.zeros(more, bool)])

    def add_children(self, state: int, ids: np.ndarray) -> None:
        """Place the children (ascending ids) at the first BASE where all are free."""
        shift, at = ids - ids[0], self.low
        while True:
            self._grow(at + 64 + int(shift[-1]))
            free = at + np.flatnonzero(~self.used[at:at + 64])
            fits = free[~self.used[free[:, None] + shift].any(1)] if len(free) else free
            if len(fits):
                break
            at += 64
        slots = fits[0] + shift
        self.base[state], self.check[slots], self.used[slots] = fits[0] - ids[0], state, True
        while self.low < len(self.used) and self.used[self.low]:
            self.low += 1

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The children of states by ids; -1 where there is none."""
        to = self.base[states] + ids
        ok = (to < len(self.check)) & (self.base[states] > 0)
        ok[ok] = self.check[to[ok]] == states[ok]
        return np.where(ok, to, -1)


def build(paths: np.ndarray, n_ids: int) -> DoubleArray:
    """Pack paths (rows of ids, 0 beyond the end) level by level."""
    trie = DoubleArray(n_ids)
    states, walk = np.zeros(len(paths), np.int64), np.arange(len(paths))
    for d in range(paths.shape[1]):
        go = paths[walk, d] > 0
        states, walk = states[go], walk[go]
        if not len(walk):
            break
        edges = np.unique(np.stack([states, paths[walk, d]], 1), axis=0)
        heads = np.flatnonzero(np.r_[True, edges[1:, 0] != edges[:-1, 0]])
        for state, ids in zip(edges[heads, 0].tolist(), np.split(edges[:, 1], heads[1:])):
            trie.add_children(state, ids)
        states = trie.step(states, paths[walk, d])
    return trie


# -- one shard -----------------------------------------------------------------

def lanes(depth: int, turn: str) -> list[int]:
    """Four 32-bit numbers of a (depth, turn), as ``lane_sums`` gives them."""
    digest = hashlib.md5(f"{turn}/{depth}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(_LANES)]


def _pair(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = (sums & _MASK).astype(np.uint64)
    return ((s[:, 0] << np.uint64(32)) | s[:, 1]).view(np.int64), ((s[:, 2] << np.uint64(32)) | s[:, 3]).view(np.int64)


def _unpair(a: int, b: int) -> list[int]:
    return [(x >> s) & _MASK for x in (a, b) for s in (32, 0)]


_SHARD = {"depth": "long", "a": "long", "b": "long", "parent_a": "long", "parent_b": "long", "border": "boolean", "goes_on": "boolean", "n_convs": "long",
          "conv_id": "long", "parent_id": "long", "last_chars": "long", "n_children": "long", "n_leaves": "long", "saved": "long",
          "chain": f"array<{_NODE}>"}


def shard_nodes(top: tuple[int, int, int], rows: list[tuple]) -> dict[str, list]:
    """Nodes of one shard. ``rows``: (path bytes, conversations, least conv_id,
    whether some go on below) in path order, all below the node ``top``.

    An inner node (all its paths are here) comes with its counts within the
    band. A border node (on the first or last path, or the top itself) comes
    with what the inner nodes below it add. Border nodes and those that go on
    below the cut carry their chain of nodes from the top.
    """
    dense: dict[bytes, int] = {}
    split = [[dense.setdefault(p[k:k + _TURN], len(dense) + 1) for k in range(0, len(p), _TURN)] for p, *_ in rows]
    width = max(map(len, split))
    paths = np.zeros((len(split), width), np.int64)
    for row, ids in zip(paths, split):
        row[:len(ids)] = ids
    trie = build(paths, len(dense))
    turns = [b"", *dense]
    chars = np.array([0, *(int.from_bytes(t[16:], "big") for t in dense)], np.int64)

    # walk all paths at once: what passes each state
    size = len(trie.check)
    n, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    border, goes_on, level_of = np.zeros(size, bool), np.zeros(size, bool), np.zeros(size, np.int64)
    count, first = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
    on = np.array([r[3] for r in rows], bool)
    at, walk = np.zeros(len(rows), np.int64), np.arange(len(rows))
    np.add.at(n, at, count)
    np.minimum.at(least, at, first)
    border[0] = True
    levels = [np.zeros(1, np.int64)]
    for d in range(width):
        go = paths[walk, d] > 0
        goes_on[at[~go & on[walk]]] = True
        walk = walk[go]
        at = trie.step(at[go], paths[walk, d])
        np.add.at(n, at, count[walk])
        np.minimum.at(least, at, first[walk])
        border[at[(walk == 0) | (walk == len(rows) - 1)]] = True
        levels.append(np.unique(at))
        level_of[levels[-1]] = d + 1
    goes_on[at[on[walk]]] = True

    # traverse BASE and CHECK: every state's parent and last turn, then sums from the bottom
    states = np.concatenate(levels)
    parent = np.maximum(trie.check, 0)
    turn = np.where(trie.check >= 0, np.arange(size) - trie.base[parent], 0)
    inner = ~border
    children = np.bincount(parent[states[1:]], weights=inner[states[1:]], minlength=size).astype(np.int64)
    leaves = np.where(inner & (children == 0) & ~goes_on, 1, 0)
    saved = np.where(inner, (n - 1) * chars[turn], 0)
    for own in reversed(levels[1:]):
        np.add.at(leaves, parent[own], leaves[own])
        np.add.at(saved, parent[own], saved[own])

    sums = np.zeros((size, _LANES), np.int64)
    sums[0] = _unpair(top[1], top[2])
    known: dict[tuple[int, int], list[int]] = {}
    for d, own in enumerate(levels[1:], 1):
        step = [known.get(key) or known.setdefault(key, lanes(top[0] + d, turns[key[1]].hex())) for key in ((d, t) for t in turn[own].tolist())]
        sums[own] = (sums[parent[own]] + np.array(step, np.int64).reshape(-1, _LANES)) & _MASK
    a, b = _pair(sums)
    depth = top[0] + level_of

    def chain(state: int) -> list[dict]:
        out = []
        while True:
            out.append({"depth": int(depth[state]), "a": int(a[state]), "b": int(b[state])})
            if state == 0:
                return out[::-1]
            state = int(parent[state])

    out = {"depth": depth, "a": a, "b": b, "parent_a": a[parent], "parent_b": b[parent], "border": border, "goes_on": goes_on, "n_convs": n,
           "conv_id": least, "parent_id": least[parent], "last_chars": chars[turn], "n_children": children, "n_leaves": leaves, "saved": saved}
    found = {k: v[states].tolist() for k, v in out.items()}
    found["parent_id"] = [None if border[p] else i for p, i in zip(parent[states].tolist(), found["parent_id"])]
    found["parent_a"][0] = found["parent_b"][0] = None
    found["chain"] = [chain(s) if border[s] or goes_on[s] else None for s in states.tolist()]
    return found


# -- jobs ----------------------------------------------------------------------

def lane_sums(depth: Column, turn: Column) -> list[Column]:
    digest = F.md5(F.concat(turn, F.lit("/"), depth.cast("string")))
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(_LANES)]


def _key(sums: list[Column]) -> list[Column]:
    low = [s.bitwiseAND(F.lit(_MASK)) for s in sums]
    return [F.shiftleft(low[0], 32).bitwiseOR(low[1]), F.shiftleft(low[2], 32).bitwiseOR(low[3])]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1, by turn, null first, then by the turn's digest),
    key (hexadecimal digest of role and text, and code points).

    Turns are dealt by ranges of (conv_id, turn, key), so a conversation that
    holds much of the table lies in many ranges; positions are counted within
    a range and lifted by the counts of the ranges before it.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit("/"), role, text)), F.lpad(F.lower(F.hex(F.length(text).cast("long"))), 16, "0"))
    rows = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), key.alias("key"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "conv_id", F.col("turn").asc_nulls_first(), "key")
    turns = stage(dealt.withColumn("range", F.spark_partition_id()), "turns")
    counts = turns.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("conv_id", "range", (F.sum("n").over(Window.partitionBy("conv_id").orderBy("range")) - F.col("n")).alias("before"))
    by = Window.partitionBy("conv_id", "range").orderBy(F.col("turn").asc_nulls_first(), "key")
    within = turns.select("conv_id", "range", "key", F.row_number().over(by).alias("pos"))
    return within.join(before, ["conv_id", "range"]).select("conv_id", (F.col("pos") + F.col("before")).alias("pos"), "key")


def shared_heads(turns: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """The conversations with their shared heads: the first h turns of
    conv_id - conv_id % group replace the first h of conv_id, where h is the
    crc32 of the decimal conv_id modulo ``heads``. Returns (conv_id) of all
    and (conv_id, depth, key) of every turn; % keeps the sign of conv_id."""
    h = F.crc32(F.col("conv_id").cast("string")) % heads
    firsts = turns.filter(F.col("pos") < heads).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "key"))).alias("first"))
    ids = stage(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "n", h.alias("h")), "conversations")
    got = ids.join(firsts.select(F.col("conv_id").alias("base"), "first"),
                   F.col("conv_id") - F.col("conv_id") % group == F.col("base"), "left")
    taken = F.slice("first", F.lit(1), F.col("h").cast("int"))
    heads_of = got.filter("first IS NOT NULL AND h > 0").select("conv_id", F.explode(taken).alias("t")).select("conv_id", F.col("t.pos").cast("long").alias("depth"), "t.key")
    short = (F.col("h") - F.least(F.coalesce(F.size("first"), F.lit(0)), F.col("h"))).alias("short")
    lift = got.select("conv_id", F.when(F.col("first").isNull(), F.col("h")).otherwise(short).alias("short"))
    own = turns.filter(F.col("pos") > h).join(lift.filter("short > 0"), "conv_id", "left")
    tails = own.select("conv_id", (F.col("pos") - F.coalesce("short", F.lit(0))).alias("depth"), "key")
    return ids.select("conv_id"), heads_of.unionByName(tails)


def _segments(path_turns: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """(top depth, a, b, path, n, conv_id, goes_on) of the distinct runs of at
    most ``levels`` turns, and (conv_id, depth, a, b) of each conversation's end."""
    sums = [f"l{k}" for k in range(_LANES)]
    rows = path_turns.select("conv_id", "depth", "key", F.floor((F.col("depth") - 1) / levels).alias("band"),
                             *[c.alias(s) for s, c in zip(sums, lane_sums(F.col("depth"), F.col("key")))])
    bands = rows.groupBy("conv_id", "band").agg(F.array_sort(F.collect_list(F.struct("depth", "key"))).alias("turns"), *[F.sum(s).alias(s) for s in sums])
    by = Window.partitionBy("conv_id").orderBy("band")
    upto = [F.sum(F.col(s).bitwiseAND(F.lit(_MASK))).over(by) for s in sums]
    full = stage(bands.select("conv_id", "band", F.unhex(F.array_join(F.col("turns.key"), "")).alias("path"), F.size("turns").alias("size"),
                              *[F.col(s).bitwiseAND(F.lit(_MASK)).alias(f"own_{s}") for s in sums], *[u.alias(s) for s, u in zip(sums, upto)],
                              F.lead("band").over(by).isNotNull().alias("goes_on")), "segments")
    a, b = _key([F.col(s) - F.col(f"own_{s}") for s in sums])
    distinct = full.groupBy((F.col("band") * levels).alias("depth"), a.alias("a"), b.alias("b"), "path").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), F.max("goes_on").alias("goes_on"))
    end_a, end_b = _key([F.col(s) for s in sums])
    ends = full.filter(~F.col("goes_on")).select("conv_id", (F.col("band") * levels + F.col("size")).alias("depth"), end_a.alias("a"), end_b.alias("b"))
    return distinct, ends


def _shards(distinct: DataFrame, shard_paths: int) -> DataFrame:
    """The nodes of all shards (``shard_nodes``)."""
    kinds = {"border": pa.bool_(), "goes_on": pa.bool_(),
             "chain": pa.list_(pa.struct([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]))}

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array(found[c], kinds.get(c, pa.int64())) for c in _SHARD], names=list(_SHARD))

    def pack(batches):
        top, held = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("depth", "a", "b", "path", "n", "conv_id", "goes_on")]
            for depth, a, b, *row in zip(*cols):
                if (depth, a, b) != top or len(held) == shard_paths:
                    if held:
                        yield batch_of(shard_nodes(top, held))
                    top, held = (depth, a, b), []
                held.append(tuple(row))
        if held:
            yield batch_of(shard_nodes(top, held))

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*_KEY, "path"]
    dealt = stage(distinct, "paths").repartitionByRange(n, *order).sortWithinPartitions(*order)
    return dealt.select(*order, "n", "conv_id", "goes_on").mapInArrow(pack, ", ".join(f"{k} {v}" for k, v in _SHARD.items()))


def _merged_border(shards: DataFrame) -> DataFrame:
    """Border nodes by (top, node): counts of all shards, own shares passed up
    the chain. ``is_top`` marks a cut in its part as the top of the band below."""
    whole = shards.filter("border").withColumn("top", F.col("chain")[0]).groupBy("top", *_KEY).agg(
        *[F.max(c).alias(c) for c in ("parent_a", "parent_b", "goes_on", "last_chars")], F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max_by("chain", F.size("chain")).alias("chain"))
    is_top = (F.col("depth") > 0) & (F.col("depth") == F.col("top.depth"))
    border = stage(whole.withColumn("is_top", is_top), "border")
    kids = border.filter(F.col("depth") > F.col("top.depth")).groupBy("top", (F.col("depth") - 1).alias("depth"), F.col("parent_a").alias("a"), F.col("parent_b").alias("b")) \
        .agg(F.count(F.lit(1)).alias("kids"))
    counted = border.join(kids, ["top", *_KEY], "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    childless = (F.col("n_children") == 0) & ~F.col("goes_on")
    own = counted.filter(~F.col("is_top")).select("top", F.explode("chain").alias("node"), childless.cast("long").alias("l"),
                                                  ((F.col("n_convs") - 1) * F.col("last_chars")).alias("s"))
    share = own.groupBy("top", *[F.col(f"node.{c}").alias(c) for c in _KEY]).agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
    return counted.join(share, ["top", *_KEY], "left").select(
        *[c for c in border.columns if c not in ("n_children", "n_leaves", "saved")], "n_children",
        (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))


def _sums_below(tops: DataFrame) -> DataFrame:
    """(node, up, n_children, n_leaves, saved): adds to each top the sums of all
    tops below it, in doubling steps; ``up`` is the top of the band above,
    null in the second band."""
    state = stage(tops, "tops")
    while True:
        gone = state.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        if gone.isEmpty():
            return state.drop("up")
        jump = state.select(F.col("node").alias("up"), F.col("up").alias("further"))
        state = stage(state.join(jump, "up", "left").join(gone, "node", "left").select(
            "node", F.col("further").alias("up"), "n_children", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved")), "tops")


def _with_bands(nodes: DataFrame, border: DataFrame) -> DataFrame:
    """Add what lies below the cuts to the nodes of the bands above them."""
    node = F.struct(*_KEY)
    cuts = stage(nodes.filter("goes_on").select(node.alias("node"), "chain"), "cuts")
    if cuts.isEmpty():
        return nodes
    up = F.when(F.col("chain")[0]["depth"] > 0, F.col("chain")[0])
    tops = border.filter("is_top").select(node.alias("node"), "n_children", "n_leaves", "saved").join(cuts.select("node", up.alias("up")), "node")
    full = stage(cuts.join(_sums_below(tops.select("node", "up", "n_children", "n_leaves", "saved")), "node"), "below")
    chain = F.filter("chain", lambda c: (c["depth"] == 0) | (c["depth"] > F.col("chain")[0]["depth"]))
    lift = full.select(F.explode(chain).alias("to"), "node", "n_children", "n_leaves", "saved").groupBy(*[F.col(f"to.{c}").alias(c) for c in _KEY]).agg(
        F.sum(F.when(F.col("to") == F.col("node"), F.col("n_children")).otherwise(0)).alias("k"), F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
    more = {"n_children": "k", "n_leaves": "l", "saved": "s"}
    return nodes.join(lift, _KEY, "left").withColumns({c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in more.items()}).drop(*more.values())


def _ends_digest(ends: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256: the digest of the ascending, comma-joined conv_ids
    that end at a node. Ids are joined in blocks first; a node's blocks then
    pass one running digest, so neither is held whole."""
    block = F.floor(F.col("conv_id") / ENDS)
    blocks = ends.groupBy(*_KEY, block.alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches):
        at, made = None, []
        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
                if key != at:
                    if at is not None:
                        made.append((*at, run.hexdigest()))
                    at, run = key, hashlib.sha256(ids.encode())
                else:
                    run.update(b"," + ids.encode())
            if len(made) > 4096:
                yield columns(made)
                made = []
        if at is not None:
            made.append((*at, run.hexdigest()))
        if made:
            yield columns(made)

    def columns(made):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=[*_KEY, "ends_sha256"])

    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, *_KEY).sortWithinPartitions(*_KEY, "block").mapInArrow(digest, "depth long, a long, b long, ends_sha256 string")


def prefix_nodes(conversations: DataFrame, levels: int = LEVELS, shard_paths: int = SHARD_PATHS, group: int = 100, heads: int = 6) -> DataFrame:
    """One row for each distinct sequence of first turns of the conversations
    (conv_id, turn, role, text) with shared heads (``shared_heads``): conv_id
    (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns are ordered by turn, null first; turns of equal number by the digest
    of role and text, so repeated rows are turns of their own. A null role or
    text is empty. Rows without conv_id belong to no conversation and are left
    out. A conversation that the rebuilding leaves without turns is a member
    of the root. An empty table gives no rows. Other columns are not read.
    """
    turns = numbered_turns(conversations.select("conv_id", "turn", "role", "text"))
    ids, path_turns = shared_heads(stage(turns, "numbered"), group, heads)
    distinct, ends = _segments(path_turns, levels)
    ends = stage(ends, "ends")
    turnless = ids.join(ends.select("conv_id"), "conv_id", "left_anti")
    zero = F.lit(0).cast("long")
    ends = ends.unionByName(turnless.select("conv_id", *[zero.alias(c) for c in _KEY]))
    root = {c: F.lit(None) for c in _SHARD} | {c: zero for c in (*_KEY, "last_chars", "n_children", "n_leaves", "saved")} | {
        "border": F.lit(True), "goes_on": F.lit(False), "chain": F.array(F.struct(*[zero.alias(c) for c in _KEY])),
        "n_convs": F.col("n_convs"), "conv_id": F.col("conv_id")}
    bare = turnless.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"))
    made = stage(_shards(distinct, shard_paths).unionByName(bare.select(*[root[c].cast(kind).alias(c) for c, kind in _SHARD.items()])), "shard-nodes")
    border = stage(_merged_border(made), "merged")
    kept = [c for c in _SHARD if c not in ("border", "last_chars")]
    merged = border.filter("NOT is_top AND n_convs > 0").withColumn("parent_id", F.lit(None).cast("long")).select(*kept)
    nodes = _with_bands(stage(made.filter("NOT border").select(*kept).unionByName(merged), "nodes"), border)
    # parents that are border nodes or cuts have their conv_id only now
    parents = merged.unionByName(made.filter("NOT border AND goes_on").select(*kept)).select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("met"))
    named = nodes.filter("parent_id IS NULL").join(parents, ["depth", "parent_a", "parent_b"], "left").withColumn("parent_id", F.col("met")).drop("met")
    out = nodes.filter("parent_id IS NOT NULL").unionByName(named).join(_ends_digest(ends), _KEY, "left")
    return out.select("conv_id", "depth", F.col("parent_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")
