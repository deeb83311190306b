"""The trie of conversations' turns, as balanced parentheses in shards.

A node is a sequence of turns that some conversation begins with; its members are those conversations. Nodes with the same
members form a chain, of which a conversation that shares nothing more has one. Chains (with the members' smallest id, which
tells siblings apart) are the letters of a path, so paths stay short however long conversations are: N turns make no path of
more than about sqrt(2 N) chains. Paths sorted by these letters stand in depth-first order and are dealt into shards by range.

A shard writes its chains as parentheses, one open where a chain begins and one closed where its subtree ends. The excess of
open over closed ones is kept as the least and largest of every block and of a tree above the blocks; findclose walks it to
the first place behind an open parenthesis where the excess falls below. Between the two lies the subtree: the leaf pairs `()`
counted up to either place give its leaves, cumulative sums over the opened chains its savings. Only chains on a shard's
first and last path can go on in a neighbour; these spines are summed over shards.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import number_rows, running
from .common import materialize

#: Chains of one shard at most: a task that gets more writes several shards.
SHARD = 1 << 18
#: Parentheses of a block of the range min-max tree.
BLOCK = 64
#: Ids in a piece of a list of conversations.
PIECE = 4096


class Parentheses:
    """Balanced parentheses (1 open, 0 closed) with findclose and ranks, for many positions in one call."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits.astype(np.int64)
        self.opened = np.cumsum(self.bits)
        self.excess = 2 * self.opened - np.arange(1, len(bits) + 1)
        blocks = -(-len(bits) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:len(bits)] = self.excess
        self.rows = padded.reshape(blocks, BLOCK)
        #: Least excess below a node of the tree; node 1 is its root, the blocks are its last level.
        self.first_leaf = 1 << max(0, (blocks - 1).bit_length())
        self.least = np.full(2 * self.first_leaf, np.iinfo(np.int64).max)
        self.least[self.first_leaf:self.first_leaf + blocks] = self.rows.min(axis=1)
        for node in range(self.first_leaf - 1, 0, -1):
            self.least[node] = min(self.least[2 * node], self.least[2 * node + 1])

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Of every open parenthesis the closed one that belongs to it: the first behind it with an excess of one less."""
        wanted = self.excess[at] - 1
        found = np.full(len(at), -1)
        inside = np.arange(BLOCK)
        here = (self.rows[at // BLOCK] <= wanted[:, None]) & (inside > (at % BLOCK)[:, None])
        done = here.any(axis=1)
        found[done] = at[done] // BLOCK * BLOCK + here[done].argmax(axis=1)
        left = np.flatnonzero(~done)
        node = self.first_leaf + at[left] // BLOCK
        # Up until a right neighbour holds a small enough excess, then down to the first block below it that does.
        up = np.ones(len(left), dtype=bool)
        while up.any():
            right = up & (node % 2 == 0) & (self.least[np.minimum(node + 1, len(self.least) - 1)] <= wanted[left])
            node = np.where(right, node + 1, np.where(up, node // 2, node))
            up &= ~right
            if (node[up] < 1).any():
                raise ValueError("parentheses are not balanced")
        while (down := node < self.first_leaf).any():
            low = 2 * node
            node = np.where(down, np.where(self.least[np.minimum(low, len(self.least) - 1)] <= wanted[left], low, low + 1), node)
        block = node - self.first_leaf
        found[left] = block * BLOCK + (self.rows[block] <= wanted[left][:, None]).argmax(axis=1)
        return found


SHARD_ROWS = "rep long, n long, parent long, n_children long, n_leaves long, saved long, spine boolean"


class _Shard:
    """Paths in depth-first order, written as parentheses."""

    def __init__(self) -> None:
        self.bits: list[int] = []
        self.rep: list[int] = []
        self.n: list[int] = []
        self.parent: list[int] = []
        self.own: list[int] = []
        self.children: list[int] = []
        self.leaf: list[int] = []
        self.stack: list[int] = []
        self.first: set[int] | None = None

    def add(self, seq: int, reps: list[int], ns: list[int], saves: list[int], leaf: bool) -> None:
        shared = 0
        while shared < len(self.stack) and shared < len(reps) and self.rep[self.stack[shared]] == reps[shared]:
            shared += 1
        self.bits += [0] * (len(self.stack) - shared)
        del self.stack[shared:]
        for rep, n in zip(reps[shared:], ns[shared:]):
            self.parent.append(self.rep[self.stack[-1]] if self.stack else -1)
            self.stack.append(len(self.rep))
            self.bits.append(1)
            self.rep.append(rep)
            self.n.append(n)
            self.own.append(0)
            self.children.append(0)
            self.leaf.append(0)
        # The path of a chain's smallest member is the one, over all shards, that counts the chain.
        for depth, (rep, saved) in enumerate(zip(reps, saves)):
            if rep == seq:
                self.own[self.stack[depth]] = saved
                if depth:
                    self.children[self.stack[depth - 1]] += 1
        self.leaf[self.stack[-1]] = int(leaf)
        if self.first is None:
            self.first = set(self.stack)

    def rows(self) -> pa.RecordBatch:
        last = set(self.stack)
        self.bits += [0] * len(self.stack)
        bits = np.array(self.bits)
        tree = Parentheses(bits)
        opens = np.flatnonzero(bits)
        closes = tree.find_close(opens)
        # A pair on the last path may be a chain that goes on in the next shard; the path itself knows.
        pair = np.zeros(len(bits), dtype=np.int64)
        pair[opens] = (bits[opens + 1] == 0) * np.array(self.leaf)
        pairs, before = np.cumsum(pair), np.cumsum(np.array(self.own, dtype=np.int64))
        first, upto = tree.opened[opens] - 1, tree.opened[closes] - 1
        own = np.array(self.own, dtype=np.int64)
        spine = np.zeros(len(opens), dtype=bool)
        spine[list((self.first or set()) | last)] = True
        return pa.record_batch([
            pa.array(self.rep, pa.int64()), pa.array(self.n, pa.int64()), pa.array(self.parent, pa.int64()), pa.array(self.children, pa.int64()),
            pa.array(pairs[closes] - pairs[opens] + pair[opens]), pa.array(before[upto] - before[first] + own[first]), pa.array(spine)],
            names=[f.split()[0] for f in SHARD_ROWS.split(", ")])


def _shards(most: int, stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in stream:
        for row in zip(*(batch.column(c).to_pylist() for c in ("seq", "reps", "ns", "saves", "leaf"))):
            shard.add(*row)
            if len(shard.rep) >= most:
                yield shard.rows()
                shard = _Shard()
    if shard.rep:
        yield shard.rows()


def _lists(most: int, stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of the comma-joined ids of a node, from rows sorted by node and id."""
    names, made, node, ids = ["d", "x", "y", "first", "piece"], [], None, []

    def piece() -> tuple:
        return (*node, ids[0], ",".join(map(str, ids)))
    for batch in stream:
        for d, x, y, conv in zip(*(batch.column(c).to_pylist() for c in ("d", "x", "y", "conv"))):
            if ids and ((d, x, y) != node or len(ids) == most):
                made.append(piece())
                ids = []
            node = d, x, y
            ids.append(conv)
        if len(made) >= 256:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=names)
            made = []
    if ids:
        made.append(piece())
    if made:
        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=names)


def _digests(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, made, node, digest = ["d", "x", "y", "ends_sha256"], [], None, None
    for batch in stream:
        for d, x, y, piece in zip(*(batch.column(c).to_pylist() for c in ("d", "x", "y", "piece"))):
            if (d, x, y) == node:
                digest.update(b"," + piece.encode())
                continue
            if node:
                made.append((*node, digest.hexdigest()))
            node, digest = (d, x, y), hashlib.sha256(piece.encode())
        if len(made) >= 256:
            yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=names)
            made = []
    if node:
        made.append((*node, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([*map(pa.array, zip(*made))], names=names)


def ordered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, d, h1, h2, size): the turns of every conversation, numbered from 1 by turn (null first), as 128 bits of role and
    text and the text's code points. Turns of the same number stand by these bits. A null role or text is empty; rows without
    an id belong to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), role, text).alias("h2"), F.char_length(text).cast("long").alias("size"))
    return number_rows(rows, ["conv"], ["turn", "h1", "h2"], "d").drop("turn")


def share_heads(rows: DataFrame, source: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations with their `length`) after every conversation's first `head` turns gave way to those of the
    conversation `source`, as far as it has them. Both are columns of `conv`; `head` is at most `most`."""
    rows = materialize(rows)
    counts = rows.groupBy("conv").agg(F.max("d").alias("n")).select("conv", "n", source.alias("source"), head.alias("head"))
    given = counts.select(F.col("conv").alias("source"), F.col("n").alias("n_source"))
    lent = F.least("head", F.coalesce("n_source", F.lit(0)))
    plan = materialize(counts.join(given, "source", "left").select("conv", "source", "head", lent.alias("lent"), (lent + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length")))
    heads = rows.where(F.col("d") <= most).withColumnRenamed("conv", "source")
    borrowed = plan.join(heads, "source").where("d <= head").select("conv", "d", "h1", "h2", "size")
    own = rows.join(plan, "conv").where("d > head").select("conv", (F.col("d") - F.col("head") + F.col("lent")).alias("d"), "h1", "h2", "size")
    return borrowed.unionByName(own), plan.select("conv", "length")


def prefix_trie(rows: DataFrame, conversations: DataFrame, shard: int = SHARD, piece: int = PIECE) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends_sha256) for every node.

    `rows` (conv, d, h1, h2, size) are turns numbered from 1, `conversations` (conv, length) all of them, those without turns
    too; ids are unique there. A node's `conv_id` is its smallest member; the root has depth 0 and no parent. `saved` sums, over
    the node's subtree, the size of a node's last turn times its members but one; `n_leaves` counts the nodes in it that have no
    child, the node itself included. `ends_sha256` is of the ids, ascending and comma-joined, of the members with no turn more.
    Conversations that are alike end at the same node. No conversations give no nodes.

    Prefixes are told apart by 128 bits that turns add to by exclusive or, so that no conversation is ever gathered. A list of
    ids that is hashed is read as a stream of pieces. `shard` chains and `piece` ids bound what a task holds.
    """
    roots = conversations.select("conv", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(0).cast("long").alias("size"))
    lanes = {"x": F.xxhash64("d", "h1", "h2"), "y": F.xxhash64(F.lit(1), "h2", "d", "h1")}
    prefixes = running(roots.unionByName(rows), ["conv"], "d", sums={"upto": F.col("size")}, xors=lanes)
    prefixes = materialize(prefixes.join(conversations, "conv").select("conv", "d", "x", "y", "size", "upto", (F.col("d") == F.col("length")).alias("last")))
    nodes = materialize(prefixes.groupBy("d", "x", "y").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("rep"), F.max("size").alias("size"), F.max("upto").alias("upto"),
        F.count_if("last").alias("n_ends"), F.min(F.when(F.col("last"), F.col("conv"))).alias("seq")))
    bottom = F.struct("d", "x", "y", "upto", "n_ends", "seq")
    chains = nodes.groupBy("rep", "n").agg(F.max(bottom).alias("b"), F.min("d").alias("top"), F.min(F.col("upto") - F.col("size")).alias("before"))
    chains = materialize(chains.select("rep", "n", "b.*", "top", "before", ((F.col("n") - 1) * (F.col("b.upto") - F.col("before"))).alias("own")))
    # A path is that of the smallest conversation of those that end together, told by the chains' last nodes.
    ends = chains.where("n_ends > 0").select(F.col("seq").alias("conv"), (F.col("n_ends") == F.col("n")).alias("leaf"))
    met = prefixes.join(ends, "conv").select(F.col("conv").alias("path"), "leaf", "d", "x", "y").join(chains.select("d", "x", "y", "rep", "n", "own"), ["d", "x", "y"])
    steps = F.array_sort(F.collect_list(F.struct("d", "rep", "n", "own")))
    paths = met.groupBy("path", "leaf").agg(steps.alias("s")).select(
        F.col("path").alias("seq"), F.transform("s", lambda s: s["rep"]).alias("reps"), F.transform("s", lambda s: s["n"]).alias("ns"),
        F.transform("s", lambda s: s["own"]).alias("saves"), "leaf")
    shards = materialize(materialize(paths).repartitionByRange("reps").sortWithinPartitions("reps").mapInArrow(partial(_shards, shard), SHARD_ROWS))
    spines = shards.where("spine").groupBy("rep", "n").agg(*[f(c).alias(c) for f, c in (
        (F.max, "parent"), (F.sum, "n_children"), (F.sum, "n_leaves"), (F.sum, "saved"))])
    merged = shards.where("not spine").drop("spine").unionByName(spines)
    known = merged.join(chains.select("rep", "n", F.col("d").alias("bottom"), "top", "before"), ["rep", "n"])
    ids = prefixes.where("last").select("d", "x", "y", "conv")
    pieces = ids.repartitionByRange("d", "x", "y", "conv").sortWithinPartitions("d", "x", "y", "conv").mapInArrow(partial(_lists, piece), "d long, x long, y long, first long, piece string")
    digests = pieces.repartition("d", "x", "y").sortWithinPartitions("d", "x", "y", "first").mapInArrow(_digests, "d long, x long, y long, ends_sha256 string")
    above = F.when(F.col("d") > F.col("top"), F.col("rep")).when(F.col("d") > 0, F.col("parent"))
    spared = F.col("saved") - (F.col("n") - 1) * (F.col("upto") - F.col("size") - F.col("before"))
    return nodes.select("d", "x", "y", "n", "rep", "size", "upto").join(known, ["rep", "n"]).join(digests, ["d", "x", "y"], "left").select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), above.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(F.col("d") == F.col("bottom"), F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"), "n_leaves",
        spared.alias("saved"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
