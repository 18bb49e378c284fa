"""Prefix trie of conversations by vertical bitmaps, shard by shard, with figures of every subtree.

A node is a distinct sequence of first turns (role, text); its members are the conversations that start with it.
Conversations are dealt by ranges of their id, and each task cuts its range into shards of at most ``SHARD``
conversations. Within a shard, a postings list of bitsets says for every (position, turn) which conversations have that
turn there. A depth-first walk starts from the bitset of all conversations; it intersects the bitset of a node with
the postings at the next position, found through the lowest conversation not yet covered, so that every intersection is
a child. Popcounts are numbers of members, the lowest bit is the smallest member, and what no child covers ends there.

The same node may occur in many shards. It is named by a chain of SHA-256 digests of its turns, and figures that add
up over shards (members, smallest member) are aggregated by that name, partial sums first, so a node that a third of
all conversations share sends one row per shard. Sums over subtrees need no level-by-level joins: what a node
contributes is attached to its occurrence in the shard of its smallest member only; each shard adds up its own walk
from below, and these sums add up over shards, too. End lists stay apart per shard, in ascending order.

A conversation of more than ``LONG`` turns is a shard of its own that is walked row by row, as a bitset of one member
needs no postings; its turns are never held at once. Every turn is two digests and a length from the first step on.

Defined results: rows without a conversation id belong to none and are left out; a missing role or text is empty; turns
of the same number follow by role and the digest of the text; repeated rows are turns of their own. A conversation without turns is a
member of the root and ends there. Without conversations there are no nodes, not even a root. A negative id's base
follows Spark's remainder, which takes the sign of the id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHARD = 2048
#: Turns that a shard holds at most, and beyond which a conversation is a shard of its own.
LONG = 1 << 16
ROOT = hashlib.sha256(b"root").digest()

TURN = "conv_id long, pos long, turn binary, chars long"
LOCAL = (
    "shard long, at long, node binary, parent binary, depth long, first long, members long, chars long, "
    "ends array<long>"
)


# Turns


def turns(
    chats: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turns as ``conv_id``, ``pos`` (from 0), ``turn`` (a digest of role and text) and ``chars`` of the text."""
    role_of, text_of = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    # The length of the role tells apart what else would be the same characters.
    whole = F.concat(F.length(role_of).cast("string"), F.lit(":"), role_of, text_of)
    rows = chats.filter(F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("conv_id"), F.col(turn).alias("_turn"),
        F.unhex(F.sha2(whole, 256)).alias("turn"), F.length(text_of).cast("long").alias("chars"),
        role_of.alias("_role"), F.sha2(text_of, 256).alias("_text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("_turn"), "_role", "_text")
    place = F.row_number().over(order).cast("long") - 1
    return rows.select("conv_id", place.alias("pos"), "turn", "chars")


def borrowed(own: DataFrame, base: Column, number: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations and turns after the first ``number`` turns of each were replaced by those of its ``base``.

    ``base`` and ``number`` are columns of ``conv_id``; ``own`` must be a written table. A base without conversation
    gives no turns.
    """
    convs = own.groupBy("conv_id").agg(F.lit(1).alias("_one")).select(
        "conv_id", base.alias("_base"), number.alias("_number")
    )
    # Only conversations that are a base of one: their first turns.
    most = convs.filter("_number > 0").groupBy("_base").agg(F.max("_number").alias("_most"))
    heads = own.join(most, own["conv_id"] == most["_base"]).filter("pos < _most")
    heads = heads.select("_base", "pos", "turn", "chars")
    taken = convs.filter("_number > 0").join(heads, "_base").filter("pos < _number")
    kept = own.filter(F.col("pos") >= number)
    # Turns that are taken over may be fewer than ``number``; those that are kept move up.
    short = taken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_taken"))
    place = F.col("pos") - F.col("_number") + F.coalesce("_taken", F.lit(0))
    moved = kept.join(convs, "conv_id").join(short, "conv_id", "left")
    moved = moved.select("conv_id", place.alias("pos"), "turn", "chars")
    return convs.select("conv_id"), taken.select("conv_id", "pos", "turn", "chars").unionByName(moved)


# Shards


class _Rows:
    """Occurrences of nodes in shards, as Arrow batches."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, *row: object) -> None:
        self.rows.append(row)

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        while self.rows and len(self.rows) >= least:
            some, self.rows = self.rows[:10_000], self.rows[10_000:]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.list_(pa.int64())]
            columns = [pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)]
            names = [c.split()[0] for c in LOCAL.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def walk(ids: list[int], convs: list[list[tuple[bytes, int]]], out: _Rows) -> None:
    """Nodes of a shard, children before parents; ``convs`` has the turns (digest, characters) of each id."""
    postings: dict[tuple[int, bytes], int] = {}
    chars: dict[bytes, int] = {}
    ended: dict[int, int] = {}
    for k, conv in enumerate(convs):
        bit = 1 << k
        for pos, (turn, n) in enumerate(conv):
            postings[pos, turn] = postings.get((pos, turn), 0) | bit
            chars[turn] = n
        ended[len(conv)] = ended.get(len(conv), 0) | bit
    shard, at = ids[0], 0
    # Each entry: name, parent's name, characters, members, members not yet covered by children.
    everyone = (1 << len(ids)) - 1
    path = [[ROOT, None, 0, everyone, everyone & ~ended.get(0, 0)]]
    while path:
        node, parent, n, members, rest = path[-1]
        depth = len(path) - 1
        if rest:
            turn = convs[(rest & -rest).bit_length() - 1][depth][0]
            child = members & postings[depth, turn]
            path[-1][4] = rest & ~child
            name = hashlib.sha256(node + turn).digest()
            path.append([name, node, chars[turn], child, child & ~ended.get(depth + 1, 0)])
            continue
        first = ids[(members & -members).bit_length() - 1]
        ends, left = [], members & ended.get(depth, 0)
        while left:
            low = left & -left
            ends.append(ids[low.bit_length() - 1])
            left ^= low
        out.add(shard, at, node, parent, depth, first, members.bit_count(), n, ends)
        at += 1
        path.pop()


def _shards(batches: Iterator[pa.RecordBatch], most: int, long: int) -> Iterator[pa.RecordBatch]:
    out = _Rows()
    ids: list[int] = []
    convs: list[list[tuple[bytes, int]]] = []
    held, node, alone = 0, ROOT, None
    for batch in batches:
        columns = (batch.column(c) for c in ("conv_id", "pos", "turn", "chars", "size"))
        for conv, pos, turn, chars, size in zip(*(c.to_pylist() for c in columns), strict=True):
            if alone is not None and conv == alone:
                pass
            elif not ids or conv != ids[-1]:
                alone = None
                if ids and (len(ids) >= most or held + size > long):
                    walk(ids, convs, out)
                    ids, convs, held = [], [], 0
                if size > long:
                    alone, node = conv, ROOT
                    out.add(conv, 0, ROOT, None, 0, conv, 1, 0, [])
                else:
                    ids.append(conv)
                    convs.append([])
            if alone is not None:
                parent, node = node, hashlib.sha256(node + turn).digest()
                # Deeper nodes come first when the shard is added up.
                out.add(conv, -1 - pos, node, parent, pos + 1, conv, 1, chars, [conv] if pos + 1 == size else [])
            elif pos is not None:
                convs[-1].append((turn, chars))
                held += 1
            if len(out.rows) >= 10_000:
                yield from out.batches(10_000)
    if ids:
        walk(ids, convs, out)
    yield from out.batches(1)


def local_nodes(convs: DataFrame, rows: DataFrame, shard: int = SHARD, long: int = LONG) -> DataFrame:
    """Occurrences of nodes in shards, written: see ``LOCAL``; ``at`` orders a shard, children before parents."""
    # Conversations without turns get one row without a turn.
    sized = rows.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("conv_id")))
    none = convs.join(rows.select("conv_id").distinct(), "conv_id", "left_anti")
    empty = {c: F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in TURN.split(", "))}
    none = none.select("conv_id", empty["pos"], empty["turn"], empty["chars"], F.lit(0).cast("long").alias("size"))
    every = common.stored(sized.unionByName(none), "turns")
    # A range never cuts a conversation, as only its id counts.
    dealt = every.repartitionByRange(common.partitions(rows.sparkSession), "conv_id")
    dealt = dealt.sortWithinPartitions("conv_id", "pos")
    found = common.stored(common.map_arrow(dealt, _shards, LOCAL, shard, long), "nodes")
    common.dropped(every)
    return found


# Sums over subtrees


def _from_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of ``leaf`` and ``value`` over the subtree of each occurrence; rows come by shard, children before parents."""
    shard, pending = None, {}
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("shard", "depth", "leaf", "value"))
        leaves, values = [], []
        for now, depth, leaf, value in zip(*columns, strict=True):
            if now != shard:
                shard, pending = now, {}
            below = pending.pop(depth + 1, (0, 0))
            leaf, value = leaf + below[0], value + below[1]
            before = pending.get(depth, (0, 0))
            pending[depth] = (leaf + before[0], value + before[1])
            leaves.append(leaf)
            values.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array(leaves, pa.int64()), pa.array(values, pa.int64())],
            names=["node", "n_leaves", "saved"],
        )


def trie(local: DataFrame) -> DataFrame:
    """Per node: ``node``, ``parent``, ``depth``, ``conv_id`` (smallest member), ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved`` (both over its subtree)."""
    # Parent, depth and characters follow from the name.
    merged = local.groupBy("node", "parent", "depth", "chars").agg(
        F.min("first").alias("conv_id"), F.sum("members").alias("n_convs")
    )
    merged = common.stored(merged, "merged")
    children = merged.filter(F.col("parent").isNotNull()).groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    nodes = merged.join(children.withColumnRenamed("parent", "node"), "node", "left")
    nodes = common.stored(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    # What a node contributes goes to one shard: that of its smallest member.
    given = nodes.select(
        "node", F.col("conv_id").alias("first"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("value"),
    )
    zero = F.lit(0).cast("long")
    valued = local.select("shard", "at", "node", "depth", "first").join(given, ["node", "first"], "left")
    valued = valued.select(
        "shard", "at", "node", "depth", F.coalesce("leaf", zero).alias("leaf"), F.coalesce("value", zero).alias("value")
    )
    dealt = valued.repartition(common.partitions(local.sparkSession), "shard").sortWithinPartitions("shard", "at")
    sums = common.map_arrow(dealt, _from_below, "node binary, n_leaves long, saved long")
    sums = sums.groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    total = nodes.count()
    names = ("node", "parent", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved")
    found = common.stored(nodes.join(sums, "node").select(*names), "sums")
    # A parent of very many children is sent to all tasks instead of meeting all of them in one.
    parents = found.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_size")
    )
    named = common.attach(found.filter(F.col("parent").isNotNull()), parents, ["parent"], "_size", total).drop("_size")
    root = found.filter(F.col("parent").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long"))
    common.dropped(merged)
    return named.unionByName(root)


def ends(local: DataFrame) -> DataFrame:
    """End lists: per node and shard the ids of the conversations that end there, ascending; shards ascend with ids."""
    return local.filter(F.size("ends") > 0).select("node", "shard", "ends")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, digest, names, digests = None, None, [], []
    columns_out = ["node", "ends_sha256"]
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("node", "ends"))
        for now, ids in zip(*columns, strict=True):
            text = ",".join(map(str, ids)).encode()
            if now == node:
                digest.update(b"," + text)
                continue
            if node is not None:
                names.append(node)
                digests.append(digest.hexdigest())
            node, digest = now, hashlib.sha256(text)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=columns_out)
        names, digests = [], []
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=columns_out)


def with_end_digests(nodes: DataFrame, lists: DataFrame) -> DataFrame:
    """``nodes`` with ``ends_sha256``: SHA-256 of the ids of ``lists``, ascending, as text with commas between.

    The lists of a node pass through one task shard by shard; a task holds one of them at a time.
    """
    dealt = lists.repartition(common.partitions(nodes.sparkSession), "node").sortWithinPartitions("node", "shard")
    digests = common.map_arrow(dealt.select("node", "ends"), _hashed, "node binary, ends_sha256 string")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(digests, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
