"""SimHash near-dedup over a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most d < 8 bits differ in at most d of their 8 bytes, so they share at
least ``8 - d`` bytes in the same positions. The inverted index lists fingerprints by positional bytes. Lists of
single bytes would hold a 256th of all fingerprints each, so a list is kept for every choice of ``8 - d``
positions instead (56 choices for d = 3): it is the intersection of that many single-byte lists. A pair is met
exactly when it reaches the guaranteed minimum of shared bytes. Its shared positions are tallied, the pair is
kept in the first of its lists only, and the differing bits are counted to verify it.

Copies share one entry. A long list does not emit all its pairs: within it the components of the links are
computed (by neighbourhood look-ups in the 2**24 values its open bytes can take, which also bounds its length)
and a tree of them is emitted. Components over all lists give the groups.

Defined results: a missing or white-space-only text has fingerprint zero and links like any other. A group's id is
the smallest id in it (missing ids come last, so it is missing only if all are). Repeated rows are rows of the
same group. An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph

SHINGLE = 3
SEED = 42
BITS = 3
#: Lists up to this length are compared pair by pair and emit every link; longer ones emit a tree.
PAIRWISE = 256
#: Lists up to this length are compared in blocks, longer ones by neighbourhood look-ups.
BLOCKWISE = 8192


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """Fingerprint of a whole text: A-Z lower-cased, words free of ASCII white space, bitwise majority of XXH64."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total, n = np.zeros(64, np.int64), len(words) - shingle + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for i in range(0, n, 1 << 16):
        part = words[i : min(n, i + (1 << 16)) + shingle - 1]
        hashes = [digest(join(s), SEED) for s in zip(*(part[k:] for k in range(shingle)), strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _simhashes(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([simhash(t, shingle) for t in common.texts(batch.column("_text"))], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_file"), batch.column("_row"), batch.column("_id"), pa.array(prints.view(np.int64))],
            names=["_file", "_row", "_id", "fp"],
        )


def choices(bits: int) -> list[tuple[int, ...]]:
    """The position sets that get a list."""
    return list(itertools.combinations(range(8), 8 - bits))


def _mask(positions: tuple[int, ...]) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >> 63 else value


def _first_list(bits: int) -> np.ndarray:
    """By the set of shared positions (as a byte): the first list that holds the pair, or -1 below the minimum."""
    sets = [sum(1 << p for p in c) for c in choices(bits)]
    return np.array([next((i for i, s in enumerate(sets) if s & have == s), -1) for have in range(256)])


def _components(prints: np.ndarray, bits: int) -> np.ndarray:
    """Number of its component for each of the distinct fingerprints of one list."""
    n, labels = len(prints), np.arange(len(prints))
    if n <= BLOCKWISE:
        def spread(old: np.ndarray) -> np.ndarray:
            new = old.copy()
            for i in range(0, n, 512):
                near = np.bitwise_count(prints[i : i + 512, None] ^ prints[None, :]) <= bits
                new[i : i + 512] = np.where(near, old[None, :], n).min(1)
            return new
    else:
        # The open bytes as one number; places of all numbers that occur.
        varying = np.bitwise_or.reduce(prints ^ prints[0])
        open_bytes = [p for p in range(8) if int(varying) >> (8 * p) & 0xFF]
        value = np.zeros(n, np.int64)
        for k, p in enumerate(open_bytes):
            value |= ((prints >> np.uint64(8 * p)) & np.uint64(0xFF)).astype(np.int64) << (8 * k)
        width = 8 * len(open_bytes)
        place = np.full(1 << width, -1, np.int32)
        place[value] = np.arange(n)
        flips = [sum(1 << b for b in c) for d in range(1, bits + 1) for c in itertools.combinations(range(width), d)]

        def spread(old: np.ndarray) -> np.ndarray:
            new = old.copy()
            for flip in flips:
                other = place[value ^ flip]
                has = other >= 0
                new[has] = np.minimum(new[has], new[other[has]])
            return new

    while True:
        new = spread(labels)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def _tree(prints: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join each component as a tree in which no node has many neighbours."""
    order = np.argsort(labels, kind="stable")
    labels, prints = labels[order], prints[order]
    start = np.maximum.accumulate(np.where(np.r_[True, labels[1:] != labels[:-1]], np.arange(len(labels)), 0))
    rank = np.arange(len(labels)) - start
    inner = rank > 0
    return prints[inner], prints[(start + (rank - 1) // 8)[inner]]


def _links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Verified links of lists that arrive in order; a list may go on in the next batch."""
    first = _first_list(bits)
    held: list[np.ndarray] = []

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        lists, prints = rows["pos"], rows["fp"]
        begins = np.flatnonzero(np.r_[True, (lists[1:] != lists[:-1]) | (rows["at"][1:] != rows["at"][:-1])])
        ends = np.r_[begins[1:], len(rows)]
        sizes = ends - begins
        end = np.repeat(ends, sizes)
        index = np.flatnonzero((np.repeat(sizes, sizes) > 1) & (np.repeat(sizes, sizes) <= PAIRWISE))
        step = 1
        while len(index := index[index + step < end[index]]):
            a, b = prints[index], prints[index + step]
            differ = a ^ b
            near = np.bitwise_count(differ) <= bits
            a, b, differ, of = a[near], b[near], differ[near], lists[index[near]]
            if len(a):
                shared = np.packbits(differ.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little")[:, 0]
                here = first[shared] == of
                yield edges(a[here], b[here])
            step += 1
        for i in np.flatnonzero(sizes > PAIRWISE):
            own = prints[begins[i] : ends[i]]
            yield edges(*_tree(own, _components(own, bits)))

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
        )

    for batch in batches:
        rows = np.empty(batch.num_rows, [("pos", np.int32), ("at", np.int64), ("fp", np.uint64)])
        for name in ("pos", "at", "fp"):
            rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
        if not len(rows):
            continue
        last = rows[-1]
        if held and (held[0]["pos"][0], held[0]["at"][0]) == (last["pos"], last["at"]):
            held.append(rows)
            continue
        cut = np.flatnonzero((rows["pos"] != last["pos"]) | (rows["at"] != last["at"]))
        cut = cut[-1] + 1 if len(cut) else 0
        whole = np.concatenate([*held, rows[:cut]])
        if len(whole):
            yield from found(whole)
        held = [rows[cut:]]
    if held:
        yield from found(np.concatenate(held))


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` at most ``bits`` bits apart (trees of long lists)."""
    lists = [F.col("fp").bitwiseAND(F.lit(_mask(c))) for c in choices(bits)]
    index = nodes.select("fp", F.posexplode(F.array(*lists)).alias("pos", "at"))
    n = common.partitions(nodes.sparkSession)
    # Sorted to the last column, so a task that is repeated emits the same tree.
    dealt = index.repartition(n, "pos", "at").sortWithinPartitions("pos", "at", "fp")
    return common.map_arrow(dealt, _links, "a long, b long", bits)


def groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS
) -> DataFrame:
    """One row per document: ``_file``, ``_row``, ``_id``, ``fp``, ``component_id`` and whether it is ``first``.

    ``first`` marks the one row of each group that stays: the smallest id, then the first of repeated rows.
    """
    rows = common.keyed(docs, _id=id, _text=text)
    kind = rows.schema["_id"].dataType.simpleString()
    prints = common.stored(
        common.map_arrow(rows, _simhashes, f"_file long, _row long, _id {kind}, fp long", shingle), "simhash"
    )
    total = prints.count()
    own = F.struct(F.col("_id").isNull().alias("m"), F.col("_id").alias("i"),
                   F.col("_file").alias("f"), F.col("_row").alias("r"))
    nodes = common.stored(prints.groupBy("fp").agg(F.count("*").alias("copies"), F.min(own).alias("low")), "nodes")
    roots = graph.components(links(nodes, bits), "links")
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "copies", "low", F.coalesce("root", "fp").alias("root")
    )
    rooted = common.stored(rooted, "roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("least"), F.count("*").alias("members"))
    named = common.attach(rooted.select("fp", "copies", "root"), lowest, ["root"], "members", total)
    return common.attach(prints, named.drop("members", "root"), ["fp"], "copies", total).select(
        "_file", "_row", "_id", "fp", F.col("least.i").alias("component_id"),
        ((F.col("least.f") == F.col("_file")) & (F.col("least.r") == F.col("_row"))).alias("first"),
    )


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with all its columns."""
    docs = common.rooted(docs)
    kept = groups(docs, id, text).filter("first").select("_file", "_row")
    return common.whole_rows(docs, text).join(kept, ["_file", "_row"], "left_semi").select("doc.*")
