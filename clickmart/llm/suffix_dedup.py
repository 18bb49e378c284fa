"""Removal of long passages that documents with smaller ids also have, by run-length indexes of repetitive text.

Every window of ``LENGTH`` bytes has an anchor: the smallest hash among its grams of ``GRAM`` bytes. Equal windows have
equal anchors, wherever they stand, so neighbouring windows with one anchor travel together as a piece, and a window
only needs to be sought among pieces with its anchor.

1. Documents are packed into shards. Every shard sends its distinct anchors to buckets, which answer with those
   that at least two documents have; most text ends here.
2. Shards send the distinct pieces of those anchors, each with the smallest id that has it. A bucket combines equal
   pieces. Where an anchor has several different pieces, a run-length index (run-compressed Burrows-Wheeler transform
   with sampled run ends) is built over them, matching statistics of all pieces are streamed against it, and matches
   of ``LENGTH`` or more tell each window's smallest id.
3. Shards get back which windows occur in a document with a smaller id, and cover them.

Equal pieces meet in each shard before they are sent, so a passage that many documents share arrives once per shard.
An anchor with ``HOT`` pieces or more (the distinct ones of each shard, added up) is split, however few documents they are
from: its distinct windows are sent one by one, whole, with their smallest id, to buckets by a hash, and compared byte by
byte there. So no index is built over more than 20,000 and ``HOT`` pieces.

Defined results: ids are integers; a missing id is larger than all others, and equal ids are not smaller than each other, so
repeated rows do not remove each other. A missing text is empty; texts shorter than ``LENGTH`` stay whole. An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .run_index import RunIndex

LENGTH = 50
GRAM = 24
#: Pieces with one anchor, from which on its windows go one by one.
HOT = 10_000
#: Pieces of a shard with one anchor, from which on they are told apart to be counted.
MANY = 16
#: Bytes of text in a shard, unless one document is longer.
SHARD = 8 << 20
#: Buckets for each shuffle partition.
BUCKETS = 4
#: Windows hashed at a time.
STRETCH = 1 << 16

NO_ID = np.iinfo(np.int64).max
_FACTOR = 0x9E3779B97F4A7C15


# Windows of a text


def gram_hashes(data: np.ndarray, size: int, factor: int = _FACTOR) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on, by doubling."""
    part, length = data.astype(np.uint64) + np.uint64(1), 1
    found, have = None, 0
    while size:
        if size & 1:
            if found is None:
                found, have = part, length
            else:
                n = len(data) - have - length + 1
                found = found[:n] * np.uint64(pow(factor, length, 1 << 64)) + part[have : have + n]
                have += length
        size >>= 1
        if size:
            part = part[:-length] * np.uint64(pow(factor, length, 1 << 64)) + part[length:]
            length *= 2
    found = found ^ (found >> np.uint64(29))
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(32))


def pieces(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows with one anchor: first window, number of windows (at most a gram's reach), anchor.

    ``ends`` are the ends of the documents in ``data``; no window crosses one.
    """
    width = LENGTH - GRAM + 1
    out = []
    for begin in range(0, len(data) - LENGTH + 1, STRETCH):
        least = gram_hashes(data[begin : begin + STRETCH + LENGTH - 1], GRAM)
        length = 1
        while 2 * length <= width:
            least, length = np.minimum(least[:-length], least[length:]), 2 * length
        if length < width:
            least = np.minimum(least[: length - width], least[width - length :])
        inside = np.ones(len(least), bool)
        near = ends[np.searchsorted(ends, begin) : np.searchsorted(ends, begin + len(least) + LENGTH)] - begin
        over = (near[:, None] - np.arange(1, LENGTH)).ravel()
        inside[over[(over >= 0) & (over < len(least))]] = False
        # Between windows of two documents there is always one that crosses their edge.
        change = np.empty(len(least), bool)
        change[0] = True
        np.not_equal(least[1:], least[:-1], out=change[1:])
        change[1:] |= inside[1:] != inside[:-1]
        first = np.flatnonzero(change)
        windows = np.diff(first, append=len(least))
        whole = inside[first]
        first, windows = first[whole], windows[whole]
        parts = -(-windows // width)
        anchor = least[first]
        if (parts > 1).any():
            number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            anchor, first = np.repeat(anchor, parts), np.repeat(first, parts) + number * width
            windows = np.minimum(np.repeat(windows, parts) - number * width, width)
        out.append((first + begin, windows, anchor >> np.uint64(8)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


# Shards


def _sharded(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    files, rows, ids, data, held = [], [], [], [], 0
    coder = zstandard.ZstdCompressor(level=1)

    def shard() -> pa.RecordBatch:
        nonlocal held
        values = [
            pa.array([files[0]], pa.int64()), pa.array([rows[0]], pa.int64()), pa.array([files], pa.list_(pa.int64())),
            pa.array([rows], pa.list_(pa.int64())), pa.array([ids], pa.list_(pa.int64())),
            pa.array([[len(d) for d in data]], pa.list_(pa.int64())),
            pa.array([coder.compress(b"".join(data))], pa.binary()),
        ]
        for column in (files, rows, ids, data):
            column.clear()
        held = 0
        return pa.RecordBatch.from_arrays(values, names=["s1", "s2", "files", "rows", "ids", "lengths", "data"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("_file", "_row", "_id")]
        for file, row, id, text in zip(*columns, common.texts(batch.column("_text")), strict=True):
            files.append(file)
            rows.append(row)
            ids.append(id)
            data.append(text.encode())
            held += len(data[-1])
            if held >= size:
                yield shard()
    if files:
        yield shard()


class _Shard:
    """A shard's documents: rank (id, or NO_ID) and bytes of each."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        self.s1, self.s2 = batch.column("s1")[i].as_py(), batch.column("s2")[i].as_py()
        self.files, self.rows, self.ids = (batch.column(c)[i].values for c in ("files", "rows", "ids"))
        self.ranks = self.ids.fill_null(NO_ID).to_numpy()
        lengths = batch.column("lengths")[i].values.to_numpy()
        self.ends = np.cumsum(lengths)
        self.begins = self.ends - lengths
        total = int(lengths.sum())
        packed = batch.column("data")[i].as_py()
        self.data = zstandard.ZstdDecompressor().decompress(packed, max_output_size=max(1, total)) if total else b""
        self.array = np.frombuffer(self.data, np.uint8)

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All pieces, and the number of the document of each."""
        first, windows, anchor = pieces(self.array, self.ends)
        return first, windows, anchor, np.searchsorted(self.ends, first, "right")


def _message(shards: list, buckets: list, kinds: list, data: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array([s[0] for s in shards], pa.int64()),
         pa.array([s[1] for s in shards], pa.int64()), pa.array(kinds, pa.int32()), pa.array(data, pa.binary())],
        names=["bucket", "s1", "s2", "kind", "data"],
    )


MESSAGE = "bucket int, s1 long, s2 long, kind int, data binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers, their bytes by place, compressed."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(numbers)) + planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    body = zstandard.ZstdDecompressor().decompress(data)
    n = struct.unpack_from("<I", body)[0]
    return np.ascontiguousarray(np.frombuffer(body, np.uint8, 8 * n, 4).reshape(8, n).T).view(np.uint64).reshape(-1)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places of its entries, in their order."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.r_[True, bucket[order][1:] != bucket[order][:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _distinct_pieces(shard: _Shard, first: np.ndarray, windows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """For each distinct anchor, in order, the number of its different pieces; fewer than MANY count as different."""
    order = np.argsort(anchor, kind="stable")
    begins = np.flatnonzero(np.append(True, anchor[order][1:] != anchor[order][:-1]))
    count = np.diff(begins, append=len(order))
    for k in np.flatnonzero(count >= MANY):
        own = order[begins[k] : begins[k] + count[k]]
        ends = first[own] + windows[own] + LENGTH - 1
        count[k] = len({shard.data[a:b] for a, b in zip(first[own].tolist(), ends.tolist(), strict=True)})
    return count


def _anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of a shard, each with the number of its documents in the low byte (at most 255), and then the
    numbers of their pieces."""
    for batch in batches:
        for i in range(batch.num_rows):
            shard = _Shard(batch, i)
            starts, windows, anchor, doc = shard.pieces()
            if len(anchor):
                pieces_of = _distinct_pieces(shard, starts, windows, anchor).astype(np.uint64)
                # Once per document, then with the number of documents.
                order = np.lexsort((doc, anchor))
                anchor, doc = anchor[order], doc[order]
                again = (anchor[1:] == anchor[:-1]) & (doc[1:] == doc[:-1])
                anchor = anchor[np.append(True, ~again)]
                first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
                found, count = anchor[first], np.diff(first, append=len(anchor))
                packed = found << np.uint64(8) | np.minimum(count, 255).astype(np.uint64)
                parts = list(_by_bucket((found % np.uint64(buckets)).astype(np.int64)))
                yield _message([(shard.s1, shard.s2)] * len(parts), [b for b, _ in parts], [0] * len(parts),
                               [_packed(np.concatenate([packed[at], pieces_of[at]])) for _, at in parts])


def _per_bucket(
    batches: Iterator[pa.RecordBatch], answer: Callable[[list], Iterator[tuple]]
) -> Iterator[pa.RecordBatch]:
    """Answers to the messages of each bucket; messages arrive bucket by bucket."""
    held: list[tuple] = []

    def answers() -> Iterator[pa.RecordBatch]:
        found = list(answer(held))
        for some in range(0, len(found), 256):
            part = found[some : some + 256]
            yield _message([m[1:3] for m in part], [m[0] for m in part], [m[3] for m in part], [m[4] for m in part])

    for batch in batches:
        for message in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            if held and held[0][0] != message[0]:
                yield from answers()
                held = []
            held.append(message)
    if held:
        yield from answers()


def _repeated(messages: list[tuple], hot: int) -> Iterator[tuple]:
    """For each shard its anchors that two documents or more have; the low byte is 1 if they are hot."""
    sent, numbers = zip(*(np.split(_unpacked(m[4]), 2) for m in messages), strict=True)
    every = np.concatenate(sent)
    found, at = np.unique(every >> np.uint64(8), return_inverse=True)
    count = np.bincount(at, weights=(every & np.uint64(255)).astype(np.float64))
    pieces_of = np.bincount(at, weights=np.concatenate(numbers).astype(np.float64))
    answer = found << np.uint64(8) | (pieces_of >= hot).astype(np.uint64)
    end = 0
    for message, own in zip(messages, sent, strict=True):
        begin, end = end, end + len(own)
        mine = at[begin:end]
        mine = mine[count[mine] >= 2]
        if len(mine):
            yield (*message[:4], _packed(answer[mine]))


class _Candidates:
    """A shard's pieces and windows to be judged, the same in every run.

    ``texts``: distinct pieces, with ``ranks``, the smallest rank of each, and ``anchors``; ``doc``, ``first``,
    ``windows`` and ``number`` of every piece. ``single``: places of the distinct windows of hot anchors, with ``single_hash`` and
    ``single_rank``; ``single_doc``, ``single_at`` and ``single_of`` of every such window. Places are those in the shard.
    """

    def __init__(self, shard: _Shard, answers: list[bytes]) -> None:
        known = np.sort(np.concatenate([np.zeros(0, np.uint64), *map(_unpacked, answers)]))
        anchors, hot = known >> np.uint64(8), (known & np.uint64(1)).astype(bool)
        first, windows, anchor, doc = shard.pieces() if len(known) else [np.zeros(0, np.int64)] * 4
        at = np.minimum(np.searchsorted(anchors, anchor), max(0, len(anchors) - 1))
        wanted = np.flatnonzero(anchors[at] == anchor) if len(known) else first
        is_hot = hot[at[wanted]]
        plain = wanted[~is_hot]
        self.first, self.windows, self.doc = first[plain], windows[plain], doc[plain]
        ends = self.first + self.windows + LENGTH - 1
        data = shard.data
        texts = [data[a:b] for a, b in zip(self.first.tolist(), ends.tolist(), strict=True)]
        numbers = {text: i for i, text in enumerate(dict.fromkeys(texts))}
        self.texts = list(numbers)
        self.number = np.fromiter(map(numbers.__getitem__, texts), np.int64, len(texts))
        self.ranks = np.full(len(self.texts), NO_ID)
        np.minimum.at(self.ranks, self.number, shard.ranks[self.doc])
        self.anchors = np.zeros(len(self.texts), np.uint64)
        self.anchors[self.number] = anchor[plain]
        alone = wanted[is_hot]
        n = windows[alone]
        self.single_at = np.repeat(first[alone] - np.cumsum(n) + n, n) + np.arange(n.sum())
        self.single_doc = np.repeat(doc[alone], n)
        hashes, places = np.empty(len(self.single_at), np.uint64), np.arange(LENGTH)

        def window(at: np.ndarray) -> np.ndarray:
            return shard.array[self.single_at[at][:, None] + places]

        for i in range(0, len(hashes), STRETCH):
            hashes[i : i + STRETCH] = window_hashes(window(np.arange(i, min(len(hashes), i + STRETCH))))
        first, self.single_of = _distinct(hashes, window)
        self.single, self.single_hash = self.single_at[first], hashes[first]
        self.single_rank = np.full(len(first), NO_ID)
        np.minimum.at(self.single_rank, self.single_of, shard.ranks[self.single_doc])


def window_hashes(windows: np.ndarray) -> np.ndarray:
    """Hash of each row of bytes."""
    powers = np.array([pow(_FACTOR, LENGTH - 1 - i, 1 << 64) for i in range(LENGTH)], np.uint64)
    out = ((windows.astype(np.uint64) + np.uint64(1)) * powers).sum(1, dtype=np.uint64)
    out ^= out >> np.uint64(31)
    return out * np.uint64(0x94D049BB133111EB)


def _distinct(hashes: np.ndarray, window: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One of each distinct window, ordered by hash, and the number of each window's.

    Windows with one hash are compared byte by byte; where some differ, their bytes tell them apart.
    """
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    equal = np.flatnonzero(ordered[1:] == ordered[:-1])
    differ = [equal[:0]]
    for i in range(0, len(equal), STRETCH):
        some = equal[i : i + STRETCH]
        differ.append(some[(window(order[some]) != window(order[some + 1])).any(1)])
    told = np.zeros(len(hashes), np.int64)
    if len(clash := np.concatenate(differ)):
        among = np.flatnonzero(np.isin(hashes, ordered[clash]))
        texts = [row.tobytes() for row in window(among)]
        number = {text: i for i, text in enumerate(sorted(set(texts)))}
        told[among] = [number[text] for text in texts]
        order = np.lexsort((told, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (told[order][1:] != told[order][:-1])
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def _piece_buckets(found: _Candidates, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    yield from _by_bucket((found.anchors % np.uint64(buckets)).astype(np.int64))


def _window_buckets(found: _Candidates, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    yield from _by_bucket((found.single_hash % np.uint64(buckets)).astype(np.int64))


def _sent(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Pieces (kind 0) and windows (kind 1) of a shard, to their buckets."""
    coder = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for i in range(batch.num_rows):
            shard = _Shard(batch, i)
            found = _Candidates(shard, batch.column("answers")[i].as_py() or [])
            texts, ranks = found.texts, found.ranks
            out: list[tuple[int, int, bytes]] = []
            for bucket, at in _piece_buckets(found, buckets):
                own = [texts[k] for k in at]
                steps = np.diff(ranks[at], prepend=0)
                body = b"".join([struct.pack("<I", len(own)), steps.tobytes(), bytes(map(len, own)), *own])
                out.append((bucket, 0, coder.compress(body)))
            for bucket, at in _window_buckets(found, buckets):
                body = struct.pack("<I", len(at)) + found.single_rank[at].tobytes()
                body += shard.array[found.single[at][:, None] + np.arange(LENGTH)].tobytes()
                out.append((bucket, 1, coder.compress(body)))
            for some in range(0, len(out), 256):
                part = out[some : some + 256]
                yield _message([(shard.s1, shard.s2)] * len(part), [m[0] for m in part], [m[1] for m in part],
                               [m[2] for m in part])


def _judged(messages: list[tuple]) -> Iterator[tuple]:
    """Per piece a bit for each window, per window a byte: whether a smaller rank has it, too."""
    opened = [zstandard.ZstdDecompressor().decompress(m[4]) for m in messages]
    of_piece: dict[bytes, int] = {}
    pieces_sent, windows_sent = [], []
    for message, body in zip(messages, opened, strict=True):
        n = struct.unpack_from("<I", body)[0]
        rank = np.frombuffer(body, np.int64, n, 4)
        if message[3]:
            windows_sent.append((message, rank, np.frombuffer(body, np.uint8, n * LENGTH, 4 + 8 * n).reshape(n, LENGTH)))
            continue
        ends = 4 + 9 * n + np.cumsum(np.frombuffer(body, np.uint8, n, 4 + 8 * n), dtype=np.int64)
        edges, add = [4 + 9 * n, *ends.tolist()], of_piece.setdefault
        number = [add(body[a:b], len(of_piece)) for a, b in zip(edges, edges[1:], strict=False)]
        pieces_sent.append((message, np.cumsum(rank), np.array(number, np.int64)))
    del opened
    smallest = np.full(len(of_piece), NO_ID)
    for _, rank, number in pieces_sent:
        np.minimum.at(smallest, number, rank)
    elsewhere = _elsewhere(list(of_piece), smallest)
    whole = np.array([(1 << len(t) - LENGTH + 1) - 1 for t in of_piece], np.uint32)
    for message, rank, number in pieces_sent:
        found = np.where(rank > smallest[number], whole[number], elsewhere[number]) if len(number) else whole
        yield (*message[:4], found.astype("<u4").tobytes())
    if windows_sent:
        windows, ranks = (np.concatenate([w[k] for w in windows_sent]) for k in (2, 1))
        first, of = _distinct(np.concatenate([window_hashes(w[2]) for w in windows_sent]), windows.__getitem__)
        low = np.full(len(first), NO_ID)
        np.minimum.at(low, of, ranks)
        found, end = (ranks > low[of]).astype(np.uint8), 0
        for message, rank, *_ in windows_sent:
            begin, end = end, end + len(rank)
            yield (*message[:4], found[begin:end].tobytes())


def _anchors_of(texts: list[bytes]) -> np.ndarray:
    """Anchor of each piece: the smallest hash among the grams of its first window."""
    lengths = np.array(list(map(len, texts)))
    begins = np.cumsum(lengths) - lengths
    hashes = gram_hashes(np.frombuffer(b"".join(texts), np.uint8), GRAM)
    edges = np.column_stack([begins, begins + LENGTH - GRAM + 1]).ravel()
    return np.minimum.reduceat(np.append(hashes, hashes[-1:]), edges)[::2] >> np.uint64(8)


def _elsewhere(texts: list[bytes], ranks: np.ndarray) -> np.ndarray:
    """For each distinct piece the windows (as bits) that another piece with a smaller rank has."""
    out = np.zeros(len(texts), np.uint32)
    if not len(texts):
        return out
    anchors = _anchors_of(texts)
    order = np.argsort(anchors, kind="stable")
    new = np.r_[True, anchors[order][1:] != anchors[order][:-1]]
    size = np.diff(np.r_[np.flatnonzero(new), len(order)])
    several = order[np.repeat(size, size) > 1]
    # Whole anchors at a time, so that an index stays small.
    group = anchors[several]
    begin = 0
    while begin < len(several):
        end = min(len(several), begin + 20_000)
        while end < len(several) and group[end] == group[end - 1]:
            end += 1
        part = several[begin:end]
        begin = end
        own = [texts[k] for k in part]
        index = RunIndex(own, ranks[part], LENGTH)
        rows, sizes, begins = index.matching_statistics(own)
        windows = np.array([len(t) - LENGTH + 1 for t in own])
        of = np.repeat(np.arange(len(own)), windows)
        bit = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
        place = begins[of] + bit
        smaller = (sizes[place] >= LENGTH) & (index.smallest_owner(rows[place]) < ranks[part][of])
        np.bitwise_or.at(out, part[of[smaller]], np.uint32(1) << bit[smaller].astype(np.uint32))
    return out


def _covered(
    batches: Iterator[pa.RecordBatch], buckets: int, with_texts: bool
) -> Iterator[pa.RecordBatch]:
    """Per document what is removed."""
    for batch in batches:
        for i in range(batch.num_rows):
            shard = _Shard(batch, i)
            found = _Candidates(shard, batch.column("answers")[i].as_py() or [])
            judged = {(v["bucket"], v["kind"]): v["data"] for v in batch.column("judged")[i].as_py() or []}
            bits = np.zeros(len(found.ranks), np.uint32)
            for bucket, at in _piece_buckets(found, buckets):
                bits[at] = np.frombuffer(judged[bucket, 0], "<u4")
            single = np.zeros(len(found.single_rank), bool)
            for bucket, at in _window_buckets(found, buckets):
                single[at] = np.frombuffer(judged[bucket, 1], np.uint8)
            # Windows that a smaller rank has: a later document of the shard has all of a piece's.
            flags = np.zeros(len(shard.array) + 1, bool)
            whole = ((np.int64(1) << found.windows) - 1).astype(np.uint32)
            later = shard.ranks[found.doc] > found.ranks[found.number]
            mine = np.where(later, whole, bits[found.number])
            some = np.flatnonzero(mine)
            mine, first = mine[some], found.first[some]
            for bit in range(LENGTH - GRAM + 1):
                flags[first[(mine >> np.uint32(bit) & np.uint32(1)).astype(bool)] + bit] = True
            later = shard.ranks[found.single_doc] > found.single_rank[found.single_of]
            flags[found.single_at[later | single[found.single_of]]] = True
            # Each flagged window covers LENGTH bytes; no window crosses a document's edge.
            cover = np.zeros(len(flags) + LENGTH, np.int8)
            cover[: len(flags)] = flags
            cover[LENGTH:] -= flags
            removed = np.cumsum(cover, dtype=np.int32)[: len(shard.array)] > 0
            rows = []
            for a, b in zip(shard.begins.tolist(), shard.ends.tolist(), strict=True):
                gone = removed[a:b]
                n = int(gone.sum())
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if n else 0
                kept = shard.array[a:b][~gone].tobytes() if n else shard.data[a:b]
                rows.append((b - a, n, spans, kept.decode(errors="ignore") if with_texts else hashlib.sha256(kept).hexdigest()))
            n_bytes, n_removed, n_spans, kept = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [shard.files, shard.rows, shard.ids, pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(n_spans, pa.int64()), pa.array(kept, pa.string())],
                names=["_file", "_row", "_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def removals(
    docs: DataFrame, id: str = "doc_id", text: str = "text", with_texts: bool = False, hot: int = HOT, size: int = SHARD
) -> DataFrame:
    """Per document: ``_file``, ``_row``, ``_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the sha256 of the
    bytes that stay, or with ``with_texts`` their text (bytes of a character that is cut go)."""
    n = common.partitions(docs.sparkSession)
    buckets = BUCKETS * n
    rows = common.keyed(docs, _id=F.col(id).cast("long"), _text=text)
    shards = common.stored(
        common.map_arrow(
            rows, _sharded,
            "s1 long, s2 long, files array<long>, rows array<long>, ids array<long>, lengths array<long>, data binary",
            size,
        ), "shards",
    )

    def ask(messages: DataFrame, answer: Callable) -> DataFrame:
        dealt = messages.repartition(n, "bucket").sortWithinPartitions("bucket", "kind", "s1", "s2")
        return common.map_arrow(dealt, _per_bucket, MESSAGE, answer)

    key = ["s1", "s2"]
    # One exchange of the shards and one of the answers serve both later steps, as both join them alike.
    spread = shards.repartition(n, *key)
    repeated = ask(common.map_arrow(shards, _anchors, MESSAGE, buckets), partial(_repeated, hot=hot))
    answers = repeated.groupBy(*key).agg(F.collect_list("data").alias("answers"))
    with_answers = spread.join(answers, key, "left")
    judged = ask(
        common.map_arrow(with_answers, _sent, MESSAGE, buckets), _judged
    )
    results = judged.groupBy(*key).agg(F.collect_list(F.struct("bucket", "kind", "data")).alias("judged"))
    return common.map_arrow(
        with_answers.join(results, key, "left"), _covered,
        "_file long, _row long, _id long, n_bytes long, n_removed long, n_spans long, "
        "kept string", buckets, with_texts,
    )


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows with all their columns; the text is what stays of it."""
    docs = common.rooted(docs)
    kept = removals(docs, id, text, with_texts=True).select("_file", "_row", F.col("kept"))
    rest = common.keyed(docs, doc=F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != text]))
    both = rest.join(kept, ["_file", "_row"])
    return both.select(
        *[(F.col("kept") if c == text else F.col("doc").getField(c)).alias(c) for c in docs.columns]
    )
