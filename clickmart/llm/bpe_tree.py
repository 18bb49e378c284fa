"""Byte-level BPE by tree reduction: halves are encoded apart and joined where they meet.

Two levels use the same idea. A text is cut into words (matches of a pattern) by halves: matches of a half keep
their places except near the cut, so the last matches of the left and the first of the right half are found again
over a window that grows until a match boundary falls on one of the right half; the pattern never looks back,
so all further matches stay. The last two matches of a window are not trusted, as the pattern looks ahead.

The bytes of a word are encoded by halves: the last tokens of the left and the first of the right half are encoded
again as one window that grows until the tokens at both its edges are compatible with their outer neighbours, that
is, encoding the bytes of the two neighbours together gives the two again. A sequence in which all neighbours are
compatible is the encoding of its bytes, so tokens outside the window are proven stable.

Decoding concatenates the bytes of tokens up the same tree. Texts are whole; the parts of a very long one are held
once, and a window only covers what is near a cut.

Defined results: a missing text is empty and has no ids. Every row is encoded for itself, so repeated rows, ties and
empty tables need nothing special.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: Characters (tokens) that a leaf of the text (decoding) tree has at most.
LEAF = 4096
#: Bytes of a window that are merged without a heap, and what long words are cut at multiples of.
SHORT, ALIGNED = 48, 4096
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its rank per line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Codec:
    """Encoder and decoder for the ranks of a file and the pattern that cuts texts into words."""

    def __init__(self, path: str, pattern: str, most: int = 300_000) -> None:
        self.ranks = load_ranks(path)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        # White space as in the library that the ranks are made for.
        self.find = regex.compile(pattern.replace(r"[^\s", "[^" + WHITE[1:-1]).replace(r"\s", WHITE).replace(
            r"\S", "[^" + WHITE[1:])).findall
        self.compatible = lru_cache(1 << 17)(self._compatible)
        self.known: dict[str, bytes] = {}
        self.seen = bytearray(1 << 22)
        self.most = most

    # Words of a text

    def words(self, text: str) -> list[str]:
        """Matches of the pattern, found by halves."""
        if len(text) <= LEAF:
            return self.find(text)
        half = len(text) // 2
        return self._join_words(self.words(text[:half]), self.words(text[half:]))

    def _join_words(self, left: list[str], right: list[str]) -> list[str]:
        back, ahead = 2, 4
        while True:
            tail, head = left[max(0, len(left) - back) :], right[:ahead]
            window = self.find("".join(tail) + "".join(head))
            whole = ahead >= len(right)
            # Boundaries of the right half, as places in the window.
            at, edges = sum(map(len, tail)), {}
            for i, word in enumerate(head):
                edges[at] = i
                at += len(word)
            if whole:
                edges[at] = len(head)
            place, trusted = 0, len(window) if whole else len(window) - 2
            for i in range(max(0, trusted) + 1):
                if place in edges and i <= trusted:
                    del left[len(left) - len(tail) :]
                    left += window[:i]
                    left += right[edges[place] :] if edges[place] else right
                    return left
                if i < len(window):
                    place += len(window[i])
            ahead *= 2

    # Tokens of a word

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of two neighbours together encode to the two."""
        return self._merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def _merged(self, data: bytes) -> list[int]:
        """Tokens of a window: the neighbours of the lowest rank merge until none has a rank."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > SHORT:
            return self._merged_by_heap(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks, none = self.ranks, 1 << 62
        pair = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while pair:
            low = min(pair)
            if low == none:
                break
            i = pair.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i < len(pair):
                pair[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merged_by_heap(self, data: bytes) -> list[int]:
        """The same for a long window; the time grows a little more than its length."""
        n, rank = len(data), self.ranks.get
        # Parts are named by where they begin; one that was taken up by the part before it ends nowhere.
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            j = end[i]
            if j < 0 or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := rank(data[i : end[stop]])) is not None:
                    heappush(heap, (r, i, end[stop]))
            j = before[i]
            if j >= 0 and (r := rank(data[j:stop])) is not None:
                heappush(heap, (r, j, stop))
        found, i = [], 0
        while i < n:
            found.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return found

    def tokens(self, data: bytes) -> list[int]:
        """Tokens of a word's bytes, encoded by halves."""
        if len(data) <= 8:
            return self._merged(data) if data else []
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        half = len(data) // 2
        if half > ALIGNED:
            # Runs of one sign have tokens of a power of two; cut between such tokens, halves fit at once.
            half -= half % ALIGNED
        return self._join_tokens(self.tokens(data[:half]), self.tokens(data[half:]))

    def _join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if self.compatible(left[-1], right[0]):
            return left + right
        a, b = len(left) - 1, 1
        while True:
            data = b"".join(map(self.bytes_of.__getitem__, [*left[a:], *right[:b]]))
            window = self._merged(data)
            grow_left = a and not self.compatible(left[a - 1], window[0])
            grow_right = b < len(right) and not self.compatible(window[-1], right[b])
            if not (grow_left or grow_right):
                return left[:a] + window + right[b:]
            size = len(left) - a + b
            if grow_left:
                a = max(0, a - size)
            if grow_right:
                b = min(len(right), b + size)

    # Whole texts

    def word_ids(self, word: str) -> bytes:
        ids = array("I", self.tokens(word.encode())).tobytes()
        place = hash(word) & 0x3FFFFF
        if self.seen[place] and len(word) <= 32 and len(self.known) < self.most:
            self.known[word] = ids
        self.seen[place] = 1
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        known, make = self.known.get, self.word_ids
        return b"".join([known(w) or make(w) for w in self.words(text)])

    def decode(self, ids: memoryview | list[int]) -> bytes:
        """The bytes of ids."""
        if len(ids) <= LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec for a file."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _coded(batches: Iterator[pa.RecordBatch], path: str, pattern: str, digest: bool) -> Iterator[pa.RecordBatch]:
    coder = codec(path, pattern)
    for whole in batches:
        for some in range(0, whole.num_rows, 200):
            batch = whole.slice(some, 200)
            ids = [coder.encode(t) for t in common.texts(batch.column("_text"))]
            columns = {"_id": batch.column("_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64())}
            decoded = [coder.decode(memoryview(x).cast("I")) for x in ids]
            if digest:
                columns["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())
            else:
                columns["ids"] = pa.array([memoryview(x).cast("I").tolist() for x in ids], pa.list_(pa.int32()))
                columns["decoded"] = pa.array(decoded, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def encode(
    docs: DataFrame, ranks: str, pattern: str, id: str = "doc_id", text: str = "text", digest: bool = False
) -> DataFrame:
    """Per document: ``_id``, ``n_tokens``, ``ids`` and ``decoded`` bytes; with ``digest`` their sha256 instead."""
    rows = docs.select(docs[id].alias("_id"), docs[text].alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    out = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded binary"
    return common.map_arrow(rows, _coded, f"_id {kind}, n_tokens long, {out}", ranks, pattern, digest)
