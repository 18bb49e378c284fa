"""Adaptive context-mixing range coder for token ids, in independent, checksummed blocks.

Three models predict the next id: order 2 and order 1 each name the id that last followed the two or one ids before,
with a confidence; order 0 is an adaptive distribution over all ids. Their predictions are mixed to one distribution
(each named id gets a share that grows with how often predictions of that confidence came true), and that
distribution drives a 64-bit range coder.

A block is coded in lanes: neighbouring stretches of its ids, each with a coder of its own, which advance in step and
share the models. So each step is a few array operations over all lanes. Models start anew in every block; any block
can be read, checked and repeated alone. All arithmetic is on integers, so reader and writer agree on any machine.

Block: ``MAGIC``, then little-endian u32 version, ids, lanes, vocabulary, crc32 of the ids, crc32 of the rest; per
lane u32 number of words; then the words (u32) of one lane after the other.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMRC"
VERSION = 1
HEADER = struct.Struct("<4s6I")

#: Ids a lane has at least, and lanes a block has at most.
LANE, LANES = 256, 8192
#: Shares of the three models sum to 2**SHARE; contexts of order 2 are hashed to 2**CONTEXT places.
SHARE, CONTEXT = 10, 18
#: Confidence of a prediction: 0 to LEVELS - 1.
LEVELS = 8
#: What is added to a confidence after a miss and after a hit.
CHANGE = np.array([x for c in range(LEVELS) for x in (c // 2 - c, int(c < LEVELS - 1))], np.int64)
#: Order 0 adds STEP to the count of an id, and halves all counts until they are MOST in total at most.
STEP, MOST = 8, 9 << 17
#: The shared statistics take up what was seen after these first steps, and then after every so many.
FIRST, EVERY = (1, 2, 4, 8), 16

#: A lane gives out its upper 32 bits when its range falls below this.
BOTTOM = np.uint64(1 << 32)
WORD = np.uint64(32)


class Corrupt(ValueError):
    """A block that is damaged."""


class _Model:
    """What reader and writer know after the same ids."""

    def __init__(self, vocabulary: int, lanes: int) -> None:
        self.size = vocabulary
        self.counts = np.ones(vocabulary, np.int32)
        # The id that last followed a context, times LEVELS, plus the confidence.
        self.next1, self.next2 = np.zeros(vocabulary, np.int32), np.zeros(1 << CONTEXT, np.int32)
        self.before1, self.before2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        # Per confidence: tries and hits of order 2, and of order 1 where order 2 failed, from a mild start.
        self.tries = np.full((2, LEVELS), 64, np.int64)
        self.hits = 8 * np.arange(1, LEVELS + 1)[None, :] * np.ones((2, 1), np.int64)
        self.outcomes = np.zeros(4 * LEVELS * LEVELS, np.int64)
        self.steps, self.pending = 0, []
        self._settle()

    def _settle(self) -> None:
        while self.counts.sum() > MOST:
            self.counts = (self.counts + 1) >> 1
        self.low = np.zeros(self.size + 1, np.int32)
        np.cumsum(self.counts, out=self.low[1:])
        self.total = int(self.low[-1])
        whole = 1 << SHARE
        rate = np.clip(self.hits * whole // self.tries, 4, whole - 4)
        second = np.repeat(rate[0], LEVELS)
        first = (whole - second) * np.tile(rate[1], LEVELS) >> SHARE
        self.share0 = whole - second - first
        self.mass2, self.mass1 = second * self.total, first * self.total
        self.unit = np.uint64(self.total << SHARE)
        self.symbols = None

    def symbol(self, count: np.ndarray) -> np.ndarray:
        """The id to which a place in the order-0 counts belongs."""
        if self.symbols is None:
            self.symbols = np.repeat(np.arange(self.size, dtype=np.int32), self.counts)
        return self.symbols.take(count)

    def predict(self) -> tuple[np.ndarray, ...]:
        """Ids named by order 2 and 1, what their shares weigh, and the share of order 0."""
        self.place = (self.before2 * 40503 ^ self.before1 * 9973) & ((1 << CONTEXT) - 1)
        self.found2 = self.next2.take(self.place).astype(np.int64)
        self.found1 = self.next1.take(self.before1).astype(np.int64)
        self.named2, self.named1 = self.found2 >> 3, self.found1 >> 3
        self.sure2, self.sure1 = self.found2 & 7, self.found1 & 7
        share = self.share = self.sure2 << 3 | self.sure1
        return self.named2, self.named1, self.mass2.take(share), self.mass1.take(share), self.share0.take(share)

    def learn(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """The ids of a step, and where the named ids came true."""
        fresh = ids << 3
        for place, found, sure, hit, table in (
            (self.place, self.found2, self.sure2, hit2, self.next2),
            (self.before1, self.found1, self.sure1, hit1, self.next1),
        ):
            # One up where the id came true, else halved; an id without confidence gives way.
            after = found + CHANGE.take(sure << 1 | hit)
            gone = np.flatnonzero(sure + hit == 0)
            after[gone] = fresh.take(gone)
            table[place] = after
        self.pending.append(ids)
        # Confidences and outcomes of both orders as one number per lane.
        self.outcomes += np.bincount(self.share << 2 | hit2 << 1 | hit1, minlength=4 * LEVELS * LEVELS)
        self.steps += 1
        if self.steps in FIRST or self.steps % EVERY == 0:
            of2, of1 = self.outcomes.reshape(LEVELS, LEVELS, 2, 2).sum(1), self.outcomes.reshape(LEVELS, LEVELS, 2, 2).sum(0)
            self.tries[0] += of2.sum((1, 2))
            self.hits[0] += of2[:, 1].sum(1)
            self.tries[1] += of1[:, 0].sum(1)
            self.hits[1] += of1[:, 0, 1]
            self.outcomes[:] = 0
            self.counts += (STEP * np.bincount(np.concatenate(self.pending), minlength=self.size)).astype(np.int32)
            self.pending = []
            self._settle()
        self.before2, self.before1 = self.before1, ids


def _lanes(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // LANE))
    return lanes, -(-n // lanes)


def _narrowed(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lanes with too small a range: which, their lower ends, and ranges that share the upper 32 bits."""
    out = np.flatnonzero(span < BOTTOM)
    a, b = low.take(out), span.take(out)
    to_edge = BOTTOM - (a & (BOTTOM - np.uint64(1)))
    return out, a, np.minimum(b, to_edge)


def encode(ids: np.ndarray, vocabulary: int) -> bytes:
    """A block with the ids."""
    n = len(ids)
    if n and not 0 <= int(ids.min()) <= int(ids.max()) < vocabulary:
        raise ValueError("an id lies outside the vocabulary")
    lanes, steps = _lanes(n)
    padded = np.zeros(lanes * steps, np.int64)
    padded[:n] = ids
    columns = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    model = _Model(vocabulary, lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    who, words = [], []
    for x in columns if n else ():
        named2, named1, mass2, mass1, share0 = model.predict()
        hit2, hit1 = named2 == x, named1 == x
        start = model.low.take(x) * share0
        start += mass2 * (named2 < x)
        start += mass1 * (named1 < x)
        width = model.counts.take(x) * share0
        width += mass2 * hit2
        width += mass1 * hit1
        span //= model.unit
        low += start.view(np.uint64) * span
        span *= width.view(np.uint64)
        out, a, b = _narrowed(low, span)
        who.append(out.astype(np.uint16))
        words.append((a >> WORD).astype("<u4"))
        low[out], span[out] = a << WORD, b << WORD
        model.learn(x, hit2, hit1)
    who.append(np.arange(lanes, dtype=np.uint16))
    words.append(((low + (BOTTOM - np.uint64(1))) >> WORD).astype("<u4"))
    who, words = np.concatenate(who), np.concatenate(words)
    per_lane = np.bincount(who, minlength=lanes).astype("<u4")
    body = per_lane.tobytes() + words[np.argsort(who, kind="stable")].tobytes()
    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
    return HEADER.pack(MAGIC, VERSION, n, lanes, vocabulary, crc, zlib.crc32(body)) + body


def decode(block: bytes) -> np.ndarray:
    """The ids of a block; raises ``Corrupt`` if a checksum fails."""
    try:
        magic, version, n, lanes, vocabulary, crc, body_crc = HEADER.unpack_from(block)
    except struct.error as error:
        raise Corrupt("too short for a block") from error
    body = memoryview(block)[HEADER.size :]
    if magic != MAGIC or version != VERSION or zlib.crc32(body) != body_crc:
        raise Corrupt("not a whole block")
    lanes_, steps = _lanes(n)
    if lanes != lanes_:
        raise Corrupt("lanes do not fit the number of ids")
    per_lane = np.frombuffer(body, "<u4", lanes).astype(np.int64)
    end = np.cumsum(per_lane)
    at = end - per_lane
    # A word past the end of a lane is zero.
    words = np.insert(np.frombuffer(body, "<u4", offset=4 * lanes), end, 0).astype(np.uint64)
    at += np.arange(lanes)

    model = _Model(vocabulary, lanes)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    code = words.take(at) << WORD | words.take(at + 1)
    last = end + np.arange(lanes)
    at = np.minimum(at + 2, last)
    columns = np.zeros((steps if n else 0, lanes), np.int64)
    for k in range(len(columns)):
        named2, named1, mass2, mass1, share0 = model.predict()
        span //= model.unit
        target = np.minimum((code - low) // span, model.unit - np.uint64(1)).view(np.int64)
        # A named id's share follows its order-0 part, so shares of smaller named ids stand before the target.
        over2 = target - model.low.take(named2 + 1) * share0
        over1 = target - model.low.take(named1 + 1) * share0
        first2 = named2 <= named1
        before = np.minimum(np.maximum(over1, 0), mass1)
        before[first2] = 0
        over2 -= before
        before = np.minimum(np.maximum(over2, 0), mass2)
        before *= first2
        over1 -= before
        # As unsigned numbers, places before a share are beyond it.
        in2 = over2.view(np.uint64) < mass2.view(np.uint64)
        in1 = over1.view(np.uint64) < mass1.view(np.uint64)
        x = np.where(in2, named2, named1)
        plain = np.flatnonzero(~(in2 | in1))
        rest = target.take(plain)
        rest -= mass2.take(plain) * (over2.take(plain) >= 0)
        rest -= mass1.take(plain) * (over1.take(plain) >= 0)
        x[plain] = model.symbol(rest // share0.take(plain))
        hit2, hit1 = named2 == x, named1 == x
        start = model.low.take(x) * share0
        start += mass2 * (named2 < x)
        start += mass1 * (named1 < x)
        width = model.counts.take(x) * share0
        width += mass2 * hit2
        width += mass1 * hit1
        low += start.view(np.uint64) * span
        span *= width.view(np.uint64)
        out, a, b = _narrowed(low, span)
        place = at.take(out)
        code[out] = code.take(out) << WORD | words.take(place)
        at[out] = np.minimum(place + 1, last.take(out))
        low[out], span[out] = a << WORD, b << WORD
        columns[k] = x
        model.learn(x, hit2, hit1)
    ids = np.ascontiguousarray(columns.T).reshape(-1)[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise Corrupt("the ids do not have the block's checksum")
    return ids
