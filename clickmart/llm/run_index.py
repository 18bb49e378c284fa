"""Run-length index of repetitive strings: run-compressed Burrows-Wheeler transform with sampled run ends.

The transform of all strings (each ended by a separator) is kept as its runs: the character and first row of each, where
its first row maps to, and the text positions of its first and last row. Matching statistics of patterns are
streamed right to left, all patterns in step: as long as the row's run has the wanted character the match grows by
the mapping alone; else it goes on at the end of the nearest run of that character above or below, whichever sample
shares more text with the match. So every pattern position gets the row of a longest match and its length.

Strings have owners (integers). Rows whose suffixes share ``length`` characters inside their strings follow each other;
of each such stretch of rows the first row and the smallest owner are kept.
"""

from __future__ import annotations

import numpy as np

SEPARATOR, OFFSET = 1, 2


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and the rank of each among the distinct ones."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.zeros(len(key), np.int64)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:], casting="unsafe")
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Order of all suffixes of symbols below 512, by prefix doubling; ranks by the first ``depth`` symbols, too."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(7):
        key = key << 9 | padded[j : j + n]
    order, rank = _ranked(key)
    size, ranks = 7, {}
    while True:
        if size <= depth:
            ranks = {size: rank}
        if rank[order[-1]] == n - 1 or size >= n:
            return order, ranks
        after = np.zeros(n, np.int64)
        after[: n - size] = rank[size:] + 1
        order, rank = _ranked(rank * (n + 1) + after)
        size *= 2


class RunIndex:
    """Index of byte strings; ``owners`` has an integer for each."""

    def __init__(self, strings: list[bytes], owners: np.ndarray, length: int) -> None:
        lengths = np.array([len(s) for s in strings], np.int64)
        flat = np.frombuffer(b"".join(strings), np.uint8)
        begins = np.cumsum(lengths + 1) - lengths - 1
        self.n = n = len(flat) + len(strings) + 1
        text = np.full(n, SEPARATOR, np.int64)
        text[n - 1] = 0
        of = np.repeat(np.arange(len(strings)), lengths)
        text[np.arange(len(flat)) + of] = flat + np.int64(OFFSET)
        order, ranks = suffix_array(text, length)
        before = text[order - 1]
        self.starts = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.heads = before[self.starts]
        self.ends = ends = np.append(self.starts[1:], n) - 1
        # The run of a row, looked up instead of searched.
        self.run_of = np.repeat(np.arange(len(self.starts), dtype=np.int32), ends - self.starts + 1)
        self.first, self.last = order[self.starts], order[ends]
        # Runs by character: where the rows of a run go, and the neighbours of a run among those of a character.
        self.by_head = np.argsort(self.heads, kind="stable")
        sizes = (ends - self.starts + 1)[self.by_head]
        self.maps_to = np.empty(len(self.starts), np.int64)
        self.maps_to[self.by_head] = np.cumsum(sizes) - sizes
        self.keys = self.heads[self.by_head] * len(self.starts) + self.by_head
        self.text = np.concatenate([text, np.zeros(2 * length, np.int64)])
        self.length = length
        # Stretches of rows that share ``length`` characters inside their strings.
        left = np.zeros(n, np.int64)
        left[np.arange(len(flat)) + of] = (begins + lengths)[of] - (np.arange(len(flat)) + of)
        whole = left[order] >= length
        depth, rank = next(iter(ranks.items())) if ranks else (0, np.zeros(n, np.int64))
        same = whole[1:] & whole[:-1]
        for at in self._steps(depth, length):
            pair = np.flatnonzero(same)
            i, j = order[pair] + at, order[pair + 1] + at
            same[pair] = rank[i] == rank[j] if depth else self.text[i] == self.text[j]
        self.stretches = np.flatnonzero(np.r_[True, ~same])
        owner = np.full(n, np.iinfo(np.int64).max)
        owner[np.arange(len(flat)) + of] = np.asarray(owners, np.int64)[of]
        self.owners = np.minimum.reduceat(owner[order], self.stretches)

    @staticmethod
    def _steps(depth: int, length: int) -> list[int]:
        """Offsets at which prefixes of ``depth`` cover ``length`` symbols."""
        step = max(1, depth)
        return sorted({*range(0, max(1, length - step + 1), step), max(0, length - step)})

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common characters of the text from two positions on, at most ``length``."""
        steps = np.arange(self.length)
        differ = self.text[a[:, None] + steps] != self.text[b[:, None] + steps]
        return np.where(differ.any(1), differ.argmax(1), self.length)

    def matching_statistics(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every byte of the patterns, one after the other: row and length of a longest match that starts there;
        and where each pattern begins. Lengths beyond ``length`` are only known to be that long."""
        lengths = np.array([len(p) for p in patterns], np.int64)
        flat = np.frombuffer(b"".join(patterns), np.uint8).astype(np.int64) + OFFSET
        begins = np.cumsum(lengths) - lengths
        rows, sizes = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        order = np.argsort(-lengths, kind="stable")
        left = lengths[order]
        row = np.zeros(len(patterns), np.int64)
        place = np.full(len(patterns), self.first[0])
        size = np.zeros(len(patterns), np.int64)
        runs = len(self.starts)
        for step in range(int(left[0]) if len(left) else 0):
            live = int(np.searchsorted(-left, -step, "left"))
            at = begins[order[:live]] + left[:live] - 1 - step
            c, p, q, n = flat[at], row[:live], place[:live], size[:live]
            run = self.run_of.take(p).astype(np.int64)
            jump = np.flatnonzero(self.heads[run] != c)
            if len(jump):
                cj, qj = c[jump], q[jump]
                k = np.searchsorted(self.keys, cj * runs + run[jump])
                down = k < runs
                below = self.by_head[np.where(down, k, 0)]
                down &= self.heads[below] == cj
                up = k > 0
                above = self.by_head[np.where(up, k - 1, 0)]
                up &= self.heads[above] == cj
                with_below = np.where(down, self._shared(qj, self.first[below]), -1)
                with_above = np.where(up, self._shared(qj, self.last[above]), -1)
                lower = with_below >= with_above
                found = np.where(lower, below, above)
                run[jump] = found
                p[jump] = np.where(lower, self.starts[found], self.ends[found])
                q[jump] = np.where(lower, self.first[found], self.last[found])
                shared = np.maximum(with_below, with_above)
                # A character that no string has ends the match.
                n[jump] = np.where(shared < 0, -1, np.minimum(n[jump], shared))
            p += self.maps_to[run] - self.starts[run]
            q -= 1
            n += 1
            if len(jump) and (n[jump] == 0).any():
                none = jump[n[jump] == 0]
                p[none], q[none] = 0, self.first[0]
            rows[at], sizes[at] = p, n
        return rows, sizes, begins

    def smallest_owner(self, rows: np.ndarray) -> np.ndarray:
        """The smallest owner among strings that share ``length`` characters with the suffix of a row."""
        return self.owners[np.searchsorted(self.stretches, rows, "right") - 1]
