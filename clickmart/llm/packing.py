"""Pattern packing by non-negative least squares.

Documents become token sequences with an end token; only those longer than a sequence are cut. The lengths of all
pieces form a histogram of at most ``size`` entries, whatever the number of documents, and the packing is planned on it:

1. lengths are rounded up to ``BINS`` bins, and all patterns of at most ``FEW`` bins that fill a sequence exactly
   are enumerated;
2. non-negative least squares fit repeat counts of the patterns to the binned histogram (short lengths weigh less,
   as they fill gaps anyway), and the counts are rounded and held to what is there;
3. patterns of bins are filled with lengths, longest first, and the residual lengths are packed best-fit, longest
   first, into the smallest gap that takes them, or into new sequences.

The plan lists patterns of lengths with repeat counts: its size is bounded by the lengths, not by the documents. A
piece finds its place by its number among the pieces of its length, counted in hash buckets, so a length that a
third of all pieces have is spread over all tasks.

Defined results: a missing text is empty and makes one piece with the end token alone; repeated rows are packed each.
An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

BINS = 64
FEW = 4
#: Bins up to this part of a sequence weigh SHORT_WEIGHT in the fit.
SHORT, SHORT_WEIGHT = 1 / 8, 0.1


# The plan, on the histogram


def patterns(bins: int, few: int) -> list[tuple[int, ...]]:
    """Descending tuples of at most ``few`` bins that sum to ``bins``."""

    def parts(total: int, most: int, left: int) -> Iterator[tuple[int, ...]]:
        if not total:
            yield ()
        elif left:
            for first in range(min(total, most), -(-total // left) - 1, -1):
                for rest in parts(total - first, first, left - 1):
                    yield (first, *rest)

    return list(parts(bins, bins, few))


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by an active set: columns enter by gradient and leave when they turn negative."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, np.abs(b).max()) * np.abs(a).max()
    for _ in range(3 * a.shape[1]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        if active.all() or gradient.max() <= tolerance:
            break
        active[gradient.argmax()] = True
        while True:
            trial = np.zeros_like(x)
            trial[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (trial <= 0)
            if not low.any():
                break
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x += step * (trial - x)
            leaving = low & (x <= 1e-12 * max(1.0, np.abs(x).max()))
            if not leaving.any():
                leaving = low
            x[leaving], active[leaving] = 0, False
        x = trial
    return x


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, times), ...) with repeat counts that hold every piece of the histogram exactly once."""
    left = {n: c for n, c in histogram.items() if c > 0}
    if not left:
        return []
    bins = min(BINS, size)
    bin_of = {n: -(-n * bins // size) for n in left}
    counts = np.zeros(bins + 1)
    for n, c in left.items():
        counts[bin_of[n]] += c
    shapes = patterns(bins, FEW)
    shapes = [s for s in shapes if all(counts[b] for b in s)]
    repeats = np.zeros(0)
    if shapes:
        matrix = np.zeros((bins + 1, len(shapes)))
        for k, shape in enumerate(shapes):
            for b in shape:
                matrix[b, k] += 1
        weight = np.where(np.arange(bins + 1) <= SHORT * bins, SHORT_WEIGHT, 1.0)
        repeats = np.rint(non_negative_least_squares(weight[:, None] * matrix, weight * counts)).astype(np.int64)

    # Filled patterns by the gap they leave; each: the pieces and how often.
    open_by_gap: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    gaps: list[int] = []

    def put(pieces: tuple[tuple[int, int], ...], gap: int, times: int) -> None:
        if gap not in open_by_gap:
            open_by_gap[gap] = []
            insort(gaps, gap)
        open_by_gap[gap].append((pieces, times))

    by_bin: dict[int, list[int]] = {}
    for n in sorted(left):
        by_bin.setdefault(bin_of[n], []).append(n)
    for k in np.argsort([-s[0] for s in shapes], kind="stable") if shapes else ():
        times, shape = int(repeats[k]), shapes[k]
        while times > 0:
            taken: dict[int, int] = {}
            for b in shape:
                lengths = by_bin.get(b, [])
                place = len(lengths) - 1
                while place >= 0 and left[lengths[place]] <= taken.get(lengths[place], 0):
                    place -= 1
                if place < 0:
                    break
                taken[lengths[place]] = taken.get(lengths[place], 0) + 1
            if sum(taken.values()) < len(shape):
                break  # the bins hold no more whole patterns
            now = min(times, *(left[n] // m for n, m in taken.items()))
            for n, m in taken.items():
                left[n] -= now * m
            for b in set(shape):
                while by_bin[b] and not left[by_bin[b][-1]]:
                    by_bin[b].pop()
            put(tuple(taken.items()), size - sum(n * m for n, m in taken.items()), now)
            times -= now

    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                per = size // n
                if count >= per:
                    put(((n, per),), size - per * n, count // per)
                if count % per:
                    put(((n, count % per),), size - count % per * n, 1)
                break
            gap = gaps[at]
            pieces, times = open_by_gap[gap].pop()
            if not open_by_gap[gap]:
                del open_by_gap[gap], gaps[at]
            per = gap // n
            full = min(times, count // per)
            if full:
                put((*pieces, (n, per)), gap - per * n, full)
                count, times = count - full * per, times - full
            if times and count and count < per:
                put((*pieces, (n, count)), gap - count * n, 1)
                count, times = 0, times - 1
            if times:
                put(pieces, gap, times)
    return [x for gap in gaps for x in open_by_gap[gap]]


def slots(packed: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[str, np.ndarray]:
    """The plan by length and number of the piece: where a run of pieces of one length goes."""
    rows, used, base = [], {}, 0
    for pieces, times in packed:
        offset = 0
        for n, m in pieces:
            rows.append((n, used.get(n, 0), base, times, offset))
            used[n] = used.get(n, 0) + m * times
            offset += n * m
        base += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "sequence", "times", "offset"), columns, strict=True))


# Pieces and places, in Spark


def _tokenised(
    batches: Iterator[pa.RecordBatch], path: str, keep_space: bool, end: int, size: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    encoder, end_bytes, width = tokens.encoder(path, keep_space), end.to_bytes(4, "little"), 4 * size
    for whole in batches:
        for some in range(0, whole.num_rows, 500):
            batch = whole.slice(some, 500)
            rows, at, out = [], [], []
            for i, ids in enumerate(encoder.encode(common.texts(batch.column("_text")))):
                ids += end_bytes
                for k in range(0, len(ids), width):
                    rows.append(i)
                    at.append(k // 4)
                    out.append(ids[k : k + width])
            rows, start = pa.array(rows, pa.int64()), np.array(at, np.int64)
            columns = {
                "_file": batch.column("_file").take(rows), "_row": batch.column("_row").take(rows),
                "_id": batch.column("_id").take(rows), "piece": pa.array((start // size).astype(np.int32)),
                "start": pa.array(start), "length": pa.array([len(x) // 4 for x in out], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x) for x in out], pa.int64()),
            }
            if with_ids:
                kind = pa.list_(pa.int32())
                columns["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in out], kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def pieces(
    docs: DataFrame, tokenizer: str, size: int, end: int, keep_space: bool = False,
    id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Tokenised pieces of at most ``size`` ids; ``with_ids`` adds the ids themselves."""
    rows = common.keyed(docs, _id=id, _text=text)
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_file long, _row long, _id {kind}, piece int, start long, length long, ids_crc32 long"
    return common.map_arrow(
        rows, _tokenised, schema + ", ids array<int>" * with_ids, tokenizer, keep_space, end, size, with_ids
    )


def _placed(batches: Iterator[pa.RecordBatch], where: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    order = (where["length"] << 44) + where["first"]
    for batch in batches:
        length, number = batch.column("length").to_numpy(), batch.column("number").to_numpy()
        at = np.searchsorted(order, (length << 44) + number, "right") - 1
        slot, repeat = np.divmod(number - where["first"][at], where["times"][at])
        keep = [n for n in batch.schema.names if n not in ("number", "bucket")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(n) for n in keep]
            + [pa.array(where["sequence"][at] + repeat), pa.array(where["offset"][at] + slot * length)],
            names=[*keep, "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 1, keep_space: bool = False,
    id: str = "doc_id", text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """One row per piece with the sequence it goes to and its place there."""
    cut = common.stored(pieces(docs, tokenizer, size, end, keep_space, id, text, with_ids), "pieces")
    where = slots(plan({r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}, size))
    if not len(where["length"]):
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    n = common.partitions(docs.sparkSession)
    rows = cut.withColumn("bucket", F.pmod(F.xxhash64("_file", "_row", "piece"), F.lit(n)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    base = counted.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("_file", "_row", "piece")
    numbered = rows.withColumn("within", F.row_number().over(within)).join(base, ["length", "bucket"])
    numbered = numbered.withColumn("number", F.col("within") - 1 + F.col("base")).drop("within", "base", "bucket")
    names = [c for c in cut.columns if c != "length"]
    out = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in ("length", *names))
    return common.map_arrow(
        numbered.select("length", *names, "number"), _placed, f"{out}, sequence_id long, offset long", where
    )
