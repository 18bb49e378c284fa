"""Importance resampling towards a target: hashed n-gram counts of corpus and target weigh every document of the corpus.

Features are the runs of 1 to ``run`` consecutive words, joined by one space; a feature's bucket is the CRC-32 of its
bytes modulo ``buckets``. Text is lower-cased in A-Z only; all signs of ASCII other than letters and digits part words.

Head and tail. One pass finds the frequent words and pairs: every task keeps Misra-Gries counters, and their sums name
at most ``HEAD`` words and ``HEAD`` pairs of at most ``LONGEST`` bytes, so what is broadcast does not grow with the
data. The broadcast holds the exact CRC state after each frequent word, from which the CRC of a longer run is carried
on, and the bucket of each frequent pair. Every other feature takes its CRC directly. Both ways give the same bucket, so
the head decides the speed only; bucket totals count every feature of every document exactly.

The same pass that cuts a document into features writes their buckets (two bytes each) and adds up the totals of its
task; the gains of the buckets are then summed over those written rows, and no text is read again. Per task one vector
of ``buckets`` numbers is written; these are added up in tasks first, and ``buckets`` rows reach the driver.

Scores add Gumbel noise from a hash of the id. Drawn documents are ranked by a sort over ranges (score, id and place in
the file, so that a score or id that very many rows share does not meet in one task), whose sizes give the offsets.

Defined results: a missing text has no features and the weight 0; a missing id takes the noise of an empty id and comes
last among equal scores. Rows of the same id are documents of their own; equal ones are drawn in the order of the files.
An empty corpus has no rows; an empty target has the total 0, and the gains follow the formula.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

HEAD = 20_000
LONGEST = 64

_lower = bytes(range(0x41, 0x5B))
#: Letters in lower case, and a space for every sign that parts words.
WORD_BYTES = bytes(
    c + 0x20 if c in _lower else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8."""
    return text.translate(WORD_BYTES).split()


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in batches:
        for some in range(0, whole.num_rows, 200):
            batch = whole.slice(some, 200)
            yield batch, batch.column("_text").cast(pa.binary()).to_pylist()


# Head


def _frequent(batches: Iterator[pa.RecordBatch], run: int, size: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries counters of the task's words and pairs: a feature with more than a ``size``-th of all is among them."""
    found: list[Counter[bytes]] = [Counter() for _ in range(min(run, 2))]
    for _, texts in _texts(batches):
        for text in texts:
            features = words(text)
            for counter in found:
                counter.update(features)
                if len(counter) > 10 * size:
                    # What every counter loses, at least ``size`` counters lose.
                    off = np.partition(np.fromiter(counter.values(), np.int64, len(counter)), -size)[-size]
                    less = {k: n - int(off) for k, n in counter.items() if n > off}
                    counter.clear()
                    counter.update(less)
                features = [a + b" " + b for a, b in zip(features, features[1:], strict=False)] if run > 1 else []
    for kind, counter in enumerate(found, 1):
        top = [(k, n) for k, n in counter.most_common(size) if len(k) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(top), kind, np.int32)), pa.array([k for k, _ in top], pa.binary()),
             pa.array([n for _, n in top], pa.int64())], names=["kind", "feature", "n"],
        )


def head(texts: DataFrame, run: int, size: int = HEAD) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """CRC states of at most ``size`` frequent words, and of as many frequent pairs."""
    counted = common.map_arrow(texts.select("_text"), _frequent, "kind int, feature binary, n long", run, size)
    sums = counted.groupBy("kind", "feature").agg(F.sum("n").alias("n"))
    found = []
    for kind in (1, 2):
        top = sums.filter(F.col("kind") == kind).orderBy(F.desc("n"), "feature").limit(size) if kind <= run else None
        found.append({bytes(r["feature"]): zlib.crc32(r["feature"]) for r in top.collect()} if top is not None else {})
    return found[0], found[1]


# Features and totals


class _Tail(dict):
    """CRCs of frequent features; any other feature takes its own."""

    def __missing__(self, feature: bytes) -> int:
        return zlib.crc32(feature)


def _crcs(found: list[bytes], run: int, states: _Tail, pairs: dict[bytes, int]) -> list[int]:
    """CRCs of all runs of 1 to ``run`` of the words."""
    of_word = [states[w] for w in found]
    out, before = list(of_word), of_word
    for n in range(2, run + 1):
        longer = []
        for i in range(len(found) - n + 1):
            known = pairs.get(found[i] + b" " + found[i + 1]) if n == 2 else None
            longer.append(zlib.crc32(b" " + found[i + n - 1], before[i]) if known is None else known)
        out += longer
        before = longer
    return out


NAMES = ["_file", "_row", "_id", "n_features", "enough", "data"]


def _features(
    batches: Iterator[pa.RecordBatch], run: int, buckets: int, states: dict, pairs: dict, least: int
) -> Iterator[pa.RecordBatch]:
    """Buckets of each document's features; then, in a row without a place, the totals of the task and the number of
    its documents that are long enough."""
    states, kind = _Tail(states), "<u2" if buckets <= 1 << 16 else "<u4"
    totals, long_enough, ids = np.zeros(buckets, np.int64), 0, None
    for batch, texts in _texts(batches):
        crcs, ends, enough = [], [0], []
        for text in texts:
            found = words(text)
            crcs += _crcs(found, run, states, pairs)
            ends.append(len(crcs))
            enough.append(len(found) >= least)
        own = np.array(crcs, np.uint32) % np.uint32(buckets)
        totals += np.bincount(own, minlength=buckets)
        long_enough += sum(enough)
        data, width = own.astype(kind).tobytes(), int(kind[2])
        rows = [data[a * width : b * width] for a, b in zip(ends, ends[1:], strict=False)]
        ids = batch.column("_id").type
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in NAMES[:3]), pa.array(np.diff(ends), pa.int64()),
             pa.array(enough, pa.bool_()), pa.array(rows, pa.binary())], names=NAMES,
        )
    if ids is not None:
        empty = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [empty, empty, pa.nulls(1, ids), pa.array([long_enough], pa.int64()), pa.nulls(1, pa.bool_()),
             pa.array([totals.tobytes()], pa.binary())], names=NAMES,
        )


def features(rows: DataFrame, run: int, buckets: int, known: tuple[dict, dict], least: int) -> DataFrame:
    """Written buckets and totals of keyed texts (``_file``, ``_row``, ``_id``, ``_text``)."""
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_file long, _row long, _id {kind}, n_features long, enough boolean, data binary"
    return common.stored(common.map_arrow(rows, _features, schema, run, buckets, *known, least), "features")


def _added(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(buckets + 1, np.int64)
    for batch in batches:
        for data in batch.column("data"):
            totals[:buckets] += np.frombuffer(data.as_buffer(), np.int64)
        totals[buckets] += int(np.sum(batch.column("n_features").to_numpy(zero_copy_only=False)))
    at = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(totals[at])], names=["bucket", "n"])


def totals(written: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """How often each bucket occurs in all documents, and how many documents are long enough."""
    rows = written.filter(F.col("_file").isNull()).select("n_features", "data")
    sums = common.map_arrow(rows, _added, "bucket int, n long", buckets).groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(buckets + 1, np.int64)
    for row in sums.collect():
        found[row["bucket"]] = row["n"]
    return found[:buckets], int(found[buckets])


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths of the logarithm of the smoothed ratio."""
    n, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = [
        (t + 1) * (s_all + n) / ((s + 1) * (t_all + n)) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


# Scores and draw


def _noise(seed: object, doc: object) -> int:
    text = f"{seed}:{'' if doc is None else doc}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(batches: Iterator[pa.RecordBatch], gain: np.ndarray, seed: object) -> Iterator[pa.RecordBatch]:
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    for batch in batches:
        # One after the other: a batch of long documents is not held as one array of gains.
        weights = [int(gain[np.frombuffer(x.as_buffer(), kind)].sum()) for x in batch.column("data")]
        noise = [_noise(seed, i) for i in batch.column("_id").to_pylist()]
        scores = [w + x for w, x in zip(weights, noise, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in NAMES[:5]), pa.array(weights, pa.int64()), pa.array(scores, pa.int64())],
            names=[*NAMES[:5], "weight", "score"],
        )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        place = np.arange(at, at + batch.num_rows, dtype=np.int64)
        at += batch.num_rows
        columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(place)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "place"])


def ranked(scored: DataFrame, most: int) -> DataFrame:
    """Rows with ``rank`` (from 1) by falling ``score``; beyond ``most`` it is missing."""
    names = ["_id", "n_features", "weight", "score"]
    order = [F.desc("score"), F.asc_nulls_last("_id"), F.col("_file"), F.col("_row")]
    rows = scored.select("_file", "_row", *names)
    dealt = rows.repartitionByRange(common.partitions(scored.sparkSession), *order).sortWithinPartitions(*order)
    kind = scored.schema["_id"].dataType.simpleString()
    placed = common.stored(
        common.map_arrow(
            dealt.select(*names), _placed,
            f"_id {kind}, n_features long, weight long, score long, part int, place long",
        ), "ranks",
    )
    # One row per partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    rank = F.col("offset") + F.col("place") + 1
    return placed.join(F.broadcast(offsets), "part").select(*names, F.when(rank <= most, rank).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, run: int = 2, buckets: int = 10_000, least: int = 20, percent: int = 10,
    seed: object = 0, id: str = "doc_id", text: str = "text", head_size: int = HEAD,
) -> DataFrame:
    """Per document: ``_id``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the documents with at least ``least`` words, ``percent`` in a hundred are drawn; others have no rank.
    """
    if run < 1 or buckets < 1 or head_size < 1:
        raise ValueError("run, buckets and head_size must be positive")
    plain = F.coalesce(F.col(text), F.lit(""))
    rows = common.keyed(docs, _id=id, _text=plain)
    wanted = common.keyed(target, _id=F.lit(None).cast("long"), _text=plain)
    known = head(rows, run, head_size)
    corpus = features(rows, run, buckets, known, least)
    counts, number = totals(corpus, buckets)
    target_rows = features(wanted, run, buckets, known, least)
    target_counts, _ = totals(target_rows, buckets)
    common.dropped(target_rows)
    kind = rows.schema["_id"].dataType.simpleString()
    scored = common.map_arrow(
        corpus.filter(F.col("_file").isNotNull()), _weighed,
        f"_file long, _row long, _id {kind}, n_features long, enough boolean, weight long, score long",
        gains(counts, target_counts), seed,
    )
    scored = common.stored(scored, "scores")
    common.dropped(corpus)
    drawn = ranked(scored.filter("enough"), number * percent // 100)
    rest = scored.filter("NOT enough").select("_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)
