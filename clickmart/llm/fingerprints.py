"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words (words: what ASCII white space parts; fewer words make one shingle, no
words none). The sketch keeps the k smallest 64-bit hashes of distinct shingles. Sketches merge: the bottom k of two
sketches' union is the sketch of the two shingle sets' union, so parts of a text or of a corpus can be sketched in
different tasks. Two sketches estimate resemblance, containment and the number of distinct shingles; a sketch with
fewer than k hashes holds all of them, and what it estimates is exact.

Defined results: a missing text is empty; two empty sketches resemble each other fully (1), an empty and another one not
at all (0). Equal texts have equal sketches. Missing ids come after all others; rows with equal ids are ordered
by text. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

K = 128
WORDS = 5

_SPREAD = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(1, 17)], np.uint64)
_words: dict[bytes, int] = {}


def _word_hashes(words: list[bytes]) -> np.ndarray:
    """Hash of each word; those of frequent words are kept by the worker."""
    try:
        return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    except KeyError:
        found = {w: xxhash.xxh64_intdigest(w) for w in set(words).difference(_words)}
        if len(_words) < 400_000:
            _words.update(found)
            return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
        get = _words.get
        return np.fromiter((get(w) or found[w] for w in words), np.uint64, len(words))


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Hash of each shingle, in order, repeats included."""
    found = _word_hashes(text.encode().split())
    n = min(words, len(found))
    if not n:
        return found
    out = np.full(len(found) - n + 1, n, np.uint64)
    for i in range(n):
        out += found[i : len(found) - n + 1 + i] * _SPREAD[i]
    # A finalizer that lets every bit depend on all bits (splitmix64).
    out ^= out >> np.uint64(30)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def sketch(text: str, k: int = K, words: int = WORDS) -> np.ndarray:
    """The k smallest distinct shingle hashes, ascending."""
    return bottom(shingle_hashes(text, words), k)


def bottom(hashes: np.ndarray, k: int = K) -> np.ndarray:
    if len(hashes) > 4 * k:
        low = np.unique(np.partition(hashes, 2 * k)[: 2 * k + 1])
        if len(low) >= k:
            return low[:k]
    return np.unique(hashes)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union."""
    return np.unique(np.concatenate([a, b]))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Shared part of all distinct shingles, from the bottom k of the union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    new = np.r_[True, both[1:] != both[:-1]]
    of = min(k, int(new.sum()))
    if int(new.sum()) > k:
        last = both[new][k - 1]
        both, new = both[both <= last], new[both <= last]
    return (len(both) - int(new.sum())) / of


def distinct(a: np.ndarray, k: int = K) -> float:
    """Number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / (float(a[k - 1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Part of the first one's shingles that the second one has."""
    if not len(a):
        return 1.0
    alike = resemblance(a, b, k)
    return min(1.0, alike / (1 + alike) * (distinct(a, k) + distinct(b, k)) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype("<u8").tobytes()).decode()


def from_text(a: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(a), "<u8").astype(np.uint64)


# In Spark


def _sketched(batches: Iterator[pa.RecordBatch], k: int, words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sketch(t, k, words) for t in common.texts(batch.column("_text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array([to_text(f) for f in found]),
             pa.array([distinct(f, k) for f in found], pa.float64())],
            names=["_id", "fingerprint", "shingles"],
        )


def documents(
    docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, words: int = WORDS
) -> DataFrame:
    """Per document: ``_id``, ``fingerprint`` and the estimated number of distinct ``shingles``."""
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return common.map_arrow(rows, _sketched, f"_id {kind}, fingerprint string, shingles double", k, words)


def _merged_parts(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    held: dict[object, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), kind), pa.array([to_text(x) for x in held.values()], pa.string())],
            names=["_id", "fingerprint"],
        )

    for batch in batches:
        kind = batch.schema.field("_id").type
        for key, one in zip(batch.column("_id").to_pylist(), batch.column("fingerprint").to_pylist(), strict=True):
            one = from_text(one)
            held[key] = merge(held[key], one, k) if key in held else one
        if len(held) > 20_000:
            yield out()
            held = {}
    if held:
        yield out()


def merged(sketches: DataFrame, k: int = K) -> DataFrame:
    """One sketch per ``_id`` from the sketches of its parts; parts meet in each task before they are shuffled."""
    kind = sketches.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, fingerprint string"
    rows = sketches.select("_id", "fingerprint")
    once = common.map_arrow(rows, _merged_parts, schema, k)
    # A key that nearly every task has is spread over salts first, then its few rest rows meet.
    salted = once.withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(32)))
    n = common.partitions(sketches.sparkSession)
    spread = salted.repartition(n, "_id", "salt").sortWithinPartitions("_id").select("_id", "fingerprint")
    twice = common.map_arrow(spread, _merged_parts, schema, k)

    def last(rows: pd.DataFrame) -> pd.DataFrame:
        total = from_text(rows.fingerprint.iloc[0])
        for one in rows.fingerprint.iloc[1:]:
            total = merge(total, from_text(one), k)
        return pd.DataFrame({"_id": rows["_id"].iloc[:1], "fingerprint": [to_text(total)]})

    return twice.groupBy("_id").applyInPandas(last, schema)


# Each text, the text edited towards the next one, and the next one


def edited(text: str, other: str) -> str:
    """The text with its last half replaced by as much of the other's beginning as there is."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _neighbours(batches: Iterator[pa.RecordBatch], k: int, words: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their ranges; the first row of the following range stands at the end of each."""
    held = None  # id, text, sketch and range of the row before
    for batch in batches:
        rows = []
        columns = [batch.column(c).to_pylist() for c in ("range", "guest", "_id")]
        for of, guest, id, text in zip(*columns, common.texts(batch.column("_text")), strict=True):
            if held is not None and held[3] != of:
                held = None
            if guest and held is None:
                continue
            own = sketch(text, k, words)
            if held is not None:
                new = edited(held[1], text)
                mixed = sketch(new, k, words)
                rows.append((
                    held[0], len(held[1]), hashlib.sha256(new.encode()).hexdigest(), to_text(held[2]),
                    to_text(mixed), resemblance(held[2], mixed, k), resemblance(held[2], own, k),
                ))
            held = None if guest else (id, text, own, of)
        if rows:
            kinds = [batch.schema.field("_id").type, pa.int64(), pa.string(), pa.string(), pa.string(),
                     pa.float64(), pa.float64()]
            names = ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
            )


def with_next(
    docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = K, words: int = WORDS
) -> DataFrame:
    """Per document its sketch, that of its text edited towards the next document, and how near both are.

    Ids are dealt to ranges, whose first ids (one per partition) the driver knows. A range's first row also goes to
    the range before it, the very first to the last one, so every row meets the next one and texts are
    shuffled once.
    """
    n = common.partitions(docs.sparkSession)
    ids = docs.select(F.col(id).alias("_id")).filter("_id is not null").repartitionByRange(n, "_id")
    lows = ids.groupBy(F.spark_partition_id().alias("p")).agg(F.min("_id").alias("low")).select("low").collect()
    firsts = sorted(r["low"] for r in lows)
    last = max(0, len(firsts) - 1)

    @F.pandas_udf("long")
    def place(ids: pd.Series) -> pd.Series:
        """Twice the range, plus one for a range's first id."""
        out = []
        for one in ids.array:
            if pd.isna(one):
                out.append(2 * last + (not firsts))
            else:
                at = bisect_right(firsts, one) - 1
                out.append(2 * at + (firsts[at] == one))
        return pd.Series(out, dtype="int64")

    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    rows = rows.withColumn("at", place("_id"))
    own = F.struct(F.shiftright("at", 1).alias("range"), F.lit(0).alias("guest"))
    before = F.struct(F.pmod(F.shiftright("at", 1) - 1, F.lit(last + 1)).alias("range"), F.lit(1).alias("guest"))
    dealt = rows.withColumn("to", F.explode(F.when(F.col("at") % 2 == 1, F.array(own, before)).otherwise(F.array(own))))
    dealt = dealt.select("to.range", "to.guest", "_id", "_text").repartitionByRange(n, "range")
    ordered = dealt.sortWithinPartitions("range", "guest", F.col("_id").asc_nulls_last(), "_text")
    return common.map_arrow(
        ordered, _neighbours,
        f"_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double", k, words,
    )
