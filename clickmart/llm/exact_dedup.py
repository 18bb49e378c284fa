"""Exact de-duplication by composable polynomial fingerprints.

A text, freed of the white space ``[\\x20\\x09-\\x0D]``, is hashed in chunks: a chunk's hash is the value of
its bytes as a polynomial in a fixed base, modulo each of two primes. Two hashes join by length-shifted
arithmetic, ``h(xy) = h(x) * base**len(y) + h(y)``, so chunks of a huge document can be hashed apart, in any
number of tasks, and combined afterwards (``combine``, ``parts_fingerprints``). Texts with the same length and
fingerprints are then compared chunk by chunk: equal chunks meet in one group, in which copies are combined
before they are shuffled, and a group with two contents tells equal fingerprints of different texts apart.

Defined results: a missing text counts as empty, and empty texts (or those of white space only) equal each
other. Of equal texts the row with the most code points stays, then the smallest id (a missing id comes after
all others), then the first row of exact repeats. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Two primes below 2**40, and a base for each: sums of a chunk's 2**16 terms fit 64 bits.
PRIMES = (2**40 - 87, 2**40 - 167)
BASES = (702_341_618_339, 314_159_265_359)
CHUNK = 1 << 16

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def _powers(base: int, prime: int, n: int = CHUNK) -> np.ndarray:
    """base**(n-1) .. base**0 modulo prime."""
    out, power = np.empty(n, np.uint64), 1
    for i in range(n - 1, -1, -1):
        out[i] = power
        power = power * base % prime
    return out


_tables: dict[tuple[int, int], np.ndarray] = {}


def chunk_hash(chunk: bytes, moduli: tuple[tuple[int, int], ...]) -> tuple[int, ...]:
    """Hash of at most CHUNK bytes for each (base, prime)."""
    values = np.frombuffer(chunk, np.uint8).astype(np.uint64)
    out = []
    for base, prime in moduli:
        if (base, prime) not in _tables:
            _tables[base, prime] = _powers(base, prime)
        out.append(int((values * _tables[base, prime][CHUNK - len(values) :]).sum()) % prime)
    return tuple(out)


def combine(
    left: tuple[int, ...], right: tuple[int, ...], right_bytes: int, moduli: tuple[tuple[int, int], ...]
) -> tuple[int, ...]:
    """Hash of a concatenation from the hashes of its parts."""
    return tuple((x * pow(b, right_bytes, p) + y) % p for x, y, (b, p) in zip(left, right, moduli, strict=True))


def fingerprint(data: bytes, moduli: tuple[tuple[int, int], ...]) -> tuple[int, ...]:
    """Hash of any number of bytes, chunk by chunk."""
    out = (0,) * len(moduli)
    for i in range(0, len(data), CHUNK):
        chunk = data[i : i + CHUNK]
        out = combine(out, chunk_hash(chunk, moduli), len(chunk), moduli)
    return out


def moduli_of(primes: tuple[int, ...] = PRIMES) -> tuple[tuple[int, int], ...]:
    return tuple((b % p, p) for b, p in zip(BASES, primes, strict=True))


def normalise(text: str) -> bytes:
    """UTF-8 of the text without white space."""
    return text.encode().translate(None, WHITE)


def _fingerprints(batches: Iterator[pa.RecordBatch], moduli: tuple) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [common.texts(batch.column("_text"))]
        chars = [len(t) for t in found[0]]
        data = [normalise(t) for t in found.pop()]
        hashes = [fingerprint(d, moduli) for d in data]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_file"), batch.column("_row"), batch.column("_id"), pa.array(chars, pa.int64()),
             pa.array([len(d) for d in data], pa.int64()),
             pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()),
             pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string())],
            names=["_file", "_row", "_id", "chars", "bytes", "h1", "h2", "sha"],
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [normalise(t) for t in common.texts(batch.column("_text"))]
        spans = [(i, k) for i, d in enumerate(data) for k in range(0, max(1, len(d)), CHUNK)]
        for some in range(0, len(spans), 512):
            part = spans[some : some + 512]
            rows = pa.array([i for i, _ in part], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(rows) for c in ("_file", "_row", "bytes", "h1", "h2")]
                + [pa.array([k // CHUNK for _, k in part], pa.int64()),
                   pa.array([data[i][k : k + CHUNK] for i, k in part], pa.binary())],
                names=["_file", "_row", "bytes", "h1", "h2", "chunk_no", "chunk"],
            )


GROUP = ["bytes", "h1", "h2"]


def parts_fingerprints(parts: DataFrame, key: str, part_no: str, text: str) -> DataFrame:
    """Fingerprints of documents that come as several rows: parts are hashed where they are, then combined.

    Returns ``key``, ``bytes``, ``h1``, ``h2``; one small row per part is shuffled, not its text.
    """
    moduli = moduli_of()
    rows = common.keyed(parts, _id=F.struct(F.col(key).alias("k"), F.col(part_no).alias("n")), _text=text)
    kind = rows.schema["_id"].dataType
    hashed = common.map_arrow(
        rows, _fingerprints,
        f"_file long, _row long, _id {kind.simpleString()}, chars long, bytes long, h1 long, h2 long, sha string",
        moduli,
    )

    def join(rows):
        rows = rows.sort_values("n")
        total, size = (0,) * len(moduli), 0
        for n, *h in rows[GROUP].itertuples(index=False):
            total, size = combine(total, tuple(h), n, moduli), size + n
        return rows.head(1)[["k"]].assign(bytes=size, h1=total[0], h2=total[1])

    return (
        hashed.select("_id.k", "_id.n", *GROUP).groupBy("k")
        .applyInPandas(join, f"k {kind['k'].dataType.simpleString()}, bytes long, h1 long, h2 long")
        .withColumnRenamed("k", key)
    )


def decisions(
    docs: DataFrame, id: str = "doc_id", text: str = "text", primes: tuple[int, ...] = PRIMES
) -> DataFrame:
    """One row per document: ``_file``, ``_row``, ``_id``, ``keep_id``, ``group_size``, ``kept``, ``sha``.

    The fingerprints are written once (small rows). Texts that share one are read again and compared.
    """
    moduli = moduli_of(primes)
    rows = common.keyed(docs, _id=id, _text=text)
    kind = rows.schema["_id"].dataType.simpleString()
    prints = common.stored(
        common.map_arrow(
            rows, _fingerprints,
            f"_file long, _row long, _id {kind}, chars long, bytes long, h1 long, h2 long, sha string", moduli,
        ), "fingerprints",
    )
    total = prints.count()
    groups = prints.groupBy(*GROUP).agg(F.count("*").alias("n"))
    shared = common.attach(
        prints.select("_file", "_row", *GROUP), groups.filter("n > 1"), GROUP, "n", total
    ).filter("n > 1")
    chunks = common.map_arrow(
        rows.select("_file", "_row", "_text").join(shared, ["_file", "_row"]), _chunks,
        "_file long, _row long, bytes long, h1 long, h2 long, chunk_no long, chunk binary",
    )
    # Equal chunks are combined in each task, so a text with thousands of copies is not shuffled thousands of times.
    contents = common.stored(
        chunks.groupBy(*GROUP, "chunk_no", "chunk").agg(F.count("*").alias("rows")), "chunks"
    )
    differing = contents.groupBy(*GROUP, "chunk_no").agg(F.count("*").alias("contents")).filter("contents > 1")
    collided = common.stored(differing.select(*GROUP).distinct(), "collisions")
    if collided.isEmpty():
        classes = prints.withColumn("class", F.lit(""))
    else:
        # Fingerprints of different texts: the numbers of a text's chunk contents tell its class.
        order = Window.partitionBy(*GROUP, "chunk_no").orderBy("chunk")
        numbered = contents.join(collided, GROUP).withColumn("content", F.row_number().over(order))
        again = chunks.join(collided, GROUP).join(
            numbered.select(*GROUP, "chunk_no", "chunk", "content"), [*GROUP, "chunk_no", "chunk"]
        )
        signs = again.groupBy("_file", "_row").agg(
            F.to_json(F.sort_array(F.collect_list(F.struct("chunk_no", "content")))).alias("sign")
        )
        classes = prints.join(signs, ["_file", "_row"], "left").withColumn(
            "class", F.coalesce("sign", F.lit(""))
        )
        classes = common.stored(classes.drop("sign"), "classes")
    best = classes.groupBy(*GROUP, "class").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("chars")).alias("c"), F.col("_id").isNull().alias("m"), F.col("_id").alias("i"),
                       F.col("_file").alias("f"), F.col("_row").alias("r"))).alias("first"),
    )
    return common.attach(classes, best, [*GROUP, "class"], "group_size", total).select(
        "_file", "_row", "_id", F.col("first.i").alias("keep_id"), "group_size",
        ((F.col("first.f") == F.col("_file")) & (F.col("first.r") == F.col("_row"))).alias("kept"), "sha",
    )


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    docs = common.rooted(docs)
    kept = decisions(docs, id, text).filter("kept").select("_file", "_row")
    return common.whole_rows(docs, text).join(kept, ["_file", "_row"], "left_semi").select("doc.*")
