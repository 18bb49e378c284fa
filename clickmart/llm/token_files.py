"""Token ids of documents in files of compressed, checksummed blocks, written in ascending id order and read back.

Documents are dealt by ranges of ``doc_id`` and sorted; each task encodes its texts, appends the end id and closes a
block at ``BLOCK`` ids (a document is never cut, so a block ends with a whole one). Blocks are coded by
``mixing_coder`` and stand in Parquet files as one row each: the range and place they belong to, the number of their
documents and ids, the documents' ids and lengths, and the bytes of the block. Any block can be decoded, checked or
written again alone.

Defined results: a missing text is empty and becomes the end id alone; a missing id comes first; repeated rows and equal
ids follow each other, ordered by text, whose beginning also deals out the rows of an id that very many share. An empty table makes files without blocks, which read as no documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, mixing_coder, tokens

BLOCK = 1 << 21
KEY = "part int, block int"


def _blocks(
    batches: Iterator[pa.RecordBatch], path: str, keep_space: bool, end: int, vocabulary: int, size: int
) -> Iterator[pa.RecordBatch]:
    encoder, end_bytes = tokens.encoder(path, keep_space), end.to_bytes(4, "little")
    part, number = TaskContext.get().partitionId(), 0
    docs: list[pa.Array] = []
    coded: list[bytes] = []
    held = 0

    def block() -> pa.RecordBatch:
        nonlocal number, held
        ids = np.frombuffer(b"".join(coded), "<u4")
        lengths = np.array([len(c) // 4 for c in coded], np.int64)
        names = pa.concat_arrays(docs)
        out = pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(coded)], pa.int64()),
             pa.array([len(ids)], pa.int64()), pa.ListArray.from_arrays([0, len(names)], names),
             pa.ListArray.from_arrays([0, len(lengths)], pa.array(lengths)),
             pa.array([mixing_coder.encode(ids, vocabulary)], pa.binary())],
            names=["part", "block", "n_docs", "n_tokens", "ids", "lengths", "data"],
        )
        docs.clear()
        coded.clear()
        number, held = number + 1, 0
        return out

    for batch in batches:
        begin = 0
        ids, texts = batch.column("_id"), batch.column("_text")
        for some in range(0, batch.num_rows, 200):
            for k, one in enumerate(encoder.encode(common.texts(texts.slice(some, 200)))):
                coded.append(one + end_bytes)
                held += len(one) // 4 + 1
                if held >= size:
                    docs.append(ids.slice(begin, some + k + 1 - begin))
                    begin = some + k + 1
                    yield block()
        docs.append(ids.slice(begin))
    if coded:
        yield block()


def write(
    docs: DataFrame, path: str, tokenizer: str, end: int = 0, keep_space: bool = True, vocabulary: int = 1 << 16,
    id: str = "doc_id", text: str = "text", block: int = BLOCK,
) -> None:
    """Write the ids of all documents below ``path``."""
    rows = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    start = F.substring("_text", 1, 24)
    dealt = rows.repartitionByRange(common.partitions(docs.sparkSession), "_id", start)
    blocks = common.map_arrow(
        dealt.sortWithinPartitions("_id", "_text"), _blocks,
        f"{KEY}, n_docs long, n_tokens long, ids array<{kind}>, lengths array<long>, data binary",
        tokenizer, keep_space, end, vocabulary, block,
    )
    blocks.write.option("compression", "none").parquet(path)


def _decoded(
    batches: Iterator[pa.RecordBatch], fold: Callable[[np.ndarray, np.ndarray], dict[str, pa.Array]]
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids = mixing_coder.decode(row.column("data")[0].as_buffer().to_pybytes())
            lengths = row.column("lengths")[0].values.to_numpy()
            n, ends = len(lengths), np.cumsum(lengths)
            if len(ids) != row.column("n_tokens")[0].as_py() or (n and ends[-1] != len(ids)):
                raise mixing_coder.Corrupt("documents do not fit the ids of the block")
            more = fold(ids, ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, row.column(c)[0].as_py(), np.int32)) for c in ("part", "block")]
                + [pa.array(np.arange(n, dtype=np.int32)), row.column("ids")[0].values, pa.array(lengths),
                   pa.array(ends - lengths), *more.values()],
                names=["part", "block", "place", "_id", "n_tokens", "before", *more],
            )


def as_arrays(ids: np.ndarray, ends: np.ndarray) -> dict[str, pa.Array]:
    """The ids of each document."""
    return {"ids": pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), pa.array(ids.astype(np.int32)))}


def as_checksums(ids: np.ndarray, ends: np.ndarray) -> dict[str, pa.Array]:
    """The checksum of each document's ids."""
    view, edges = memoryview(ids.tobytes()), (4 * np.r_[0, ends]).tolist()
    found = [zlib.crc32(view[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return {"ids_crc32": pa.array(found, pa.int64())}


def load(
    spark: SparkSession, path: str, fold: Callable = as_arrays, columns: str = "ids array<int>"
) -> DataFrame:
    """Documents of the files: ``_id``, ``n_tokens``, ``start`` (ids of all documents before) and what ``fold`` makes.

    Only the numbers of ids per range and block are added up across blocks, never rows of documents.
    """
    files = spark.read.parquet(path)
    kind = files.schema["ids"].dataType.elementType.simpleString()
    blocks = files.select("part", "block", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.join(parts, "part").select(
        "part", "block", (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("base")
    )
    docs = common.map_arrow(
        files.select("part", "block", "n_tokens", "ids", "lengths", "data"), _decoded,
        f"{KEY}, place int, _id {kind}, n_tokens long, before long, {columns}", fold,
    )
    return docs.join(begins, ["part", "block"]).select(
        "_id", "n_tokens", (F.col("base") + F.col("before")).alias("start"),
        *[c for c in docs.columns if c not in ("part", "block", "place", "_id", "n_tokens", "before")],
    )
