"""Shared helpers: tables between steps, lasting row keys, joins that a hot key does not block.

Missing texts count as empty. Operators select the columns they need under names of their own, so
further columns of the caller, whatever their names, neither clash nor get lost.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.sources.files import is_local

#: A key with more than this part of all rows is hot, so there are at most HOT_PARTS hot keys.
HOT_PARTS = 1000

_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local session may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        base = _own.setdefault(app, _own.get(app) or tempfile.mkdtemp(prefix="llm-"))
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder: lineage is cut, every later read sees the same rows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing will read again."""
    for table in tables:
        path = getattr(table, "_scratch_path", None)
        if path:
            jvm = table.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rooted(df: DataFrame) -> DataFrame:
    """The same rows, each with a place in a file: rows that are not just read from files are written first."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    if "Relation" in node.nodeName() and node.children().isEmpty():
        try:
            df.metadataColumn("_metadata")
            df.select(df.metadataColumn("_metadata")["row_index"]).schema  # noqa: B018  resolves it
            return df
        except AnalysisException:
            pass
    return stored(df, "rows")


def keyed(df: DataFrame, **columns: object) -> DataFrame:
    """The given columns with a row key (``_file``, ``_row``) that stays the same in every read and retry.

    It comes from the place of the row in its file, so repeated rows and missing ids are told apart.
    Functions that take keys of one frame twice call ``rooted`` before.
    """
    df = rooted(df)
    chosen = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    place = df.metadataColumn("_metadata")
    return df.select(F.xxhash64(place["file_path"]).alias("_file"), place["row_index"].alias("_row"), *chosen)


def whole_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """Key, text and the whole row as ``doc``."""
    return keyed(df, _text=F.coalesce(F.col(text), F.lit("")), doc=F.struct(*[F.col(f"`{c}`") for c in df.columns]))


def map_arrow(df: DataFrame, f: Callable[..., Iterator[pa.RecordBatch]], schema: str, *args: object) -> DataFrame:
    """``mapInArrow`` with further arguments for the function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return f(batches, *args)

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """Strings of an Arrow column; a missing one is empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def partitions(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach(rows: DataFrame, table: DataFrame, on: Sequence[str], size: str, total: int) -> DataFrame:
    """Left join to a table with one row per key, whose column ``size`` counts the key's rows among ``total``.

    Keys with over a thousandth of the rows go through a broadcast (there cannot be more than a thousand
    such keys); every other key is small, so its shuffle partition is too. Both inputs are read twice.
    """
    limit = max(1, total // HOT_PARTS)
    hot = F.broadcast(table.filter(F.col(size) > limit))
    rest = table.filter(F.col(size) <= limit)
    through = rows.join(hot, list(on))
    shuffled = rows.join(F.broadcast(hot.select(*on)), list(on), "left_anti").join(rest, list(on), "left")
    return through.unionByName(shuffled)
