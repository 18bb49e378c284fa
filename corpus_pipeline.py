"""A training corpus from the documents: quality, exact and near copies, shared passages, packed sequences.

Every stage works on all that the one before kept. Stages are written as Parquet below ``spark.checkpoint.dir``
and read back, so a lost executor costs at most the running stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.llm import common, exact_dedup, packing, pu_classifier, simhash_dedup, suffix_dedup
from clickmart.llm.queries import packed_columns, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return pu_classifier.keep_good(docs, common.read(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_dedup.dedup(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages that documents with smaller ids have."""
    found = suffix_dedup.dedup(docs)
    if "n_chars" in found.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    path = tokenizer_path(spark, "word_bpe_49k.json")
    return packed_columns(packing.pack(docs, path, size=4096, end=1))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("suffix-array dedup", passages),
    ("best-fit packing", sequences),
]

#: Scores, XXH64 fingerprints and token ids have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = common.read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, docs = docs, common.stored(stage(spark, docs, sf_dir), "stage")
        common.dropped(before)
    return docs
