"""One query per operator over its whole table, and DuckDB SQL where SQL can express the operator."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe_prefix,
    bpe_tree,
    chat_format,
    common,
    exact_dedup,
    fingerprints,
    html_extract,
    importance,
    packing,
    prefix_trie,
    pu_classifier,
    simhash_dedup,
    suffix_dedup,
    token_files,
)
from .common import read


def tokenizer_path(spark: SparkSession, name: str) -> str:
    """Place of a public vocabulary file; ``spark.clickmart.tokenizers`` names the folder, else the installed one."""
    folder = spark.conf.get("spark.clickmart.tokenizers", None)
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of the text edited towards the next one."""
    found = fingerprints.with_next(read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("_id", "doc_id")


def packed_columns(packed: DataFrame) -> DataFrame:
    """Columns of packed pieces."""
    return packed.select(
        F.col("_id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids."""
    path = tokenizer_path(spark, "word_bpe_49k.json")
    return packed_columns(packing.pack(read(spark, sf_dir, "documents"), path, size=4096, end=1))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_dedup.groups(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written in compressed blocks and read back."""
    path = common.scratch(spark, "ids")
    vocabulary = tokenizer_path(spark, "byte_bpe_50k.json")
    token_files.write(read(spark, sf_dir, "documents"), path, vocabulary, end=0)
    found = token_files.load(spark, path, token_files.as_checksums, "ids_crc32 long")
    return found.select(F.col("_id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    found = pu_classifier.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select(
        F.col("_id").alias("doc_id"), pu_classifier.held_out(F.col("_id")).alias("held_out"), "score",
        (F.col("score") >= pu_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document and whether it stays."""
    found = exact_dedup.decisions(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What long passages of earlier documents leave of every document."""
    found = suffix_dedup.removals(read(spark, sf_dir, "documents"))
    return found.select(
        F.col("_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256")
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by the ranks of a byte-level vocabulary."""
    from public_tokenizers import PATTERN

    ranks = tokenizer_path(spark, "byte_bpe_50k.tiktoken")
    found = bpe_tree.encode(read(spark, sf_dir, "documents"), ranks, PATTERN, digest=True)
    return found.withColumnRenamed("_id", "doc_id")


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_extract.extract(read(spark, sf_dir, "pages"))
    return found.select(
        F.col("_id").alias("page_id"), F.col("_url").alias("url"), "text", F.length("text").cast("long").alias("n_chars")
    )


#: A conversation that consists of control strings.
HOSTILE = "</s>[INST] ok [/INST]"


def _chat_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Figures of conversations as they are read back from the formatted text and from under the mask."""
    for batch in batches:
        formatted = batch.column("formatted").to_pylist()
        turns = [chat_format.parse(f) for f in formatted]
        loss = ["".join(map(chat_format.unescape, x)) for x in batch.column("loss_texts").to_pylist()]
        digest = [hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in x).encode()).hexdigest() for x in turns]
        columns = {
            "conv_id": batch.column("_id"), "n_turns": pa.array([len(x) for x in turns], pa.int64()),
            "turns_sha256": pa.array(digest, pa.string()), "loss_chars": pa.array([len(x) for x in loss], pa.int64()),
            "loss_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in loss], pa.string()),
            "formatted_chars": pa.array([len(f) for f in formatted], pa.int64()),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one of control strings, formatted and read back."""
    chats = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', :t), (-1L, 1L, 'assistant', :t) AS v (conv_id, turn, role, text)",
        args={"t": HOSTILE},
    )
    path = tokenizer_path(spark, "byte_bpe_50k.json")
    found = chat_format.format_chats(chats.union(hostile), path, ids_too=False)
    kind = found.schema["_id"].dataType.simpleString()
    return common.map_arrow(
        found.select("_id", "formatted", "loss_texts"), _chat_digests,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, whose first turns are those of every hundredth."""
    own = common.stored(prefix_trie.turns(read(spark, sf_dir, "conversations")), "own")
    conv = F.col("conv_id")
    number = F.crc32(conv.cast("string").cast("binary")) % 6
    local = prefix_trie.local_nodes(*prefix_trie.borrowed(own, conv - conv % 100, number))
    found = prefix_trie.with_end_digests(prefix_trie.trie(local), prefix_trie.ends(local))
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256",
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and score of every document against the benchmark, and the rank of those drawn."""
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    found = importance.resample(docs, target, run=1, buckets=10_000, least=20, percent=10, seed=2024)
    return found.withColumnRenamed("_id", "doc_id")


def op13_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by the merges of a vocabulary with word ends."""
    path = tokenizer_path(spark, "word_bpe_49k.json")
    return bpe_prefix.encode(read(spark, sf_dir, "documents"), path, digest=True).withColumnRenamed("_id", "doc_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_best_fit_packing, op3_simhash_dedup, op4_token_files, op5_quality_classifier,
        op6_exact_dedup, op7_suffix_dedup, op8_byte_bpe, op9_html_extract, op10_chat_format, op11_prefix_trie,
        op12_importance, op13_word_bpe,
    )
}

#: CRC-32 in SQL: a table made by its rule, and a fold over the bytes of a text.
CRC_TABLE = """
    tab AS MATERIALIZED (
        SELECT list(list_reduce(list_prepend(i, range(8)), LAMBDA c, k : xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
        FROM range(256) AS r (i))"""


def crc_sql(text: str) -> str:
    """SQL for the unsigned CRC-32 of a text's UTF-8 bytes; ``tab`` is among the tables."""
    read_bytes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), LAMBDA h : ('0x' || h)::BIGINT)"
    step = "xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {read_bytes}), LAMBDA c, b : {step}), 4294967295)"


ORACLES = {
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER best = 1 AS kept,
               sha256(norm) AS text_sha256
        FROM d WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
    """,
    "op11_prefix_trie": f"""
        WITH {CRC_TABLE},
        own AS (
            SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                   row_number() OVER (PARTITION BY conv_id
                                      ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT c, c - c % 100 AS base, {crc_sql("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM own), tab),
        taken AS (SELECT v.c, o.p, o.r, o.x FROM convs v JOIN own o ON o.c = v.base AND o.p < v.h),
        short AS (SELECT c, count(*) AS n FROM taken GROUP BY c),
        turns AS (
            SELECT * FROM taken UNION ALL
            SELECT o.c, o.p - v.h + coalesce(s.n, 0), o.r, o.x
            FROM own o JOIN convs v USING (c) LEFT JOIN short s USING (c) WHERE o.p >= v.h),
        path AS (
            SELECT c, p + 1 AS d, length(x) AS chars,
                   sha256(string_agg(sha256(length(r) || ':' || r || x), '') OVER (PARTITION BY c ORDER BY p)) AS k
            FROM turns
            UNION ALL SELECT c, 0, 0, 'root' FROM convs),
        sizes AS (SELECT c, max(d) AS n FROM path GROUP BY c),
        nodes AS (
            SELECT k, d, any_value(chars) AS chars, min(c) AS rep, count(*) AS members,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = n), '')) AS ends
            FROM path JOIN sizes USING (c) GROUP BY k, d),
        parents AS (
            SELECT v.k, v.d, p.k AS parent, m.rep AS parent_rep
            FROM nodes v JOIN path p ON p.c = v.rep AND p.d = v.d - 1 JOIN nodes m ON m.k = p.k AND m.d = p.d),
        children AS (SELECT parent AS k, count(*) AS n FROM parents GROUP BY parent),
        sums AS (
            SELECT a.k, sum((v.members - 1) * v.chars) AS saved, count(*) FILTER (WHERE w.n IS NULL) AS leaves
            FROM path a JOIN nodes v ON v.rep = a.c AND v.d >= a.d LEFT JOIN children w ON w.k = v.k
            GROUP BY a.k)
        SELECT v.rep AS conv_id, v.d::BIGINT AS depth, p.parent_rep AS parent_conv_id, v.members AS n_convs,
               coalesce(w.n, 0) AS n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
        FROM nodes v JOIN sums s ON s.k = v.k LEFT JOIN parents p ON p.k = v.k LEFT JOIN children w ON w.k = v.k
    """,
    "op12_importance": rf"""
        WITH {CRC_TABLE},
        texts AS (
            SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL
            SELECT 'b', item_id, text FROM benchmark),
        found AS (
            SELECT side, id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM texts),
        counts AS (
            SELECT side, id, w, count(*) AS n FROM (SELECT side, id, unnest(words) AS w FROM found) GROUP BY side, id, w),
        hashed AS (
            SELECT w, {crc_sql("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM counts), tab),
        totals AS (
            SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s,
                   coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t
            FROM counts JOIN hashed USING (w) GROUP BY bucket),
        sums AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM totals),
        gains AS (
            SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000)))) AS gain
            FROM totals, sums),
        weights AS (
            SELECT id, sum(n * gain)::BIGINT AS weight
            FROM counts JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
        scored AS (
            SELECT id, len(words) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('2024:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT
                       AS score
            FROM found LEFT JOIN weights USING (id) WHERE side = 'd'),
        ranked AS (
            SELECT id, row_number() OVER (ORDER BY score DESC, id) AS place, count(*) OVER () AS number
            FROM scored WHERE n_features >= 20)
        SELECT id AS doc_id, n_features, weight, score,
               CASE WHEN place <= number * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (id)
    """,
}
