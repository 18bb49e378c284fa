"""Tokenising, packing, token files and byte-level BPE against the tokenizer libraries and exact round trips."""

from __future__ import annotations

import math
import random
import time
import zlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN
from tokenizers import Tokenizer

from clickmart.llm import bpe_tree, common, mixing_coder, packing, token_files, tokens
from clickmart.llm.queries import QUERIES

SMALL = settings(max_examples=150, deadline=None)
PIECES = [
    "a", "b", "the", " The", "'s", "'", "'r", "e", " ", "  ", "\n", "\t", "\xa0", "é", "É", "ß", "1", "²", "!", "##",
    "***", "日本", "　", "\x1c", "x" * 40, "\U0001f600", "é", "_", "µ", "İ", "Σ", "<|endoftext|>", "\r\n",
]
TEXT = st.lists(st.sampled_from(PIECES), max_size=40).map("".join)


def library(path, plain=True):
    found = Tokenizer.from_file(path)
    found.encode_special_tokens = not plain
    return found


@pytest.mark.parametrize("plain", [True, False])
@pytest.mark.parametrize("name, keep_space", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_ids_are_those_of_the_library(vocabulary, name, keep_space, plain):
    path = vocabulary(name)
    encoder = tokens.Ranks(path, plain) if keep_space else tokens.Words(path, plain, most=50)
    of_library = library(path, plain)

    @SMALL
    @given(TEXT)
    def check(text):
        want = of_library.encode(text, add_special_tokens=False).ids
        for _ in range(3):
            assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want

    check()


def test_byte_level_ids_of_every_character_and_of_long_runs(vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    encoder, of_library = tokens.encoder(path, True), library(path)
    every = [chr(i) for i in range(0x20000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}b 1{c}{c} {c}." for c in every[i : i + 512]) for i in range(0, len(every), 512)]
    texts += ["=" * 200_000, " " * 50_000, "\n x" * 20_000, "ab" * 50_000]
    for text, want in zip(texts, of_library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == want.ids


# Packing


@SMALL
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=20), st.integers(64, 200))
def test_plans_hold_every_piece_once(histogram, size):
    used = {}
    sequences = 0
    for pieces, times in packing.plan(histogram, size):
        assert sum(n * m for n, m in pieces) <= size
        sequences += times
        for n, m in pieces:
            used[n] = used.get(n, 0) + m * times
    assert used == histogram
    total = sum(n * c for n, c in histogram.items())
    assert math.ceil(total / size) <= sequences <= 2 * total / size + 1


def test_least_squares_are_not_negative_and_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((8, 12)), rng.normal(size=8)
        x = packing.non_negative_least_squares(a, b)
        gradient = a.T @ (a @ x - b)
        assert (x >= 0).all() and (gradient > -1e-6).all() and abs(gradient @ x) < 1e-6


def test_plans_are_near_the_bound():
    rng = np.random.default_rng(0)
    lengths = np.clip(rng.lognormal(6, 1.3, 100_000).astype(int), 1, 4096)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    assert sum(k for _, k in packing.plan(histogram, 4096)) <= 1.01 * lengths.sum() / 4096 + 1


def test_packed_sequences_are_gapless_and_hold_the_ids(frame, odd_rows, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    found = packing.pack(frame(odd_rows), path, size=256, end=1, with_ids=True).toPandas()
    plain = library(path)
    want = {}
    for i, (_, text) in enumerate(odd_rows):
        want[i] = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
    documents = [
        sum((list(x) for x in g.sort_values("piece")["ids"]), []) for _, g in found.groupby(["_file", "_row"])
    ]
    assert sorted(documents) == sorted(want.values())
    for _, g in found.groupby(["_file", "_row"]):
        g = g.sort_values("piece")
        assert (g.start.to_numpy() == 256 * np.arange(len(g))).all() and (g.length[:-1] == 256).all()
    for _, g in found.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 256
    crc = [zlib.crc32(np.array(x, "<u4").tobytes()) for x in found["ids"]]
    assert found.ids_crc32.tolist() == crc
    assert packing.pack(frame([]), path).count() == 0


# Token files


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 1500), st.integers(1, 5000), st.integers(0, 2**32))
def test_blocks_round_trip(n, vocabulary, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(vocabulary - 1, rng.zipf(1.3, n) - 1) if seed % 2 else rng.integers(0, vocabulary, n)
    assert (mixing_coder.decode(mixing_coder.encode(ids.astype(np.uint32), vocabulary)) == ids).all()


def test_long_blocks_round_trip_and_use_what_repeats():
    rng = np.random.default_rng(0)
    random_ids = rng.integers(0, 50257, 300_000).astype(np.uint32)
    repeated = np.tile(rng.integers(0, 50257, 1000), 300).astype(np.uint32)
    sizes = []
    for ids in (random_ids, repeated):
        block = mixing_coder.encode(ids, 50257)
        assert (mixing_coder.decode(block) == ids).all()
        sizes.append(len(block))
    assert sizes[0] < 2.2 * len(random_ids) and sizes[1] < sizes[0] / 4


def test_damaged_blocks_are_found():
    block = mixing_coder.encode(np.arange(1000, dtype=np.uint32), 1000)
    for place in (0, 30, len(block) // 2, len(block) - 1):
        damaged = bytearray(block)
        damaged[place] ^= 1
        with pytest.raises(mixing_coder.Corrupt):
            mixing_coder.decode(bytes(damaged))
    with pytest.raises(mixing_coder.Corrupt):
        mixing_coder.decode(block[:-2])
    with pytest.raises(ValueError, match="vocabulary"):
        mixing_coder.encode(np.array([5], np.uint32), 5)


def test_token_files_round_trip(spark, frame, odd_rows, vocabulary, tmp_path):
    path, plain = vocabulary("byte_bpe_50k.json"), library(vocabulary("byte_bpe_50k.json"))
    token_files.write(frame(odd_rows), str(tmp_path / "ids"), path, end=0, block=500)
    found = token_files.load(spark, str(tmp_path / "ids")).orderBy("start").collect()
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r["_id"] for r in found] == [id for id, _ in ordered]
    start = 0
    for row, (_, text) in zip(found, ordered, strict=True):
        want = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        assert row["ids"] == want and row["start"] == start and row["n_tokens"] == len(want)
        start += len(want)
    token_files.write(frame([]), str(tmp_path / "none"), path)
    assert token_files.load(spark, str(tmp_path / "none")).count() == 0


def test_an_id_that_very_many_share_is_dealt_out(spark, frame, vocabulary, tmp_path):
    rows = [(None, f"text {i * 7919 % 2000:04}") for i in range(2000)] + [(1, "last")]
    token_files.write(frame(rows), str(tmp_path / "ids"), vocabulary("byte_bpe_50k.json"))
    blocks = spark.read.parquet(str(tmp_path / "ids")).select("part", "n_docs").collect()
    assert len({r["part"] for r in blocks}) > 4 and max(r["n_docs"] for r in blocks) < 1000
    found = token_files.load(spark, str(tmp_path / "ids"), token_files.as_checksums, "ids_crc32 long").orderBy("start").collect()
    of_library = library(vocabulary("byte_bpe_50k.json"))
    want = [[*of_library.encode(t, add_special_tokens=False).ids, 0] for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[1]))]
    assert [r["ids_crc32"] for r in found] == [zlib.crc32(np.array(ids, "<u4").tobytes()) for ids in want]


# Byte-level BPE


@pytest.fixture(scope="module")
def codec(vocabulary):
    return bpe_tree.Codec(vocabulary("byte_bpe_50k.tiktoken"), PATTERN, most=100)


@pytest.fixture(scope="module")
def reference_encoding(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_tree_encoding_is_that_of_the_library(codec, reference_encoding, monkeypatch):
    monkeypatch.setattr(bpe_tree, "LEAF", 8)

    @SMALL
    @given(TEXT)
    def check(text):
        ids = memoryview(codec.encode(text)).cast("I")
        assert ids.tolist() == reference_encoding.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()

    check()


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 20_000, "\n" * 9000 + "x", "ab" * 9000, "é" * 9000, "'" * 5000])
def test_long_runs(codec, reference_encoding, text):
    assert memoryview(codec.encode(text)).cast("I").tolist() == reference_encoding.encode_ordinary(text)


@pytest.mark.parametrize("text", ["=" * 1_000_000, "ha" * 200_000, "abc" * 100_001, "é" * 70_000, " " * 100_000])
def test_very_long_runs_take_seconds(codec, reference_encoding, text):
    begin = time.monotonic()
    found = codec.encode(text)
    assert time.monotonic() - begin < 20
    assert memoryview(found).cast("I").tolist() == reference_encoding.encode_ordinary(text)
    assert codec.decode(memoryview(found).cast("I")) == text.encode()


def test_windows_merged_by_heap_and_by_list(codec):
    rng = random.Random(1)
    for n in (2, 7, 60, 300):
        for letters in (b"a", b"ab", b"the re", bytes(range(256))):
            data = bytes(rng.choices(letters, k=n))
            assert codec._merged_by_heap(data) == codec.tokens(data)


def test_long_words_without_pattern(codec, reference_encoding):
    rng = random.Random(0)
    for _ in range(5):
        word = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5000))
        assert memoryview(codec.encode(word)).cast("I").tolist() == reference_encoding.encode_ordinary(word)


def test_documents_are_encoded_and_decoded(frame, odd_rows, vocabulary, reference_encoding):
    found = bpe_tree.encode(frame(odd_rows), vocabulary("byte_bpe_50k.tiktoken"), PATTERN).collect()
    want = [(id, reference_encoding.encode_ordinary(text or ""), (text or "").encode()) for id, text in odd_rows]
    assert sorted([(r["_id"], r["ids"], bytes(r["decoded"])) for r in found], key=str) == sorted(want, key=str)
    assert bpe_tree.encode(frame([]), vocabulary("byte_bpe_50k.tiktoken"), PATTERN).count() == 0


def test_registered_token_files_are_the_plain_library_call(spark, sf_dir, vocabulary):
    """All columns of op4, end id and checksums included, against the library."""
    of_library, start = library(vocabulary("byte_bpe_50k.json")), 0
    docs = sorted(map(tuple, common.read(spark, sf_dir, "documents").select("doc_id", "text").collect()))
    found = {r["doc_id"]: r for r in QUERIES["op4_token_files"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for doc, text in docs:
        ids = [*of_library.encode(text or "", add_special_tokens=False).ids, 0]
        row = found[doc]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
