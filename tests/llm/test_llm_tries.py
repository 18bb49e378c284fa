"""Prefix BPE against the library, importance resampling and the prefix trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickmart.llm import bpe_prefix, common, importance, prefix_trie
from clickmart.llm.queries import QUERIES

SMALL = settings(max_examples=150, deadline=None)
PIECES = [
    "a", "b", "the", " The", "'s", "'", "'r", "e", " ", "  ", "\n", "\t", "\xa0", "é", "É", "ß", "1", "²", "!", "##",
    "***", "日本", "　", "\x1c", "x" * 40, "\U0001f600", "é", "_", "µ", "İ", "Σ", "<|endoftext|>", "\r\n",
    "<|STARTOFTEXT|>", "<|startoftext|>", "</w>", "</w", "̈",
]


# Prefix BPE


@pytest.fixture(scope="module")
def words(vocabulary):
    path = vocabulary("word_bpe_49k.json")
    return path, bpe_prefix.Coder(path, most=100), Tokenizer.from_file(path)


@SMALL
@given(st.data())
def test_prefix_ids_are_those_of_the_plain_library_call(words, data):
    _, coder, library = words
    text = "".join(data.draw(st.lists(st.sampled_from(PIECES), max_size=40)))
    want = library.encode(text, add_special_tokens=False).ids
    for _ in range(3):
        number, ids, decoded = bpe_prefix._whole(coder.encode(text))
        assert (number, ids, decoded) == (len(want), want, library.decode(want, skip_special_tokens=False))


@SMALL
@given(st.text("etaoinshr'1", max_size=60))
def test_prefix_ids_of_letters(words, text):
    _, coder, library = words
    assert bpe_prefix._whole(coder.encode(text))[1] == library.encode(text, add_special_tokens=False).ids


def test_tokens_fit_if_their_bytes_encode_to_them(words):
    """Seams read off the merges against plain merging of both tokens' signs."""
    vocabulary = words[1].vocabulary
    form = {}
    with open(words[0], encoding="utf-8") as file:
        for token, i in __import__("json").load(file)["model"]["vocab"].items():
            form[i] = vocabulary._form(token)
    of_form = {f: i for i, f in form.items()}

    def merged(text):
        inner = text.removesuffix(bpe_prefix.END)
        parts = list(inner)
        if len(inner) < len(text):
            parts[-1] += bpe_prefix.END
        parts = [of_form[p] for p in parts]
        while True:
            ranks = [vocabulary.pair.get(a << 32 | b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
            if not ranks or min(ranks) == 1 << 60:
                return parts
            at = ranks.index(min(ranks))
            parts[at : at + 2] = [of_form[form[parts[at]] + form[parts[at + 1]]]]

    rng = random.Random(0)
    inner = [i for i, f in form.items() if not f.endswith(bpe_prefix.END) and i < 5000 and merged(f) == [i]]
    every = [i for i in list(form)[:8000] if merged(form[i]) == [i]]
    for _ in range(3000):
        a, b = rng.choice(inner), rng.choice(every)
        assert vocabulary.fit(a, b) == (merged(form[a] + form[b]) == [a, b])


@pytest.mark.parametrize("text", ["=" * 300_000, "ab" * 100_000, "ha" * 50_000 + "!?" * 50_000])
def test_long_words(words, text):
    _, coder, library = words
    number, ids, _ = bpe_prefix._whole(coder.encode(text))
    assert ids == library.encode(text, add_special_tokens=False).ids and number == len(ids)


def test_stretches_of_a_long_text(words, monkeypatch):
    _, coder, library = words
    monkeypatch.setattr(bpe_prefix, "STRETCH", 7)
    text = "One two, three\tfour  five's six\n\n seven eleven " * 20
    assert bpe_prefix._whole(coder.encode(text))[1] == library.encode(text, add_special_tokens=False).ids
    assert bpe_prefix._digests(coder.encode(" ")) == (0, *[hashlib.sha256(b"").hexdigest()] * 2)


def test_odd_rows_of_prefix_bpe(spark, frame, odd_rows, words):
    path, _, library = words
    found = bpe_prefix.encode(frame(odd_rows), path).collect()
    digests = bpe_prefix.encode(frame(odd_rows), path, digest=True).collect()
    want, hashed = Counter(), Counter()
    for doc, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[doc, len(ids), tuple(ids), decoded] += 1
        shas = (hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))
        hashed[doc, len(ids), *shas] += 1
    assert Counter((r["_id"], r["n_tokens"], tuple(r["ids"]), r["decoded"]) for r in found) == want
    assert Counter(map(tuple, digests)) == hashed
    assert bpe_prefix.encode(frame([]), path).collect() == []


def test_op13_is_the_library(spark, sf_dir, words):
    library = words[2]
    texts = {r["doc_id"]: r["text"] for r in common.read(spark, sf_dir, "documents").collect()}
    rows = QUERIES["op13_word_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


# Importance resampling


def plain_resample(docs, target, run, buckets, least, percent, seed):
    def features(text):
        lowered = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        runs = [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(x.encode()) % buckets for x in runs]

    cut = [(doc, *features(text)) for doc, text in docs]
    s, t = Counter(b for _, _, x in cut for b in x), Counter(b for _, x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    rows = []
    for doc, n_words, x in cut:
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in x
        )
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((doc, len(x), weight, score, n_words >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    most, out = len(order) * percent // 100, Counter((*r[:4], None) for r in rows if not r[4])
    return out + Counter((*r[:4], k if k <= most else None) for k, r in enumerate(order, 1))


@pytest.mark.parametrize("run, size, least, percent", [(1, 3, 1, 50), (2, 5, 0, 100), (3, 1, 2, 34), (2, 20_000, 20, 10)])
def test_resampling_is_exact_for_any_head(spark, frame, odd_rows, run, size, least, percent):
    rng = random.Random(run)
    rows = odd_rows + [(100 + i, " ".join(rng.choices(["ab", "Cd", "é", "x1", "the", "İ"], k=i % 30))) for i in range(90)]
    target = [(1, "the ab the Cd"), (2, None), (3, "é-é;The x1"), (3, "")]
    made = importance.resample(
        frame(rows), frame(target), run=run, buckets=50, least=least, percent=percent, seed=7, head_size=size
    )
    assert Counter(map(tuple, made.collect())) == plain_resample(rows, target, run, 50, least, percent, 7)


def test_resampling_of_empty_tables(spark, frame, odd_rows):
    assert importance.resample(frame([]), frame(odd_rows)).collect() == []
    found = importance.resample(frame(odd_rows), frame([]), run=1, buckets=10, least=1, percent=100, seed=1).collect()
    assert Counter(map(tuple, found)) == plain_resample(odd_rows, [], 1, 10, 1, 100, 1)


def test_frequent_words_are_found_by_every_task(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(0)
    names = [f"w{i}" for i in rng.integers(0, 3000, 20_000)] + ["often"] * 4000 + ["usual"] * 3000
    rng.shuffle(names)
    texts = [" ".join(names[i : i + 100]) for i in range(0, len(names), 100)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["_text"])
    (found,) = importance._frequent(iter([batch]), 1, 20)
    assert {b"often", b"usual"} <= set(found.column("feature").to_pylist()) and found.num_rows <= 20


# Prefix trie


def plain_trie(convs):
    """Figures of every node by its path, from the turns (role, text) of each conversation."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    out = Counter()
    for path, found in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * (len(p[-1][1]) if p else 0) for p in below)
        text = ",".join(map(str, sorted(ends[path])))
        out[
            min(found), len(path), min(members[path[:-1]]) if path else None, len(found), len(children), len(leaves),
            saved, hashlib.sha256(text.encode()).hexdigest(),
        ] += 1
    return out


def ordered(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            out[c].append(((turn is not None, turn or 0, role or "", digest), (role or "", text or "")))
    return {c: [x for _, x in sorted(turns)] for c, turns in out.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


FIGURES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256")


def chats(spark, rows):
    found = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = ("pos", "chars", "size", "node", "shard", "_base", "_number", "_turn", "_role", "first", "depth")
    return found.selectExpr("conv_id", "turn", "role", "text", *(f"'e' AS `{c}`" for c in extra))


def odd_chats(seed, number, roles=("user", "assistant", None), texts=("hi", "", None, "é日", "long " * 50)):
    rng = random.Random(seed)
    return [
        (rng.choice([0, 1, 2, 99, 100, 101, 150, 200, 305, 1005, 1006, 7, 8, 9, None]), rng.choice([None, 0, 1, 2, 2, 3]),
         rng.choice(roles), rng.choice(texts)) for _ in range(number)
    ]


@pytest.mark.parametrize("shard, long, number", [(2048, 1 << 16, 60), (1, 100, 60), (3, 4, 80), (2, 1, 40), (2048, 1 << 16, 200)])
def test_trie_is_that_of_brute_force(spark, shard, long, number):
    rows = odd_chats(number, number) + [(None, 0, "user", "x"), (-5, 1, "user", "hi"), (-105, 1, "user", "hi")]
    own = common.stored(prefix_trie.turns(chats(spark, rows)), "own")
    number = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    convs, turns = prefix_trie.borrowed(own, F.col("conv_id") - F.col("conv_id") % 100, number)
    local = prefix_trie.local_nodes(convs, turns, shard, long)
    found = prefix_trie.with_end_digests(prefix_trie.trie(local), prefix_trie.ends(local))
    assert Counter(map(tuple, found.select(*FIGURES).collect())) == plain_trie(rebuilt(ordered(rows)))


def test_a_turn_that_most_conversations_share(spark):
    rows = [(c, t, "user", "same" if t == 0 else f"{c % 7} {t}") for c in range(400) for t in range(c % 5)]
    rows += [(1000 + c, 0, "user", "same") for c in range(300)]
    own = prefix_trie.turns(chats(spark, rows))
    convs = own.select("conv_id").distinct()
    local = prefix_trie.local_nodes(convs, own, 50)
    found = prefix_trie.with_end_digests(prefix_trie.trie(local), prefix_trie.ends(local))
    assert Counter(map(tuple, found.select(*FIGURES).collect())) == plain_trie(ordered(rows))
    lists = [r["ends"] for r in prefix_trie.ends(local).collect()]
    assert sorted(i for x in lists for i in x) == sorted(ordered(rows)) and max(map(len, lists)) <= 50


def test_trie_without_conversations(spark):
    own = common.stored(prefix_trie.turns(chats(spark, [(None, 1, "user", "x")])), "own")
    local = prefix_trie.local_nodes(*prefix_trie.borrowed(own, F.col("conv_id"), F.lit(1)))
    found = prefix_trie.with_end_digests(prefix_trie.trie(local), prefix_trie.ends(local))
    assert found.select(*FIGURES).collect() == []
