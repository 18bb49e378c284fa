"""Exact, SimHash and passage de-duplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmart.llm import exact_dedup, graph, simhash_dedup, suffix_dedup
from clickmart.llm.run_index import RunIndex

SMALL = settings(max_examples=40, deadline=None)


def is_prime(n):
    return all(pow(a, n - 1, n) == 1 for a in (2, 3, 5, 7, 11, 13, 17, 19, 23))


# Exact copies


def test_moduli_are_primes_that_fit():
    assert all(is_prime(p) and 255 * p * exact_dedup.CHUNK < 2**64 for p in exact_dedup.PRIMES)


@SMALL
@given(st.binary(max_size=300), st.binary(max_size=300))
def test_fingerprints_compose(left, right):
    moduli = exact_dedup.moduli_of()
    joined = exact_dedup.combine(
        exact_dedup.fingerprint(left, moduli), exact_dedup.fingerprint(right, moduli), len(right), moduli
    )
    direct = tuple(
        sum(b * pow(base, i, p) for i, b in enumerate(reversed(left + right))) % p for base, p in moduli
    )
    assert joined == exact_dedup.fingerprint(left + right, moduli) == direct


def expected_exact(rows):
    groups = defaultdict(list)
    for i, (id, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), id is None, id or 0, i))
    out = []
    for norm, members in groups.items():
        keep = rows[min(members)[3]][0]
        out += [(rows[m[3]][0], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (17, 13)])
def test_exact_groups_also_when_fingerprints_collide(frame, odd_rows, primes):
    rows = odd_rows + [(100 + i, "w" * (i % 7) + "ab"[i % 2] * 3 + " " * (i % 3)) for i in range(60)]
    found = exact_dedup.decisions(frame(rows), primes=primes).collect()
    want, groups = expected_exact(rows)
    assert sorted(((r["_id"], r["keep_id"], r["group_size"], r["sha"]) for r in found), key=str) == want
    assert sum(r["kept"] for r in found) == groups


def test_exact_dedup_keeps_whole_rows(frame, odd_rows):
    docs = frame(odd_rows)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == expected_exact(odd_rows)[1]
    assert exact_dedup.dedup(frame([])).count() == 0


def test_parts_have_the_fingerprint_of_the_whole(spark):
    text = "".join(random.Random(1).choices("abcdef \n", k=200_000))
    parts = [("a", i, text[i : i + 30_001]) for i in range(0, len(text), 30_001)] + [("b", 0, text)]
    frame = spark.createDataFrame(parts, "doc string, part long, body string")
    found = {r["doc"]: r[1:] for r in exact_dedup.parts_fingerprints(frame, "doc", "part", "body").collect()}
    assert found["a"] == found["b"]


# Near copies


def brute_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(prints):
    prints = np.array(prints, np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    labels = np.arange(len(prints))
    while True:
        new = np.where(near, labels[None, :], len(prints)).min(1)
        if (new == labels).all():
            return labels
        labels = new


@SMALL
@given(st.text(alphabet="aB \t\né\x1c", max_size=60))
def test_simhash_follows_its_definition(text):
    assert simhash_dedup.simhash(text) == brute_simhash(text)


def test_simhash_groups_and_whole_rows(frame, odd_rows):
    base = [f"word{i}" for i in range(400)]
    near = [(20 + i, " ".join(base[:i] + ["other"] + base[i + 1 :])) for i in range(12)]
    rows = odd_rows + near
    found = simhash_dedup.groups(frame(rows)).collect()
    labels = brute_components([brute_simhash(t or "") for _, t in rows])
    want = []
    for i, (id, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(labels == labels[i])]
        want.append((id, min((x for x in ids if x is not None), default=None)))
    assert sorted(((r["_id"], r["component_id"]) for r in found), key=str) == sorted(want, key=str)
    assert sum(r["first"] for r in found) == len(set(labels))
    docs = frame(rows)
    kept = simhash_dedup.dedup(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(labels))
    assert simhash_dedup.groups(frame([])).count() == 0


def test_long_lists_lose_no_component(spark):
    rng = np.random.default_rng(1)

    def flips(n, k, width):
        return np.array([sum(1 << int(b) for b in rng.choice(width, k, replace=False)) for _ in range(n)], np.uint64)

    base = np.uint64(0x123456789ABCDEF0)
    prints = np.unique(np.concatenate([
        base ^ flips(900, 3, 64), base ^ flips(500, 2, 20) ^ np.uint64(1 << 60),
        rng.integers(0, 1 << 63, 300).astype(np.uint64),
    ]))
    nodes = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    roots = dict(graph.components(simhash_dedup.links(nodes)).select("node", "root").collect())
    labels = brute_components(prints)
    own = [roots.get(int(x), int(x)) for x in prints.view(np.int64)]
    assert len(set(zip(labels.tolist(), own))) == len(set(labels.tolist())) == len(set(own))


def test_look_ups_and_blocks_find_the_same_components(monkeypatch):
    prints = np.unique(np.random.default_rng(2).integers(0, 1 << 24, 3000).astype(np.uint64))
    blocks = simhash_dedup._components(prints, 3)
    monkeypatch.setattr(simhash_dedup, "BLOCKWISE", 10)
    assert (simhash_dedup._components(prints, 3) == blocks).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {n: 0 if n < 50 else 100 for e in edges for n in e}


# Passages


@SMALL
@given(st.lists(st.binary(min_size=4, max_size=30), min_size=1, max_size=12, unique=True), st.data())
def test_matching_statistics(strings, data):
    length = 4
    owners = data.draw(st.lists(st.integers(0, 9), min_size=len(strings), max_size=len(strings)))
    index = RunIndex(strings, np.array(owners), length)
    patterns = [*strings, data.draw(st.binary(min_size=1, max_size=20))]
    rows, sizes, begins = index.matching_statistics(patterns)
    for pattern, begin in zip(patterns, begins, strict=True):
        for i in range(len(pattern)):
            n = 0
            while n < length and i + n < len(pattern) and any(pattern[i : i + n + 1] in s for s in strings):
                n += 1
            assert min(sizes[begin + i], length) == n
            if n == length:
                least = min(o for o, s in zip(owners, strings, strict=True) if pattern[i : i + length] in s)
                assert index.smallest_owner(rows[begin + i : begin + i + 1])[0] == least


def brute_removals(rows, n=50):
    rank = [suffix_dedup.NO_ID if id is None else id for id, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    least = {}
    for r, d in zip(rank, data, strict=True):
        for i in range(len(d) - n + 1):
            least[d[i : i + n]] = min(r, least.get(d[i : i + n], r))
    out = []
    for (id, _), r, d in zip(rows, rank, data, strict=True):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - n + 1):
            if least[d[i : i + n]] < r:
                gone[i : i + n] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = np.frombuffer(d, np.uint8)[~gone].tobytes()
        out.append((id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(n):
    rng = random.Random(5)
    shared = ["".join(rng.choices("abcdefgh ", k=rng.randint(40, 200))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [*shared, "é" * rng.randint(1, 80), "x" * rng.randint(1, 200), "".join(rng.choices("abc", k=30))]
        text = "".join(rng.choices(parts, k=rng.randint(0, 6)))
        if rng.random() < 0.3 and text:
            k = rng.randrange(len(text))
            text = text[:k] + "#" + text[k + 1 :]
        rows.append((rng.choice([None, i, i, i, rng.randint(0, 20)]), None if rng.random() < 0.03 else text))
    return rows


@pytest.mark.parametrize("hot, size", [(10_000, 8 << 20), (3, 3000), (40, 500)])
def test_removals(frame, odd_rows, hot, size):
    rows = passages(200) + odd_rows
    found = suffix_dedup.removals(frame(rows), hot=hot, size=size)
    columns = ("_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=str) == brute_removals(rows)


def lines_with_one_gram(n):
    """Different lines whose windows have one anchor: a gram of a very small hash in their middle."""
    rng = np.random.default_rng(3)
    grams = rng.integers(97, 123, (1 << 16) + suffix_dedup.GRAM, dtype=np.uint8)
    least = int(np.argmin(suffix_dedup.gram_hashes(grams, suffix_dedup.GRAM)))
    gram = grams[least : least + suffix_dedup.GRAM].tobytes().decode()
    around = rng.integers(97, 123, (n, 60), dtype=np.uint8)
    return [bytes(a[:30]).decode() + gram + bytes(a[30:]).decode() for a in around]


def test_an_anchor_of_few_documents_with_many_pieces_is_split(frame):
    lines = lines_with_one_gram(400)
    rows = [(1, "\n".join(lines)), (2, "\n".join(lines[::3]))]
    batch = pa.RecordBatch.from_pydict(
        {"_file": [0, 0], "_row": [0, 1], "_id": [1, 2], "_text": [t for _, t in rows]}
    )
    sent = suffix_dedup._anchors(suffix_dedup._sharded(iter([batch]), 8 << 20), 1)
    messages = [tuple(m.values()) for b in sent for m in b.to_pylist()]
    split = {hot: sum(int((suffix_dedup._unpacked(m[4]) & np.uint64(1)).sum())
                      for m in suffix_dedup._repeated(messages, hot)) for hot in (200, 10_000)}
    assert split == {200: 1, 10_000: 0}
    found = suffix_dedup.removals(frame(rows), hot=200)
    columns = ("_id", "n_bytes", "n_removed", "n_spans", "kept")
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=str) == brute_removals(rows)


@SMALL
@given(st.lists(st.integers(0, 12), max_size=60), st.integers(1, 4))
def test_windows_with_one_hash_are_told_apart_by_their_bytes(values, hashes):
    windows = np.array(values, np.uint8)[:, None] * np.ones(suffix_dedup.LENGTH, np.uint8)
    poor = np.array([v % hashes for v in values], np.uint64)
    first, of = suffix_dedup._distinct(poor, windows.__getitem__)
    assert len(first) == len(set(values)) and [values[k] for k in first[of]] == values
    assert (poor[first] == np.sort(poor[first])).all()


def test_removal_keeps_rows_and_columns(frame, odd_rows):
    docs = frame(odd_rows)
    found = suffix_dedup.dedup(docs)
    assert found.columns == docs.columns and found.count() == len(odd_rows)
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts[0] == odd_rows[0][1] and texts[7] == "x"[:0] + texts[7] and len(texts[7]) < 60
    assert suffix_dedup.dedup(frame([])).count() == 0
