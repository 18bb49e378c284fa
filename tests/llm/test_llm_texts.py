"""Fingerprints, quality scores, page texts and chats."""

from __future__ import annotations

import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import Row

from clickmart.llm import chat_format, common, fingerprints, html_extract, pu_classifier

SMALL = settings(max_examples=100, deadline=None)


# Fingerprints


def shingles(text):
    words = text.encode().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def words(*ranges):
    return " ".join(f"w{i}" for r in ranges for i in range(*r))


def test_small_sketches_are_exact():
    a, b = words((0, 60)), words((30, 80))
    x, y = shingles(a), shingles(b)
    p, q = fingerprints.sketch(a), fingerprints.sketch(b)
    assert fingerprints.resemblance(p, q) == len(x & y) / len(x | y)
    assert fingerprints.distinct(p) == len(x) and fingerprints.containment(p, q) == pytest.approx(len(x & y) / len(x))


@pytest.mark.parametrize("shift", [0, 500, 2000, 4000])
def test_large_sketches_estimate(shift):
    a, b = words((0, 5000)), words((shift, 5000 + shift))
    x, y = shingles(a), shingles(b)
    p, q = fingerprints.sketch(a, 512), fingerprints.sketch(b, 512)
    assert abs(fingerprints.resemblance(p, q, 512) - len(x & y) / len(x | y)) < 0.08
    assert abs(fingerprints.containment(p, q, 512) - len(x & y) / len(x)) < 0.1
    assert abs(fingerprints.distinct(p, 512) / len(x) - 1) < 0.15


@SMALL
@given(st.lists(st.integers(0, 30), max_size=400), st.lists(st.integers(0, 30), max_size=400))
def test_sketches_merge(a, b):
    x, y = (np.array(v, np.uint64) * np.uint64(0x9E3779B97F4A7C15) for v in (a, b))
    both = fingerprints.bottom(np.concatenate([x, y]), 16)
    merged = fingerprints.merge(fingerprints.bottom(x, 16), fingerprints.bottom(y, 16), 16)
    assert (both == merged).all() and (fingerprints.from_text(fingerprints.to_text(both)) == both).all()


def test_every_document_meets_the_next(frame, odd_rows):
    ordered = sorted(odd_rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    texts = [t or "" for _, t in ordered]
    want = []
    for (id, _), text, other in zip(ordered, texts, texts[1:] + texts[:1], strict=True):
        half = len(text) // 2
        new = text[: len(text) - half] + other[:half]
        want.append((id, len(text), hashlib.sha256(new.encode()).hexdigest(),
                     fingerprints.resemblance(fingerprints.sketch(text), fingerprints.sketch(other))))
    found = fingerprints.with_next(frame(odd_rows)).collect()
    got = [(r["_id"], r["n_chars"], r["edited_sha256"], r["near_next"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert fingerprints.with_next(frame([])).count() == 0


def test_corpus_sketches_equal_those_of_all_shingles(spark):
    parts = [(s, words((100 * i, 100 * i + 150))) for i in range(40) for s in ("a", "b")]
    docs = spark.createDataFrame(parts, "source string, text string").repartition(7)
    found = fingerprints.merged(fingerprints.documents(docs, id="source")).collect()
    every = np.concatenate([fingerprints.shingle_hashes(t) for s, t in parts if s == "a"])
    assert {r["_id"] for r in found} == {"a", "b"}
    assert {r["fingerprint"] for r in found} == {fingerprints.to_text(fingerprints.bottom(every))}


# Quality


def corpus(n):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(n):
        plain = [("the", "and", "stone", "river", "house", "water")[k] for k in rng.integers(0, 6, 80)]
        junk = i % 5 == 0
        text = " ".join(w + "$$$" for w in plain) if junk else " ".join(plain) + "."
        rows.append((i, text))
        labels.append((i, int(not junk)))
    return rows, labels


def test_scores_of_held_out_documents(spark, frame):
    rows, labels = corpus(900)
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    scored = pu_classifier.scores(frame(rows), labels)
    found = {r["_id"]: r["score"] for r in scored.collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [(found[i] >= 0.7) == (i % 5 != 0) for i in held]
    assert len(found) == 900 and np.mean(right) > 0.97
    assert 0.6 < scored._model.prior < 0.95
    kept = pu_classifier.keep_good(frame(rows), labels)
    assert kept.columns == frame(rows).columns and abs(kept.count() - 720) < 20


def test_held_out_rows_lend_nothing(spark, frame):
    rows, labels = corpus(300)
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    docs = frame(rows)
    scored = [
        sorted(map(tuple, pu_classifier.scores(docs, spark.createDataFrame(x, "doc_id long, quality int"))
                   .select("_id", "score").collect()))
        for x in (labels, other)
    ]
    assert scored[0] == scored[1]


def test_odd_rows_and_no_labels(spark, frame, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = pu_classifier.scores(frame(odd_rows), none).collect()
    assert len(found) == len(odd_rows) and {r["score"] for r in found} == {0.0, 0.5}
    labels = spark.createDataFrame([(0, 1), (0, 0), (4, 1), (None, 1), (6, None), (99, 1)], "doc_id long, quality int")
    found = pu_classifier.scores(frame(odd_rows), labels).collect()
    assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert pu_classifier.scores(frame([]), labels).count() == 0


def test_samples_are_bounded_and_do_not_depend_on_the_partitioning(spark):
    rows = [(i, [float(i)] + [0.0] * (pu_classifier.WIDTH - 1)) for i in range(2000)]
    known = spark.createDataFrame(rows, "_id long, x array<float>")
    for n in (0, 50, 3000):
        one, two = (pu_classifier._sample(known.repartition(k), n) for k in (1, 7))
        assert one.shape == two.shape == (min(n, 2000), pu_classifier.WIDTH) and (one == two).all()


def test_the_prior_is_near_the_share_of_positives():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(2, 1, (4000, 5)), rng.normal(-2, 1, (4000, 5))
    mixed = rng.permutation(np.concatenate([pos[2000:], neg[:1000]]))
    assert abs(pu_classifier.estimate_prior(pos[:2000], mixed) - 2 / 3) < 0.08


def test_wrong_labels_do_not_move_the_threshold_to_the_junk():
    rng = np.random.default_rng(0)
    good, bad = (np.tile(rng.normal(m, 1, (n, 5)), (1, 2)) for m, n in ((2, 6000), (-2, 1000)))
    positives = np.concatenate([good[:2000], bad[:40]])
    model = pu_classifier.fit(positives, np.concatenate([good[2000:5000], bad[40:700]]))
    kept = [np.mean(model.score(x) >= pu_classifier.THRESHOLD) for x in (good[5000:], bad[700:])]
    assert kept[0] > 0.97 and kept[1] < 0.1


# Pages


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


NAV = "<nav><ul><li><a href='/a'>Home</a></li></ul></nav>"


@pytest.mark.parametrize(
    "source, text",
    [
        (page(f"{NAV}<article><h1>A &amp; B</h1><p>one\n two<b> three<br><p>four</p></article><footer>F</footer>"),
         "A & B\none two three\nfour"),
        (page("<article><p>x</p><script>var t='</p>'</script><style>p{}</style><!-- c --><p>y</p>"), "x\ny"),
        (page("<article><p>in</p><aside>side</aside><form>f</form><section class='comments'><p>c</p></section></article>"),
         "in"),
        (page("<div class='sidebar'>s</div><div id='cookie-notice'>n</div><main><p>m</p></main><div class=ad>a</div>"), "m"),
        (page("<div class='content has-sidebar no-ads'><p>c</p></div><div class='left-sidebar'>s</div>"), "c"),
        (page("<div class='post'><p>only text</p></div><div class='menu'>m</div>"), "only text"),
        ("<p>cut &am", "cut &am"), ("", ""), ("plain < text", "plain < text"), ("<article><p>a<p", "a"),
        (page("<article><p title='a > b'>quoted</p><p hidden>h</p><ul><li>1<li>2</ul></article>"), "quoted\n1\n2"),
    ],
)
def test_main_text(source, text):
    assert html_extract.main_text(source, None) == text


def test_templates_find_the_main_element(spark):
    rows = [
        (i, "http://a.example/%d" % i, page(f"{NAV}<div class='x'><h2>H{i}</h2><p>{words((i, i + 30))}</p></div>"
                                           f"<div class='y'>short {i}</div>"))
        for i in range(6)
    ] + [(10, None, None), (11, "http://b.example/", "<article>b</article>"), (11, "http://b.example/", "<article>b</article>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.selectExpr("*", "'e' AS host", "'e' AS main", "1 AS pages")
    found = {r["host"]: r for r in html_extract.templates(frame).collect()}
    assert found["a.example"]["main"] == "/html/body/div.x" and found["a.example"]["pages"] == 6
    texts = {(r["_id"], r["text"]) for r in html_extract.extract(frame).collect()}
    assert (0, f"H0\n{words((0, 30))}") in texts and (10, "") in texts and (11, "b") in texts
    assert html_extract.extract(frame).count() == 9
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_occurrence_vectors_make_classes(spark):
    rows = [(i, "http://h.example/", page("<article>" + "<p>x</p>" * (1 + i) + "</article>" + NAV)) for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_extract.templates(frame).first()
    assert '"tokens": ["/html/body/article/p"]' in found["template"]
    assert found["main"] == "/html/body/article"


def test_classes_choose_the_template_of_a_page_and_its_slots(spark):
    rows = []
    for i in range(16):
        kind = "abcd"[i % 4]
        text = f"<h2>H{i}</h2><p>{words((i * 40, i * 40 + 40))}</p>"
        rows.append((i, "http://t.example/", page(f"<div class='{kind}'>{text}<div class='k'>Thanks for reading {kind}</div>"
                                                  f"</div><div class='z{kind}'>short {i}</div>")))  # fmt: skip
    same = page("<article><p>the same</p><p>on every page</p></article>")
    rows += [(100 + i, "http://copies.example/", same) for i in range(9)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["host"]: r for r in html_extract.templates(frame).collect()}
    assert sorted(found["t.example"]["mains"][:4]) == [f"/html/body/div.{k}" for k in "abcd"]
    texts = {r["_id"]: r["text"] for r in html_extract.extract(frame).collect()}
    assert all(texts[i] == f"H{i}\n{words((i * 40, i * 40 + 40))}" for i in range(16))
    assert all(texts[100 + i] == "the same\non every page" for i in range(9))


def test_classes_that_do_not_nest_are_split(spark):
    # As many /div/b as /div/u/li on every page, but an element of the one never holds one of the other.
    rows = [
        (i, "http://n.example/", "<div class='r'>" + "<section>a</section>" * 2 + "<ul><li>x</li><li>y</li></ul></div>")
        for i in range(3)
    ]
    rows += [(5, "http://s.example/", "<div><section><h3>a</h3><h3>b</h3></section><section></section></div>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["host"]: json.loads(r["template"]) for r in html_extract.templates(frame).collect()}
    tokens = {h: sorted(c["tokens"] for c in t) for h, t in found.items()}
    assert tokens["n.example"] == [["/div.r", "/div.r/ul"], ["/div.r/section"], ["/div.r/ul/li"]]
    assert tokens["s.example"] == [["/div"], ["/div/section"], ["/div/section/h3"]]


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h2 id='related-work'>Related work</h2><p id='search-engines'>p</p></article>", "Related work\np"),
        ("<main><section id='social-history'><h2>S</h2><p>p</p></section><div class='menu-design'>d</div></main>", "S\np\nd"),
        ("<div class='post'><h2 id='side-effects'>Side effects</h2><p>p</p></div>", "Side effects\np"),
        ("<article><p class='notice'>n</p><div class='share'>s</div><p>p</p></article>", "p"),
    ],
)
def test_single_words_inside_an_article_drop_nothing(body, text):
    assert html_extract.main_text(page(body), None) == text


def test_words_tell_elements_that_most_pages_have(spark):
    rows = []
    for i in range(6):
        topic = f"<section id='social-history'><p>history {i}</p></section>" if i == 2 else ""
        body = f"<p>{words((i * 50, i * 50 + 50))}</p>{topic}<div id='related-posts'>post {i}</div>"
        body += f"<div class='share-box'>shared {i}</div>"
        rows.append((i, "http://w.example/", page(f"<article>{body}</article>")))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["_id"]: r["text"] for r in html_extract.extract(frame).collect()}
    assert all(t == words((i * 50, i * 50 + 50)) + "\nhistory 2" * (i == 2) for i, t in texts.items())


def test_recurring_headings_and_closing_notes_of_articles_stay(spark):
    rows, want = [], {}
    for i in range(10):
        one, two = words((i * 50, i * 50 + 25)), words((i * 50 + 25, i * 50 + 50))
        body = f"<h2>Summary</h2><p>{one}</p><div class='s'><h3>References</h3><div class='b'><ul><li>{two}</li></ul></div></div>"
        box = "<div class='box'><h4>About us</h4><p>We write.</p></div>"
        rows.append((i, "http://r.example/", page(f"<article>{body}{box}<p>Thanks for reading.</p></article>")))
        want[i] = f"Summary\n{one}\nReferences\n{two}\nThanks for reading."
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["_id"]: r["text"] for r in html_extract.extract(frame).collect()} == want


def test_deep_and_long_pages(spark):
    deep = "<article>" + "".join(f"<div>t{i}" for i in range(20_000))
    wide = f"<article class='{'x' * 5000}'><p>a</p><div {'y' * 300_000}>b</div></article>"
    rows = [(1, "http://deep.example/", deep), (1, "http://deep.example/", "<p>other</p>"), (2, "http://wide.example/", wide)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = sorted((r["_id"], r["text"]) for r in html_extract.extract(frame).collect())
    assert texts == [(1, "other"), (1, "\n".join(f"t{i}" for i in range(20_000))), (2, "a\nb")]
    assert max(map(len, html_extract.Page(deep).paths)) < 2 * html_extract.LONG
    page = html_extract.Page("<table><tr><td><p>" + "<div>" * 50_000 + "<tr><p>x<li>y<li>z")
    assert [(b.text, page.depth[b.path]) for b in page.blocks] == [("x", 3), ("y", 3), ("z", 3)]


def test_classes_of_hashed_paths_are_those_of_plain_ones(spark, monkeypatch):
    rng = random.Random(5)
    sources = ["<main>" + "".join(rng.choice(["<div class='a'>", "<ul><li>", "</div>", "x", "</li>"]) for _ in range(60))
               for _ in range(8)]
    shapes = []
    for long in (10_000, 12):
        monkeypatch.setattr(html_extract, "LONG", long)
        pages = [html_extract.Page(x) for x in sources]
        shapes.append([(p.outer, p.depth, p.main, p.blocks, p.shared) for p in pages])
        names = {p for page in pages for p in page.paths}
        shapes[-1].append((len(names), [[page.paths.index(e) for e in page.elements] for page in pages]))
    assert shapes[0] == shapes[1]


def test_classes_against_plain_occurrence_vectors(spark):
    rng = random.Random(3)
    sources = []
    for _ in range(12):
        inner = "".join(rng.choice(["<div class='a'><p>x</p></div>", "<section><ul><li>y</li></ul></section>", "<p>z</p>"])
                        for _ in range(rng.randint(0, 4)))
        sources.append(page(f"<div class='m'>{inner}</div>" + "<div class='n'><p>w</p></div>" * rng.randint(0, 2)))
    frame = spark.createDataFrame([(i, "http://v.example/", x) for i, x in enumerate(sources)], "page_id long, url string, html string")
    classes = json.loads(html_extract.templates(frame).first()["template"])
    counts = [Counter(html_extract.Page(x).elements) for x in sources]
    vector = {t: tuple(c[t] for c in counts) for t in set().union(*counts)}
    assert sorted(t for c in classes for t in c["tokens"]) == sorted(vector)
    for found in classes:
        assert len({vector[t] for t in found["tokens"]}) == 1
        assert found["pages"] == sum(map(bool, vector[found["tokens"][0]]))
    once = {t for t, v in vector.items() if set(v) == {1}}
    assert any(set(c["tokens"]) == once for c in classes)


# Chats

PARTS = st.lists(
    st.sampled_from(["\\", "</s>", "<", "/s>", "[INST]", "[/INST]", "a", " ", "\n", "<|im_end|>", "|im_sep|>", "é", "日本", "\U0001f600"]),
    max_size=12,
).map("".join)


@SMALL
@given(PARTS, PARTS)
def test_escapes_are_reversible(role, text):
    assert chat_format.unescape(chat_format.escape(text)) == text
    assert not any(c in chat_format.escape(text) for c in chat_format.CONTROL)
    turns = [(role, text), ("assistant", text), ("assistant", role)]
    formatted, _ = chat_format.render(turns)
    assert chat_format.parse(formatted) == turns


@pytest.fixture(scope="module")
def chats(spark, vocabulary):
    def make(rows):
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        frame = frame.selectExpr("*", "'e' AS _id", "'e' AS ids", "'e' AS formatted")
        return chat_format.format_chats(frame, vocabulary("byte_bpe_50k.json"))

    return make


def test_masks_cover_the_assistant_texts(chats, vocabulary):
    from tokenizers import Tokenizer

    rows = [
        (1, 2, "assistant", "日本 \U0001f600 </s>"), (1, 0, "user", "x"), (1, 1, "assistant", ""), (2, 0, "assistant", None),
        (2, None, None, "first"), (None, 0, "assistant", "n"), (2, 0, "assistant", None), (3, 0, "user", "long " * 5000),
        (3, 1, "assistant", "answer " * 5000),
    ]
    found = {r["_id"]: r for r in chats(rows).collect()}
    assert set(found) == {1, 2, 3, None}
    texts = {k: [chat_format.unescape(t) for t in r["loss_texts"]] for k, r in found.items()}
    assert texts[1] == ["", "日本 \U0001f600 </s>"] and texts[2] == ["", ""] and texts[None] == ["n"]
    assert texts[3] == ["answer " * 5000]
    assert chat_format.parse(found[2]["formatted"]) == [("", "first"), ("assistant", ""), ("assistant", "")]
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for r in found.values():
        assert len(r["ids"]) == len(r["loss_mask"]) and tokenizer.decode(r["ids"], False) == r["formatted"]
    assert chats([]).count() == 0


def test_mask_is_that_of_every_token_and_span():
    rng = np.random.default_rng(0)
    for _ in range(200):
        edges = np.unique(rng.integers(0, 60, 20))
        offsets = np.column_stack([edges[:-1], edges[1:]])
        cuts = np.sort(rng.integers(0, 60, 6)).reshape(-1, 2)
        spans = [tuple(map(int, c)) for c in cuts if c[0] < c[1]]
        want = [any(a < y and x < b for x, y in spans) for a, b in offsets]
        assert chat_format.mask(offsets, spans).tolist() == want


def test_registered_chats_are_read_back_whole(spark, sf_dir):
    """All columns of op10 against the rows themselves, the conversation of control strings included."""
    from clickmart.llm import queries

    want = {}
    rows = common.read(spark, sf_dir, "conversations").orderBy("conv_id", "turn").collect()
    rows += [Row(conv_id=-1, turn=i, role=r, text=queries.HOSTILE) for i, r in enumerate(("user", "assistant"))]
    for r in rows:
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    found = {r["conv_id"]: r for r in queries.QUERIES["op10_chat_format"](spark, sf_dir).collect()}
    assert set(found) == set(want) and -1 in found
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        row = found[conv]
        assert row["n_turns"] == len(turns) and row["loss_chars"] == len(loss)
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert row["formatted_chars"] == len(chat_format.render(turns)[0])


def test_text_under_the_mask_of_many_byte_texts(vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    turns = [("user", "日本"), ("assistant", "é😀 [INST] <s>\\"), ("assistant", ""), ("系", "x"), ("assistant", "日")]
    text, spans = chat_format.render(turns)
    ids = np.frombuffer(chat_format.tokens.encoder(path, True, plain=False).ids(text), "<u4")
    ends = np.cumsum(chat_format._token_lengths(path).take(ids))
    offsets = np.stack([ends - chat_format._token_lengths(path).take(ids), ends], axis=1)
    assert ends[-1] == len(text.encode())
    found = chat_format.under_mask(text.encode(), offsets, chat_format.mask(offsets, spans), spans)
    assert [chat_format.unescape(t) for t in found] == [t for r, t in turns if r == "assistant"]
