"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from templates. A page is read as a sequence of tokens: element starts, told apart by their path
of block elements with classes. The occurrence vector of a token says how often each page of the host has it; tokens with
equal vectors form an equivalence class (a vector is folded to the exclusive-or of a hash of every page and count,
so tasks add theirs up before anything is shuffled, whatever the size of a host). A class is valid if on every page each
of its outermost elements holds every other one of its tokens exactly once; a class that is not is split until its parts
are. Each is nested into the class of its nearest outer token. Those trees are the templates; the text positions of the
tokens are the slots. A template's main element is the token of a valid class, present once on each of the class's pages,
that holds the article: an article or main element, else the innermost one that holds most of the text of those pages.

A page is read by the classes it has: the first main element of the host that is on it. Extraction reads the slots
inside, but for those of menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments, and
but for texts that a slot repeats on nearly all pages of its class (``CONSTANT``, at least ``LEAST`` different pages) in
an element of which nothing else is the page's own: a heading or closing note that all articles of a host have stays.
Inside an article or main element only a whole class name tells such an element at once; a single word of its class
or id does if most pages of the host have the element. Ids of headings, paragraphs and the like never tell.

Paths are interned per page, each with the number of the one around it, and a path longer than ``LONG`` goes by a hash of
the path around it; so a page takes time and room in proportion to its length, however deep its elements are nested.

Text rules: character references are decoded, white space inside a block becomes one space, blocks are trimmed and
joined in page order by one line feed; nothing else is dropped.

Defined results: a missing html is empty and has no text; a missing url belongs to a host of its own; repeated rows
count as pages of their own; an empty table gives an empty table.
"""

from __future__ import annotations

import html as entities
import json
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence, Set
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Fixed values of HTML: kinds of elements by name.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr ruby rt rp".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul li dt dd tr td th tbody thead tfoot".split()
)
ENDS_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("td", "th", "tr", "thead", "tbody"),
}
TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th figcaption caption address".split())
HELD = TEXTUAL | frozenset("ul ol dl table thead tbody tfoot tr figure".split())
SCOPE = frozenset("ul ol dl table tbody thead tr select".split())

# Elements beside the article, by name, role, and words of class and id. Those of OUTER are beside it only outside.
BESIDE = frozenset(
    "nav footer aside form script style noscript template svg button select textarea iframe object dialog menu head "
    "title input".split()
)
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu form".split())
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice popup modal newsletter subscribe signup "
    "share sharing social related recommended comment comments disqus replies pagination pager search login".split()
)
OUTER = frozenset(["header"])
OUTER_WORDS = frozenset("header masthead banner side widget widgets toolbar topbar".split())
MAIN = ("article", "main")

#: Different pages of a host that a template must have, and that must repeat a text, unless it has half the host's pages.
LEAST = 3
#: Part of a class's different pages on which a slot's text is the template's.
CONSTANT = 0.9
#: Characters of a path or of one of its steps beyond which a hash stands for them.
LONG = 400

_markup = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+[^>]*)>?",
    re.DOTALL,
)
_attribute = re.compile(
    r"(?<![^\s=/\"'<>])(?:([^\s=/\"'<>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(hidden)(?![^\s=/\"'<>]))"
)
#: Classes that tell what an element has, not what it is.
_states = re.compile(r"(?:has|no|with|without|is)[-_]").match
_words = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


class Block(NamedTuple):
    """A block's place (number of a path), text, whether it stands beside the article, and its characters outside links."""

    path: int
    text: str
    beside: bool
    free: int


class Open(NamedTuple):
    """An open element: name, number of its path, whether it is beside the article, and whether in an article or main element."""

    name: str
    path: int
    beside: bool
    inside: bool


def _marks(value: str) -> list[str]:
    """Names in a class or id that tell what an element is."""
    return [m for m in value.split() if not _states(m)]


def _told(marks: list[str]) -> bool:
    """Whether a word of them tells an element beside the article."""
    return any(w.lower() in BESIDE_WORDS for m in marks for w in _words.findall(m))


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, a, b, c, flag in _attribute.findall(raw):
        found.setdefault((name or flag).lower(), entities.unescape(a or b or c))
    return found


def _step(name: str, classes: list[str], ids: list[str]) -> str:
    """An element's part of a path."""
    step = name + "".join(f".{c}" for c in classes) + ("#" + "_".join(ids) if ids else "")
    step = step.replace("/", "|")
    return step if len(step) <= LONG else f"{_name(step)[:20]}.~{xxhash.xxh128_hexdigest(step)}"


class Page:
    """Elements (paths, in order) and blocks of a page."""

    def __init__(self, source: str) -> None:
        #: Paths by number, with the number of the one around, its depth, and whether it is in an article or main element;
        #: a path comes after the one around it.
        self.paths: list[str] = [""]
        self.outer: list[int] = [-1]
        self.depth: list[int] = [0]
        self.main: list[bool] = [False]
        self.number: dict[tuple[int, str], int] = {}
        self.elements: list[str] = []
        #: Elements opened so far by path: the last one's number, and the most open elements that two of them share.
        self.last: dict[int, int] = {}
        self.shared: dict[int, int] = {}
        self.numbers: list[int] = []
        self.blocks: list[Block] = []
        #: Paths of elements inside the article that a word of their class or id tells: beside it if most pages have them.
        self.suspects: set[int] = set()
        self.open: list[Open] = [Open("", 0, False, False)]
        #: Depths of the open elements of a name.
        self.depths: dict[str, list[int]] = {}
        self.text: list[str] = []
        self.linked = self.links = 0
        at, end = 0, len(source)
        while at < end:
            found = _markup.search(source, at)
            if not found:
                self._chars(source[at:])
                break
            if found.start() > at:
                self._chars(source[at : found.start()])
            at = found.end()
            if name := found["start"]:
                name = name.lower()
                self._start(name, found["attributes"])
                if name in RAW:
                    close = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(source, at)
                    at = close.start() if close else end
            elif name := found["end"]:
                self._end(name.lower())
        self._flush()

    def within(self, roots: Set[int]) -> list[bool]:
        """Per path, whether it is one of ``roots`` or inside of one."""
        found: list[bool] = []
        for path, outer in enumerate(self.outer):
            found.append(path in roots or (outer >= 0 and found[outer]))
        return found

    def holders(self) -> list[int]:
        """Per path, the element that a heading, paragraph or list stands in; any other element itself."""
        found: list[int] = []
        for path, outer in enumerate(self.outer):
            found.append(found[outer] if _name(self.paths[path]) in HELD else path)
        return found

    def _last(self, names: Iterable[str]) -> int:
        """Depth of the innermost open element of these names, or 0."""
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)

    def _chars(self, raw: str) -> None:
        text = entities.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if self.links:
            self.linked += len(text)

    def _flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                top = self.open[-1]
                self.blocks.append(Block(top.path, text, top.beside, max(0, len(text) - self.linked)))
            self.text, self.linked = [], 0

    def _close_to(self, depth: int) -> None:
        self._flush()
        while len(self.open) > depth:
            self.depths[self.open.pop().name].pop()
        del self.numbers[depth - 1 :]

    def _start(self, name: str, raw: str) -> None:
        if name in INLINE:
            self.links += name == "a" and not raw.rstrip().endswith("/")
            return
        if name in ENDS_PARAGRAPH and (depth := self._last(("p",))) > self._last(("td", "th", "table", "button")):
            self._close_to(depth)
        if same := ENDS_SAME.get(name):
            # The outermost of the elements that it ends, within the scope.
            scope = self._last(SCOPE.difference(same))
            opened = [of[bisect_right(of, scope)] for n in same if (of := self.depths.get(n)) and of[-1] > scope]
            if opened:
                self._close_to(min(opened))
        self._flush()
        self.links = 0
        if name in VOID:
            return
        _, outer, beside, inside = self.open[-1]
        found = _attributes(raw) if raw else {}
        marks, ids = _marks(found.get("class", "")), _marks(found.get("id", ""))
        ids = [] if name in TEXTUAL else ids
        words = {w.lower() for m in marks + ids for w in _words.findall(m)}
        whole = {m.lower() for m in marks}
        if name not in ("html", "body"):
            beside = (
                beside or name in BESIDE or found.get("role", "").lower() in BESIDE_ROLES
                or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
                or "display:none" in found.get("style", "").replace(" ", "").lower()
                or (name not in MAIN and not BESIDE_WORDS.isdisjoint(whole if inside else words))
                or (name in MAIN and not {"comment", "comments"}.isdisjoint(words))
                or (not inside and name not in MAIN and (name in OUTER or not OUTER_WORDS.isdisjoint(words)))
            )
        classes = sorted(set(found.get("class", "").split()))
        step = _step(name, classes, ids if inside and name not in MAIN and _told(ids) else [])
        path = self.number.get((outer, step))
        if path is None:
            path = self.number[outer, step] = len(self.paths)
            full = f"{self.paths[outer]}/{step}"
            if len(full) > LONG:
                full = f"~{xxhash.xxh128_hexdigest(self.paths[outer])}/{step}"
            self.paths.append(full)
            self.outer.append(outer)
            self.depth.append(self.depth[outer] + 1)
            self.main.append(self.main[outer] or name in MAIN)
        if path in self.last:
            shared = bisect_left(self.numbers, self.last[path])
            self.shared[path] = max(shared, self.shared.get(path, 0))
        self.last[path] = len(self.elements)
        self.numbers.append(len(self.elements))
        self.elements.append(self.paths[path])
        if inside and not beside and name not in (*MAIN, *TEXTUAL) and _told(marks + ids):
            self.suspects.add(path)
        self.depths.setdefault(name, []).append(len(self.open))
        self.open.append(Open(name, path, beside, inside or name in MAIN or found.get("role", "").lower() == "main"))

    def _end(self, name: str) -> None:
        if name in INLINE:
            self.links -= name == "a" and self.links > 0
            return
        if name in ("p", "br"):
            self._flush()
        if depth := self._last((name,)):
            self._close_to(depth)
            self.links = 0


def _name(path: str) -> str:
    return path.rpartition("/")[2].partition("#")[0].partition(".")[0]


def slot_key(path: str, text: str) -> int:
    """A slot and its text."""
    return xxhash.xxh64_intdigest(f"{path} {text}") >> 1


def main_text(
    source: str, element: str | Sequence[str] | None, constant: Set[int] = frozenset(), common: Sequence[str] = ()
) -> str:
    """The text in the first main element of the templates that the page has; without one, in articles, else in all that
    is not beside one. Texts of slots in ``constant`` are the template's if all of their element is, suspects in ``common``
    are beside the article."""
    elements = [element] if isinstance(element, str) else element or []
    page = Page(source)
    blocks = [b for b in page.blocks if not b.beside]
    often = set(common)
    if most := {p for p in page.suspects if page.paths[p] in often}:
        dropped = page.within(most)
        blocks = [b for b in blocks if not dropped[b.path]]
    having = {page.paths[path]: path for path in range(1, len(page.paths))}
    for main in elements:
        within = page.within({having[main]}) if main in having else []
        chosen = [b for b in blocks if within and within[b.path]]
        if chosen:
            break
    else:
        chosen = [b for b in blocks if page.main[b.path]] or blocks
    if not constant:
        return "\n".join(b.text for b in chosen)
    repeated = [slot_key(page.paths[b.path], b.text) in constant for b in chosen]
    # Elements with a text of the page's own, and all around them.
    varied: set[int] = set()
    for block, again in zip(chosen, repeated, strict=True):
        path = 0 if again else block.path
        while path > 0 and path not in varied:
            varied.add(path)
            path = page.outer[path]
    holder = page.holders()
    return "\n".join(b.text for b, again in zip(chosen, repeated, strict=True) if not again or holder[b.path] in varied)


# Templates

FIGURES = ["pages", "vector", "single", "free", "of", "shared", "suspect", "depth"]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, host and token: pages, folded occurrence vector, pages with one occurrence, free text inside and on all
    of its pages, the open elements that two occurrences share at most, pages where it is a suspect, and its depth. Further rows have a slot's text and page
    (hashes); those of every text have none."""
    held: dict[tuple[str, str, str], list[int]] = {}
    slots: set[tuple[str, str, int | None, int]] = set()

    def out() -> pa.RecordBatch:
        keys = [(*k, None, None) for k in held] + [(h, token, None, *more) for h, token, *more in slots]
        types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate(types)]
        for i in range(len(FIGURES)):
            columns.append(pa.array([v[i] for v in held.values()] + [0] * len(slots), pa.int64()))
        return pa.RecordBatch.from_arrays(columns, names=["host", "token", "outer", "text", "page", *FIGURES])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("host", "_file", "_row")]
        for host, file, row, source in zip(*columns, common.texts(batch.column("_text")), strict=True):
            page = Page(source)
            counts = Counter(page.elements)
            counts[""] = 1
            free = [0] * len(page.paths)
            kept = [b for b in page.blocks if not b.beside]
            same = xxhash.xxh64_intdigest("\n".join(b.text for b in kept)) >> 1
            for block in kept:
                path = page.paths[block.path]
                slots.add((host, path, None, same))
                slots.add((host, path, slot_key(path, block.text), same))
                free[block.path] += block.free
            for path in range(len(free) - 1, 0, -1):
                free[page.outer[path]] += free[path]
            for path, token in enumerate(page.paths):
                n = counts[token]
                figures = held.setdefault((host, token, page.paths[page.outer[path]] if path else ""), [0] * len(FIGURES))
                figures[0] += 1
                figures[1] ^= xxhash.xxh64_intdigest(f"{file} {row} {n}") >> 1
                figures[2] += n == 1
                figures[3] += free[path]
                figures[4] += free[0]
                figures[5] = max(figures[5], page.shared.get(path, 0))
                figures[6] += path in page.suspects
                figures[7] = page.depth[path]
        if len(held) + len(slots) > 100_000:
            yield out()
            held, slots = {}, set()
    if held:
        yield out()


def deduce(tokens: pd.DataFrame) -> dict:
    """Templates of a host from its tokens: valid classes with their parents and slots, and the main elements, those to
    be tried first in front."""
    pages = int(tokens.pages[tokens.token == ""].iloc[0])
    rows = {r.token: r for r in tokens.itertuples()}
    vectors: dict[tuple[int, int], list[str]] = {}
    for token in sorted(rows):
        if token:
            vectors.setdefault((rows[token].pages, rows[token].vector), []).append(token)

    within: dict[str, list[str]] = {}
    for token in sorted(rows):
        if token:
            within.setdefault(rows[token].outer, []).append(token)

    # As tokens of a class are equally many on every page, each element of an outer token holds one of an inner token
    # exactly if none holds two. Tokens without such an outer token begin a class, which is valid by that. One walk down
    # the paths keeps the tokens around by vector; ``beyond`` is the nearest one around of another class.
    of: dict[str, str] = {}
    beyond: dict[str, str] = {}
    around: dict[tuple[int, int], list[str]] = {}
    todo = [(token, False) for token in within.get("", [])]
    while todo:
        token, left = todo.pop()
        row = rows[token]
        same = around.setdefault((row.pages, row.vector), [])
        if left:
            same.pop()
            continue
        outer = same[-1] if same and row.shared < rows[same[-1]].depth else None
        once = row.single == row.pages == pages
        of[token] = of[outer] if outer else "" if once else token
        if row.outer:
            beyond[token] = row.outer if of[row.outer] != of[token] else beyond.get(row.outer, "")
        same.append(token)
        todo.append((token, True))
        todo += [(inner, False) for inner in within.get(token, [])]
    classes: dict[str, list[str]] = {}
    for members in vectors.values():
        for token in members:
            classes.setdefault(of[token], []).append(token)
    names = {first: i for i, first in enumerate(classes)}

    def parent(members: list[str]) -> int:
        """The class of the nearest enclosing token of another class."""
        return min(names[of[beyond[m]]] if beyond.get(m) else -1 for m in members)

    template = [
        {
            "pages": int(rows[members[0]].pages), "tokens": members, "parent": parent(members),
            "slots": [t for t in members if rows[t].free],
        }
        for members in classes.values()
    ]
    # Once on every page of the class, with most of the free text of those pages inside.
    mains = []
    for members in classes.values():
        r = rows[members[0]]
        if r.single == r.pages and (r.pages >= LEAST or 2 * r.pages >= pages):
            named = [t for t in members if _name(t) in MAIN and 2 * rows[t].free > rows[t].of]
            holders = [t for t in members if _name(t) not in TEXTUAL and 4 * rows[t].free > 3 * rows[t].of]
            mains += [(bool(named), max(named or holders, key=lambda t: (rows[t].depth, t)))] if named or holders else []
    mains = [t for _, t in sorted(mains, key=lambda m: (m[0], rows[m[1]].depth, rows[m[1]].pages, m[1]), reverse=True)]
    most = max(mains, key=lambda t: rows[t].pages, default=None)
    often = [t for t, r in rows.items() if r.suspect >= LEAST and 2 * r.suspect > pages]
    return {"pages": pages, "classes": template, "mains": mains, "main": most, "common": sorted(often)}


def host(url: Column) -> Column:
    """Host of an address, lower case, without user and port."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return found


def templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Per host: number of ``pages``, the ``template`` as JSON, the ``main`` element of most pages, all ``mains`` in the order in
    which pages try them, suspects that most pages have (``common``), and the ``constant`` texts of slots (hashes)."""
    rows = common.keyed(pages, host=host(F.col(url)), _text=html)
    counted = common.map_arrow(
        rows, _tokens, "host string, token string, outer string, text long, page long, " + ", ".join(f"{c} long" for c in FIGURES)
    )
    added = {"vector": F.bit_xor, "shared": F.max, "depth": F.max}
    tokens = common.stored(
        counted.groupBy("host", "token", "outer", "text", "page").agg(*(added.get(c, F.sum)(c).alias(c) for c in FIGURES)),
        "tokens",
    )
    # Copies of a page count once, so that an article with copies is not taken for the template.
    slots = tokens.filter("page IS NOT NULL").groupBy("host", "token", "text").agg(F.count("*").alias("n"))
    slots = common.stored(slots.filter(f"n >= {LEAST}"), "slots")
    sizes = tokens.filter("page IS NULL AND token = ''").select("host", F.col("pages").alias("of_host"))
    every = slots.filter("text IS NULL").select("host", "token", F.col("n").alias("of")).join(sizes, "host")
    every = every.filter("of * 50 >= of_host").drop("of_host")
    constant = (
        slots.filter("text IS NOT NULL").join(every, ["host", "token"]).filter(f"n >= {CONSTANT} * of")
        .groupBy("host").agg(F.sort_array(F.collect_set("text")).alias("constant"))
    )
    tokens = tokens.filter("page IS NULL").drop("text", "page")
    # Tokens on at least a fiftieth of a host's pages: at most fifty times the tokens of a page, however large the host.
    often = tokens.join(sizes, "host").filter("pages * 50 >= of_host").drop("of_host")

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        found = deduce(rows)
        return pd.DataFrame(
            [[rows["host"].iloc[0], found["pages"], json.dumps(found["classes"]),
              *(found[c] for c in ("main", "mains", "common"))]],
            columns=["host", "pages", "template", "main", "mains", "common"],
        )

    deduced = often.groupBy("host").applyInPandas(
        one, "host string, pages long, template string, main string, mains array<string>, common array<string>"
    )
    return common.stored(deduced.join(constant, "host", "left"), "templates")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("mains", "constant", "common"))
        found = [
            main_text(t, m, frozenset(c or ()), often or ())
            for t, m, c, often in zip(common.texts(batch.column("_text")), *columns, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), batch.column("_url"), pa.array(found, pa.string())], names=["_id", "_url", "text"]
        )


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per page: ``_id``, ``_url`` and the main ``text``."""
    found = templates(pages, url, html)
    total = found.agg(F.sum("pages")).first()[0] or 0
    rows = pages.select(F.col(id).alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_text"),
                        host(F.col(url)).alias("host"))
    both = common.attach(rows, found.select("host", "pages", "mains", "constant", "common"), ["host"], "pages", total)
    kind = rows.schema["_id"].dataType.simpleString()
    return common.map_arrow(
        both.select("_id", "_url", "_text", "mains", "constant", "common"), _extracted, f"_id {kind}, _url string, text string"
    )
