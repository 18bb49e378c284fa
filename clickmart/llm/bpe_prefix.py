"""BPE by dynamic programming over prefixes, for tokenizer files with merges by rank and a mark of word ends.

If a token ends the encoding of a prefix, the tokens before it are the encoding of the prefix without it. So one token
per prefix of a word is enough: the unique token that ends there and fits the token stored where it begins. A suffix
automaton of the vocabulary (states are suffixes of what was read, links lead to the next shorter one) names all tokens
that end at a place in one walk over the word. Two tokens fit if the bytes of both together encode to the two again; a
sequence whose neighbours all fit is the encoding of its bytes. Back-pointers from the word's end give the ids. A word of
any length takes time in proportion to it.

Whether two tokens fit is read off the merges: while the two are being built, each symbol at the seam lives from the
merge that made it to the merge that takes it up; they fit unless two symbols that meet there have a merge of their own
in time. That needs merges that make different tokens, each later than its parts, which is checked when a file is
loaded.

Normal forms and the cutting into words follow the file: plain words are cut here, all other pieces by the library's
own normaliser and word splitter. Strings of special tokens in a text become these tokens, as in the library's plain
call; truncation and padding are not applied. The ids of pieces that were seen before are kept, up to a bound.

Defined results: a missing text is empty and has no ids; it decodes to the empty text. Every row is encoded for itself,
so repeated rows, ties, equal ids and empty tables need nothing special. Texts are worked on in stretches, cut at white
space, so a long one is not held in pieces as a whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .tokens import SIGNS

#: Stands for the mark of a word's end; no byte is written as a space.
END = " "
NEVER = 1 << 60
#: Characters of a text that are cut into pieces at a time.
STRETCH = 1 << 20

Piece = tuple[int, bytes, bytes]


class Vocabulary:
    """Tokens, merges and the automaton of a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in whole["added_tokens"]):
            raise ValueError("special tokens must match as they are written")
        names = {token: i for token, i in model["vocab"].items() if token not in self.special}
        size = 1 + max((*names.values(), *self.special.values()))
        #: What the library's decode writes for each id (such files have no decoder of their own).
        self.written = [b""] * size
        for token, i in (*names.items(), *self.special.items()):
            self.written[i] = token.encode()
        self.length = [0] * size
        form = {i: self._form(token) for token, i in names.items()}
        for i, text in form.items():
            self.length[i] = len(text)
        self.pair: dict[int, int] = {}
        #: Symbols that stand at the right (left) edge while a token is built, each with the rank that takes it up.
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = {names["".join(m)] for m in merges}
        if len(made) < len(merges):
            raise ValueError("two merges make the same token")
        valid = set(form) - made
        for i in valid:
            self.right[i] = self.left[i] = [(i, NEVER)]
            if len(form[i].removesuffix(END)) != 1:
                raise ValueError("a token is neither a sign nor merged")
        for rank, (a, b) in enumerate(merges):
            one, two, token = names[a], names[b], names[a + b]
            if one not in self.right or two not in self.left or form[one] + form[two] != form[token]:
                raise ValueError("a merge comes before its parts")
            self.pair[one << 32 | two] = rank
            self.right[token] = [*self.right[two][:-1], (two, rank), (token, NEVER)]
            self.left[token] = [*self.left[one][:-1], (one, rank), (token, NEVER)]
        for a, b in merges:
            one, two, token = names[a], names[b], names[a + b]
            # Tokens that no text encodes to alone never end a prefix. Their parts come earlier in the list.
            if one in valid and two in valid and self.meeting(one, two) == self.pair[one << 32 | two]:
                valid.add(token)
        self.automaton = ahocorasick.Automaton()
        for i in valid:
            self.automaton.add_word(form[i], i)
        self.automaton.make_automaton()
        self.known: dict[int, bool] = {}

    def _form(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            return token[: -len(self.suffix)] + END
        return token

    def meeting(self, a: int, b: int) -> int | None:
        """Rank of the first merge across the seam of two neighbouring tokens."""
        right, left = iter(self.right[a]), iter(self.left[b])
        (x, x_end), (y, y_end) = next(right), next(left)
        while True:
            rank = self.pair.get(x << 32 | y)
            # Of equal merges the leftmost is made first.
            if rank is not None and rank < x_end and rank <= y_end:
                return rank
            if x_end <= y_end:
                if x_end == NEVER:
                    return None
                x, x_end = next(right)
            else:
                y, y_end = next(left)

    def fit(self, a: int, b: int) -> bool:
        """Whether two neighbours stay as they are; answers are kept, up to a bound."""
        if len(self.known) > 1 << 20:
            self.known.clear()
        found = self.known[a << 32 | b] = self.meeting(a, b) is None
        return found

    def ids(self, form: str) -> list[int]:
        """Ids of a word, written in byte signs with the mark of its end."""
        length, known, fit = self.length, self.known, self.fit
        #: The token that ends each prefix; prefixes are named by their last place.
        last: list[int] = [-1] * len(form)
        for end, token in self.automaton.iter(form):
            if last[end] < 0:
                begin = end - length[token]
                if begin < 0:
                    last[end] = token
                else:
                    before = last[begin]
                    if before >= 0:
                        fits = known.get(before << 32 | token)
                        if fits or (fits is None and fit(before, token)):
                            last[end] = token
        found, at = [], len(form) - 1
        while at >= 0:
            token = last[at]
            if token < 0:
                raise ValueError("a sign of the text is not in the vocabulary")
            found.append(token)
            at -= length[token]
        return found[::-1]


class Coder:
    """Encodes and decodes texts; ids as decimal text, decoded as the library writes it."""

    def __init__(self, path: str, most: int = 300_000) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        library = Tokenizer.from_file(path)
        if library.decoder is not None or library.pre_tokenizer is None:
            raise ValueError("the file must cut words and have no decoder")
        self.normalize, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.vocabulary = Vocabulary(path)
        self.end = END if self.vocabulary.suffix else ""
        self.specials = re.compile("(" + "|".join(map(re.escape, self.vocabulary.special)) + ")") \
            if self.vocabulary.special else None
        signs = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = str.maketrans({c: signs(c)[0][0] for c in map(chr, range(0xA1, 0x100))})
        self.kept: dict[str, Piece] = {}
        self.seen, self.most = bytearray(1 << 22), most

    def _piece(self, ids: list[int]) -> Piece:
        written = self.vocabulary.written
        return len(ids), b" ".join([b"%d" % i for i in ids]), b" ".join([written[i] for i in ids])

    def _encode(self, piece: str) -> list[int]:
        word = piece.rstrip(SIGNS)
        if not word.isalpha() or not (word.isascii() or max(word) <= "\xff"):
            # Also signs alone, contractions, figures and what normal forms may change.
            return [i for form, _ in self.cut(self.normalize(piece)) for i in self.vocabulary.ids(form + self.end)]
        form = word.lower()
        ids = self.vocabulary.ids((form if form.isascii() else form.translate(self.letters)) + self.end)
        return ids + self.vocabulary.ids(piece[len(word) :] + self.end) if len(word) < len(piece) else ids

    def piece(self, piece: str) -> Piece:
        """A stretch of a text without a space in it."""
        made = self._piece(self._encode(piece))
        place = hash(piece) & 0x3FFFFF
        if self.seen[place] and len(piece) <= 32 and len(self.kept) < self.most:
            self.kept[piece] = made
        self.seen[place] = 1
        return made

    def _plain(self, text: str) -> Iterator[list[Piece]]:
        kept, make, begin = self.kept.get, self.piece, 0
        while begin < len(text):
            end = begin + STRETCH
            if end < len(text):
                cut = text.find(" ", end)
                end = len(text) if cut < 0 else cut
            pieces = re.sub("[\t-\r]", " ", text[begin:end]).split(" ")
            found = [kept(p) or make(p) for p in pieces if p]
            yield [p for p in found if p[0]]
            begin = end

    def encode(self, text: str) -> Iterator[list[Piece]]:
        """The pieces of a text: number of ids, the ids and what they decode to."""
        if self.specials is None or not self.specials.search(text):
            yield from self._plain(text)
            return
        for part in self.specials.split(text):
            if part in self.vocabulary.special:
                yield [self._piece([self.vocabulary.special[part]])]
            else:
                yield from self._plain(part)


_coders: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """The worker's coder for a file."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def _digests(encoded: Iterator[list[Piece]]) -> tuple[int, str, str]:
    number, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
    for pieces in encoded:
        if pieces:
            for digest, column in ((ids, 1), (decoded, 2)):
                if number:
                    digest.update(b" ")
                digest.update(b" ".join([p[column] for p in pieces]))
            number += sum([p[0] for p in pieces])
    return number, ids.hexdigest(), decoded.hexdigest()


def _whole(encoded: Iterator[list[Piece]]) -> tuple[int, list[int], str]:
    pieces = [p for some in encoded for p in some]
    ids = [int(i) for p in pieces for i in p[1].split()]
    return len(ids), ids, b" ".join([p[2] for p in pieces]).decode()


def _coded(batches: Iterator[pa.RecordBatch], path: str, digest: bool) -> Iterator[pa.RecordBatch]:
    encode, fold = coder(path).encode, _digests if digest else _whole
    names = ["_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))]
    kind = pa.string() if digest else pa.list_(pa.int32())
    for whole in batches:
        for some in range(0, whole.num_rows, 200):
            batch = whole.slice(some, 200)
            rows = [fold(encode(text)) for text in common.texts(batch.column("_text"))]
            numbers, ids, decoded = zip(*rows, strict=True)
            columns = [pa.array(numbers, pa.int64()), pa.array(ids, kind), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], names=names)


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Per document: ``_id``, ``n_tokens``, ``ids`` and ``decoded`` text; with ``digest`` their sha256 instead."""
    rows = docs.select(docs[id].alias("_id"), docs[text].alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    out = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return common.map_arrow(rows, _coded, f"_id {kind}, n_tokens long, {out}", path, digest)
