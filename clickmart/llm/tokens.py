"""Token ids of whole texts, equal to those of the tokenizers library's plain call without special tokens added.

Strings of special tokens that stand in a text become these tokens, as in that call (``plain``), or are ordinary text.

Files that drop white space (words with a mark of their end) are encoded piece by piece: texts are cut where the
tokenizer's own first split cuts them whatever stands around, before a run of white space that follows a character which
is none. The ids of the pieces, one after the other, are the ids of the text. A piece is kept from its second sighting
on, so that the many words that occur once take no room.

Byte-level files whose merges stand in the order of their ids are encoded by ranks, whole text after whole text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

#: White space as the tokenizers' patterns see it (Unicode White_Space).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: ASCII signs that follow a word; an apostrophe may belong to a contraction.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Fixed value: how byte-level files cut texts into words.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[tuple, Encoder] = {}


class _Kept(dict):
    """Ids of pieces; one that is missing is made, and kept if it was seen before."""

    def __init__(self, make: Callable[[str], bytes], most: int) -> None:
        super().__init__()
        self.make, self.most, self.seen = make, most, bytearray(1 << 22)

    def __missing__(self, piece: str) -> bytes:
        ids = self.make(piece)
        place = hash(piece) & 0x3FFFFF
        if self.seen[place] and len(self) < self.most and len(piece) <= 32:
            self[piece] = ids
        self.seen[place] = 1
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, one ``bytes`` per text."""

    def __init__(self, path: str, plain: bool = True) -> None:
        with open(path, encoding="utf-8") as file:
            self.whole = json.load(file)
        added = self.whole["added_tokens"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("special tokens must match as they are written")
        self.special = {t["content"]: array("I", [t["id"]]).tobytes() for t in added} if plain else {}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None

    def ordinary(self, text: str) -> bytes:
        """Ids of a text in which no special token stands."""
        raise NotImplementedError

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            # Parts that are cut out are special tokens; those between may be empty.
            return b"".join([self.special[p] if p in self.special else self.ordinary(p) for p in self.cut(text)])
        return self.ordinary(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.ids(t) for t in texts]


class Words(Encoder):
    """Files that drop white space and case. ``most`` bounds the pieces kept."""

    def __init__(self, path: str, plain: bool = True, most: int = 500_000) -> None:
        super().__init__(path, plain)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.piece, self.sign = _Kept(self._piece, most), _Kept(self._plain, 10_000)
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = str.maketrans({c: to_bytes(c)[0][0] for c in map(chr, range(0xA1, 0x100))})

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        word = piece.rstrip(SIGNS)
        if not word.isalpha() or not (word.isascii() or max(word) <= "\xff"):
            # Also signs alone, contractions, figures and what normal forms may change.
            return self._plain(piece)
        if len(word) < len(piece):
            return self.piece[word] + self.sign[piece[len(word) :]]
        if (lower := word.lower()) != word:
            return self.piece[lower]
        # ASCII letters stand for themselves in byte-level vocabularies.
        form = word if word.isascii() else word.translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(form)]).tobytes()

    def ordinary(self, text: str) -> bytes:
        return b"".join(map(self.piece.__getitem__, re.sub("[\t-\r]", " ", text).split(" ")))


class Ranks(Encoder):
    """Byte-level files whose ids rank the merges."""

    def __init__(self, path: str, plain: bool = True) -> None:
        super().__init__(path, plain)
        import tiktoken
        from tokenizers import pre_tokenizers

        model, cut = self.whole["model"], self.whole["pre_tokenizer"]
        if cut["type"] != "ByteLevel" or not cut["use_regex"] or cut["add_prefix_space"] or self.whole["normalizer"]:
            raise ValueError("the file does not cut texts as byte-level files do")
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        places = [model["vocab"][a + b] for a, b in merges]
        if any(b <= a for a, b in zip(places, places[1:], strict=False)) or model["ignore_merges"]:
            raise ValueError("merges do not stand in the order of their ids")
        to_sign = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # The signs of all bytes that occur in texts, read off characters of one to four bytes.
        seen = (*range(0x800), *range(0x800, 0xD800, 0x40), *range(0xE000, 0x10000, 0x40), *range(0x10000, 0x110000, 0x10000))
        byte_of = {sign: b for c in map(chr, seen) for sign, b in zip(to_sign(c)[0][0], c.encode(), strict=True)}
        # Bytes that no text has: which of them has which sign does not matter.
        left = sorted(t for t in model["vocab"] if len(t) == 1 and t not in byte_of)
        byte_of |= zip(left, sorted(set(range(256)) - set(byte_of.values())), strict=True)
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in self.special}
        self.ranked = tiktoken.Encoding(path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def ordinary(self, text: str) -> bytes:
        return array("I", self.ranked.encode_ordinary(text)).tobytes()


def encoder(path: str, keep_space: bool, plain: bool = True) -> Encoder:
    """The worker's encoder for a file; ``keep_space``: white space makes tokens (byte-level files)."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = (Ranks if keep_space else Words)(path, plain)
    return _encoders[path, plain]
