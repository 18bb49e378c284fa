"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one string, ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn. Control strings
inside roles and texts are escaped: every backslash is doubled, and a backslash goes after the first character of each
control string, so no rendered text holds one, and ``unescape`` gives the text back. The string is encoded once by a
byte-level vocabulary; the lengths of the tokens, added up, are the offsets of each token in its UTF-8 bytes. Turns are
sorted spans of the string, and so are tokens; binary search finds the tokens that meet an assistant's text, which the
loss mask marks. A token may reach over the edge of a text, so the text under the mask is the intersection of token and
turn spans.

Defined results: turns go by number (missing ones first, equal ones by role and text); a missing role or text is empty; a
missing conversation id is a conversation of its own kind. Repeated rows are turns of their own. An empty table
gives an empty table. A conversation is one training example and must fit a row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Strings that mean something to a template or a tokenizer.
CONTROL = (
    START, SEP, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
LOSS_ROLE = "assistant"

_control = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))


def escape(text: str) -> str:
    """The text without any control string."""
    if "\\" not in text and "<" not in text and "[" not in text:
        return text
    return _control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """What ``escape`` was given."""
    if "\\" not in text:
        return text
    return re.sub(r"\\(\\?)", r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the span of each assistant text in its bytes."""
    parts, at, spans = [], 0, []
    for role, text in turns:
        head, body = START + escape(role) + SEP, escape(text)
        begin = at + len(head.encode())
        end = begin + (len(body) if body.isascii() else len(body.encode()))
        if role == LOSS_ROLE:
            spans.append((begin, end))
        parts.append(head + body + END)
        at = end + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted conversation."""
    turns = [turn.removesuffix(END).split(SEP, 1) for turn in formatted.split(START)[1:]]
    return [(unescape(role), unescape(text)) for role, text in turns]


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (ascending offsets, two columns) meet a span (ascending, apart): by binary search."""
    out = np.zeros(len(offsets), bool)
    if not len(offsets) or not spans:
        return out
    begin, end = np.array(spans, np.int64).T
    first = np.searchsorted(offsets[:, 1], begin, "right")
    last = np.searchsorted(offsets[:, 0], end, "left")
    for a, b, empty in zip(first, last, begin == end, strict=True):
        out[a:b] |= not empty
    return out


def under_mask(formatted: bytes, offsets: np.ndarray, masked: np.ndarray, spans: list[tuple[int, int]]) -> list[str]:
    """The text of each span that masked tokens cover."""
    begin, end = offsets[masked, 0], offsets[masked, 1]
    out = []
    for a, b in spans:
        # Tokens follow each other without gaps, so those that meet a span cover one stretch of it.
        i, j = np.searchsorted(end, a, "right"), np.searchsorted(begin, b, "left")
        out.append(formatted[max(a, int(begin[i])) : min(b, int(end[j - 1]))].decode() if i < j else "")
    return out


_lengths: dict[str, np.ndarray] = {}


def _token_lengths(path: str) -> np.ndarray:
    """Bytes of each token of a byte-level vocabulary (its signs stand for a byte each)."""
    if path not in _lengths:
        encoder = tokens.encoder(path, True, plain=False)
        vocabulary = encoder.whole["model"]["vocab"]
        _lengths[path] = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            _lengths[path][i] = len(token)
    return _lengths[path]


def _formatted(batches: Iterator[pa.RecordBatch], path: str, ids_too: bool) -> Iterator[pa.RecordBatch]:
    encoder, lengths = tokens.encoder(path, True, plain=False), _token_lengths(path)
    held_id: object = None
    held: list[tuple[str, str]] = []
    ready: list[tuple[object, list[tuple[str, str]]]] = []

    def out(kind: pa.DataType) -> pa.RecordBatch:
        names, texts, losses, ids, masks = [], [], [], [], []
        for id, turns in ready:
            text, spans = render(turns)
            own = np.frombuffer(encoder.ids(text), "<u4")
            ends = np.cumsum(lengths.take(own))
            offsets = np.stack([ends - lengths.take(own), ends], axis=1)
            masked = mask(offsets, spans)
            names.append(id)
            texts.append(text)
            losses.append(under_mask(text.encode(), offsets, masked, spans))
            ids.append(own)
            masks.append(masked)
        columns = {
            "_id": pa.array(names, kind), "n_turns": pa.array([len(t) for _, t in ready], pa.int64()),
            "formatted": pa.array(texts, pa.string()), "loss_texts": pa.array(losses, pa.list_(pa.string())),
        }
        if ids_too:
            edges = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            columns["ids"] = pa.ListArray.from_arrays(edges, pa.array(np.concatenate(ids).astype(np.int32)))
            columns["loss_mask"] = pa.ListArray.from_arrays(edges, pa.array(np.concatenate(masks)))
        ready.clear()
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = None
    size = 0
    for batch in batches:
        kind = batch.schema.field("_id").type
        ids, roles = batch.column("_id").to_pylist(), common.texts(batch.column("_role"))
        for id, role, text in zip(ids, roles, common.texts(batch.column("_text")), strict=True):
            if held and id != held_id:
                ready.append((held_id, held))
                size += sum(len(t) for _, t in held)
                held = []
                if size > 1 << 21:
                    yield out(kind)
                    size = 0
            held_id = id
            held.append((role, text))
    if held:
        ready.append((held_id, held))
    if ready:
        yield out(kind)


def format_chats(
    turns: DataFrame, tokenizer: str, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    ids_too: bool = True,
) -> DataFrame:
    """One row per conversation: ``_id``, ``n_turns``, ``formatted``, ``loss_texts`` (the text under the mask for each
    assistant turn, as it stands in ``formatted``) and, with ``ids_too``, ``ids`` and ``loss_mask`` (one per id)."""
    rows = turns.select(
        F.col(id).alias("_id"), F.col(turn).alias("_turn"), F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    kind = rows.schema["_id"].dataType.simpleString()
    dealt = rows.repartition(common.partitions(turns.sparkSession), "_id")
    ordered = dealt.sortWithinPartitions("_id", "_turn", "_role", "_text")
    return common.map_arrow(
        ordered.select("_id", "_role", "_text"), _formatted,
        f"_id {kind}, n_turns long, formatted string, loss_texts array<string>"
        + (", ids array<int>, loss_mask array<boolean>" if ids_too else ""), tokenizer, ids_too,
    )
