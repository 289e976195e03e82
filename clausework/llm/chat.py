"""Chat formatting at token level.

Every text segment is encoded alone with a lossless byte-level vocabulary, and
the template's control marks are spliced in as reserved ids past that
vocabulary, so that no text can produce them. The loss mask is the prefix sum
of +1 where an assistant's text begins and -1 where it ends. So that the
written form is unambiguous too, control strings occurring in a text get a
backslash behind their first character (and one more if they have some there
already); reading back takes one away.

Template: ``<s>`` opens a conversation; a user turn is ``[INST] text [/INST]``
without the blanks, an assistant turn ``text</s>``, and a turn of any other
role ``<|role|>name<|says|>text<|end|>``.

Two passes: the first escapes and encodes each row where it lies; the second
brings a conversation's rows together in order and streams through them. A
task holds ``max_tokens`` of one conversation at a time, so a conversation of
any length passes; a longer one becomes several rows, cut between turns.

Defined cases: a null text is empty, a null role is the empty role; rows
without a conversation id form the conversation null; turns are ordered by
number (null first), then role, then text, and repeated rows are repeated
turns; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators._util import worker_cache

# fixed values: the control strings of the template, in the order of their ids
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<|role|>", "<|says|>", "<|end|>")
BOS, EOS, USER, USER_END, ROLE, SAYS, END = range(len(CONTROLS))
# characters encoded at once: bounds the encoder's work on a very long run
SLICE = 1 << 16
# tokens of a conversation in one row, about
MAX_TOKENS = 1 << 22

_PLAIN = re.compile("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROLS))
_ESCAPED = re.compile("|".join(re.escape(c[0]) + r"\\+" + re.escape(c[1:]) for c in CONTROLS))


def escape(text: str) -> str:
    """The text with a backslash put into every control string. No control string is left."""
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The inverse of ``escape``."""
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


class Codec:
    """A byte-level vocabulary in rank format, with the control ids behind it."""

    def __init__(self, path: str, pattern: str):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
        self.base = max(ranks.values()) + 1
        self.encoding = tiktoken.Encoding("segments", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        ids = []
        for at in range(0, len(text), SLICE):
            ids += self.encoding.encode_ordinary(text[at:at + SLICE])
        return np.array(ids, dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8")


def codec(path: str, pattern: str) -> Codec:
    """The codec of a file, built once per worker."""
    cache = worker_cache()
    if ("chat", path, pattern) not in cache:
        cache["chat", path, pattern] = Codec(path, pattern)
    return cache["chat", path, pattern]


def turn_ids(c: Codec, role: str, text: str) -> tuple[np.ndarray, int, int]:
    """The ids of one turn and where the text under the loss begins and ends in them (0, 0: nowhere)."""
    body = c.encode(escape(text))
    mark = lambda *m: np.array(m, dtype=np.int32) + c.base
    if role == "assistant":
        return np.concatenate([body, mark(EOS)]), 0, len(body)
    if role == "user":
        return np.concatenate([mark(USER), body, mark(USER_END)]), 0, 0
    return np.concatenate([mark(ROLE), c.encode(escape(role)), mark(SAYS), body, mark(END)]), 0, 0


def format_conversations(turns: DataFrame, vocabulary: str, pattern: str, conv_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                         max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``(conv_id, part, input_ids array<int>, loss_mask array<tinyint>)``: one row per conversation.

    Only a conversation of over ``max_tokens`` tokens has further rows, with
    ``part`` counting from 0. Rows of a conversation follow each other in one
    partition.
    """
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(vocabulary, pattern)
        for b in batches:
            done = [turn_ids(c, r, t) for r, t in zip(b["role"], b["text"], strict=True)]
            yield pd.DataFrame({"conv_id": b["conv_id"].astype("Int64"), "turn": b["turn"].astype("Int64"), "role": b["role"],
                                "ids": [d[0] for d in done], "loss_from": [d[1] for d in done], "loss_to": [d[2] for d in done]})

    encoded = rows.mapInPandas(encode, "conv_id long, turn long, role string, ids array<int>, loss_from int, loss_to int")
    together = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "ids")
    return together.mapInPandas(lambda batches: _assemble(batches, codec(vocabulary, pattern).base, max_tokens),
                                "conv_id long, part int, input_ids array<int>, loss_mask array<tinyint>")


def _assemble(batches: Iterator[pd.DataFrame], base: int, max_tokens: int) -> Iterator[pd.DataFrame]:
    """Join the ordered turns of each conversation; at most one open part is held."""
    done, held, conv, part, size = [], [], None, 0, 0

    def close() -> None:
        ids = np.concatenate([np.array([base + BOS], dtype=np.int32)] * (part == 0) + [t[0] for t in held])
        steps = np.zeros(len(ids) + 1, dtype=np.int32)
        at = np.cumsum([int(part == 0)] + [len(t[0]) for t in held])[:-1]
        np.add.at(steps, at + [t[1] for t in held], 1)
        np.add.at(steps, at + [t[2] for t in held], -1)
        done.append((conv, part, ids, np.cumsum(steps)[:-1].astype(np.int8)))

    def frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["conv_id", "part", "input_ids", "loss_mask"]).astype({"conv_id": "Int64"})

    for b in batches:
        ready = 0
        for c, ids, lo, hi in zip(b["conv_id"].array, b["ids"], b["loss_from"], b["loss_to"], strict=True):
            c = None if pd.isna(c) else int(c)
            if held and (c != conv or size + len(ids) > max_tokens):
                close()
                ready += size
                held, part, size = [], part + 1 if c == conv else 0, 0
                if ready > max_tokens:
                    yield frame(done)
                    done, ready = [], 0
            conv = c
            held.append((ids, lo, hi))
            size += len(ids)
        yield frame(done)
        done = []
    if held:
        close()
        yield frame(done)


def read_part(c: Codec, ids: np.ndarray) -> Iterator[tuple[str, str]]:
    """``(role, text)`` of the turns in one row's ids."""
    at, role, start = 0, None, 0
    for m in np.flatnonzero(ids >= c.base).tolist():
        mark = int(ids[m]) - c.base
        if mark in (BOS, USER, ROLE):
            start = m + 1
        elif mark == SAYS:
            role, start = unescape(c.decode(ids[start:m])), m + 1
        else:
            name = {EOS: "assistant", USER_END: "user"}.get(mark, role)
            yield name, unescape(c.decode(ids[start:m]))
            start = m + 1


def masked_texts(c: Codec, ids: np.ndarray, mask: np.ndarray) -> Iterator[str]:
    """The texts under the loss mask, one for each run of it."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8)))
    for a, b in edges.reshape(-1, 2).tolist():
        yield unescape(c.decode(ids[a:b]))


def written_length(c: Codec, ids: np.ndarray) -> int:
    """Code points of the written form: control strings and escaped texts."""
    marks = np.flatnonzero(ids >= c.base)
    total = sum(len(CONTROLS[int(ids[m]) - c.base]) for m in marks)
    for a, b in zip([0, *(marks + 1).tolist()], [*marks.tolist(), len(ids)], strict=True):
        if b > a:
            total += len(c.decode(ids[a:b]))
    return total


def written(c: Codec, ids: np.ndarray) -> str:
    """The written form of one row's ids."""
    marks = np.flatnonzero(ids >= c.base).tolist()
    out, at = [], 0
    for m in marks:
        out += [c.decode(ids[at:m]), CONTROLS[int(ids[m]) - c.base]]
        at = m + 1
    return "".join([*out, c.decode(ids[at:])])


def digests(formatted: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """What formatted conversations say when read back, one row per conversation.

    ``n_turns`` and ``turns_sha256`` (role, newline, text, newline of each
    turn), ``loss_chars`` and ``loss_sha256`` (the texts under the mask),
    ``formatted_chars``. Reads the output of ``format_conversations`` as it
    comes, without another shuffle, with one hash state per conversation.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, open_, rows = codec(vocabulary, pattern), None, []

        def frame() -> pd.DataFrame:
            return pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")]).astype({"conv_id": "Int64"})

        def close() -> None:
            conv, n, turns, chars, loss, length = open_
            rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), length))

        for b in batches:
            for conv, part, ids, mask in zip(b["conv_id"].array, b["part"], b["input_ids"], b["loss_mask"], strict=True):
                if part == 0:
                    if open_:
                        close()
                    open_ = [None if pd.isna(conv) else int(conv), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in read_part(c, ids):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{text}\n".encode())
                for text in masked_texts(c, ids, mask):
                    open_[3] += len(text)
                    open_[4].update(text.encode())
                open_[5] += written_length(c, ids)
            yield frame()
            rows.clear()
        if open_:
            close()
            yield frame()

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInPandas(run, schema)
