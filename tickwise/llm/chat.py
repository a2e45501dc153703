"""Conversations as training windows in a marked template.

Template: each turn is ``<|im_start|>role`` + newline + text + ``<|im_end|>`` + newline. A control string inside a text or role gets a
backslash (``<|`` becomes ``<\\|``, ``<\\|`` becomes ``<\\\\|``), so that marks in the output are always the template's, and
unescaping gives back the very text. Role names also have backslash and newline escaped.

Windows: running sums of turn tokens decide how many whole turns fit a budget. Every later window repeats the system turn and, if they
fit in a share of the budget, the last turns before it. Repeated turns are context: only new assistant texts carry the
loss, each in exactly one window. A turn above the budget has a window of its own and is never cut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.frames import batch, column
from tickwise.llm.tokens import encoded

BUDGET = 2_048
HISTORY_TURNS = 2
HISTORY_SHARE = 0.25
MARK_TOKENS = 4
ROWS_OUT = 256
START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

WINDOW_TYPE = "conv_id long, window int, first_turn long, repeated int, text string, loss_starts array<int>, loss_ends array<int>, tokens long"
_WINDOW = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("first_turn", pa.int64()), ("repeated", pa.int32()),
                     ("text", pa.string()), ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32())),
                     ("tokens", pa.int64())])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Windows:
    """Takes the turns of one conversation in order and gives out finished windows; holds one window's turns at most."""

    def __init__(self, conv_id: int | None, budget: int, history: int, share: float):
        self.conv_id, self.budget, self.history, self.share = conv_id, budget, history, share
        self.system: tuple | None = None
        self.context: list[tuple] = []
        self.fresh: list[tuple] = []
        self.size, self.window, self.turn, self.first = 0, 0, 0, 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[list]:
        turn = (role, text, tokens)
        if self.fresh and self.size + tokens > self.budget:
            yield self.close()
            base = self.system[2] if self.system else 0
            room = min(self.share * self.budget, self.budget - base - tokens)
            # Running sums from the last turn backwards: as many whole turns as the room allows.
            last = [t for t in self.fresh if t is not self.system][-self.history:] if self.history else []
            fits = int(np.searchsorted(np.cumsum([t[2] for t in reversed(last)]), room, "right")) if last else 0
            self.context = ([self.system] if self.system else []) + last[len(last) - fits:]
            self.fresh, self.first = [], self.turn
            self.size = sum(t[2] for t in self.context)
        if self.turn == 0 and role == SYSTEM_ROLE:
            self.system = turn
        self.fresh.append(turn)
        self.size += tokens
        self.turn += 1

    def close(self) -> list:
        parts, at, starts, ends = [], 0, [], []
        for k, (role, text, _) in enumerate(self.context + self.fresh):
            head, body = f"{START}{escape_role(role)}\n", escape(text)
            if k >= len(self.context) and role == TARGET_ROLE:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            parts += [head, body, END, "\n"]
            at += len(head) + len(body) + len(END) + 1
        self.window += 1
        return [self.conv_id, self.window - 1, self.first, len(self.context), "".join(parts), starts, ends, self.size]


def _format(rows: Iterator[pa.RecordBatch], budget: int, history: int, share: float, path: str | None) -> Iterator[pa.RecordBatch]:
    now, out = None, []
    for some in rows:
        counts = np.zeros(some.num_rows, np.int64)
        for lo, _, first in encoded(column(some, "text"), path):
            counts[lo:lo + len(first) - 1] = np.diff(first) - 1 + MARK_TOKENS
        for conv, role, text, tokens in zip(column(some, "conv_id").to_pylist(), column(some, "role").to_pylist(),
                                            column(some, "text").to_pylist(), counts.tolist(), strict=True):
            if now is None or now.conv_id != conv:
                if now is not None:
                    out.append(now.close())
                now = Windows(conv, budget, history, share)
            out.extend(now.add(role or "", text or "", tokens))
            if len(out) >= ROWS_OUT:
                yield batch(_WINDOW, list(zip(*out, strict=True)))
                out = []
    if now is not None:
        out.append(now.close())
    if out:
        yield batch(_WINDOW, list(zip(*out, strict=True)))


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY_TURNS, share: float = HISTORY_SHARE,
                         tokenizer: str | None = None) -> DataFrame:
    """Windows of all conversations of ``turns`` (conv_id, turn, role, text; other columns are not read).

    Null roles and texts count as empty; a null conv_id is a conversation of its own; turns with equal numbers are ordered by role and
    text, null numbers first; repeated rows are turns of their own; an empty table gives no windows. ``repeated`` leading turns of a
    window are context. loss_starts and loss_ends are code points of ``text``. A conversation is streamed through one task in turn
    order and never held as a whole.
    """
    ordered = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"),
                           F.col("text").cast("string").alias("text"))
    ordered = ordered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn")
    return ordered.mapInArrow(lambda rows: _format(rows, budget, history, share, tokenizer), WINDOW_TYPE)


class _Reader:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss, self.formatted = conv_id, 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, repeated: int, starts: list[int], ends: list[int]) -> None:
        self.formatted += len(text)
        for k, found in enumerate(_TURN.finditer(text)):
            if k >= repeated:
                self.turns += 1
                self.turns_hash.update(f"{unescape_role(found[1])}\n{unescape(found[2])}\n".encode())
        for a, b in zip(starts, ends, strict=True):
            target = unescape(text[a:b])
            self.loss += len(target)
            self.loss_hash.update(target.encode())

    def row(self) -> list:
        return [self.conv_id, self.turns, self.turns_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.formatted]


def _digest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out = None, []
    for some in rows:
        for row in some.to_pylist():
            if now is None or now.conv_id != row["conv_id"]:
                if now is not None:
                    out.append(now.row())
                now = _Reader(row["conv_id"])
            now.read(row["text"], row["repeated"], row["loss_starts"], row["loss_ends"])
        if out:
            yield batch(_DIGEST, list(zip(*out, strict=True)))
            out = []
    if now is not None:
        yield batch(_DIGEST, [[v] for v in now.row()])


def read_digests(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted windows."""
    needed = windows.select("conv_id", "window", "repeated", "text", "loss_starts", "loss_ends")
    return needed.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(
        _digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
