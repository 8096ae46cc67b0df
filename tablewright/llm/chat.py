"""Chat formatting in budgeted windows of whole turns, with a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.base import query, small_batches, table
from tablewright.llm.token_files import BYTE_BPE
from tablewright.llm.words import tokenizer

# The template. A turn is "### role: text</turn>\n"; a backslash escapes its own kind, "#" and "<"
# in texts, and ":" and line ends in roles, so that no control string can occur inside them.
TEXT_CONTROLS = str.maketrans({c: "\\" + c for c in "\\#<"})
ROLE_CONTROLS = str.maketrans({c: "\\" + c for c in "\\#<:\n"})
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)

WINDOW_SCHEMA = ("conv_id long, window_no long, n_context int, n_turns int, n_tokens long, text string,"
                 " loss_spans array<struct<start: long, end: long>>")


def escape(text: str) -> str:
    return text.translate(TEXT_CONTROLS)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The turn as it is written, and where its text begins."""
    head = f"### {role.translate(ROLE_CONTROLS)}: "
    return f"{head}{escape(text)}</turn>\n", len(head)


def parse_window(text: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted window."""
    turns, at = [], 0
    while at < len(text):
        found = TURN.match(text, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


@dataclass
class _Turn:
    role: str
    text: str
    body: int
    tokens: int


class _Windows:
    """Windows of one conversation whose turns come one at a time; holds one window's turns."""

    def __init__(self, conv_id: int | None, budget: int, history: int) -> None:
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: _Turn | None = None
        self.context: list[_Turn] = []
        self.new: list[_Turn] = []
        self.number = self.seen = self.context_tokens = self.total = 0

    def add(self, turn: _Turn) -> dict | None:
        """Take a turn; gives the window that it closes, if it closes one."""
        closed = None
        # Sum of context and new turns before this one, plus this one, against the budget.
        if self.new and self.total + turn.tokens > self.budget:
            closed = self.close()
        if not self.new:
            # Repeated history gives way, the oldest turn first, until the first new turn fits.
            first = 1 if self.system else 0
            while len(self.context) > first and self.total + turn.tokens > self.budget:
                self.total -= self.context.pop(first).tokens
        if self.seen == 0 and turn.role == "system":
            self.system = turn
        self.seen += 1
        self.new.append(turn)
        self.total += turn.tokens
        return closed

    def close(self) -> dict:
        turns, at, parts, spans = self.context + self.new, 0, [], []
        for i, turn in enumerate(turns):
            if i >= len(self.context) and turn.role == "assistant":
                # The text, still escaped, without its end mark.
                spans.append({"start": at + turn.body, "end": at + len(turn.text) - len("</turn>\n")})
            parts.append(turn.text)
            at += len(turn.text)
        row = {"conv_id": self.conv_id, "window_no": self.number, "n_context": len(self.context),
               "n_turns": len(self.new), "n_tokens": self.total, "text": "".join(parts), "loss_spans": spans}
        self.number += 1
        # The next window repeats the system turn and as many last turns as the history budget holds.
        kept: list[_Turn] = []
        left = self.history
        for turn in reversed(turns):
            if turn is self.system or turn.tokens > left:
                break
            kept.append(turn)
            left -= turn.tokens
        self.context = ([self.system] if self.system else []) + kept[::-1]
        self.new = []
        self.total = sum(t.tokens for t in self.context)
        return row


def format_chats(turns: DataFrame, budget: int = 2048, history: int = 512, vocabulary: str = BYTE_BPE,
                 partitions: int | None = None) -> DataFrame:
    """Formatted windows of every conversation: columns of ``WINDOW_SCHEMA``.

    Turns in order of (turn, role, text) are added while the running sum of their tokens stays
    within ``budget``; a window ends on a whole turn. Windows after the first begin with the system
    turn (the first turn, if its role is "system") and with the last turns before them that fit into
    ``history`` tokens and leave room for the first new turn: ``n_context`` turns in all, which are
    never targets again. A window is over the budget only if it has one new turn that is so together
    with the system turn; no history stands in it. ``loss_spans``
    are code point ranges of ``text`` that hold the (escaped) texts of new assistant turns.

    NULL roles and texts are empty, NULL turns come first, NULL conv_ids form one conversation,
    repeated rows are turns of their own, and other columns are ignored. A conversation streams
    through one task in sorted order; what is held is one window, however long it is.
    """
    small_batches(turns.sparkSession)

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, current = tokenizer(vocabulary), None
        schema = pa.schema([("conv_id", pa.int64()), ("window_no", pa.int64()), ("n_context", pa.int32()),
                            ("n_turns", pa.int32()), ("n_tokens", pa.int64()), ("text", pa.string()),
                            ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        for batch in batches:
            columns = batch.to_pydict()
            formatted = [format_turn(r, t) for r, t in zip(columns["role"], columns["text"])]
            counts = words.counts(pa.array([f for f, _ in formatted], pa.large_string())).tolist()
            rows, held = [], 0
            for conv_id, role, (text, body), tokens in zip(columns["conv_id"], columns["role"], formatted, counts):
                if current is None or current.conv_id != conv_id:
                    if current is not None:
                        rows.append(current.close())
                    current = _Windows(conv_id, budget, history)
                closed = current.add(_Turn(role, text, body, tokens))
                if closed:
                    rows.append(closed)
                held += len(text)
                if rows and held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        if current is not None:
            yield pa.RecordBatch.from_pylist([current.close()], schema)

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    dealt = rows.repartition(partitions, "conv_id") if partitions else rows.repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(windows, WINDOW_SCHEMA)


def read_chats(windows: DataFrame) -> DataFrame:
    """Digests read back from formatted windows whose conversations are in order within partitions.

    Parses every window by the template, drops the repeated turns and streams the rest into
    hashes: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.
    """
    schema = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
              " formatted_chars long, n_windows long")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        began, conv, state = False, None, None

        def row():
            turns, loss, sums = state
            return {"conv_id": conv, "n_turns": sums[0], "turns_sha256": turns.hexdigest(), "loss_chars": sums[1],
                    "loss_sha256": loss.hexdigest(), "formatted_chars": sums[2], "n_windows": sums[3]}

        kinds = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                           ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                           ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])
        for batch in batches:
            rows = []
            for w in batch.to_pylist():
                if not began or w["conv_id"] != conv:
                    if began:
                        rows.append(row())
                    began, conv = True, w["conv_id"]
                    state = (hashlib.sha256(), hashlib.sha256(), np.zeros(4, np.int64).tolist())
                turns, loss, sums = state
                for role, text in parse_window(w["text"])[w["n_context"]:]:
                    turns.update(f"{role}\n{text}\n".encode())
                    sums[0] += 1
                for span in w["loss_spans"]:
                    text = unescape(w["text"][span["start"]:span["end"]])
                    loss.update(text.encode())
                    sums[1] += len(text)
                sums[2] += len(w["text"])
                sums[3] += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kinds)
        if began:
            yield pa.RecordBatch.from_pylist([row()], kinds)

    return windows.mapInArrow(read, schema)


@query("op1_chat_windows")
def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = [(-7, turn, role, "\\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(planted, "conv_id long, turn long, role string, text string"))
    return read_chats(format_chats(turns))
