"""Chat formatting by event-sourced reconstruction.

A log has one row per event: conversation, sequence number, kind, message, role, text. Kinds:

* ``message`` sets a message's role and text, ``edit`` sets its text,
* ``delta`` adds to its text (a streamed piece), ``regenerate`` empties it before new pieces.

The log is dealt by conversation once. Inside a partition it is sorted by message and sequence and
folded as a stream: only the message at hand is held, never a conversation. Final messages stand in
the order of their first event and are rendered row by row; what reads the rendering back is again a
stream. A conversation of any length needs no more memory than its longest message.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. In roles and texts ``\\`` becomes ``\\\\`` and
``<|`` becomes ``<\\|``; in roles a line break becomes ``\\n`` as well. So no text can open or close
a turn and the rendering can be read back exactly. The loss mask covers assistant texts.

Cases: null texts and roles are empty. A null kind is ``message``. Null conversations are one
conversation. Events with the same sequence number come in the order of kind, role and text; equal
``message`` rows of different messages are separate turns. An unknown kind stops the job. Empty
logs give empty results; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
EVENTS = ("conv", "message", "seq", "kind", "role", "text")
FINAL = "conv long, message string, position long, role string, text string"
RENDERED = "conv long, position long, message string, rendered string, loss_start int, loss_length int"
SUMMARY = ("conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn, and start and length of its loss span (length 0: none)."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE + "\n", len(head), len(body) if role == "assistant" else 0


def parse(turn: str) -> tuple[str, str]:
    """Role and text of one rendered turn."""
    if not (turn.startswith(OPEN) and turn.endswith(CLOSE + "\n")):
        raise ValueError("not a rendered turn")
    role, _, text = turn[len(OPEN):-len(CLOSE) - 1].partition("\n")
    return unescape(role), unescape(text)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold sorted events into final messages."""
    at, first, role, parts, begun = None, None, "", [], False
    out: list[tuple] = []
    names = ("conv", "message", "position", "role", "text")

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [()] * 5
        types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], list(names))

    for batch in batches:
        for conv, message, seq, kind, who, text in zip(*(batch.column(n).to_pylist() for n in EVENTS)):
            if not begun or at != (conv, message):
                if begun:
                    out.append((*at, first, role, "".join(parts)))
                at, first, role, parts, begun = (conv, message), seq, "", [], True
            if kind == "message":
                role, parts = who, [text]
            elif kind == "edit":
                parts = [text]
            elif kind == "delta":
                parts.append(text)
                role = who or role
            elif kind == "regenerate":
                parts = []
            else:
                raise ValueError(f"unknown kind of event: {kind}")
        yield flush()
        out.clear()
    if begun:
        out.append((*at, first, role, "".join(parts)))
        yield flush()


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = [render(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("position"), batch.column("message"), pa.array([t[0] for t in turns], pa.string()),
             pa.array([t[1] for t in turns], pa.int32()), pa.array([t[2] for t in turns], pa.int32())],
            ["conv", "position", "message", "rendered", "loss_start", "loss_length"])


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation, from its rendered turns in order."""
    begun, conv, turns, loss, n, lost, chars = False, None, None, None, 0, 0, 0
    out: list[tuple] = []
    schema = [("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
              ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, schema)], [s for s, _ in schema])

    for batch in batches:
        for key, turn, start, length in zip(*(batch.column(c).to_pylist() for c in ("conv", "rendered", "loss_start", "loss_length"))):
            if not begun or key != conv:
                if begun:
                    out.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars))
                begun, conv, turns, loss, n, lost, chars = True, key, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            role, text = parse(turn)
            turns.update(f"{role}\n{text}\n".encode())
            masked = unescape(turn[start:start + length])
            loss.update(masked.encode())
            n, lost, chars = n + 1, lost + len(masked), chars + len(turn)
        yield flush()
        out.clear()
    if begun:
        out.append((conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars))
        yield flush()


def final_messages(events: DataFrame) -> DataFrame:
    """Messages as they ended, dealt by conversation and sorted by position inside it.

    ``events``: conv, message, seq (long), kind, role, text.
    """
    plain = events.select(
        F.col("conv").cast("long").alias("conv"), F.col("message").cast("string").alias("message"), F.col("seq").cast("long").alias("seq"),
        F.coalesce("kind", F.lit("message")).alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (plain.repartition("conv").sortWithinPartitions(*EVENTS).mapInArrow(_fold, FINAL)
            .sortWithinPartitions("conv", "position", "message"))


def rendered_turns(events: DataFrame) -> DataFrame:
    """One row per turn: its rendering and its loss span, in order inside each conversation."""
    return final_messages(events).mapInArrow(_render, RENDERED)


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of every conversation, from the output of ``rendered_turns``."""
    return turns.mapInArrow(_read_back, SUMMARY)
