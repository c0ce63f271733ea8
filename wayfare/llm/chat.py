"""Chat conversations rebuilt from event logs, rendered with a template.

An event creates a message, appends streamed text to one (``delta``), replaces
its text (``edit``), or starts it anew and drops what was said after it
(``regenerate``).  Windows over the log find which events count; then each
conversation's events are read in order, folded into its final messages and
rendered, one message at a time.  What is rendered can be read back exactly:
control strings inside texts are escaped reversibly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.DOTALL)

OPERATIONS = ("create", "delta", "edit", "regenerate")


def escape(text: str) -> str:
    r"""One backslash more in each ``<|``, ``<\|``, ...: no ``<|`` is left."""
    return _OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render_turn(role: str, text: str) -> str:
    """A turn of the template; a line end in the role is escaped too."""
    name = escape(role).replace("\\", "\\\\").replace("\n", "\\n")
    return f"{START}{name}\n{escape(text)}{END}\n"


def read_turn(rendered: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    name, text = _TURN.fullmatch(rendered).groups()
    name = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], name)
    return unescape(name), unescape(text)


def final_events(events: DataFrame) -> DataFrame:
    """The events whose text is part of a final message, with the message's place.

    ``events``: conv_id, seq, message_id, op, role, text (op one of create,
    delta, edit, regenerate; anything else, and null, counts as create).  Null seq
    sorts last; events with one seq are taken in the order of op, role, text and
    message_id, so repeated rows are applied one after the other.  A message begins with its
    first event whatever its op.  What precedes a message's last create, edit or
    regenerate does not count; a regenerate drops the messages that began between
    its message and itself.  Null text is empty.
    """
    log = events.select(
        "conv_id", "message_id", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.when(F.col("op").isin(*OPERATIONS), F.col("op")).otherwise("create").alias("op"),
        F.col("seq").cast("long").alias("seq"))
    in_order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("seq"), "op", "role", "text", "message_id")
    log = log.withColumn("at", F.row_number().over(in_order).cast("long"))
    message = Window.partitionBy("conv_id", "message_id")
    log = (log.withColumn("began", F.min("at").over(message))
           .withColumn("reset", F.max(F.when(F.col("op") != "delta", F.col("at"))).over(message))
           .withColumn("role", F.first("role").over(message.orderBy("at"))))
    before = Window.partitionBy("conv_id").orderBy("began").rangeBetween(Window.unboundedPreceding, -1)
    log = log.withColumn("cut", F.max(F.when(F.col("op") == "regenerate", F.col("at"))).over(before))
    return (log.filter("at >= coalesce(reset, began)").filter("cut is null or cut < began")
            .select("conv_id", "began", "at", "role", "text"))


def format_chats(events: DataFrame) -> DataFrame:
    """Render every conversation's final messages, a row per turn.

    Returns conv_id, turn (from 0), role, rendered, loss_start and loss_end (code
    points of ``rendered`` under the loss mask: an assistant's text; both null for
    others).  A conversation's rendered turns in order are its formatted text.  A
    null conv_id is a conversation of its own.  No conversation is held whole: a
    task holds one message.  Empty events give an empty result.
    """
    ready = (final_events(events).repartition("conv_id")
             .sortWithinPartitions("conv_id", "began", "at"))
    fields = T.StructType([ready.schema["conv_id"], *T.StructType.fromDDL(
        "turn long, role string, rendered string, loss_start long, loss_end long")])

    def fold(batches):
        open_message, turn = None, 0          # (conv_id, began, role, texts)
        rows: list[tuple] = []

        def finish() -> tuple:
            conv, _, role, texts = open_message
            rendered = render_turn(role, "".join(texts))
            loss = (rendered.index("\n") + 1, len(rendered) - len(END) - 1) if role == "assistant" else (None, None)
            return (conv, turn, role, rendered, *loss)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [id_type, pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=fields.names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, began, _, role, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if open_message and open_message[:2] == (conv, began):
                    open_message[3].append(text)
                    continue
                if open_message:
                    rows.append(finish())
                    turn = turn + 1 if open_message[0] == conv else 0
                open_message = (conv, began, role, [text])
            if rows:
                yield batch_of(rows)
                rows = []
        if open_message:
            yield batch_of([finish()])

    return ready.mapInArrow(fold, fields)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read from the rendered turns alone.

    Returns a row per conversation: conv_id, n_turns, turns_sha256 (role, line
    end, text, line end of each turn), loss_chars, loss_sha256 (all text under the
    loss mask, unescaped), formatted_chars.
    """
    ready = (formatted.select("conv_id", "turn", "rendered", "loss_start", "loss_end")
             .repartition("conv_id").sortWithinPartitions("conv_id", "turn"))
    fields = T.StructType([ready.schema["conv_id"], *T.StructType.fromDDL(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")])

    def conversations(batches) -> Iterator[tuple]:
        state = None
        for batch in batches:
            for conv, _, rendered, start, end in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if state is None or state[0] != conv:
                    if state:
                        yield state
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(rendered)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                if start is not None:
                    loss = unescape(rendered[start:end])
                    state[3] += len(loss)
                    state[4].update(loss.encode())
                state[5] += len(rendered)
        if state:
            yield state

    def digest(batches):
        first = next(iter(batches), None)
        if first is None:
            return
        types = [first.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        rows: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=fields.names)

        for s in conversations(_with(first, batches)):
            rows.append((s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]))
            if len(rows) == 10_000:
                yield batch_of()
                rows = []
        if rows:
            yield batch_of()

    return ready.mapInArrow(digest, fields)


def _with(first, rest) -> Iterator:
    yield first
    yield from rest
