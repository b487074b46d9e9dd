"""Conversations as one formatted text with a loss mask, for any template that is a function of messages.

The template is a black box. A conversation's turns are rendered one more at a time, and each output
is compared with the one before: what was added is the turn's span, and an output that does not begin
with the one before shows a template that rewrites history. Where the text stands inside a span is
found by rendering the turn once more with a mark in place of its text.

Turns come sorted and are handled one after the other, so a conversation of any length needs bounded
memory; past ``context`` turns the rendering starts at a later turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKS = tuple(map(chr, range(0xE000, 0xE100)))  # private use: a mark is one that the role does not have
CONTEXT = 256
Message = tuple[str, str]  # role, text
Template = Callable[[list[Message]], str]
START, END = "<|im_start|>", "<|im_end|>"
_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")
_ROWS = 2000


def escape(text: str) -> str:
    """No control string is left: a backslash goes between ``<`` and ``|``, one more where some are there."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _SHUT.sub(r"<\1|", text)


def _role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def _unrole(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def chat_template(messages: list[Message]) -> str:
    """Marked turns: start mark, role, line feed, escaped text, end mark, line feed."""
    return "".join(f"{START}{_role(role)}\n{escape(text)}{END}\n" for role, text in messages)


@dataclass
class Span:
    """A turn in its conversation's formatted text: code points from ``start`` on, its text from ``text_start`` to ``text_end``."""

    piece: str
    start: int
    text_start: int
    text_end: int
    rewrites: bool


class Renderer:
    """Renders one conversation turn by turn, from ``turns`` on, whose rendering is ``length`` code points into the conversation."""

    def __init__(self, template: Template, turns: list[Message] | None = None, length: int | None = None):
        self.template, self.turns = template, list(turns or [])
        self.before = template(self.turns)
        self.length = len(self.before) if length is None else length

    def add(self, role: str, text: str) -> Span:
        self.turns.append((role, text))
        after = self.template(self.turns)
        rewrites = not after.startswith(self.before)
        common = len(self.before)
        if rewrites:
            common = next((i for i, (a, b) in enumerate(zip(self.before, after, strict=False)) if a != b), min(len(self.before), len(after)))
        piece = after[common:]
        mark = next(m for m in MARKS if m not in role)
        probe = self.template([*self.turns[:-1], (role, mark)])
        at = probe.find(mark, common)
        head = at - common if at >= common else len(piece)
        tail = len(probe) - at - 1 if at >= 0 else 0
        span = Span(piece, self.length, self.length + head, max(self.length + head, self.length + len(piece) - tail), rewrites)
        self.before, self.length = after, self.length + len(piece)
        return span


class Conversation:
    """The spans of a conversation, some turns at a time.

    Up to ``context`` turns every prefix is rendered whole. Beyond it, turns are first rendered behind
    the last half a context only, and then one whole rendering must be what all pieces so far give; if
    it is not, these turns and all later ones are rendered whole. With ``reach``, the template is known
    to look at no more than so many earlier turns, and earlier ones are given up.
    """

    def __init__(self, template: Template, context: int = CONTEXT, reach: int | None = None):
        self.template, self.context, self.reach = template, context, reach
        self.turns: list[Message] = []
        self.text, self.length = hashlib.sha256(), 0
        self.whole = False
        self._told(template([]))

    def _told(self, piece: str) -> None:
        self.text.update(piece.encode())
        self.length += len(piece)

    def add(self, new: list[Message]) -> list[Span]:
        """At most half a context of turns at once."""
        known = len(self.turns)
        short = self.reach is not None or not (self.whole or known + len(new) <= self.context)
        kept = self.context // 2 if self.reach is None else self.reach
        start = (self.turns[-kept:] if kept else []) if short else self.turns
        renderer = Renderer(self.template, start, self.length)
        spans = [renderer.add(*m) for m in new]
        if short and self.reach is None:
            text = self.text.copy()
            for span in spans:
                text.update(span.piece.encode())
            if any(s.rewrites for s in spans) or hashlib.sha256(self.template(self.turns + new).encode()).digest() != text.digest():
                self.whole = True
                return self.add(new)
        for span in spans:
            self._told(span.piece)
            self.whole |= span.rewrites
        self.turns += new
        if self.reach is not None:
            self.turns = self.turns[-self.reach:] if self.reach else []
        return spans


_TURNS = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("position", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("piece", T.StringType()), T.StructField("start", T.LongType()), T.StructField("loss_start", T.LongType()),
    T.StructField("loss_end", T.LongType()), T.StructField("rewrites", T.BooleanType())])


def format_turns(
    conversations: DataFrame, template: Template = chat_template, loss_role: str = "assistant", context: int = CONTEXT, reach: int | None = None,
    conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per turn, in order within a conversation: the ``piece`` it adds to the formatted text, where it
    starts, and the span under the loss mask (null for other roles).

    The pieces of a conversation by ``position`` are its formatted text. Turns are ordered by number,
    nulls first, then by role and text, so repeated rows stay as turns of their own. Null roles and
    texts are empty; turns with a null conversation form one conversation. ``rewrites`` tells that the
    template changed what it had rendered before this turn; ``piece`` then starts at the change.
    Without ``reach`` the text is what the template gives for all turns, whatever it looks at, and a
    conversation's turns are held while it is rendered; a template that looks at no more than ``reach``
    earlier turns needs no more of them. An empty table gives no rows.
    """
    schema = T.StructType([T.StructField("conv_id", conversations.schema[conv_id].dataType), *_TURNS.fields[1:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(1, context // 2)
        key, conversation, position = None, None, 0
        held: list[Message] = []
        rows: list[tuple] = []

        def render() -> None:
            nonlocal position
            for (name, _), span in zip(held, conversation.add(held), strict=True):
                loss = name == loss_role
                rows.append((key, position, name, span.piece, span.start, span.text_start if loss else None,
                             span.text_end if loss else None, span.rewrites))
                position += 1
            held.clear()

        def batch_of(kind: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()),
                 pa.array(columns[3], pa.string()), *[pa.array(c, pa.int64()) for c in columns[4:7]], pa.array(columns[7], pa.bool_())],
                schema.names)

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                for own, name, body in zip(*(part.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                    if conversation is None or own != key or len(held) == most:
                        if held:
                            render()
                        if conversation is None or own != key:
                            key, conversation, position = own, Conversation(template, context, reach), 0
                    held.append((name, body))
                if rows:
                    yield batch_of(kind)
        if held:
            render()
            yield batch_of(kind)

    chosen = conversations.select(
        F.col(f"`{conv_id}`").alias("_c"), F.col(f"`{turn}`").alias("_t"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role, "_r"), (text, "_x"))])
    ordered = chosen.repartition("_c").sortWithinPartitions("_c", "_t", "_r", "_x")
    return ordered.mapInArrow(run, schema)


class _Digest:
    """What one conversation's formatted text says when it is read back, piece by piece."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.rewrites = False

    def add(self, piece: str, start: int, loss_start: int | None, loss_end: int | None, rewrites: bool) -> None:
        role, body = read_turn(piece)
        self.turns.update(f"{role}\n{body}\n".encode())
        self.n += 1
        self.chars += len(piece)
        self.rewrites |= rewrites
        if loss_start is not None:
            masked = unescape(piece[loss_start - start:loss_end - start])
            self.loss.update(masked.encode())
            self.loss_chars += len(masked)


def read_turn(piece: str) -> Message:
    """Role and text of one rendered turn of ``chat_template``."""
    if not piece.startswith(START) or not piece.endswith(END + "\n"):
        raise ValueError("not a turn of this template")
    role, _, body = piece[len(START):-len(END) - 1].partition("\n")
    return _unrole(role), unescape(body)


def read_back(turns: DataFrame) -> DataFrame:
    """Digests of formatted conversations, read from the pieces and the loss mask alone.

    ``turns`` is the result of ``format_turns`` as it comes, in order within its partitions: one row
    per conversation with ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed of each turn),
    ``loss_chars`` and ``loss_sha256`` (all text under the mask), ``formatted_chars`` and ``rewrites``.
    """
    schema = T.StructType([
        T.StructField("conv_id", turns.schema["conv_id"].dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
        T.StructField("rewrites", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, kind = None, None, None

        def row(done: list) -> pa.RecordBatch:
            cells = [(k, d.n, d.turns.hexdigest(), d.loss_chars, d.loss.hexdigest(), d.chars, d.rewrites) for k, d in done]
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells, strict=True), types, strict=True)], schema.names)

        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for key, position, piece, start, low, high, rewrites in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if position == 0:
                    if digest is not None:
                        done.append((current, digest))
                    current, digest = key, _Digest()
                digest.add(piece, start, low, high, rewrites)
            if done:
                yield row(done)
        if digest is not None:
            yield row([(current, digest)])

    return turns.select("conv_id", "position", "piece", "start", "loss_start", "loss_end", "rewrites").mapInArrow(run, schema)
