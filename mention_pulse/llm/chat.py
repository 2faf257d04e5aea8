"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to one string; nothing is known of its
inside. Turn by turn the whole conversation so far is rendered with and without the next turn: what the
longer output adds is that turn's span (the first span has what the template puts before all turns).
Where the shorter output is not the beginning of the longer one, the template rewrites history, and the
whole conversation is given back with `rewrites` set and without spans. A turn's text is found inside
its span by rendering the turn with two probe texts that share no character: what their outputs have in
common at both ends is the template's.

Rendering every prefix takes time in the square of a conversation's length, and its task holds the
conversation. Only where the caller declares a template local by `window` (a turn's span depends on the
turn and at most that many turns before it, and never changes), as `marked_turns` is, those turns alone are
rendered: time is in proportion to the length, and pieces stream. A template that breaks this where it is
seen raises an error.

Conversations pass through a task in the order of turn (nulls first; ties by role, then text), so with a
local template a hot conversation needs no more memory than its formatted pieces of one batch; digests of a
whole conversation are sequential by definition. Defined results: null roles and texts count as empty; rows of
a null conv_id form one conversation; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

OPEN, CLOSE = "### ", "</turn>\n"
TRAINED_ROLE = "assistant"
WINDOW = 4
_PROBES = ("\x01", "\x02")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*): ", re.DOTALL)


def escape(text: str) -> str:
    """The text with control strings broken up; `unescape` gives it back."""
    return text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>").replace("### ", "##\\# ")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked_turns(turns: list[Turn]) -> str:
    """Template of this module: each turn between a head that names the role and an end mark."""
    return "".join(f"{OPEN}{escape(role).replace(':', chr(92) + ':')}: {escape(text)}{CLOSE}" for role, text in turns)


def parse_turn(piece: str) -> tuple[str, str]:
    """Role and text, read back from the output of one turn."""
    head = _HEAD.match(piece)
    if not head or not piece.endswith(CLOSE) or CLOSE[:-1] in piece[head.end() : -len(CLOSE)]:
        raise ValueError("not the output of one turn")
    return unescape(head[1]), unescape(piece[head.end() : -len(CLOSE)])


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


@dataclass
class Piece:
    """What a turn adds to the output, and where in it the turn's text stands."""

    output: str
    begin: int
    end: int


@dataclass
class Renderer:
    """Gives each turn's piece; None once the template was seen to rewrite history."""

    template: Template
    window: int | None = None  # turns that a template declared to be local looks back
    past: list[Turn] = field(default_factory=list)
    rewrites: bool = False
    rendered: str = ""  # the output of `past`

    def add(self, role: str, text: str) -> Piece | None:
        if self.rewrites:
            return None
        before = self.rendered
        after = self.template([*self.past, (role, text)])
        probes = [self.template([*self.past, (role, p)]) for p in _PROBES]
        if not all(x.startswith(before) for x in (after, *probes)):
            self.rewrites = True
            return None
        a, b = (p[len(before) :] for p in probes)
        begin, tail = _common(a, b), _common(a[::-1], b[::-1])
        output = after[len(before) :]
        fixed = output[:begin] == a[:begin] and output[len(output) - tail :] == a[len(a) - tail :]
        self.past.append((role, text))
        self.rendered = after
        if self.window is not None and len(self.past) > self.window:
            del self.past[: len(self.past) - self.window]
            self.rendered = self.template(self.past) if self.past else ""
        if not fixed or len(output) < begin + tail:
            self.rewrites = True
            return None
        return Piece(output, begin, len(output) - tail)


def _sorted(turns: DataFrame) -> DataFrame:
    """Whole conversations in a partition each, turns in order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    own = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, object, str, str, bool]]:
    """conv_id, turn, role, text, and whether a new conversation begins."""
    last: object = _PROBES
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            for row in batch.slice(at, 512).to_pylist():
                yield row["conv_id"], row["turn"], row["role"], row["text"], row["conv_id"] != last
                last = row["conv_id"]


def format_turns(turns: DataFrame, template: Template = marked_turns, trained_role: str = TRAINED_ROLE, window: int | None = None) -> DataFrame:
    """One row per turn: its piece of the output, where the piece and the turn's text stand, and the loss mask.

    Pieces joined by `begin` are the conversation's output. `text_begin`:`text_end` is under the loss mask
    if `trained`. Offsets are code points. With `rewrites` the other columns are null. `window` declares a
    template of the caller's to be local.
    """
    if window is None and template is marked_turns:
        window = WINDOW
    schema = turns.schema
    kinds = f"conv_id {schema['conv_id'].dataType.simpleString()}, turn {schema['turn'].dataType.simpleString()}"
    shape = f"{kinds}, output string, begin long, text_begin long, text_end long, trained boolean, rewrites boolean"

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at, held, room = Renderer(template, window), 0, [], 0
        open_rows: list[tuple] = []  # of a conversation that may yet turn out to be rewritten
        batch_schema = None

        def flush() -> pa.RecordBatch:
            names = ("conv_id", "turn", "output", "begin", "text_begin", "text_end", "trained", "rewrites")
            types = (batch_schema.field("conv_id").type, batch_schema.field("turn").type, pa.string(), *[pa.int64()] * 3, pa.bool_(), pa.bool_())
            columns = [pa.array(c, t) for c, t in zip(zip(*held), types)]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=list(names))

        def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal batch_schema
            for batch in batches:
                batch_schema = batch.schema
                yield batch

        def dealt(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal room
            for row in rows:
                held.append(row)
                room += len(row[2] or "")
                if len(held) >= 4096 or room > 1 << 22:
                    room = 0
                    yield flush()
            rows.clear()

        for conv, turn, role, text, new in _streamed(known(batches)):
            if new:
                yield from dealt(open_rows)
                own, at = Renderer(template, window), 0
            piece = own.add(role, text)
            if piece is None:
                if window is not None:
                    raise ValueError("a template declared to be local rewrites history")
                open_rows = [(c, t, None, None, None, None, None, True) for c, t, *_ in [*open_rows, (conv, turn)]]
            else:
                open_rows.append((conv, turn, piece.output, at, at + piece.begin, at + piece.end, role == trained_role, False))
                at += len(piece.output)
            if window is not None or own.rewrites:  # nothing later changes these rows
                yield from dealt(open_rows)
        yield from dealt(open_rows)
        if held:
            yield flush()

    return _sorted(turns).mapInArrow(rendered, shape)


@dataclass
class _Digest:
    """What is read back from a conversation's output, piece by piece."""

    n_turns: int = 0
    turns: object = field(default_factory=hashlib.sha256)
    loss: object = field(default_factory=hashlib.sha256)
    loss_chars: int = 0
    formatted_chars: int = 0

    def add(self, piece: Piece) -> None:
        role, text = parse_turn(piece.output)
        self.n_turns += 1
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        if role == TRAINED_ROLE:
            masked = unescape(piece.output[piece.begin : piece.end])
            self.loss.update(masked.encode("utf-8", "replace"))
            self.loss_chars += len(masked)
        self.formatted_chars += len(piece.output)


def format_digests(turns: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted output: turns, loss text and their digests."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kind = turns.schema["conv_id"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        own, digest, current = Renderer(marked_turns, WINDOW), _Digest(), None

        def close() -> None:
            done.append((current, digest.n_turns, digest.turns.hexdigest(), digest.loss_chars, digest.loss.hexdigest(), digest.formatted_chars))

        def flush() -> pa.RecordBatch:
            types = (None, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
            if pa.types.is_null(columns[0].type):
                columns[0] = columns[0].cast(pa.int64())
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        started = False
        for conv, _, role, text, new in _streamed(batches):
            if new:
                if started:
                    close()
                started, current = True, conv
                own, digest = Renderer(marked_turns, WINDOW), _Digest()
                if len(done) >= 4096:
                    yield flush()
            piece = own.add(role, text)
            if piece is None:
                raise ValueError("this template rewrites no history")
            digest.add(piece)
        if started:
            close()
            yield flush()

    shape = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _sorted(turns).mapInArrow(digests, shape)
