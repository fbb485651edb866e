"""Chat formatting by columnar byte assembly.

Turns are sorted by conversation and turn over the whole cluster, so that a
conversation's turns stand together, split between tasks only where a range
ends or a part is full.  A task lays out many turns at once: the lengths of
the segments (mark, role, mark, text, mark) give their cumulative offsets, one
buffer is allocated for all, and marks and contents are copied to their scatter
indices.  That buffer is the data of the Arrow column that goes back to Spark.

A template's control strings inside roles and texts, and its escape character,
get an escape character before them; no control string can arise where a
content and a mark meet (``Template`` checks that), so the reader finds the
marks again and undoes the escapes.

The output: a row per part of a conversation, ``text`` and ``loss``, the spans
of it (code points, end excluded) that are learned from: the texts of the
trained roles, escapes included.  A conversation is one part unless it is
longer than ``PART`` bytes or lies across two tasks; parts follow one another
by their number.  ``whole`` is true where the conversation surely has no other.

Defined cases: null texts and roles are empty; turns with the same number are
ordered by role and text, null numbers come first, repeated rows are turns
each; rows with a null conversation are one conversation.  An empty table gives
no row.  Texts are whole.  Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = 8 << 20  # bytes of roles and texts after which a conversation goes on in a further part
ASSEMBLE = 16 << 20  # bytes of roles and texts laid out together, about
COPY = 1 << 20  # content bytes whose scatter indices are held at once


@dataclass(frozen=True)
class Template:
    """A turn is ``open`` role ``named`` text ``close`` ``after``."""

    open: str = "### "
    named: str = ":\n"
    close: str = "</turn>"
    after: str = "\n"
    escape: str = "\\"
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if len(self.escape) != 1 or not self.escape.isascii():
            raise ValueError("the escape is one ASCII character")
        for c in self.controls:
            if not c or self.escape in c:
                raise ValueError(f"control string {c!r} is empty or holds the escape")
            for d in self.controls:
                if any(d.startswith(c[i:]) for i in range(1, len(c))) or (c != d and c in d):
                    raise ValueError(f"control strings {c!r} and {d!r} overlap")

    @property
    def controls(self) -> tuple[str, ...]:
        return self.open, self.named, self.close


def _escaped(data: np.ndarray, offsets: np.ndarray, template: Template) -> np.ndarray:
    """Rising places of ``data`` before which an escape goes.  Row i lies in
    [offsets[i], offsets[i + 1]); a control string lies within a row."""
    found = [np.flatnonzero(data == ord(template.escape))]
    for control in template.controls:
        c = np.frombuffer(control.encode(), np.uint8)
        at = np.flatnonzero(data[:max(0, len(data) - len(c) + 1)] == c[0])
        for i in range(1, len(c)):
            at = at[data[at + i] == c[i]]
        ends = offsets[np.searchsorted(offsets, at, side="right")]
        found.append(at[at + len(c) <= ends])
    return np.sort(np.concatenate(found))


class _Content:
    """A column of texts: where its bytes lie, and which get an escape."""

    def __init__(self, column: pa.Array, template: Template):
        offsets, data = _offsets(column), column.buffers()[2]
        self.data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.escapes = _escaped(self.data, self.offsets, template)
        self.before = np.searchsorted(self.escapes, self.offsets)  # escapes before each row
        self.sizes = np.diff(self.offsets) + np.diff(self.before)

    def scatter(self, out: np.ndarray, starts: np.ndarray, escape: int) -> None:
        """Copy each row, escaped, to its start in ``out``."""
        shift = starts - self.offsets[:-1] - self.before[:-1]  # of a row's bytes, without escapes
        for a in range(0, len(self.data), COPY):
            b = min(a + COPY, len(self.data))
            first, last = np.searchsorted(self.offsets, [a, b - 1], side="right") - 1
            edges = np.clip(self.offsets[first:last + 2], a, b)
            place = np.arange(a, b) + np.repeat(shift[first:last + 1], np.diff(edges))
            i, k = np.searchsorted(self.escapes, [a, b])
            here = self.escapes[i:k] - a
            more = np.zeros(b - a, np.int64)
            more[here] = 1
            place += i + np.cumsum(more)
            out[place] = self.data[a:b]
            out[place[here] - 1] = escape


def assemble(roles: pa.Array, texts: pa.Array, part: np.ndarray, template: Template):
    """(column of the parts' texts, first text span in each row, its end) of
    turns; ``part`` numbers the parts from 0, rising.  Spans are code points
    from the beginning of the part."""
    role, text = _Content(roles, template), _Content(texts, template)
    marks = [np.frombuffer(m.encode(), np.uint8) for m in (template.open, template.named, template.close + template.after)]
    n = len(part)
    sizes = np.empty((n, 5), np.int64)  # of a turn's segments
    sizes[:, 0], sizes[:, 1], sizes[:, 2], sizes[:, 3], sizes[:, 4] = len(marks[0]), role.sizes, len(marks[1]), text.sizes, len(marks[2])
    starts = np.cumsum(sizes).reshape(n, 5) - sizes
    total = int(sizes.sum())
    buffer = pa.allocate_buffer(total)
    out = np.frombuffer(buffer, np.uint8)
    for k, mark in zip((0, 2, 4), marks):
        out[(starts[:, k, None] + np.arange(len(mark))).ravel()] = np.tile(mark, n)
    role.scatter(out, starts[:, 1], ord(template.escape))
    text.scatter(out, starts[:, 3], ord(template.escape))

    heads = ((out & 0xC0) != 0x80).view(np.uint8)  # bytes that begin a code point
    points = np.add.reduceat(heads, np.minimum(starts.ravel(), max(0, total - 1)), dtype=np.int64).reshape(n, 5)
    points[sizes == 0] = 0
    at = (np.cumsum(points) - points.ravel()).reshape(n, 5)
    first = np.searchsorted(part, np.arange(part[-1] + 1))  # turn that begins each part
    at = at - at[first, 0][part][:, None]
    offsets = np.append(starts[first, 0], total).astype(np.int32)
    column = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(offsets), buffer])
    return column, at[:, 3], at[:, 3] + points[:, 3]


FORMATTED = "conv_id long, part long, whole boolean, n_turns int, text string, loss array<struct<start:long,end:long>>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FORMATTED = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int32()),
                        ("text", pa.string()), ("loss", pa.list_(_SPAN))])


def _offsets(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.large_binary())
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)


def _bytes(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Bytes of each turn's role and text."""
    return sum(np.diff(_offsets(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c)) for c in (rows["role"], rows["text"]))


class _Turns:
    """Cuts a task's sorted turns into parts and lays out those complete.
    Beside a turn stand its conversation's number in the task, that of its
    part in the conversation, and that of its part in the whole output."""

    def __init__(self, template: Template, task: int):
        self.template, self.held, self.bytes = template, [], 0
        self.last, self.conversation, self.filled, self.piece, self.part = None, -1, 0, 0, (task << 32) - 1

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        null = batch["conv_id"].is_null().to_numpy(zero_copy_only=False)
        conv = batch["conv_id"].fill_null(0).to_numpy()
        new = np.empty(len(conv), bool)
        new[1:] = (null[1:] != null[:-1]) | (conv[1:] != conv[:-1])
        new[0] = self.last != (null[0], conv[0])
        size = _bytes(batch)
        before = np.cumsum(size) - size
        turn_of = np.cumsum(new)
        filled = before - np.append(-self.filled, before[new])[turn_of]  # bytes of the conversation before the turn
        piece = filled // PART
        part = self.part + np.cumsum(new | (piece != np.append(self.piece, piece[:-1])))
        conversation = self.conversation + turn_of
        self.last, self.filled = (null[-1], conv[-1]), int(filled[-1] + size[-1])
        self.piece, self.part, self.conversation = int(piece[-1]), int(part[-1]), int(conversation[-1])
        table = pa.Table.from_batches([batch])
        for name, numbers in (("conversation", conversation), ("piece", piece), ("part", part)):
            table = table.append_column(name, pa.array(numbers))
        self.held.append(table)
        self.bytes += int(size.sum())
        if self.bytes >= ASSEMBLE:
            yield from self.emit(False)

    def emit(self, at_end: bool) -> Iterator[pa.RecordBatch]:
        """Lay out the parts held, but the last one if turns may follow."""
        table = pa.concat_tables(self.held) if self.held else None
        if table is None or not table.num_rows:
            return
        part, upto = table["part"].to_numpy(), np.cumsum(_bytes(table))
        end = len(part) if at_end else int(np.searchsorted(part, part[-1]))
        a = 0
        while a < end:  # whole parts, some ASSEMBLE bytes of them
            b = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + ASSEMBLE, side="right"))
            b = end if b >= end else max(int(np.searchsorted(part, part[b])), int(np.searchsorted(part, part[a], side="right")))
            yield self._laid_out(table, a, b)
            a = b
        self.held, self.bytes = [table.slice(end)], int(upto[-1] - (upto[end - 1] if end else 0))

    def _laid_out(self, table: pa.Table, a: int, b: int) -> pa.RecordBatch:
        """The parts of the turns from a to b."""
        part, conversation, piece = (table[c].to_numpy() for c in ("part", "conversation", "piece"))
        begins = a + np.flatnonzero(np.diff(part[a:b], prepend=-1))
        ends = np.append(begins[1:], b)
        # not the task's first or last conversation, which may go on elsewhere, and in one piece
        follows = np.append(conversation, conversation[-1])[ends]
        whole = (conversation[begins] > 0) & (piece[begins] == 0) & (follows != conversation[begins])
        rows = table.slice(a, b - a).combine_chunks()
        column, start, end = assemble(rows["role"].combine_chunks(), rows["text"].combine_chunks(), part[a:b] - part[a], self.template)
        trained = np.flatnonzero(np.isin(rows["role"].to_numpy(), self.template.trained))
        spans = pa.StructArray.from_arrays([pa.array(start[trained]), pa.array(end[trained])], fields=list(_SPAN))
        edges = np.append(np.searchsorted(trained, begins - a), len(trained)).astype(np.int32)
        return pa.RecordBatch.from_arrays([
            rows["conv_id"].combine_chunks().take(pa.array(begins - a)), pa.array(part[begins]), pa.array(whole),
            pa.array((ends - begins).astype(np.int32)), column, pa.ListArray.from_arrays(pa.array(edges), spans)], schema=_FORMATTED)


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """FORMATTED of ``turns`` (conv_id, turn, role, text)."""
    empty = F.lit("")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                        F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    rows = (rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64))
            .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        laid = _Turns(template, TaskContext.get().partitionId())
        for batch in batches:
            if batch.num_rows:
                yield from laid.add(batch)
        yield from laid.emit(True)

    return rows.mapInArrow(run, FORMATTED)


class Reader:
    """Reads formatted parts back."""

    def __init__(self, template: Template):
        self.template = template
        escape = re.escape(template.escape)
        self.signs = re.compile(f"{escape}.|" + "|".join(map(re.escape, template.controls)), re.DOTALL)
        self.escaped = re.compile(f"{escape}(.)", re.DOTALL)

    def plain(self, content: str) -> str:
        return self.escaped.sub(r"\1", content)

    def turns(self, part: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn."""
        t, expected, at, role = self.template, 0, 0, ""
        for sign in self.signs.finditer(part):
            if sign[0][0] == t.escape:
                continue
            if sign[0] != t.controls[expected] or (expected == 0 and sign.start() != at):
                raise ValueError(f"{sign[0]!r} at {sign.start()} is out of turn")
            if expected == 1:
                role = self.plain(part[at:sign.start()])
            elif expected == 2:
                yield role, self.plain(part[at:sign.start()])
                if not part.startswith(t.after, sign.end()):
                    raise ValueError(f"the turn that ends at {sign.end()} is not followed by {t.after!r}")
            at = sign.end() + (len(t.after) if expected == 2 else 0)
            expected = (expected + 1) % 3
        if expected or at != len(part):
            raise ValueError("the part ends within a turn")


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def digest(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """DIGESTS of each conversation of a stored FORMATTED, read back from it:
    sha256 of role, line end, text, line end of each turn; code points and
    sha256 of the text under the loss spans, unescaped; code points of the
    formatted text.  Only conversations of several parts, or that may have
    others, are shuffled; their parts stream through one task in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, open_, rows = Reader(template), None, []

        def done() -> tuple:
            conv, n, turns, chars, loss, size = open_
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        def made() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                              names=[f.split()[0] for f in DIGESTS.split(", ")])

        for batch in batches:
            for conv, text, loss in zip(batch["conv_id"].to_pylist(), batch["text"], batch["loss"]):
                text = text.as_py()
                if open_ is None or open_[0] != conv:
                    if open_ is not None:
                        rows.append(done())
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in reader.turns(text):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{said}\n".encode())
                for span in loss.as_py():
                    learned = reader.plain(text[span["start"]:span["end"]])
                    open_[3] += len(learned)
                    open_[4].update(learned.encode())
                open_[5] += len(text)
            if len(rows) >= 10_000:
                yield made()
                rows = []
        if open_ is not None:
            rows.append(done())
        if rows:
            yield made()

    whole = formatted.where("whole").select("conv_id", "text", "loss")
    cut = (formatted.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "text", "loss"))
    return whole.mapInArrow(run, DIGESTS).unionByName(cut.mapInArrow(run, DIGESTS))
