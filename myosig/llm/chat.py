r"""Chat formatting with a grammar round trip (operator 6).

One turn is rendered as ``### <role>: <text></turn>`` and a line feed.  Every rendered
turn is read again by a deterministic parser and compared with its source; where a text
or role holds a control string, or ends in backslashes, the plain rendering does not come
back identical and the turn is rendered again with escapes.

Escapes: a control string after k backslashes gets 2k+1 of them, a field that ends in k
backslashes gets 2k.  The parser reads an odd run before a control string as data, an even
run as the end of the field, so escaping loses nothing.

Rows are rendered where they are read, then dealt by conversation and sorted by turn; one
streaming pass per task parses the output and feeds the digests, holding one turn at a
time.  A digest over a whole conversation is a chain, so a conversation stays in one task,
but never in its memory.

Edge cases: null role and null text count as empty; turns that tie (or are null, which come
first) are ordered by role, then text; a null conv_id is a conversation of its own; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, MID, CLOSE = "### ", ": ", "</turn>"
_IN_ROLE = re.compile(r"(\\*)(### |: |</turn>)")
_IN_TEXT = re.compile(r"(\\*)(### |</turn>)")
_TAIL = re.compile(r"\\+\Z")
_RENDERED = "conv_id long, turn long, role string, text string, formatted string, loss_start int, loss_end int"
_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class ConflictError(ValueError):
    """The rendered text does not follow the grammar."""


def _escape(field: str, control: re.Pattern) -> str:
    field = control.sub(lambda m: m[1] * 2 + "\\" + m[2], field)
    return _TAIL.sub(lambda m: m[0] * 2, field)


def _field(s: str, at: int, control: re.Pattern, end: str) -> tuple[str, int, int]:
    """Read a field from ``at``: its unescaped text, where its raw form ends, where the next begins."""
    out, pos = [], at
    for m in control.finditer(s, at):
        k = len(m[1])
        out.append(s[pos : m.start()])
        out.append("\\" * (k // 2))
        pos = m.end()
        if k % 2:
            out.append(m[2])
        elif m[2] == end:
            return "".join(out), m.start(2), pos
        else:
            raise ConflictError(f"{m[2]!r} inside a field")
    raise ConflictError(f"no {end!r}")


def parse(s: str) -> list[tuple[str, str, int, int]]:
    """Turns of a rendered text: role, text, and where the raw text begins and ends."""
    turns, at = [], 0
    while at < len(s):
        if not s.startswith(OPEN, at):
            raise ConflictError("a turn must begin here")
        role, _, start = _field(s, at + len(OPEN), _IN_ROLE, MID)
        text, end, at = _field(s, start, _IN_TEXT, CLOSE)
        if not s.startswith("\n", at):
            raise ConflictError("a line must end here")
        at += 1
        turns.append((role, text, start, end))
    return turns


def _agrees(s: str, role: str, text: str) -> bool:
    try:
        return [t[:2] for t in parse(s)] == [(role, text)]
    except ConflictError:
        return False


def render(role: str, text: str) -> str:
    """The plain form if it reads back identical, else the escaped form."""
    plain = f"{OPEN}{role}{MID}{text}{CLOSE}\n"
    if _agrees(plain, role, text):
        return plain
    escaped = f"{OPEN}{_escape(role, _IN_ROLE)}{MID}{_escape(text, _IN_TEXT)}{CLOSE}\n"
    if not _agrees(escaped, role, text):
        raise ConflictError("escapes do not read back")
    return escaped


def _render_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        roles, texts = b.column(2).to_pylist(), b.column(3).to_pylist()
        done = [render(r, t) for r, t in zip(roles, texts)]
        spans = [parse(s)[0][2:] if r == "assistant" else (None, None) for s, r in zip(done, roles)]
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(done, pa.string()), pa.array([x for x, _ in spans], pa.int32()), pa.array([x for _, x in spans], pa.int32())],
            ["conv_id", "turn", "role", "text", "formatted", "loss_start", "loss_end"],
        )


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn: ``formatted`` and the span under the loss mask (assistant turns only)."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return turns.mapInArrow(_render_batches, _RENDERED)


class _Digest:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, masked: bool) -> None:
        self.chars += len(formatted)
        for role, text, _, _ in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if masked:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> dict:
        return {"conv_id": self.conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    now: _Digest | None = None
    for b in batches:
        done = []
        for conv_id, formatted, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = _Digest(conv_id)
            now.add(formatted, start is not None)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=schema)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Read the formatted turns back, conversation by conversation."""
    return (
        formatted.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "formatted", "loss_start")
        .mapInArrow(_digest_batches, _DIGESTS)
    )


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, whose texts are made of control strings."""
    text = r"\### Assistant: </turn> ok"
    return spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
