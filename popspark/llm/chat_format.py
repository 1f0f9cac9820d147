"""Operator 3: chat formatting by a finite-state machine and a declarative template.

The machine walks over a conversation's roles and says whether each turn may
follow the one before. The template says how a turn is written: a header that
names the role, the text with control characters escaped, an end mark; and
which segments the loss covers. Escaping replaces every character that a
control string starts with, so no text can hold a control string, and it can
be undone.

A conversation is formatted turn by turn, as a stream over rows that Spark has
sorted by conversation and turn: one piece of text a turn, with its segments
and their loss flags. No task ever holds a whole conversation, however long.
The pieces of a conversation, in order, are its formatted text.

Cases: a null text or role is an empty one; a null conversation id or turn
sorts first, and a null id names one conversation; equal turns are ordered by
role, then text. Rows of unknown roles are formatted, flagged as invalid, and
never covered by the loss. Invalid conversations are formatted and flagged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popspark.llm.common import shuffle_partitions, table


@dataclass(frozen=True)
class Template:
    """How turns are written. Control strings start with escaped characters only."""

    header: str = "### {role}: "
    end: str = " </turn>\n"
    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss_roles: frozenset[str] = frozenset({"assistant"})
    #: what stands for a character in a text or a role
    escapes: dict[str, str] = field(default_factory=lambda: {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"})

    def escape(self, text: str) -> str:
        return text.translate(str.maketrans(self.escapes))

    def unescape(self, text: str) -> str:
        back = {v: k for k, v in self.escapes.items()}
        return re.sub(r"\\.", lambda m: back[m[0]], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) of each segment of a turn; only the turn's own text can be covered."""
        name = self.names.get(role) or "@" + self.escape(role)
        return [(self.header.format(role=name), False), (self.escape(text), role in self.loss_roles), (self.end, False)]

    def parse(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of every turn of a formatted text."""
        roles = {v: k for k, v in self.names.items()}
        start, stop = map(re.escape, self.header.split("{role}"))
        turn = re.compile(f"{start}([^#<:]*){stop}([^#<:]*){re.escape(self.end)}")
        out, at = [], 0
        while at < len(formatted):
            m = turn.match(formatted, at)
            if not m:
                raise ValueError(f"no turn at {at}")
            name = m[1]
            out.append((self.unescape(name[1:]) if name.startswith("@") else roles[name], self.unescape(m[2])))
            at = m.end()
        return out


#: the machine: state -> role -> next state; any other role, or move, is invalid
MOVES = {
    "start": {"system": "system", "user": "user"},
    "system": {"user": "user"},
    "user": {"assistant": "assistant"},
    "assistant": {"user": "user"},
}

_PIECE = "conv_id long, position long, formatted string, segments array<struct<start:long,length:long,loss:boolean>>, valid boolean"


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for rb in batches:
        for start in range(0, rb.num_rows, 500):
            yield from zip(*(c.to_pylist() for c in rb.slice(start, 500).columns), strict=True)


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One piece per turn: conv_id, position, formatted, segments, and valid (the machine may move to it)."""
    template = template or Template()
    parts = shuffle_partitions(turns.sparkSession)
    src = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    schema = _arrow(_PIECE)

    def write(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, chars = [], 0
        for conv, rows in groupby(_stream(batches), key=lambda r: r[0]):
            state: str | None = "start"
            for position, (_, _, role, text) in enumerate(rows):
                to = MOVES[state].get(role)
                parts_, at, places = template.segments(role, text), 0, []
                for s, loss in parts_:
                    places.append({"start": at, "length": len(s), "loss": loss})
                    at += len(s)
                out.append((conv, position, "".join(s for s, _ in parts_), places, to is not None))
                state = to or (role if role in MOVES else state)  # after a wrong turn the machine goes on from it
                chars += at
                if chars > 2_000_000:
                    yield write(out)
                    out, chars = [], 0
        if out:
            yield write(out)

    return src.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, _PIECE)


def read_back(pieces: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of each conversation, from the formatted pieces alone, as a stream in order."""
    template = template or Template()
    parts = shuffle_partitions(pieces.sparkSession)
    ddl = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    schema = _arrow(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, rows in groupby(_stream(batches), key=lambda r: r[0]):
            n = loss_chars = chars = 0
            valid = True
            turns, loss = hashlib.sha256(), hashlib.sha256()
            for _, _, formatted, segments, ok in rows:
                for role, text in template.parse(formatted):
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                for s in segments:
                    if s["loss"]:
                        own = template.unescape(formatted[s["start"] : s["start"] + s["length"]])
                        loss.update(own.encode())
                        loss_chars += len(own)
                chars += len(formatted)
                valid &= ok
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid))
            if len(out) == 2_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return pieces.select("conv_id", "position", "formatted", "segments", "valid").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "position").mapInArrow(run, ddl)


def with_escape_case(turns: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts hold control strings."""
    text = "\\### Assistant: </turn> ok"
    extra = turns.sparkSession.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").unionByName(extra)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(format_conversations(with_escape_case(table(spark, sf_dir, "conversations"))))
