"""Chat formatting: a state machine over roles and a declarative template.

A template names, for each role, the text around a turn and whether the turn is learned.  It
also states which role may follow which.  Turns become segments with a loss flag; control
strings inside texts are escaped reversibly, so a segment can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.llm.registry import query, table

START = "start"


@dataclass(frozen=True)
class Template:
    """``follows[state]``: the roles allowed next; an unknown role keeps its name in the mark."""

    open: str = "<|turn|>{role}<|says|>"
    close: str = "<|end|>\n"
    controls: tuple[str, ...] = ("<|turn|>", "<|says|>", "<|end|>", "[INST]", "[/INST]", "<s>", "</s>")
    learned: frozenset[str] = frozenset({"assistant"})
    follows: dict = field(
        default_factory=lambda: {
            START: {"system", "user"},
            "system": {"user"},
            "user": {"assistant"},
            "assistant": {"user"},
        }
    )

    def __post_init__(self):
        marks = self.open.split("{role}") + [self.close]
        for c in self.controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"a control string has two characters or more and no backslash: {c!r}")
            for other in (*self.controls, *marks):
                if any(other.startswith(c[k:]) for k in range(1, len(c))):
                    raise ValueError(f"{c!r} runs into {other!r}")

    def pattern(self) -> re.Pattern:
        """A control string, with any backslashes after its first character."""
        if not hasattr(self, "_pattern"):
            parts = "|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in self.controls)
            object.__setattr__(self, "_pattern", re.compile(parts))
        return self._pattern

    def escape(self, text: str) -> str:
        return self.pattern().sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    def unescape(self, text: str) -> str:
        return self.pattern().sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)

    def may_follow(self, state: str, role: str) -> bool:
        return role in self.follows.get(state, ())

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The (text, loss) pieces of a turn: its opening, its escaped text, its end."""
        return [
            (self.open.replace("{role}", self.escape(role)), False),
            (self.escape(text), role in self.learned),
            (self.close, False),
        ]


SEGMENTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("ordinal", pa.int64()),
        ("part", pa.int32()),
        ("text", pa.string()),
        ("loss", pa.bool_()),
        ("in_order", pa.bool_()),
    ]
)
DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("in_order", pa.bool_()),
    ]
)
NOBODY = object()


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, a bounded slice at a time."""
    for at in range(0, batch.num_rows, 512):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, 512).columns))


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, ordinal, part, text, loss, in_order) of every segment.

    ``turns`` has conv_id, turn, role and text; other columns are ignored.  Turns are ordered
    by turn, then role and text, nulls first; repeated rows are turns of their own.  A null
    role or text is empty, and a null conv_id is a conversation.  A role out of turn or
    unknown is formatted all the same, with ``in_order`` false from there on.  The result is
    partitioned by conversation and sorted, and rows pass one by one: a conversation of any
    length takes a batch of memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, ordinal, in_order = NOBODY, START, 0, True
        for batch in batches:
            out = []
            for conv, role, text in rows_of(batch):
                if now is NOBODY or conv != now:
                    now, state, ordinal, in_order = conv, START, 0, True
                role, text = role or "", text or ""
                in_order = in_order and template.may_follow(state, role)
                state = role
                for part, (piece, loss) in enumerate(template.segments(role, text)):
                    out.append((conv, ordinal, part, piece, loss, in_order))
                ordinal += 1
                if len(out) >= 3000:
                    yield to_batch(out, SEGMENTS)
                    out = []
            if out:
                yield to_batch(out, SEGMENTS)

    return (
        turns.select("conv_id", "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select(F.col("conv_id").cast("long"), "role", "text")
        .mapInArrow(run, "conv_id long, ordinal long, part int, text string, loss boolean, in_order boolean")
    )


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation: turns and learned text recovered from formatted segments.

    ``segments`` must come from ``format_turns``, whose partitions and order are used.
    """
    before, after = template.open.split("{role}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tally = NOBODY, None
        for batch in batches:
            done = []
            for conv, _, part, piece, loss, in_order in rows_of(batch):
                if now is NOBODY or conv != now:
                    if tally:
                        done.append(tally.row(now))
                    now, tally = conv, Tally()
                tally.chars += len(piece)
                tally.in_order = in_order
                if part == 0:
                    tally.turns += 1
                    tally.add(template.unescape(piece[len(before) : len(piece) - len(after)]))
                elif part == 1:
                    tally.add(template.unescape(piece))
                if loss:
                    learned = template.unescape(piece)
                    tally.loss_chars += len(learned)
                    tally.loss.update(learned.encode())
            if done:
                yield to_batch(done, DIGESTS)
        if tally:
            yield to_batch([tally.row(now)], DIGESTS)

    return segments.mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
        " formatted_chars long, in_order boolean",
    )


class Tally:
    def __init__(self):
        self.turns = self.chars = self.loss_chars = 0
        self.text, self.loss, self.in_order = hashlib.sha256(), hashlib.sha256(), True

    def add(self, text: str) -> None:
        self.text.update(text.encode() + b"\n")

    def row(self, conv) -> tuple:
        return (
            conv, self.turns, self.text.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.in_order,
        )


def sql_escaped(value: str) -> str:
    for c in Template().controls:
        first, rest = re.escape(c[0]), re.escape(c[1:])
        value = rf"regexp_replace({value}, '{first}(\\*){rest}', '{c[0]}\\\1{c[1:]}', 'g')"
    return value


_FRAME = len(Template().open.replace("{role}", "")) + len(Template().close)


@query(
    "op5_chat_format",
    f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
    formed AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS all_text,
               coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
               sum({_FRAME} + length({sql_escaped('role')}) + length({sql_escaped('text')}))::BIGINT AS formatted_chars,
               bool_and(CASE role WHEN 'system' THEN before = 'start' WHEN 'user' THEN before IN ('start', 'system', 'assistant')
                        WHEN 'assistant' THEN before = 'user' ELSE false END) AS in_order
        FROM (SELECT *, lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM turns)
        GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(all_text) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
           sha256(learned) AS loss_sha256, formatted_chars, in_order
    FROM formed
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_turns(turns.unionByName(extra)))
