"""Chat formatting: a finite-state machine over roles and a declarative template.

The template says how a turn of each role is opened and closed and which roles
carry loss. The machine reads a conversation's roles in turn order, notes the
first turn that breaks the order, and emits text segments, each with its loss
flag: the opening, the escaped text, the closing. Control strings begin with
`<` or `#`; inside a text those two and the escape itself are escaped, so the
formatted string is read back without loss.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, shuffles


@dataclass(frozen=True)
class Template:
    opening: str = "### {role}: "
    closing: str = " </turn>\n"
    escape: str = "\\"
    special: str = "<#"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state; a conversation may end in the states of `final`.
    moves: dict = field(default_factory=lambda: {
        "start": {"system": "asked", "user": "user"},
        "asked": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user", "tool": "tool"},
        "tool": {"assistant": "assistant", "tool": "tool"},
    })
    final: tuple[str, ...] = ("assistant",)

    def quote(self, text: str, more: str = "") -> str:
        """text with the escape before each special character, and before those of more."""
        for c in self.escape + self.special + more:
            text = text.replace(c, self.escape + c)
        return text

    def read_text(self, s: str, at: int, end: str) -> tuple[str, int]:
        """The text from `at` up to an unescaped `end`, and the place behind it."""
        parts, start = [], at
        while True:
            e, k = s.find(self.escape, at), s.find(end, at)
            if k < 0:
                raise ValueError("a turn is not closed")
            if e < 0 or k < e:
                parts.append(s[start:k])
                return "".join(parts), k + len(end)
            parts += (s[start:e], s[e + 1])
            at = start = e + 2

    def segments(self, role: str, text: str) -> tuple[tuple[str, bool], ...]:
        head, _, tail = self.opening.partition("{role}")
        return (head + self.quote(role, ":") + tail, False), (self.quote(text), role in self.loss_roles), (self.closing, False)

    def parse(self, s: str, at: int = 0) -> tuple[str, str, int]:
        """Role, text and end of the turn that begins at `at`."""
        head, _, tail = self.opening.partition("{role}")
        if not s.startswith(head, at):
            raise ValueError("no turn begins here")
        role, at = self.read_text(s, at + len(head), tail)
        text, at = self.read_text(s, at, self.closing)
        return role, text, at

    def closed(self, s: str) -> tuple[str, str, int] | None:
        """parse() of the first turn of s; None if s ends before the turn does."""
        try:
            return self.parse(s)
        except ValueError:
            head = self.opening.partition("{role}")[0]
            if not (s.startswith(head) or head.startswith(s)):
                raise
            return None

    def unquote(self, text: str) -> str:
        return self.read_text(text + self.closing, 0, self.closing)[0]


TEMPLATE = Template()
SEGMENTS = "conv_id long, turn long, seq long, part int, text string, loss boolean, valid boolean"


def in_order(convs: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with a conversation's turns together and in order; equal turns by role and text."""
    c = convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return c.repartition(shuffles(c), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def chat_segments(convs: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """conv_id, turn, seq (the turn's place), part (0 opening, 1 text, 2 closing), text, loss, valid: three rows per row of convs, in conversation order.

    valid is false from the first turn that the machine does not allow. Null
    roles and texts are empty; a null conv_id is one conversation, a null turn
    comes first. Repeated rows are turns of their own, side by side. Tasks
    hold a batch of rows and one state, however long a conversation is.
    Columns of convs besides its four are left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, at = object(), "", 0
        for b in batches:
            ids, turns = b.column(0).to_pylist(), b.column(1).to_pylist()
            text, loss, valid, seq = [], [], [], []
            for i, role, t in zip(ids, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if i != conv:
                    conv, state, at = i, "start", 0
                seq.append(at)
                at += 1
                state = template.moves.get(state, {}).get(role, "broken")
                for s, x in template.segments(role, t):
                    text.append(s)
                    loss.append(x)
                valid.append(state != "broken")
            n = len(ids)
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i in ids for _ in range(3)], pa.int64()), pa.array([i for i in turns for _ in range(3)], pa.int64()), pa.array([i for i in seq for _ in range(3)], pa.int64()), pa.array([0, 1, 2] * n, pa.int32()),
                pa.array(text, pa.string()), pa.array(loss, pa.bool_()), pa.array([v for v in valid for _ in range(3)], pa.bool_()),
            ], names=["conv_id", "turn", "seq", "part", "text", "loss", "valid"])

    return in_order(convs).mapInArrow(run, SEGMENTS)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def read_back(segments: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation of chat_segments(), parsed again from the formatted text.

    Segments must come in the order that chat_segments() gives them; one out of
    its place raises ValueError, as does text that is no closed turn. Where a
    turn ends is read from the text alone. Hashes are taken as the segments
    stream by: a task holds one turn at a time.
    """

    class Open:
        def __init__(self, conv):
            self.conv, self.n, self.turns, self.loss, self.loss_n, self.chars, self.valid, self.held, self.next = conv, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, True, "", (0, 0)

        def take(self, seq: int, part: int, text: str, loss: bool, valid: bool) -> None:
            if (seq, part) != self.next:
                raise ValueError(f"segment {seq}, {part} of conversation {self.conv} is out of place")
            self.next = (seq, part + 1) if part < 2 else (seq + 1, 0)
            self.chars += len(text)
            self.held += text
            self.valid = self.valid and valid
            if loss:
                said = template.unquote(text)
                self.loss_n += len(said)
                self.loss.update(said.encode("utf-8", "surrogatepass"))
            while self.held.endswith(template.closing) and (turn := template.closed(self.held)) is not None:
                role, said, end = turn
                self.turns.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                self.n += 1
                self.held = self.held[end:]

        def row(self) -> tuple:
            if self.held:
                raise ValueError(f"conversation {self.conv} ends in an open turn")
            return self.conv, self.n, self.turns.hexdigest(), self.loss_n, self.loss.hexdigest(), self.chars, self.valid

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in DIGEST.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for b in batches:
            for conv, seq, part, text, loss, valid in zip(*(b.column(k).to_pylist() for k in ("conv_id", "seq", "part", "text", "loss", "valid")), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = Open(conv)
                now.take(seq, part, text, loss, valid)
            if done:
                yield table(done)
                done = []
        if now is not None:
            yield table([now.row()])

    return segments.mapInArrow(run, DIGEST)


PROBE = r"\### Assistant: </turn> ok"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return read_back(chat_segments(own.unionByName(probe)))


OP7_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (SELECT *, coalesce(lag(role) OVER w, '') AS before, row_number() OVER w AS i,
        length(regexp_replace(text, '[^\\<#]', '', 'g')) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) AS esc
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
v AS (SELECT *, CASE WHEN i = 1 THEN role IN ('system', 'user') ELSE
        (before = 'system' AND role = 'user' AND i = 2) OR (before = 'user' AND role = 'assistant')
        OR (before = 'assistant' AND role IN ('user', 'tool')) OR (before = 'tool' AND role IN ('assistant', 'tool')) END AS fine FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(text) + length(role) + esc + 15)::BIGINT AS formatted_chars, bool_and(fine) AS valid
FROM v GROUP BY conv_id
"""
