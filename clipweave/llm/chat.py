"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn; each rendered turn is parsed again by a deterministic parser and
compared with its source. A turn that does not come back identical (it holds control strings, or what looks
like an escaped one) is rendered again with those strings escaped, until it does.

    turn   := open " " text " " close "\\n"
    open   := "[SYS]" | "[INST]" | "<s>" | "[ROLE=" JSON string or null "]"
    close  := "[/SYS]" | "[/INST]" | "</s>" | "[/ROLE]"

A control string in a text is escaped by one more backslash before it and read by taking one away; a control
string without a backslash is structure, and is an error inside a text. A text stands between spaces and no control
string begins with, ends in or holds a space, so none is made at a text's edges.

Turns go in order of turn, role, text (nulls first) within a conversation; repeated rows are repeated turns.
A null text is the empty text; a null conv_id is a conversation of its own; a null role is a role. An empty
table gives no rows; other columns are dropped, whatever their names; a long text is held once. Rows stream: a conversation of any length is held one turn
at a time, and only whole-conversation digests see it all.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: role -> (open, close)
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE=", "[/ROLE]")
LEARNED = "assistant"
CONTROL = re.compile(r"(\\*)(\[/?SYS\]|\[/?INST\]|</?s>|\[ROLE=|\[/ROLE\])")
ROLE_OF = {mark: role for role, (mark, _) in MARKS.items()}
SEGMENTS = "conv_id long, position long, segment string, loss_start int, loss_end int"


class GrammarError(ValueError):
    pass


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return CONTROL.sub(lambda m: m[1][1:] + m[2], text)


def write(role: str | None, body: str) -> tuple[str, int]:
    """The rendered turn and where its text begins; body is as it shall stand."""
    mark, close = MARKS.get(role, (None, OTHER[1]))
    head = f"{mark} " if mark else f"{OTHER[0]}{json.dumps(role)}] "
    return f"{head}{body} {close}\n", len(head)


def read(text: str, at: int = 0) -> tuple[str | None, str, int, int, int]:
    """Parses one turn: its role, its text, where the text stands, where the turn ends."""
    m = CONTROL.match(text, at)
    if not m or m[1]:
        raise GrammarError("a turn must open")
    if m[2] in ROLE_OF:
        role, begin = ROLE_OF[m[2]], m.end()
        close = MARKS[role][1]
    elif m[2] == OTHER[0]:
        role, begin = json.JSONDecoder().raw_decode(text, m.end())
        if text[begin : begin + 1] != "]":
            raise GrammarError("a role must end")
        begin, close = begin + 1, OTHER[1]
    else:
        raise GrammarError("a turn must open")
    if text[begin : begin + 1] != " ":
        raise GrammarError("a space must follow")
    begin += 1
    scan = begin
    while m := CONTROL.search(text, scan):
        if not m[1]:
            end = m.start() - 1
            if m[2] != close or end < begin or text[end] != " " or text[m.end() : m.end() + 1] != "\n":
                raise GrammarError("structure inside a text")
            return role, unescape(text[begin:end]), begin, end, m.end() + 1
        scan = m.end()
    raise GrammarError("a turn must close")


def render_turn(role: str | None, text: str) -> tuple[str, int, int]:
    """The segment and where its text stands, escaped only if the round trip asks for it."""
    for body in (text, escape(text)):
        segment, begin = write(role, body)
        try:
            got = read(segment)
        except (GrammarError, json.JSONDecodeError):
            continue
        if got[:2] == (role, text) and got[4] == len(segment):
            return segment, begin, begin + len(body)
    raise GrammarError(f"no rendering of {role!r} reads back")


def render(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One rendered segment per turn, conversations whole in a partition and in order. A conversation's text is its
    segments joined; loss_start and loss_end (code points in the segment) bound what the loss is taken of."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, position = object(), 0
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                position = position + 1 if conv == now else 0
                now = conv
                segment, a, b = render_turn(role, text)
                for held, x in zip(out, (conv, position, segment, a if role == LEARNED else None, b if role == LEARNED else None), strict=True):
                    held.append(x)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=["conv_id", "position", "segment", "loss_start", "loss_end"])

    return rows.mapInArrow(run, SEGMENTS)


def whole(segments: DataFrame) -> DataFrame:
    """(conv_id, formatted): each conversation's text in one string."""
    return segments.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "segment"))), lambda s: s["segment"]), "").alias("formatted"))


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss, self.chars = conv, 0, 0, 0
        self.turns_sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def feed(self, segment: str, start: int | None, end: int | None) -> None:
        at = 0
        while at < len(segment):
            role, text, _, _, at = read(segment, at)
            self.turns += 1
            self.turns_sha.update(f"{role or ''}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.chars += len(segment)
        if start is not None:
            said = unescape(segment[start:end])
            self.loss += len(said)
            self.loss_sha.update(said.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        return self.conv, self.turns, self.turns_sha.hexdigest(), self.loss, self.loss_sha.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation of render()'s output, all of it parsed from the rendered text and the loss mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            rows = []
            for conv, position, segment, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or position == 0:
                    if now is not None:
                        rows.append(now.row())
                    now = _Digest(conv)
                now.feed(segment, a, b)
            yield out(rows)
        if now is not None:
            yield out([now.row()])

    return segments.mapInArrow(run, DIGESTS)
