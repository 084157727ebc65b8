"""Operator 2 - chat formatting that survives a grammar round trip.

Template, one string per turn; a conversation is their concatenation:

    user       [INST] text [/INST]
    system     [SYS] text [/SYS]
    assistant  (one space) text </s>
    any other  [ROLE name] text [/ROLE]

Every rendered turn is parsed again at once by the deterministic parser below and
compared with its source. Where they differ (the text holds a control string, or
something that reads like an escape), the turn is escaped further and parsed again
until it comes back identical. Turns are self-delimiting, so turn-wise round trips
make the round trip of the whole conversation.

Rendering is one pass over rows. Reading back streams each conversation in order
through one task with constant memory, however long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN = {"user": "[INST] ", "system": "[SYS] ", "assistant": " "}
CLOSE = {"user": " [/INST]", "system": " [/SYS]", "assistant": " </s>"}
OTHER_OPEN, OTHER_CLOSE = "[ROLE ", " [/ROLE]"
#: Beginnings of the strings that mean something to the parser.
CONTROL = re.compile(r"\[(?=/?(?:INST|SYS|ROLE))|<(?=/?s>)")
ESCAPED = re.compile(r"\\([\\\[\]<])")


def escape(text: str, level: int) -> str:
    """Level 0: as is. 1: backslashes that read as escapes, and control strings. 2: every such character."""
    if level == 0:
        return text
    if level == 1:
        return CONTROL.sub(lambda m: "\\" + m[0], re.sub(r"\\(?=[\\\[\]<]|$)", r"\\\\", text))
    return re.sub(r"[\\\[\]<]", lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse(rendered: str, at: int = 0) -> Iterator[tuple[str, str, int, int]]:
    """``(role, text, begin, end)`` of every turn; begin and end bound the (escaped) text.

    The first characters give the kind of turn; its text ends at the first close string of that kind.
    """
    while at < len(rendered):
        for role, mark in OPEN.items():
            if rendered.startswith(mark, at):
                begin, close = at + len(mark), CLOSE[role]
                break
        else:
            if not rendered.startswith(OTHER_OPEN, at):
                raise ValueError(f"no turn begins at {at}")
            name = re.compile(r"((?:[^\\\]]|\\.)*)\] ", re.S).match(rendered, at + len(OTHER_OPEN))
            if not name:
                raise ValueError(f"a role does not end after {at}")
            role, begin, close = unescape(name[1]), name.end(), OTHER_CLOSE
        end = rendered.find(close, begin)
        if end < 0:
            raise ValueError(f"the turn at {at} does not end")
        yield role, unescape(rendered[begin:end]), begin, end
        at = end + len(close)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn and the bounds of its text in it, escaped as far as the round trip needs."""
    for level in (0, 1, 2):
        if role in OPEN:
            head, tail = OPEN[role], CLOSE[role]
        else:
            head, tail = f"{OTHER_OPEN}{escape(role, 2)}] ", OTHER_CLOSE
        out = head + escape(text, level) + tail
        try:
            turns = list(parse(out))
        except ValueError:
            continue
        if [t[:2] for t in turns] == [(role, text)]:
            return out, turns[0][2], turns[0][3]
    raise ValueError(f"a turn of role {role!r} does not survive the round trip")


FORMATTED = "rendered string, text_begin int, text_end int, loss boolean"


def format_turns(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """``conv_id, turn, rendered, text_begin, text_end, loss`` per row of ``conv_id, turn, role, text``.

    The conversation is the rows' ``rendered`` in order of turn (null first; ties by role, then text).
    The loss mask is ``[text_begin, text_end)`` of the assistant's rows. Null texts and roles are empty
    strings; repeated rows are repeated turns; an empty table gives an empty table; other columns are dropped.
    """
    schema = T.StructType([turns.schema[id_column], turns.schema["turn"], T.StructField("role", T.StringType()),
                           *T._parse_datatype_string(FORMATTED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = [r or "" for r in batch.column("role").to_pylist()]
            done = [render(r, t or "") for r, t in zip(roles, batch.column("text").to_pylist(), strict=True)]
            text, begin, end = zip(*done, strict=True) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_column), batch.column("turn"), pa.array(roles, pa.string()), pa.array(text, pa.string()),
                 pa.array(begin, pa.int32()), pa.array(end, pa.int32()), pa.array([r == "assistant" for r in roles])],
                names=[f.name for f in schema.fields])

    return turns.select(id_column, "turn", "role", "text").mapInArrow(run, schema)


def read_back(formatted: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Parse formatted conversations again: turns, their digest, and the text under the loss mask.

    ``turns_sha256`` is over role, newline, text, newline of every turn in order; ``loss_sha256`` and
    ``loss_chars`` over the unescaped text of the masked spans; ``formatted_chars`` counts the template too.
    """
    schema = T.StructType([formatted.schema[id_column], *T._parse_datatype_string(
        "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for conv, text, begin, end, loss in zip(*(batch.column(c).to_pylist() for c in (
                    id_column, "rendered", "text_begin", "text_end", "loss")), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        done.append((now, *_closed(state)))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if loss:
                    masked = unescape(text[begin:end])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(text)
            yield _rows(done, schema)
        if state is not None:
            yield _rows([(now, *_closed(state))], schema)

    escaped = F.substring("rendered", F.col("text_begin") + 1, F.col("text_end") - F.col("text_begin"))
    said = F.regexp_replace(escaped, r"\\([\\\[\]<])", "$1")  # only looked at where turn and role tie
    order = [F.col(id_column), F.col("turn"), F.col("role"), said]
    return formatted.repartition(id_column).sortWithinPartitions(*order).mapInArrow(run, schema)


def _closed(state: list) -> tuple:
    return state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _rows(done: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = to_arrow_schema(schema)
    columns = list(zip(*done, strict=True)) if done else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, kinds, strict=True)], schema=kinds)
