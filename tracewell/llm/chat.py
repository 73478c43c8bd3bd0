"""Chat formatting: a finite-state machine over roles and a declarative template.

`formatted` turns the rows of each conversation, in the order of their turns, into segments of text,
each with a loss flag, and validates the order of roles as it goes. `read_back` takes the segments'
text apart again by the template's control strings alone.

Escaping: in a turn's text a backslash becomes two, and every control string gets a backslash after
its first character. So no control string occurs in formatted text but where the template put it,
and dropping each backslash while keeping what follows it restores the text.

The rows of a conversation are sorted within their partition and streamed: state passes from row to
row, so a conversation of any length takes the memory of one turn.

Defined cases: a null text is empty; a null role is an empty one; a role that the template doesn't
name is written under its own escaped name and makes the conversation invalid, as does a turn order
that the machine doesn't allow; nothing is dropped. A null conversation id is a conversation of its
own; equal turns are ordered by role, then text. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands before and after a role's text, where the loss lies, and which role may follow
    which ("" is the start; roles in `final` may end a conversation)."""

    open: dict[str, str] = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: tuple[str, str] = ("### Role <", ">: ")
    close: str = " </turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        return sorted({x.strip() for x in (*self.open.values(), self.other[0], self.other[1], self.close)}, key=lambda x: (-len(x), x))


class Codec:
    """Escapes texts for a template and finds turns in formatted text."""

    def __init__(self, template: Template) -> None:
        self.template = template
        starts = "|".join(map(re.escape, template.controls()))
        self._special = re.compile(rf"\\|(?={starts}).", re.DOTALL)  # control strings may overlap
        self._escaped = re.compile(r"\\(.)", re.DOTALL)

    def escape(self, text: str) -> str:
        return self._special.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def opening(self, role: str) -> str:
        t = self.template
        return t.open[role] if role in t.open else t.other[0] + self.escape(role) + t.other[1]

    def turn(self, formatted: str) -> tuple[str, str, str]:
        """Role, escaped text and rest of formatted text that starts with a turn."""
        t = self.template
        for role, mark in t.open.items():
            if formatted.startswith(mark):
                at = len(mark)
                break
        else:
            if not formatted.startswith(t.other[0]):
                raise ValueError("no turn starts here")
            stop = formatted.index(t.other[1], len(t.other[0]))
            role, at = self.unescape(formatted[len(t.other[0]) : stop]), stop + len(t.other[1])
        end = formatted.index(t.close, at)
        return role, formatted[at:end], formatted[end + len(t.close) :]




def sorted_rows(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    rows = turns.select(F.col(key), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"), F.col(turn).alias("_turn"))
    return rows.repartition(key).sortWithinPartitions(key, "_turn", "role", "text").drop("_turn")


def formatted(turns: DataFrame, template: Template | None = None, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Segments (key, turn_no, segment, role, text, loss, fault): three a turn, its opening, its
    escaped text and its closing; fault tells what is wrong with the turn's place, else null. A
    conversation's rows follow each other in order within one partition."""
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, last, state, n = Codec(template), (), "", 0
        for b in batches:
            out: list[tuple] = []
            for k, r, x in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if last != (k,):
                    last, state, n = (k,), "", 0
                fault = None if r in template.follows.get(state, ()) else f"{r or 'no role'} after {state or 'the start'}"
                for i, (part, loss) in enumerate(((codec.opening(r), False), (codec.escape(x), r in template.loss), (template.close, False))):
                    out.append((k, n, i, r, part, loss, fault))
                state, n = r, n + 1
            yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate((b.schema.types[0], pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string()))], names=[key, "turn_no", "segment", "role", "text", "loss", "fault"])

    rows = sorted_rows(turns, key, turn, role, text)
    return rows.mapInArrow(run, f"{key} {dict(rows.dtypes)[key]}, turn_no bigint, segment int, role string, text string, loss boolean, fault string")


def read_back(segments: DataFrame, template: Template | None = None, key: str = "conv_id", in_order: bool = False) -> DataFrame:
    """One row a conversation, from the segments' text and loss flags: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, valid, fault. Segments are put in order first, unless they
    come straight from `formatted`, which leaves them so (`in_order`)."""
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)
        one: dict | None = None
        out: list[tuple] = []

        def close() -> None:
            ended = one["role"] in template.final
            fault = one["fault"] or (None if ended else f"the end after {one['role'] or 'no role'}")
            if one["text"]:
                raise ValueError("formatted text goes on after its last turn")
            out.append((one["key"], one["n"], one["turns"].hexdigest(), one["loss_n"], one["loss"].hexdigest(), one["chars"], fault is None, fault))

        def batch() -> pa.RecordBatch:
            types = (key_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(types)], names=[key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid", "fault"])

        key_type = None
        for b in batches:
            key_type = b.schema.types[0]
            for k, i, part, loss, fault in zip(*(b.column(n).to_pylist() for n in range(5)), strict=True):
                if one is None or one["key"] != k:
                    if one is not None:
                        close()
                    one = {"key": k, "n": 0, "turns": hashlib.sha256(), "loss_n": 0, "loss": hashlib.sha256(), "chars": 0, "text": "", "role": "", "fault": None}
                one["text"] += part
                one["chars"] += len(part)
                one["fault"] = one["fault"] or fault
                if loss:
                    said = codec.unescape(part)
                    one["loss"].update(said.encode())
                    one["loss_n"] += len(said)
                if i == 2:  # a turn's last segment: take the turn apart by its control strings
                    one["role"], inner, one["text"] = codec.turn(one["text"])
                    one["turns"].update(f"{one['role']}\n{codec.unescape(inner)}\n".encode())
                    one["n"] += 1
            if out:
                yield batch()
                out = []
        if one is not None:
            close()
            yield batch()

    if not in_order:
        segments = segments.repartition(key).sortWithinPartitions(key, "turn_no", "segment")
    rows = segments.select(key, "segment", "text", "loss", "fault")
    return rows.mapInArrow(run, f"{key} {dict(rows.dtypes)[key]}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean, fault string")
