"""Chat formatting: a state machine over roles and a declarative template.

:func:`format_chats` turns rows (conversation, turn, role, text) into text
segments with a loss flag each.  Concatenated in order, the segments of a
conversation are its training text; a conversation is never held as one string,
so its length does not matter.  :func:`read_chats` parses such segments back.

Rows are dealt by conversation and sorted inside the partition (both spill to
disk), then streamed through the machine.  A conversation with a third of all
rows occupies one task, but that task holds one turn at a time.

Order of turns: ``turn`` (missing first), then role and text, so ties and
repeated rows have one order.  Null text is empty, a null role is the role "".
Rows without a conversation id form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatsift.llm.common import arrow_map, batches

_SEGMENT = ("conv_id long, turn_no long, part int, text string, loss boolean, last boolean, "
            "valid boolean")
_SEGMENT_ARROW = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("part", pa.int32()),
                            ("text", pa.string()), ("loss", pa.bool_()), ("last", pa.bool_()),
                            ("valid", pa.bool_())])
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                     ("n_invalid_turns", pa.int64())])


@dataclass(frozen=True)
class Template:
    """What is written around the text of each role, and what bears loss.

    ``marks`` maps a role to its (opening, closing) control strings; a role
    without an entry is written as ``named[0] role named[1] text named[2]``.
    ``begins`` are the roles that may open a conversation, ``follows`` the roles
    that may come after a role.  No control string may start another one.
    """

    marks: dict = field(default_factory=lambda: {
        "system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")})
    named: tuple = ("[ROLE]", "[/ROLE]", "[/TURN]")
    loss_roles: frozenset = frozenset({"assistant"})
    begins: frozenset = frozenset({"system", "user"})
    follows: dict = field(default_factory=lambda: {
        "system": frozenset({"user"}), "user": frozenset({"assistant"}), "assistant": frozenset({"user"})})

    def controls(self) -> list[str]:
        return [c for pair in self.marks.values() for c in pair] + list(self.named)


class Codec:
    """Escapes control strings inside texts: a backslash after their first character; backslashes double."""

    def __init__(self, template: Template):
        controls = sorted(template.controls(), key=len, reverse=True)
        if any(len(c) < 2 or "\\" in c for c in controls):
            raise ValueError("control strings need two characters and no backslash")
        if any(a != b and a.startswith(b) for a in controls for b in controls):
            raise ValueError("a control string starts another one")
        either = "|".join(map(re.escape, controls))
        self._inside = re.compile(rf"\\|(?:{either})")
        self.token = re.compile(rf"\\.|(?P<control>{either})", re.S)
        self._escaped = re.compile(r"\\(.)", re.S)

    def escape(self, text: str) -> str:
        return self._inside.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)


def _format(template: Template):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)
        held = None  # the turn that may be the last of its conversation
        state, turn_no, out = None, 0, []

        def segments(conv, no, role, text, last, ok):
            if role in template.marks:
                head, tail = template.marks[role]
            else:
                head, tail = template.named[0] + codec.escape(role) + template.named[1], template.named[2]
            out.append((conv, no, 0, head, False, False, ok))
            out.append((conv, no, 1, codec.escape(text), role in template.loss_roles, False, ok))
            out.append((conv, no, 2, tail, False, last, ok))

        def batch():
            columns = list(zip(*out)) or [[] for _ in _SEGMENT_ARROW]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SEGMENT_ARROW)],
                                              schema=_SEGMENT_ARROW)

        for rows_ in batches(rows, 2048, "text", 4 << 20):
            for conv, role, text in zip(*(rows_.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                role, text = role or "", text or ""
                same = held is not None and held[0] == conv
                if held is not None:
                    segments(*held[:4], not same, held[4])
                if not same:
                    state, turn_no = None, 0
                ok = role in (template.begins if state is None else template.follows.get(state, frozenset()))
                held = (conv, turn_no, role, text, ok)
                state, turn_no = role, turn_no + 1
            yield batch()
        if held is not None:
            segments(*held[:4], True, held[4])
            yield batch()
    return run


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments (conv_id, turn_no, part, text, loss, last, valid), partitions sorted by conversation and turn.

    ``valid`` is false for a turn that the machine does not allow after the one
    before; such a turn is formatted like any other, the caller decides.
    ``last`` marks the last segment of a conversation.
    """
    ordered = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
                            F.col("role").alias("role"), F.col("text").alias("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "role", "text"))
    return arrow_map(ordered, _format(template), _SEGMENT)


def _read(template: Template):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)
        opens = {pair[0]: (role, pair[1]) for role, pair in template.marks.items()}
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = invalid = 0
        rest, found = "", []

        def parsed(buffer: str) -> str:
            """Takes the complete turns off ``buffer``; returns what remains."""
            nonlocal n_turns
            at = 0
            controls = (m for m in codec.token.finditer(buffer) if m["control"])
            for m in controls:
                if m["control"] in opens:
                    role, closing = opens[m["control"]]
                    begin = m.end()
                elif m["control"] == template.named[0]:
                    named, closing = next(controls, None), template.named[2]
                    if named is None:
                        return buffer[at:]
                    role, begin = codec.unescape(buffer[m.end():named.start()]), named.end()
                else:
                    raise ValueError(f"unexpected control string {m['control']!r}")
                end = next(controls, None)
                if end is None:
                    return buffer[at:]
                if end["control"] != closing:
                    raise ValueError(f"{closing!r} expected, {end['control']!r} found")
                text = codec.unescape(buffer[begin:end.start()])
                turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                n_turns += 1
                at = end.end()
            return buffer[at:]

        for batch in rows:
            for conv, part, text, is_loss, last, ok in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "part", "text", "loss", "last", "valid"))):
                chars += len(text)
                rest += text
                invalid += part == 2 and not ok
                if is_loss:
                    plain = codec.unescape(text)
                    loss_chars += len(plain)
                    loss.update(plain.encode("utf-8", "surrogatepass"))
                if part == 2:
                    rest = parsed(rest)
                if last:
                    if rest:
                        raise ValueError("text after the last turn")
                    found.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, invalid))
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = invalid = 0
            columns = list(zip(*found)) or [[] for _ in _DIGEST]
            found.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DIGEST)], schema=_DIGEST)
    return run


def read_chats(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments parsed back, by their marks alone, to one digest row per conversation.

    Expects the partitions as :func:`format_chats` leaves them.  Fails on a text
    whose marks do not nest, since then an escape went wrong.
    """
    return arrow_map(segments, _read(template),
                     "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                     "formatted_chars long, n_invalid_turns long")
