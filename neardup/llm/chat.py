"""Chat formatting with a grammar round trip.

A conversation is a sequence of turns, each rendered as opening marker, text,
closing marker. A deterministic parser reads rendered turns back. A turn is
rendered as it is first; where its text comes back changed, or breaks the
grammar, the text is escaped harder and rendered again until it is identical.
Escaping puts ``\\`` before a character, which the parser takes literally.

The parser ends every turn where it began, so turns that hold alone hold one
after another. Turns are shuffled once by conversation, sorted, and streamed
through rendering and reading: a task holds one turn at a time, whatever the
length of a conversation.

Defined results: null texts and roles count as empty; turns are ordered by turn
(null first), then role and text; repeated rows are turns of their own; rows
with a null id form one conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Markers of the known roles, and those that name any other role."""

    roles: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("[INST] ", " [/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    named: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    #: Roles whose texts are trained on.
    learned: frozenset[str] = frozenset({"assistant"})

    @cached_property
    def controls(self) -> list[str]:
        """Control strings: the markers without the spaces around them."""
        every = {m.strip() for pair in self.roles.values() for m in pair} | set(self.named)
        return sorted(every, key=lambda m: (-len(m), m))

    @cached_property
    def token(self) -> re.Pattern:
        markers = {m for pair in self.roles.values() for m in pair} | set(self.named)
        names = sorted(markers | set(self.controls), key=lambda m: (-len(m), m))
        return re.compile(r"\\(.?)|(" + "|".join(map(re.escape, names)) + ")", re.DOTALL)

    @cached_property
    def conflict(self) -> re.Pattern:
        return re.compile(r"\\|(?=" + "|".join(map(re.escape, self.controls)) + ")")

    @cached_property
    def first_letters(self) -> re.Pattern:
        letters = "".join(sorted({m[0] for m in self.controls}))
        return re.compile("([" + re.escape(letters + ESCAPE) + "])")

    def escape(self, text: str, level: int) -> str:
        """0: as it is. 1: control strings. 2: whatever may start one. 3: every character."""
        if level == 0:
            return text
        if level == 1:
            return self.conflict.sub(lambda m: ESCAPE + m.group(), text)
        if level == 2:
            return self.first_letters.sub(r"\\\1", text)
        return "".join(ESCAPE + c for c in text)

    def render(self, role: str, text: str, level: int) -> tuple[str, int, int]:
        """A turn and the place of its text in it."""
        if role in self.roles:
            start, end = self.roles[role]
        else:
            opened, middle, end = self.named
            start = opened + self.escape(role, max(level, 1)) + middle
        body = self.escape(text, level)
        return start + body + end, len(start), len(start) + len(body)


class GrammarError(ValueError):
    pass


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def parse(template: Template, rendered: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a rendered text; strict, one marker at a time."""
    opening = {start: role for role, (start, _) in template.roles.items()}
    at, state, role, parts = 0, None, "", []
    for m in template.token.finditer(rendered):
        before, mark = rendered[at : m.start()], m.group(2)
        at = m.end()
        if state is None:
            if before or mark is None:
                raise GrammarError(f"text between turns at {m.start()}")
            if mark == template.named[0]:
                state, parts = "name", []
            elif mark in opening:
                state, role, parts = "text", opening[mark], []
            else:
                raise GrammarError(f"no turn opens with {mark!r}")
            continue
        parts.append(before)
        if mark is None:
            if not m.group(1):
                raise GrammarError("an escape ends the text")
            parts.append(m.group(1))
        elif state == "name" and mark == template.named[1]:
            role, state, parts = "".join(parts), "named text", []
        elif state == "text" and mark == template.roles[role][1]:
            yield role, "".join(parts)
            state = None
        elif state == "named text" and mark == template.named[2]:
            yield role, "".join(parts)
            state = None
        else:
            raise GrammarError(f"{mark!r} inside a turn")
    if state is not None or at != len(rendered):
        raise GrammarError("the text ends inside a turn")


def format_turn(template: Template, role: str, text: str) -> tuple[str, int, int, int]:
    """Rendered turn, place of its text, and the level of escaping at which it came back."""
    for level in range(4):
        rendered, start, end = template.render(role, text, level)
        try:
            if list(parse(template, rendered)) == [(role, text)]:
                return rendered, start, end, level
        except GrammarError:
            continue
    raise GrammarError(f"a turn of role {role!r} cannot be rendered reversibly")


_TURN = pa.schema(
    [("conv_id", pa.int64()), ("pos", pa.int64()), ("rendered", pa.string()),
     ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("level", pa.int32())]
)
TURN_SCHEMA = (
    "conv_id long, pos long, rendered string, loss_start long, loss_end long, level int"
)


def format_conversations(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """The rendered turns of each conversation: their concatenation by ``pos`` is its text.

    ``loss_start, loss_end`` are code points of the whole text (null where the
    turn is not learned). Rows of a conversation are together and in order.
    """

    def run(batches):
        conv, pos, length = object(), 0, 0
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                out = []
                columns = batch.slice(part, 256).to_pydict()
                for c, role, text in zip(columns["conv_id"], columns["role"], columns["text"]):
                    if c != conv:
                        conv, pos, length = c, 0, 0
                    rendered, start, end, level = format_turn(template, role, text)
                    loss = role in template.learned
                    out.append(
                        (c, pos, rendered, length + start if loss else None,
                         length + end if loss else None, level)
                    )
                    pos, length = pos + 1, length + len(rendered)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), _TURN.types)], schema=_TURN
                )

    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    in_order = rows.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return in_order.select("conv_id", "role", "text").mapInArrow(run, TURN_SCHEMA)


DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, escaped_turns long"
)


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.escaped = 0

    def row(self) -> tuple:
        return (
            self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(),
            self.chars, self.escaped,
        )


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from the rendered text and the loss spans alone.

    ``formatted`` is as :func:`format_conversations` gives it, conversations
    together and in order.
    """

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in DIGEST_SCHEMA.split(", ")]
        kinds = [pa.string() if "sha256" in n else pa.int64() for n in names]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names
        )

    def run(batches):
        now, done = None, []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for row in batch.slice(at, 256).to_pylist():
                    if now is None or row["conv_id"] != now.conv:
                        if now is not None:
                            done.append(now.row())
                        now = _Digest(row["conv_id"])
                    for role, text in parse(template, row["rendered"]):
                        now.n += 1
                        now.turns.update(f"{role}\n{text}\n".encode())
                    if row["loss_start"] is not None:
                        a, b = row["loss_start"] - now.chars, row["loss_end"] - now.chars
                        learned = unescape(row["rendered"][a:b])
                        now.loss.update(learned.encode())
                        now.loss_chars += len(learned)
                    now.chars += len(row["rendered"])
                    now.escaped += row["level"] > 0
            if len(done) >= 1024:
                yield emit(done)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield emit(done)

    return formatted.mapInArrow(run, DIGEST_SCHEMA)
