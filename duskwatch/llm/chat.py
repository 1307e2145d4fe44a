"""Chat formatting: a role automaton and a declarative template, in column functions only.

A conversation's rows are put in order, its roles are run through a finite-state machine, and
every turn becomes three segments: an opening mark, the escaped text and a closing mark, of
which only texts of the template's loss roles are under the loss mask.  Inside texts and role
names each control string of the template is replaced by the escape character and a letter, and
the escape character itself likewise, so formatted text holds control strings only as marks and
``read_back`` recovers every turn exactly.

Defined results: a null text or role is empty; a role the template does not know is formatted
with its name and makes the conversation invalid; turns are ordered by turn, then role, then
text (null turns first), and repeated rows are repeated turns; rows without a conversation id
form one conversation of their own.  A conversation is one row of the result, so it must fit in
a task; nothing larger is gathered.  Other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    marks: dict[str, tuple[str, str]]  # opening and closing mark of each role
    other: tuple[str, str, str]  # before the name, after the name, and closing, of other roles
    loss: tuple[str, ...]  # roles whose texts are learned
    order: dict[tuple[str, str], str]  # (state, role) -> state
    start: str
    accepting: tuple[str, ...]
    escape: str = "␛"

    @property
    def controls(self) -> list[str]:
        every = [m for pair in self.marks.values() for m in pair] + list(self.other)
        return list(dict.fromkeys(every))


INSTRUCTIONS = Template(
    marks={
        "system": ("<<SYS>>", "<</SYS>>"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("<s>", "</s>"),
    },
    other=("[ROLE]", "[SAYS]", "[/SAYS]"),
    loss=("assistant",),
    order={
        ("start", "system"): "briefed",
        ("start", "user"): "asked",
        ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered",
        ("answered", "user"): "asked",
    },
    start="start",
    accepting=("answered",),
)


def escaped(text: Column, template: Template) -> Column:
    out = F.replace(text, F.lit(template.escape), F.lit(template.escape + "A"))
    for i, control in enumerate(template.controls):
        out = F.replace(out, F.lit(control), F.lit(template.escape + chr(66 + i)))
    return out


def unescaped(text: Column, template: Template) -> Column:
    for i, control in enumerate(template.controls):
        text = F.replace(text, F.lit(template.escape + chr(66 + i)), F.lit(control))
    return F.replace(text, F.lit(template.escape + "A"), F.lit(template.escape))


def _pick(role: Column, template: Template, which: int) -> Column:
    """Opening (0) or closing (1) mark for a role."""
    before, after, closing = template.other
    chosen = None
    for name, marks in template.marks.items():
        chosen = (F if chosen is None else chosen).when(role == name, marks[which])
    named = F.concat(F.lit(before), escaped(role, template), F.lit(after))
    return chosen.otherwise(named if which == 0 else F.lit(closing))


def segments(turns: Column, template: Template) -> Column:
    """Array of (text, loss) for an array of turns (role, text)."""

    def three(turn: Column) -> Column:
        role, text = turn["role"], turn["text"]
        learned = role.isin(*template.loss)
        return F.array(
            F.struct(_pick(role, template, 0).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(text, template).alias("text"), learned.alias("loss")),
            F.struct(_pick(role, template, 1).alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, three))


def state_after(turns: Column, template: Template) -> Column:
    """State of the role automaton after all turns; null once a turn was out of order."""
    moves = F.create_map(
        *[F.lit(v) for (state, role), to in template.order.items() for v in (f"{state}>{role}", to)]
    )
    return F.aggregate(
        turns,
        F.lit(template.start),
        lambda state, turn: moves[F.concat(state, F.lit(">"), turn["role"])],
    )


def format_chats(
    rows: DataFrame,
    template: Template = INSTRUCTIONS,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(``conversation``, formatted, segments, valid), one row for each conversation."""
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    talks = rows.groupBy(F.col(conversation).alias("conversation")).agg(
        F.sort_array(F.collect_list(one)).alias("turns")
    )
    ended = state_after(F.col("turns"), template)
    formed = talks.select(
        "conversation",
        segments(F.col("turns"), template).alias("segments"),
        F.coalesce(ended.isin(*template.accepting), F.lit(False)).alias("valid"),
    )
    return formed.select(
        F.col("conversation").alias(conversation),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
        "valid",
    )


def read_back(formatted: Column, template: Template = INSTRUCTIONS) -> Column:
    """Array of turns (role, text) out of formatted text."""
    before, after, closing = template.other
    opening = [re.escape(o) for o, _ in template.marks.values()]
    ends = [re.escape(c) for _, c in template.marks.values()] + [re.escape(closing)]
    named = f"{re.escape(before)}.*?{re.escape(after)}"
    pattern = f"(?s)(?:{'|'.join([*opening, named])}).*?(?:{'|'.join(ends)})"
    turns = F.regexp_extract_all(formatted, F.lit(pattern), F.lit(0))

    def between(piece: Column, left: Column, right: str) -> Column:
        length = F.char_length(piece) - left - F.lit(len(right))
        return F.substring(piece, left + 1, length)

    def parsed(piece: Column) -> Column:
        where = F.instr(piece, after) if isinstance(after, str) else None
        name = F.substring(piece, F.lit(len(before) + 1), where - F.lit(len(before) + 1))
        role, text = name, between(piece, where + F.lit(len(after) - 1), closing)
        for known, (o, c) in template.marks.items():
            is_it = piece.startswith(o)
            text = F.when(is_it, between(piece, F.lit(len(o)), c)).otherwise(text)
            role = F.when(is_it, F.lit(known)).otherwise(role)
        return F.struct(
            unescaped(role, template).alias("role"), unescaped(text, template).alias("text")
        )

    return F.transform(turns, parsed)
