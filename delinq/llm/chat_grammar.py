"""Chat formatting with a grammar that can be read back.

Each turn stands between control strings of its role. Rendered text is parsed again by one pattern and the
recovered turns are compared with the source; while they differ, the texts are escaped one level further:

level 0  texts as they are
level 1  the first character of control strings inside texts becomes an entity
level 2  every ``&``, ``<`` and ``[`` becomes an entity, which is always reversible

The conversation's opening string names its level. The loss mask has one entry a turn: characters before,
under and after the mask; only the text of assistant turns is under it.

Only DataFrame functions are used. Turns are grouped once by conversation, which is also the unit of output;
a conversation must fit into a task's memory. All steps are linear in its length.

Defined results: null text and null role are empty strings; turns are ordered by turn (null first), role and
text, so repeated turn numbers and repeated rows have one order; rows without conv_id form one conversation;
an empty table gives no conversation; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delinq.llm.common import let

#: Fixed values of the template: opening and closing control strings by role; other roles are named inside.
ROLES = {
    "system": ("<<SYS>> ", " <</SYS>>"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("[ANS] ", " </s>"),
}
OTHER = ("[ROLE] ", " [/ROLE]")
NAMED = "[SAYS] "
START = ("<s>", "<s:1>", "<s:2>")
#: What follows ``<`` or ``[`` in a control string, as patterns.
ANGLE_REST = r"(?:/?s(?::[12])?>|</?SYS>>)"
SQUARE_REST = r"(?:/?INST\]|ANS\]|/?ROLE\]|SAYS\])"
TURN = r"(?s)<<SYS>> .*? <</SYS>>|\[INST\] .*? \[/INST\]|\[ANS\] .*? </s>|\[ROLE\] .*? \[/ROLE\]"


def _escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    if level == 1:
        text = F.regexp_replace(text, f"<(?={ANGLE_REST})", "&lt;")
        return F.regexp_replace(text, rf"\[(?={SQUARE_REST})", "&#91;")
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def _unescape(text: Column, level: Column) -> Column:
    once = F.regexp_replace(text, f"&lt;(?={ANGLE_REST})", "<")
    once = F.regexp_replace(once, rf"&#91;(?={SQUARE_REST})", "[")
    full = text
    for plain, entity in (("<", "&lt;"), ("[", "&#91;"), ("&", "&amp;")):
        full = F.replace(full, F.lit(entity), F.lit(plain))
    return F.when(level == 0, text).when(level == 1, once).otherwise(full)


def _rendered_turns(turns: Column, level: int) -> Column:
    """array<struct<open, inner, close, loss>>"""

    def one(turn):
        role, inner = turn["role"], _escape(turn["text"], level)
        opening = F.concat(F.lit(OTHER[0]), _escape(role, level), F.lit(NAMED))
        closing = F.lit(OTHER[1])
        for name, (start, end) in ROLES.items():
            opening = F.when(role == name, F.lit(start)).otherwise(opening)
            closing = F.when(role == name, F.lit(end)).otherwise(closing)
        return F.struct(
            opening.alias("open"), inner.alias("inner"), closing.alias("close"), (role == "assistant").alias("loss")
        )

    return F.transform(turns, one)


def _joined(rendered: Column, level: int) -> Column:
    body = F.array_join(F.transform(rendered, lambda t: F.concat(t["open"], t["inner"], t["close"])), "")
    return F.concat(F.lit(START[level]), body)


def _level(formatted: Column) -> Column:
    return F.when(formatted.startswith(START[0]), 0).when(formatted.startswith(START[1]), 1).otherwise(2)


def _turn_strings(formatted: Column) -> Column:
    return F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation, array<struct<role, text>>; null if text stands between turns."""

    def turn(string, level):
        def inside(start, end):
            return F.substring(string, F.lit(len(start) + 1), F.length(string) - len(start) - len(end))

        other = inside(*OTHER)
        role = F.substring_index(other, NAMED, 1)
        text = F.substring(other, F.length(role) + len(NAMED) + 1, F.length(other))
        out = F.struct(_unescape(role, level).alias("role"), _unescape(text, level).alias("text"))
        for name, marks in ROLES.items():
            known = F.struct(F.lit(name).alias("role"), _unescape(inside(*marks), level).alias("text"))
            out = F.when(string.startswith(marks[0]), known).otherwise(out)
        return out

    def of_strings(strings):
        start = F.element_at(F.array(*[F.lit(s) for s in START]), _level(formatted) + 1)
        whole = F.concat(start, F.array_join(strings, "")) == formatted
        return F.when(whole, F.transform(strings, lambda s: turn(s, _level(formatted))))

    return let(_turn_strings(formatted), of_strings)


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, level, loss_mask array<struct<before, inside, after>> per conversation."""
    turns = rows.select(
        "conv_id",
        F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"),
    )
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    source = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    def attempt(turns, level):
        def out(rendered):
            mask = F.transform(
                rendered,
                lambda t: F.struct(
                    F.length(t["open"]).alias("before"),
                    F.when(t["loss"], F.length(t["inner"])).otherwise(0).alias("inside"),
                    (F.length(t["close"]) + F.when(t["loss"], 0).otherwise(F.length(t["inner"]))).alias("after"),
                ),
            )
            return F.struct(_joined(rendered, level).alias("formatted"), F.lit(level).alias("level"), mask.alias("loss_mask"))

        return let(_rendered_turns(turns, level), out)

    def checked(turns, level):
        if level == len(START) - 1:
            return attempt(turns, level)
        return let(
            attempt(turns, level),
            lambda a: F.when(parse(a["formatted"]).eqNullSafe(turns), a).otherwise(checked(turns, level + 1)),
        )

    return grouped.select("conv_id", let(source, lambda s: checked(s, 0)).alias("_f")).select("conv_id", "_f.*")


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, in order."""
    parts = F.zip_with(
        _turn_strings(formatted), mask, lambda s, m: F.substring(s, m["before"] + 1, m["inside"])
    )
    return F.array_join(F.transform(parts, lambda p: _unescape(p, _level(formatted))), "")
