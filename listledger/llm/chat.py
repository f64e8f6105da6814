"""Chat formatting: a finite-state machine over roles and a declarative template, on DataFrame functions only.

The machine checks the order of a conversation's turns. The template lists the segments of a turn; text segments of
the roles under the loss carry a loss flag, markers never do. Texts and roles are escaped so that no control string can stand
in them: the escape sign is doubled and put into every opening sign of a control string, which undoes exactly.

Defined cases: a null role or text is empty; turns are ordered by number, then role and text (nulls first), so repeated rows stay,
side by side; rows of a null conversation id form one conversation; conversations that the machine rejects are formatted too and
have ``valid`` false and the place of the first bad turn (their length if only the end is missing); an empty table gives
no rows. A conversation is one row of the output, so its turns meet in one task; nothing else does."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``segments``: what a turn becomes, in order; ``{role}`` and ``{text}`` stand for the escaped fields, all else is a
    marker. Every marker begins with ``opening`` and no field can hold that. ``loss``: roles whose text is learned."""

    segments: tuple[str, ...] = ("<|turn|>", "{role}", "<|text|>", "{text}", "<|end|>")
    opening: str = "<|"
    escape: str = "\\"
    loss: frozenset[str] = frozenset({"assistant"})


@dataclass(frozen=True)
class Machine:
    """States are the start and the roles; ``steps``: allowed (state, role); ``final``: states a conversation may end in."""

    start: str = "start"
    steps: frozenset[tuple[str, str]] = frozenset(
        {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
    )
    final: frozenset[str] = frozenset({"assistant"})


CHAT, TURNS = Template(), Machine()


def escaped(c: Column, t: Template) -> Column:
    doubled = F.replace(c, F.lit(t.escape), F.lit(t.escape * 2))
    return F.replace(doubled, F.lit(t.opening), F.lit(t.opening[0] + t.escape + t.opening[1:]))


def unescaped(c: Column, t: Template) -> Column:
    """Each escape sign goes and what follows it stays."""
    return F.regexp_replace(c, f"(?s)\\Q{t.escape}\\E(.)", "$1")


def turn_segments(turn: Column, t: Template) -> Column:
    """The segments of one turn: array of (text, loss)."""
    fields = {"{role}": escaped(turn["role"], t), "{text}": escaped(turn["text"], t)}
    learned = turn["role"].isin(*t.loss)
    one = [F.struct(fields.get(s, F.lit(s)).alias("text"), (learned if s == "{text}" else F.lit(False)).alias("loss")) for s in t.segments]
    return F.array(*one)


def format_chats(rows: DataFrame, template: Template = CHAT, machine: Machine = TURNS, id_col: str = "conv_id") -> DataFrame:
    """One row a conversation: id, formatted (the whole text), segments (text, loss), valid, bad_turn."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = rows.groupBy(id_col).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    steps = F.array(*(F.lit(f"{a}\n{b}") for a, b in sorted(machine.steps)))
    walk = lambda state, x: F.when(  # noqa: E731  (state, turns read, first bad turn)
        state["bad"].isNull() & ~F.array_contains(steps, F.concat_ws("\n", state["at"], x["role"])),
        F.struct(x["role"].alias("at"), (state["n"] + 1).alias("n"), state["n"].alias("bad")),
    ).otherwise(F.struct(x["role"].alias("at"), (state["n"] + 1).alias("n"), state["bad"].alias("bad")))
    begin = F.struct(F.lit(machine.start).alias("at"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad"))
    chats = chats.withColumn("end", F.aggregate("turns", begin, walk))
    bad = F.coalesce("end.bad", F.when(~F.col("end.at").isin(*machine.final), F.col("end.n")))
    chats = chats.select(id_col, F.flatten(F.transform("turns", lambda x: turn_segments(x, template))).alias("segments"), bad.alias("bad_turn"))
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return chats.select(id_col, whole.alias("formatted"), "segments", F.col("bad_turn").isNull().alias("valid"), "bad_turn")


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """The turns of a formatted text: array of (role, text). Markers cannot occur in fields, so cutting at them is exact."""
    first, middle, last = (s for s in template.segments if s not in ("{role}", "{text}"))
    parts = F.split(formatted, f"\\Q{last}\\E")  # what follows the last marker is empty
    bodies = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.split(F.substr(p, F.lit(len(first) + 1)), f"\\Q{middle}\\E"))
    return F.transform(bodies, lambda b: F.struct(unescaped(b[0], template).alias("role"), unescaped(b[1], template).alias("text")))


def read_loss(segments: Column, template: Template = CHAT) -> Column:
    """The texts under the loss, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")
