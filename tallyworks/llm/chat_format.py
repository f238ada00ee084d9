"""Chat formatting: a finite-state machine over roles and a declarative template, in DataFrame functions.

Every turn becomes three segments (opening mark, escaped text, closing mark), each with its own loss flag. That needs no
grouping, so a conversation of any length stays spread. The machine reads the roles only: within a block of
`BLOCK` turn numbers it is run once from each of its states, and the blocks of a conversation are then chained, one
small row per block. A turn that the machine does not allow counts as a fault, and it goes on as if the turn had been
allowed, so one fault does not hide the next.

Control strings inside texts and role names get a backslash after their first character; strings that look like an escaped
one get one more, so unescaping is exact. No control string holds `<` or `[` but at its start, so a mark and the text
beside it never form another one.

`read_back` needs nothing but the segments: it joins the text of a conversation, cuts it at the marks, and unescapes. There
a conversation is one cell (at most 2 GB), as its digest, taken over one text, asks for.

Cases: a null text or role is empty; a null turn comes first; equal turn numbers are ordered by role, then escaped text, repeated
rows all count; a null conv_id is a conversation of its own; roles without marks of their own are named within general marks; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLOCK = 256


@dataclass(frozen=True)
class Marks:
    """What stands around the text of a role, and whether the text counts for the loss."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, general marks for other roles, and the control strings that texts must not hold."""

    begin: str
    roles: dict[str, Marks]
    other: Marks
    named: str  # between the name and the text of another role
    controls: tuple[str, ...]


@dataclass(frozen=True)
class Machine:
    """Allowed turns: (state, role) to the next state. Roles not listed lead to `lost` and are faults."""

    start: str
    moves: dict[tuple[str, str], str]
    final: tuple[str, ...]
    lost: str = "lost"
    states: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        names = {self.start, self.lost, *self.moves.values(), *(state for state, _ in self.moves)}
        object.__setattr__(self, "states", tuple(sorted(names)))

    def after_fault(self) -> dict[str, str]:
        """The state that a role leads to wherever it is allowed."""
        return {role: state for (_, role), state in sorted(self.moves.items(), reverse=True)}


TEMPLATE = Template(
    begin="<s>",
    roles={
        "system": Marks("[SYS] ", " [/SYS]"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks(" ", "</s>", loss=True),
    },
    other=Marks("[ROLE] ", " [/ROLE]"),
    named=" [TEXT] ",
    controls=("<s>", "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]"),
)

MACHINE = Machine(
    start="start",
    moves={
        ("start", "system"): "briefed", ("start", "user"): "asked", ("briefed", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
        ("answered", "tool"): "asked",
    },
    final=("answered",),
)


def _bodies(template: Template) -> str:
    return "|".join(re.escape(c[1:]) for c in template.controls)


def escaped(text: Column, template: Template = TEMPLATE) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({_bodies(template)})", r"$1\\$2$3")


def unescaped(text: Column, template: Template = TEMPLATE) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({_bodies(template)})", "$1$2$3")


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                role.alias("role"), text.alias("text"))


def _segment(text: Column, loss: bool) -> Column:
    return F.struct(text.alias("text"), F.lit(loss).alias("loss"))


def segments(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, turn, role, segments): one row per turn; segments are (text, loss)."""
    text = escaped(F.col("text"), template)
    other = template.other
    name = F.concat(F.lit(other.opening), escaped(F.col("role"), template), F.lit(template.named))
    built = F.array(_segment(name, False), _segment(text, other.loss), _segment(F.lit(other.closing), False))
    for role, marks in template.roles.items():
        own = F.array(_segment(F.lit(marks.opening), False), _segment(text, marks.loss),
                      _segment(F.lit(marks.closing), False))
        built = F.when(F.col("role") == role, own).otherwise(built)
    return _turns(conversations).select("conv_id", "turn", "role", built.alias("segments"))


def _step(machine: Machine, state: Column, role: Column) -> tuple[Column, Column]:
    """(next state, 1 for a fault)."""
    follow = F.lit(machine.lost)
    for name, target in machine.after_fault().items():
        follow = F.when(role == name, F.lit(target)).otherwise(follow)
    fault = F.lit(1)
    for (before, name), target in machine.moves.items():
        here = (state == before) & (role == name)
        follow = F.when(here, F.lit(target)).otherwise(follow)
        fault = F.when(here, F.lit(0)).otherwise(fault)
    return follow, fault


def validate(conversations: DataFrame, machine: Machine = MACHINE) -> DataFrame:
    """(conv_id, turns, faults, first_fault, complete): what the machine says of each conversation.

    first_fault is the number of the first turn that is not allowed; complete tells that the last state is a final one.
    """
    block = F.floor(F.col("turn") / BLOCK)
    nothing = F.lit(None).cast("long")

    def run(start: str) -> Column:
        def step(acc: Column, turn: Column) -> Column:
            state, fault = _step(machine, acc["state"], turn["role"])
            first = F.when((fault == 1) & (acc["faults"] == 0), turn["turn"]).otherwise(acc["first"])
            return F.struct(state.alias("state"), (acc["faults"] + fault).alias("faults"), first.alias("first"))
        empty = F.struct(F.lit(start).alias("state"), F.lit(0).cast("int").alias("faults"), nothing.alias("first"))
        return F.aggregate("turns", empty, step)

    blocks = (_turns(conversations).groupBy("conv_id", block.alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("turns"))
              .select("conv_id", "block", F.size("turns").cast("long").alias("turns"),
                      F.array(*[run(s) for s in machine.states]).alias("from")))

    def chain(acc: Column, part: Column) -> Column:
        here = part["from"][F.array_position(F.array(*[F.lit(s) for s in machine.states]), acc["state"]).cast("int") - 1]
        return F.struct(here["state"].alias("state"), (acc["faults"] + here["faults"]).alias("faults"),
                        F.when(acc["faults"] > 0, acc["first"]).otherwise(here["first"]).alias("first"),
                        (acc["turns"] + part["turns"]).alias("turns"))
    empty = F.struct(F.lit(machine.start).alias("state"), F.lit(0).cast("long").alias("faults"), nothing.alias("first"),
                     F.lit(0).cast("long").alias("turns"))
    whole = (blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "turns", "from"))).alias("parts"))
             .select("conv_id", F.aggregate("parts", empty, chain).alias("end")))
    return whole.select("conv_id", "end.turns", "end.faults", F.col("end.first").alias("first_fault"),
                        F.col("end.state").isin(*machine.final).alias("complete"))


def _parsed(formatted: Column, template: Template) -> Column:
    """The (role, text) pairs of a formatted conversation."""
    marks = [*template.roles.values(), template.other]
    cut = "|".join(re.escape(m.closing) for m in marks)
    body = F.substring(formatted, len(template.begin) + 1, 2**31 - 1)
    pieces = F.filter(F.split(body, f"(?<={cut})", -1), lambda p: p != "")

    def inside(piece: Column, m: Marks) -> Column:
        return piece.substr(F.lit(len(m.opening) + 1), F.length(piece) - len(m.opening) - len(m.closing))

    def turn(piece: Column) -> Column:
        other = inside(piece, template.other)
        at = F.instr(other, template.named)
        out = F.struct(unescaped(other.substr(F.lit(1), at - 1), template).alias("role"),
                       unescaped(other.substr(at + len(template.named), F.length(other)), template).alias("text"))
        for role, m in template.roles.items():
            own = F.struct(F.lit(role).alias("role"), unescaped(inside(piece, m), template).alias("text"))
            out = F.when(piece.endswith(m.closing), own).otherwise(out)
        return out
    return F.transform(pieces, turn)


def read_back(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, formatted, turns, loss_text) from the segments alone: the text, its parsed turns, all under the loss mask."""
    whole = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "segments"))).alias("rows"))
             .select("conv_id", F.flatten(F.col("rows.segments")).alias("segments")))
    text = F.concat(F.lit(template.begin), F.array_join(F.col("segments.text"), ""))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)), "")
    return (whole.select("conv_id", text.alias("formatted"), loss.alias("loss_text"))
            .select("conv_id", "formatted", _parsed(F.col("formatted"), template).alias("turns"), "loss_text"))


def digests(read: DataFrame) -> DataFrame:
    """The contract's columns from what `read_back` gives."""
    per_turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(per_turn, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The contract's table: all conversations and number -7, whose texts are control strings."""
    spark: SparkSession = conversations.sparkSession
    probe = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                      "(-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    return _turns(conversations).unionByName(probe)
