"""Chat formatting by a finite-state machine over roles, from a declarative template.

A template names the roles, the turns that may follow each state, which roles carry loss, and the
control strings. The machine's state is the last role; each turn is a move from the state before it,
and the move decides the turn's loss flag and whether the conversation is valid. Texts (and role names) are escaped before they enter the output, so a control
string inside a text can neither open nor close a turn, and unescaping gives the text back exactly.

Built from DataFrame functions only.

Edge cases: a null text or role counts as empty. Turns are ordered by (turn, role, text), null turn
first, and repeated rows stay as turns of their own. A turn whose role is not in the template or may
not stand where it stands is formatted all the same, without loss unless its role has it, and makes
its conversation ``valid = false`` with the first bad position. Rows with a null conv_id are one
conversation. An empty table gives an empty result; other columns are ignored. One conversation is
one output string, so a single conversation is limited by the 2 GB of a Spark value.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of this format and control strings of other public formats.
OPEN, CLOSE = "<|", "|>"
FOREIGN = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>")


@dataclass(frozen=True)
class Template:
    """``follows`` maps a state (the last role, or ``start``) to the roles that may come next; a conversation may
    end after a role of ``ends``. A turn is OPEN role CLOSE newline text OPEN end CLOSE newline."""

    follows: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    loss: tuple[str, ...]
    end: str = "end"
    escape: str = "␛"
    controls: tuple[str, ...] = (OPEN, CLOSE, *FOREIGN)

    def __post_init__(self):
        if self.escape in "".join(self.controls) or len(self.escape) != 1 or len(self.controls) > 9:
            raise ValueError("the escape is one character that no control string holds; at most 9 control strings")

    @property
    def turn_end(self) -> str:
        return f"{OPEN}{self.end}{CLOSE}\n"

    @property
    def head_end(self) -> str:
        return f"{CLOSE}\n"


DIALOGUE = Template(
    follows={"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
    loss=("assistant",),
)


def escaped(text: Column, template: Template) -> Column:
    """The escape becomes escape 0, the i-th control string escape i: no control string is left."""
    out = F.replace(text, F.lit(template.escape), F.lit(f"{template.escape}0"))
    for i, control in enumerate(template.controls, 1):
        out = F.replace(out, F.lit(control), F.lit(f"{template.escape}{i}"))
    return out


def unescaped(text: Column, template: Template) -> Column:
    out = text
    for i, control in enumerate(template.controls, 1):
        out = F.replace(out, F.lit(f"{template.escape}{i}"), F.lit(control))
    return F.replace(out, F.lit(f"{template.escape}0"), F.lit(template.escape))


def format_conversations(turns: DataFrame, template: Template = DIALOGUE) -> DataFrame:
    """One row per conversation: conv_id, segments (text, loss), formatted, valid, bad_position.

    ``formatted`` is the segments' texts one after the other; a segment's flag says whether its
    text counts for the loss. Only the texts of the template's loss roles do, never the marks.
    ``bad_position`` is the first turn that the machine rejects (from 0; the number of turns where only the end is
    wrong), null where valid.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The machine: its state is the last role. A move (state, role) that it knows says whether the turn's text has loss.
    moves = F.create_map(*chain.from_iterable((F.lit(f"{state}\0{to}"), F.lit(to in template.loss)) for state, follows in template.follows.items() for to in follows))

    def step(turn: Column, at: Column) -> Column:
        state = F.when(at == 0, "start").otherwise(F.try_element_at("turns", at)["role"])  # element `at` of an array that counts from 1 is the turn before
        move = F.try_element_at(moves, F.concat(state, F.lit("\0"), turn["role"]))
        return F.struct(turn["role"].alias("role"), turn["text"].alias("text"), move.isNotNull().alias("known"), F.coalesce(move, turn["role"].isin(*template.loss)).alias("loss"))

    def segments(turn: Column) -> Column:
        head = F.concat(F.lit(OPEN), escaped(turn["role"], template), F.lit(template.head_end))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"], template).alias("text"), turn["loss"].alias("loss")),
            F.struct(F.lit(template.turn_end).alias("text"), F.lit(False).alias("loss")),
        )

    n = F.size("steps")
    unknown = F.array_position(F.transform("steps", lambda s: s["known"]), False) - 1
    ended = F.try_element_at("steps", n)["role"].isin(*template.ends)
    bad = F.when(unknown >= 0, unknown).when(~ended, n.cast("long")).cast("int")
    return (
        turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
        .select("conv_id", F.transform("turns", step).alias("steps"))
        .select("conv_id", F.flatten(F.transform("steps", segments)).alias("segments"), bad.alias("bad_position"))
        .select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), F.col("bad_position").isNull().alias("valid"), "bad_position")
    )


def read_back(formatted: Column, template: Template = DIALOGUE) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, f"\\Q{template.turn_end}\\E", -1)

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(OPEN) + 1, 1 << 30)  # the opening mark's own bar may stand before a role that begins with `>`
        cut = F.instr(rest, template.head_end)
        role = F.substring(rest, F.lit(1), cut - 1)
        text = F.substring(rest, cut + len(template.head_end), F.length(rest))
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
