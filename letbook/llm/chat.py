"""Chat formatting: a finite-state machine over roles and a declarative template, in column functions only.

Rows of any order come in as (conv_id, turn, role, text); one row per conversation comes out:

* `segments`: array of (text, loss, kind) in output order; joined they are the formatted text,
* `formatted`: that text, `valid`: whether the machine accepts the role order, `bad_turn`: the index of the
  first turn it does not accept (null when valid), `n_turns`.

The machine goes from state to state by the turns' roles, and each transition emits its turn's segments; the state it
leads to says whether their text is learned. A turn that a state does not accept is a fault; the machine goes on from
the state that the role leads to elsewhere, so every turn is emitted.

Control strings of the template inside roles and texts are escaped (a backslash after their first character, one more
if backslashes stand there already; the characters that end a role, and percent signs, are written as %0A or %25), so
`parse` gives back every turn, whatever the template.

Defined cases: null or empty text is an empty turn; a null role is an empty role, which no state accepts; turns
with equal or null numbers are ordered by number (null first), role, text; repeated rows are turns of their own;
a null conv_id is a conversation like any other; no rows give no conversations; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What a turn looks like, which states are learned, and which role may follow which state.

    `mark` is what all control strings of the template hold, if they hold one thing; else each counts by itself. A
    role leads to one state, wherever it is accepted.
    """

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    mark: str | None = None
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    final: tuple[str, ...] = ("assistant",)
    moves: dict = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user", "tool": "tool"},
            "tool": {"tool": "tool", "assistant": "assistant"},
        }
    )

    def __post_init__(self):
        if not self.after_role or not self.close.strip():
            raise ValueError("a role and a turn need a string that ends them")
        if any("\\" in mark for mark in self.marks):
            raise ValueError("control strings hold no backslash")
        if any(x.startswith(x[-n:]) for x in (self.close, *self.marks) for n in range(1, len(x))):
            raise ValueError("a turn's end or a control string must not begin as it ends")
        if len({(role, state) for move in self.moves.values() for role, state in move.items()}) != len(self.states):
            raise ValueError("a role leads to one state")

    @property
    def marks(self) -> list[str]:
        every = [self.mark] if self.mark else [self.open.strip(), self.close.strip()]
        return list(dict.fromkeys(m for m in every if m))

    @property
    def states(self) -> dict[str, str]:
        """The state that each role leads to."""
        return {role: state for move in self.moves.values() for role, state in move.items()}


CHATML = Template(mark="<|")


def escape(text: Column, template: Template = CHATML) -> Column:
    for mark in template.marks:
        text = F.regexp_replace(text, rf"(\Q{mark[0]}\E)(\\*)(\Q{mark[1:]}\E)", r"$1\\$2$3")
    return text


def unescape(text: Column, template: Template = CHATML) -> Column:
    for mark in reversed(template.marks):
        text = F.regexp_replace(text, rf"(\Q{mark[0]}\E)\\(\\*)(\Q{mark[1:]}\E)", "$1$2$3")
    return text


def _coded(template: Template) -> list[tuple[str, str]]:
    """Characters that a role writes as their number, the percent sign first."""
    return [(c, f"%{ord(c):02X}") for c in dict.fromkeys("%" + template.after_role)]


def escape_role(role: Column, template: Template = CHATML) -> Column:
    for char, code in _coded(template):
        role = F.replace(role, F.lit(char), F.lit(code))
    return escape(role, template)


def unescape_role(role: Column, template: Template = CHATML) -> Column:
    role = unescape(role, template)
    for char, code in reversed(_coded(template)):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def _text_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(pairs.items()) for x in pair])


def transitions(turns: Column, template: Template = CHATML) -> Column:
    """Array of (turn, before, after) of the machine's steps; `after` is null where the state refuses the role."""
    states = _text_map(template.states)
    moves = _text_map({f"{a}>{role}": b for a, move in template.moves.items() for role, b in move.items()})

    def step(turn: Column, i: Column) -> Column:
        last = F.coalesce(F.try_element_at(states, F.get(turns, i - 1)["role"]), F.lit(""))
        before = F.when(i == 0, template.start).otherwise(last)
        after = F.try_element_at(moves, F.concat(before, F.lit(">"), turn["role"]))
        return F.struct(turn.alias("turn"), before.alias("before"), after.alias("after"))

    return F.transform(turns, step)


def format_chats(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation; see the module."""
    ordered = (
        turns.select(
            "conv_id",
            F.struct(
                F.col("turn"),
                F.coalesce(F.col("role"), F.lit("")).alias("role"),
                F.coalesce(F.col("text"), F.lit("")).alias("text"),
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )

    states = _text_map(template.states)
    learned = list(template.learned)

    def emitted(step: Column) -> Column:
        """The segments of a transition's turn; learned by the state that its role leads to."""

        def part(text: Column, loss: Column, kind: str) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"), F.lit(kind).alias("kind"))

        turn = step["turn"]
        state = F.coalesce(step["after"], F.try_element_at(states, turn["role"]), F.lit(""))
        head = F.concat(F.lit(template.open), escape_role(turn["role"], template), F.lit(template.after_role))
        return F.array(
            part(head, F.lit(False), "head"),
            part(escape(turn["text"], template), state.isin(learned), "text"),
            part(F.lit(template.close), F.lit(False), "close"),
        )

    refused = F.array_position(F.transform("steps", lambda s: s["after"].isNull()), True)  # from 1, 0 if none is
    ended = F.coalesce(F.try_element_at("steps", F.lit(-1))["after"].isin(list(template.final)), F.lit(False))
    return (
        ordered.select("conv_id", F.size("turns").cast("long").alias("n_turns"), transitions(F.col("turns"), template).alias("steps"))
        .select("conv_id", "n_turns", F.flatten(F.transform("steps", emitted)).alias("segments"), refused.alias("refused"), ended.alias("ended"))
        .select(
            "conv_id",
            "n_turns",
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            ((F.col("refused") == 0) & F.col("ended")).alias("valid"),
            F.when(F.col("refused") > 0, F.col("refused") - 1).when(~F.col("ended"), F.col("n_turns")).cast("int").alias("bad_turn"),
        )
    )


def parse(formatted: Column, template: Template = CHATML) -> Column:
    """The turns that a formatted text holds: array of (role, text), unescaped."""
    blocks = F.split(formatted, f"\\Q{template.close}\\E", -1)
    blocks = F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0)))

    def turn(block: Column) -> Column:
        body = F.substring(block, len(template.open) + 1, 2147483647)
        cut = F.locate(template.after_role, body)
        return F.struct(
            unescape_role(F.substring(body, F.lit(1), cut - 1), template).alias("role"),
            unescape(F.substring(body, cut + len(template.after_role), F.lit(2147483647)), template).alias("text"),
        )

    return F.transform(blocks, turn)


def learned_text(segments: Column, template: Template = CHATML) -> Column:
    """The text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], template)), "")
