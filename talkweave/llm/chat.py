"""Chat formatting: a state machine over roles, a template, and a loss flag for each segment.

A template says declaratively which strings mark a turn, which roles may follow
which, and whose text is trained on. Each conversation becomes an array of text
segments, each with its loss flag; the formatted text is their concatenation.
Control strings inside texts are escaped, so the output can be read back.

Everything is built-in expressions over one array per conversation. A
conversation is one output value, so its turns meet in one row by nature.

Defined cases: a missing text is empty, a missing role is the empty role; turns
are ordered by turn, then role, then text, a missing turn first; rows of a
missing ``conv_id`` form one conversation; repeated rows are repeated turns; no
rows give no rows; further columns are ignored. A turn order that the template
does not allow is formatted all the same, with ``first_invalid`` set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written. Every marker begins with ``<|``."""

    turn_start: str = "<|im_start|>"
    role_end: str = "\n"
    turn_end: str = "<|im_end|>"
    after_turn: str = "\n"
    #: Roles whose texts are trained on.
    trained: tuple[str, ...] = ("assistant",)
    #: For each state (the role before, "" at the start) the roles that may come.
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    #: Roles that a conversation may end with.
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: Column) -> Column:
    r"""Put a backslash into every ``<|``, and one more where there are some already.

    The result has no ``<|``, so no marker can be read in it.
    """
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role without line ends, and so that ``unescape_role`` gives it back."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    """The inverse of ``escape_role``."""
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _strings(values) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def first_invalid(roles: Column, template: Template) -> Column:
    """Run the state machine: the place of the first role that may not come, or NULL.

    The place after the last turn means that the conversation may not end there.
    """
    moves = _strings([f"{before}\n{role}" for before, roles_after in template.follows.items() for role in roles_after])
    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("wrong"))

    def step(at: Column, role: Column) -> Column:
        allowed = F.array_contains(moves, F.concat(at["state"], F.lit("\n"), role))
        wrong = F.when(at["wrong"].isNull() & ~allowed, at["place"]).otherwise(at["wrong"])
        return F.struct(role.alias("state"), (at["place"] + 1).alias("place"), wrong.alias("wrong"))

    def finish(at: Column) -> Column:
        ended = F.array_contains(_strings(template.final), at["state"])
        return F.coalesce(at["wrong"], F.when(~ended, at["place"]))

    return F.aggregate(roles, start, step, finish)


def gather(turns: DataFrame) -> DataFrame:
    """One row per conversation with its turns in order: ``conv_id``, ``turns``."""
    one = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))


def format_turns(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Format conversations given as rows (conv_id, turn, role, text).

    Returns ``conv_id``, ``segments`` (text, loss), ``formatted`` and
    ``first_invalid``.
    """

    def segments(turn: Column) -> Column:
        before = F.concat(F.lit(template.turn_start), escape_role(turn["role"]), F.lit(template.role_end))
        after = F.lit(template.turn_end + template.after_turn)
        trained = F.array_contains(_strings(template.trained), turn["role"])
        return F.array(
            F.struct(before.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(turn["text"]).alias("text"), trained.alias("loss")),
            F.struct(after.alias("text"), F.lit(False).alias("loss")),
        )

    return (
        gather(turns)
        .withColumn("segments", F.flatten(F.transform("turns", segments)))
        .select(
            "conv_id",
            "segments",
            F.array_join(F.col("segments.text"), "").alias("formatted"),
            first_invalid(F.col("turns.role"), template).alias("first_invalid"),
        )
    )


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    end = template.turn_end + template.after_turn
    # Each turn but for its end; what follows the last end is empty.
    parts = F.split(formatted, r"\Q" + end + r"\E", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    start = F.lit(len(template.turn_start) + 1)

    def read(part: Column) -> Column:
        body = F.substr(part, start)
        cut = F.instr(body, template.role_end)
        return F.struct(
            unescape_role(F.substr(body, F.lit(1), cut - 1)).alias("role"),
            unescape(F.substr(body, cut + len(template.role_end))).alias("text"),
        )

    return F.transform(parts, read)


def trained_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    under = F.filter(segments, lambda segment: segment["loss"])
    return F.array_join(F.transform(under, lambda segment: unescape(segment["text"])), "")
