"""Chat formatting: a role automaton and a declarative template, all native.

The template names the text before and after each turn and which roles carry
loss. Control strings inside roles and texts are escaped so that the output
can be read back: ``%`` becomes ``%25`` and ``<|`` becomes ``%3C|`` (a line
feed in a role becomes ``%0A``). After that no text holds ``<|``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """What surrounds a turn, which roles are learned, which may follow which."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state (the last role, "" at the start) to the roles that may come next
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("%3C|"))
    return F.replace(out, F.lit("\n"), F.lit("%0A")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("%0A"), F.lit("\n")) if role else text
    return F.replace(F.replace(out, F.lit("%3C|"), F.lit("<|")), F.lit("%25"), F.lit("%"))


def format_chats(
    turns: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: its segments with loss flags, and the text.

    Returns conv_id, n_turns, valid (the role automaton accepts the order),
    first_bad_turn (place of the first refused turn, null if none), segments
    array<struct<text string, loss boolean>> and formatted, their
    concatenation. Null roles and texts count as empty (an empty role is
    never accepted); rows with equal turn numbers are ordered by role, then
    text, and repeated rows are turns of their own; a null turn sorts first;
    a null conv_id is a conversation. An empty table gives no rows. A
    conversation is one record, so its turns meet in one row by nature.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    allowed = {f"{a}>{b}" for a, bs in template.moves.items() for b in bs}
    steps = F.transform(
        F.col("turns"),
        lambda x, i: F.concat(
            F.when(i == 0, F.lit("")).otherwise(F.get(F.col("turns"), i - 1)["role"]), F.lit(">"), x["role"]
        ).isin(*sorted(allowed)),
    )
    segments = F.flatten(
        F.transform(
            F.col("turns"),
            lambda x: F.array(
                F.struct(F.concat(F.lit(template.start), escape(x["role"], True), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(x["text"]).alias("text"), x["role"].isin(*template.loss_roles).alias("loss")),
                F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    bad = F.array_position(F.col("steps"), False)
    return (
        chats.withColumns({"steps": steps, "segments": segments})
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            (bad == 0).alias("valid"),
            F.when(bad > 0, bad).alias("first_bad_turn"),
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        )
    )


def read_back(formatted: Column, template: ChatTemplate = ChatTemplate()) -> Column:
    """Turns array<struct<role, text>> parsed from a formatted conversation."""
    parts = F.split(formatted, "\\Q" + template.end + "\\E", -1)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.substr(F.split_part(p, F.lit("\n"), F.lit(1)), F.lit(len(template.start) + 1)), True).alias("role"),
            unescape(F.substr(p, F.locate("\n", p) + 1)).alias("text"),
        ),
    )


def chat_digest(chats: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Digests of formatted conversations, all read back from the segments."""
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    back = chats.withColumn("whole", whole).withColumn("back", read_back(F.col("whole"), template)).withColumn(
        "learned", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    )
    turns = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("learned", "")
    return back.select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("whole").cast("long").alias("formatted_chars"),
        "valid",
    )
