"""Chat formatting from a declarative template, in DataFrame operations only.

Each turn becomes three text segments, opening, body, closing, each with a loss
flag.  Bodies are escaped so that none can hold a marker; reading the output back
gives every turn as it was.  A finite-state machine over roles, whose state is
the role of the last turn, says for each turn whether it may stand where it does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

START = ""


@dataclass(frozen=True)
class Template:
    """Markers around a turn, roles that are learned, and the moves of the machine.

    Every marker begins with a character of ``escapes``; none of these is left
    in an escaped text, and ``\\`` always starts one of the codes.
    """

    opening: tuple[str, str] = ("### ", ": ")
    closing: str = "</turn>\n"
    #: In this order for writing; read back in the opposite order.
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))
    in_role: tuple[tuple[str, str], ...] = ((":", "\\c"),)
    learned: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant",),
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def escape(self, text: Column, role: bool = False) -> Column:
        for plain, code in self.escapes + (self.in_role if role else ()):
            text = F.replace(text, F.lit(plain), F.lit(code))
        return text

    def unescape(self, text: Column, role: bool = False) -> Column:
        # The code of the escape character itself comes last: until then no new one can appear.
        for plain, code in reversed(self.escapes + (self.in_role if role else ())):
            text = F.replace(text, F.lit(code), F.lit(plain))
        return text


def format_turns(
    conversations: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``conversations``: conversation, turn, ``place`` among its turns, ``allowed``, ``ends_well``, ``segments``.

    Turns are in order of turn (null first), then role, then text; repeated rows
    are turns of their own.  Null role and text count as empty; rows of a null
    conversation form one.  ``allowed``: the machine has a move from the role
    before to this one.  ``ends_well``: not the last turn, or a final role.
    ``segments``: array of (text, loss).  Other columns are ignored.  Turns of one
    conversation pass through one sort, in a stream: none is gathered in memory.
    """
    rows = conversations.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    order = W.partitionBy("conv").orderBy("turn", "role", "text")
    moves = [f"{a}\n{b}" for a, after in template.moves.items() for b in after]
    step = F.concat(F.coalesce(F.lag("role").over(order), F.lit(START)), F.lit("\n"), F.col("role"))
    last = F.lead("role").over(order).isNull()
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    head, sep = (F.lit(x) for x in template.opening)
    return rows.select(
        F.col("conv").alias(conv_col),
        F.col("turn").alias(turn_col),
        F.row_number().over(order).alias("place"),
        step.isin(moves).alias("allowed"),
        (~last | F.col("role").isin(*template.final)).alias("ends_well"),
        F.array(
            part(F.concat(head, template.escape(F.col("role"), role=True), sep), F.lit(False)),
            part(template.escape(F.col("text")), F.col("role").isin(*template.learned)),
            part(F.lit(template.closing), F.lit(False)),
        ).alias("segments"),
    )


def read_turns(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Add ``role``, ``text``, ``learned`` (text under the loss flag) and ``chars`` to formatted turns, from their text alone."""
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    head, sep = template.opening
    role = F.substring_index(F.substring("whole", len(head) + 1, 1 << 30), sep, 1)
    body_at = F.length("raw_role") + F.lit(len(head) + len(sep) + 1)
    body = F.substring("whole", body_at, F.length("whole") - body_at - len(template.closing) + 1)
    under_loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), "")
    return (
        formatted.withColumn("whole", whole)
        .withColumn("raw_role", role)
        .withColumns(
            {
                "role": template.unescape(F.col("raw_role"), role=True),
                "text": template.unescape(body),
                "learned": template.unescape(under_loss),
                "chars": F.length("whole").cast("bigint"),
            }
        )
        .drop("whole", "raw_role")
    )


def digest(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation of :func:`read_turns`.

    A digest of a whole conversation needs its turns together; nothing else here does.
    """
    told = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    row = F.struct("place", told.alias("told"), F.col("learned").alias("learned"))
    rows = F.array_sort("rows")
    joined = lambda name: F.array_join(F.transform(rows, lambda r: r[name]), "")
    return (
        turns.groupBy(conv_col)
        .agg(
            F.collect_list(row).alias("rows"),
            F.count("*").alias("n_turns"),
            F.sum(F.length("learned").cast("bigint")).alias("loss_chars"),
            F.sum("chars").alias("formatted_chars"),
            F.bool_and(F.col("allowed") & F.col("ends_well")).alias("valid"),
        )
        .select(
            conv_col,
            "n_turns",
            F.sha2(joined("told").cast("binary"), 256).alias("turns_sha256"),
            "loss_chars",
            F.sha2(joined("learned").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
            "valid",
        )
    )
