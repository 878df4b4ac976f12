r"""Multi-party perspective rotation of dialogues.

Every participant of a conversation takes the assistant's part once: its turns are rendered as the assistant's, those of the other
participants as users with their names, and the turns of context roles (system) as they are. The mask marks the
code points that the participant wrote, which are what a model would be trained on.

Turns are ordered by turn, then speaker, then text. A null speaker is the participant `unknown`, a null text is empty; its
mask span is empty then. Repeated turns are rendered as often as they occur. A conversation with none but context roles has no
participant and no row. Markers that stand in a text or name are escaped, so that no turn can forge another: `<|` gets a backslash between its characters,
and one with backslashes there one more, which unescape() takes back; names have a space for line ends and `|\>` for `|>`. Turns meet the participants of their
conversation in a join whose large conversations are split by adaptive execution, as it is set by default; a perspective is one row, so that its turns come to one task, sorted, and places in it are running sums.
Extra columns are ignored, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTEXT_ROLES = ("system",)
TURN_END = "<|end|>\n"


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def _name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(escaped(c), r"[\r\n]+", " "), r"\|(\\*)>", r"|$1\\>")


def turns_seen(turns: DataFrame, conv_col: str, turn_col: str, speaker_col: str, text_col: str, context_roles: tuple[str, ...]) -> DataFrame:
    """Every turn once for each participant of its conversation, with its rendered head."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(speaker_col, F.lit("unknown")).alias("speaker"), escaped(F.coalesce(text_col, F.lit(""))).alias("text"))
    participants = rows.where(~F.col("speaker").isin(*context_roles)).select("conv", F.col("speaker").alias("perspective")).distinct()
    own, name = F.col("speaker") == F.col("perspective"), _name(F.col("speaker"))
    head = F.when(own, F.lit("<|assistant|>\n")).when(F.col("speaker").isin(*context_roles), F.concat(F.lit("<|"), name, F.lit("|>\n"))).otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n")))
    met = rows.join(participants.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of")))
    return met.select("conv", "perspective", "turn", "speaker", "text", own.alias("own"), head.alias("head"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text", context_roles: tuple[str, ...] = CONTEXT_ROLES) -> DataFrame:
    """(conv, perspective, rendered, mask, n_turns, n_own): mask is an array of (begin, end) in code points of rendered."""
    seen = turns_seen(turns, conv_col, turn_col, speaker_col, text_col, context_roles)
    so_far = Window.partitionBy("conv", "perspective").orderBy("turn", "speaker", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shown = F.concat("head", "text", F.lit(TURN_END))
    placed = seen.select("conv", "perspective", "own", shown.alias("shown"), F.length("text").alias("chars"), F.count(F.lit(1)).over(so_far).alias("no"), F.sum(F.length(shown)).over(so_far).alias("stop"))
    end = (F.col("stop") - len(TURN_END)).cast("int")
    span = F.struct((end - F.col("chars")).alias("begin"), end.alias("end"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("no", "shown"))), lambda x: x["shown"])
    return placed.groupBy("conv", "perspective").agg(
        F.array_join(in_order, "").alias("rendered"),
        F.array_sort(F.collect_list(F.when(F.col("own"), span))).alias("mask"),
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if("own").alias("n_own"),
    ).withColumnRenamed("conv", conv_col)
