"""Chat formatting by multi-party perspective rotation, in DataFrame functions only.

For every participant of a dialogue the whole dialogue is rendered once: that speaker's turns as ``assistant``, all
others as ``user`` with the speaker's name, and a mask that covers the assistant's own words. The system speaker is
part of every rendering but is no participant to rotate to.

One row is one block of a rendering: ``block_turns`` turns by their number in the order of the dialogue. An ordinary
dialogue is one block. Blocks in order of their number, one after another, are the dialogue, and the mask's spans
count from the start of their block; so no dialogue, however long, has to fit into one task. Turns are numbered by
ranges: equal rows are counted first, the different ones dealt to ranges of the whole order, and each starts behind
what its conversation has in the ranges and rows before it. So neither a conversation nor a turn number nor a row that
holds a third of all rows is numbered or collected in one task.

Defined results: a null role is the speaker ``unknown``, a null text is empty. Turns are ordered by number, then
speaker, then text; null numbers come first. Repeated rows are rendered as often as they occur. A dialogue of system
turns only has no rendering. Rows with a null conversation id form one dialogue. An empty table gives an empty
result. Input columns other than the four named ones are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraproof.llm.common import cut

SYSTEM = "system"
START, MIDDLE, END = "<|start|>", "<|message|>", "<|end|>\n"


def _head(t: Column, own: Column) -> Column:
    """What stands before a turn's words."""
    other = F.when(t["speaker"] == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), t["speaker"]))
    return F.concat(F.lit(START), F.when(own, F.lit("assistant")).otherwise(other), F.lit(MIDDLE))


def _numbered(turns: DataFrame) -> DataFrame:
    """The different rows with their ``copies`` and ``start``, the number of turns before them in their conversation."""
    order = ["turn", "speaker", "said"]
    dealt = turns.groupBy("conv", *order).agg(F.count(F.lit(1)).alias("copies")).repartitionByRange("conv", *order)
    dealt = cut(dealt.withColumn("part", F.spark_partition_id()))  # written, so that all that follows sees the same ranges
    parts = dealt.groupBy("conv", "part").agg(F.sum("copies").alias("held"))
    before = F.sum("held").over(Window.partitionBy("conv").orderBy("part")) - F.col("held")
    parts = parts.select(F.col("conv").alias("of"), F.col("part").alias("in_part"), before.alias("before"))
    here = F.sum("copies").over(Window.partitionBy("conv", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    both = dealt.withColumn("here", here).join(parts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in_part")))
    return both.select("conv", *order, "copies", (F.col("before") + F.col("here")).alias("start"))


def rotate_dialogues(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_turns: int = 64) -> DataFrame:
    """Rows (conversation, perspective, block, n_turns, n_chars, n_masked, text, mask).

    ``mask`` lists the spans of the assistant's words as ``start+length``, comma-separated.
    """
    turns = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("unknown")).alias("speaker"), F.coalesce(text_col, F.lit("")).alias("said"))
    first, end = F.col("start"), F.col("start") + F.col("copies")
    at = lambda x: F.floor(x / block_turns).cast("long")
    rows = _numbered(turns).select("*", F.explode(F.sequence(at(first), at(end - 1))).alias("block"))
    inside = (F.least(end, (F.col("block") + 1) * block_turns) - F.greatest(first, F.col("block") * block_turns)).cast("int")
    held = F.sort_array(F.collect_list(F.struct("start", "speaker", "said", inside.alias("times"))))
    blocks = rows.groupBy("conv", "block").agg(F.flatten(F.transform(held, lambda t: F.array_repeat(t, t["times"]))).alias("turns"))
    speakers = turns.filter(F.col("speaker") != SYSTEM).select(F.col("conv").alias("of"), F.col("speaker").alias("perspective")).distinct()
    each = blocks.join(speakers, blocks["conv"].eqNullSafe(speakers["of"]))

    own = lambda t: t["speaker"] == F.col("perspective")
    parts = F.transform("turns", lambda t: F.struct(_head(t, own(t)).alias("head"), t["said"].alias("said"), own(t).alias("own")))
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["said"], F.lit(END))), "")
    begun = F.struct(F.lit(0).alias("at"), F.lit("").alias("mask"))
    spans = F.aggregate(
        "parts",
        begun,
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["said"]) + len(END)).alias("at"),
            F.concat(acc["mask"], F.when(p["own"], F.concat(F.lit(","), (acc["at"] + F.length(p["head"])).cast("string"), F.lit("+"), F.length(p["said"]).cast("string"))).otherwise(F.lit(""))).alias("mask"),
        ),
        lambda acc: F.substring(acc["mask"], 2, 2147483647),
    )
    masked = F.aggregate("parts", F.lit(0), lambda n, p: n + F.when(p["own"], F.length(p["said"])).otherwise(0))
    shown = each.select("conv", "perspective", "block", parts.alias("parts"))
    return shown.select(
        F.col("conv").alias(conv_col), "perspective", "block", F.size("parts").cast("long").alias("n_turns"),
        F.length(text).cast("long").alias("n_chars"), masked.cast("long").alias("n_masked"), text.alias("text"), spans.alias("mask"),
    )
