"""Chat formatting: every participant's view of a dialogue (DataFrame functions only).

For each speaker of a conversation but ``system`` the dialogue is rendered
with that speaker as ``assistant``, every other speaker as a named user and
system turns as they are; the loss mask covers the assistant's words and the
end mark that follows them.  Offsets are code points of the whole rendering.

A dialogue is rendered in parts of ``PART_TURNS`` turn numbers, one row each,
so that a conversation with a third of all turns is many rows, never one
group; ordinary dialogues are one part.  Offsets run on from part to part
(a running sum over parts, not turns).

Defined results: turns are ordered by number, then speaker, then text; rows
that repeat a turn wholly are one; a null turn number comes first; a null
speaker is ``unknown``; a null text is empty; null conversation ids are one
conversation; marks inside texts are defused; a conversation of system turns
only has no view; an empty table gives an empty table; other columns are not
read, so clashing names do not matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PART_TURNS = 512
START, END = "<|im_start|>", "<|im_end|>"


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
                 text_col: str = "text", part_turns: int = PART_TURNS) -> DataFrame:
    """``(conv_id, speaker, part, n_turns, rendered, start, masks)``: ``start`` is
    the offset of the part, ``masks`` an array of (start, end)."""
    clean = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit("<|"), F.lit("< |"))
    name = F.regexp_replace(F.coalesce(F.col(speaker_col), F.lit("unknown")), r"[\x00-\x1F]|<\|", " ")
    t = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), name.alias("by"),
                     clean.alias("text")).distinct()
    t = t.withColumn("part", F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long"))
    views = t.where("by <> 'system'").select(F.col("conv_id").alias("_c"), F.col("by").alias("speaker")).distinct()
    seen = t.join(views, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
    role = (F.when(F.col("by") == F.col("speaker"), "assistant").when(F.col("by") == "system", "system")
            .otherwise(F.concat(F.lit("user name="), F.col("by"))))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    line = F.concat(head, "text", F.lit(END + "\n"))
    seen = seen.select("conv_id", "speaker", "part", F.struct(
        "turn", "by", "text", line.alias("line"),
        F.when(F.col("by") == F.col("speaker"), F.length(head)).alias("head")).alias("m"))
    parts = seen.groupBy("conv_id", "speaker", "part").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    parts = parts.select(
        "conv_id", "speaker", "part", F.size("ms").cast("long").alias("n_turns"),
        F.array_join(F.col("ms.line"), "").alias("rendered"),
        F.expr(f"""aggregate(ms, named_struct('at', 0L, 'spans', cast(array() as array<struct<start: bigint, end: bigint>>)),
            (a, m) -> named_struct('at', a.at + length(m.line), 'spans', if(m.head IS NULL, a.spans, concat(a.spans,
                array(named_struct('start', a.at + m.head, 'end', a.at + length(m.line) - 1))))),
            a -> a.spans)""").alias("own"))
    before = Window.partitionBy("conv_id", "speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0)).cast("long"))
    return parts.select("conv_id", "speaker", "part", "n_turns", "rendered", "start", F.expr(
        "transform(own, s -> named_struct('start', s.start + start, 'end', s.end + start))").alias("masks"))
