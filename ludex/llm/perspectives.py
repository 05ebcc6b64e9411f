"""Chat formatting: multi-party perspective rotation.

Every participant of a conversation gets a rendering of it with that speaker
as the assistant and all others as named users, and a loss mask over the
speaker's own turns. Turns of context roles (``system``) are rendered as such
and have no perspective of their own.

A conversation of any length is cut into parts of ``PART_TURNS`` turns, so no
group holds more; where a conversation is longer the turns' positions come
from range partitioning. Nothing but DataFrame functions is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludex.llm.common import read_table
from ludex.llm.positions import group_positions
from ludex.session import stage_table

PART_TURNS = 256
# The chat markers.
START, END = "<|im_start|>", "<|im_end|>\n"
CONTEXT_ROLES = ["system"]


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_last(), F.col("role").asc(), F.col("text").asc()]


def _named(context: list[str]) -> Column:
    """How a turn opens for other speakers."""
    return F.when(F.col("role").isin(context), F.concat(F.lit(START), "role", F.lit("\n"))) \
        .otherwise(F.concat(F.lit(f"{START}user name="), "role", F.lit("\n")))


def perspectives(conversations: DataFrame, context_roles: list[str] | None = None,
                 part_turns: int = PART_TURNS) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) -> one row per
    conversation, participant and part: conv_id, participant, part (0-based),
    n_turns, n_own (turns of the participant), text, mask (array of [start,
    end) spans of the participant's own content and end marker, in code points
    of text).

    Turns go by (turn, role, text), NULL turns last. Cases: a NULL role is the
    speaker ``unknown``, a NULL text is empty, a NULL conv_id is a conversation
    like others; equal rows are turns of their own. Markers inside a text are
    broken up (``<|`` becomes ``< |``); line breaks in a role become spaces. A
    conversation of context turns only has no participant and no row. Other
    columns are ignored. An empty table gives an empty table."""
    context = CONTEXT_ROLES if context_roles is None else context_roles
    clean = lambda c: F.regexp_replace(c, r"<\|", "< |")
    rows = conversations.select(
        "conv_id", "turn",
        F.regexp_replace(clean(F.coalesce("role", F.lit("unknown"))), r"[\r\n]", " ").alias("role"),
        clean(F.coalesce("text", F.lit(""))).alias("text"))
    long_ = stage_table(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > part_turns)
                        .select(F.col("conv_id").alias("long_id")), "long")
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    short = rows.join(long_, same, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    spread = group_positions(rows.join(long_, same, "left_semi"), ["conv_id"], _order(), "at")
    spread = spread.withColumn("part", F.floor(F.col("at") / part_turns)).drop("at")

    # One group per part; its turns in order.
    turn = F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "text",
                    _named(context).alias("open"))
    grouped = (short.select("conv_id", "turn", "role", "text", "part").unionByName(spread)
               .groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(turn)).alias("turns")))
    speakers = lambda a: F.array_distinct(F.filter(
        F.transform(a, lambda t: t["role"]), lambda r: ~r.isin(context)))
    # Participants: of a short conversation from its one group.
    whole = (grouped.join(long_, same, "left_anti")
             .select("conv_id", "part", "turns",
                     F.explode(speakers(F.col("turns"))).alias("participant")))
    who = (rows.join(long_, same, "left_semi").where(~F.col("role").isin(context))
           .select(F.col("conv_id").alias("who_id"), F.col("role").alias("participant")).distinct())
    pieces = (grouped.join(long_, same, "left_semi")
              .join(who, F.col("conv_id").eqNullSafe(F.col("who_id")))
              .select("conv_id", "part", "turns", "participant"))
    all_ = whole.unionByName(pieces)

    own = lambda t: t["role"] == F.col("participant")
    opening = lambda t: F.when(own(t), F.lit(f"{START}assistant\n")).otherwise(t["open"])
    text = F.array_join(F.transform(
        "turns", lambda t: F.concat(opening(t), t["text"], F.lit(END))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>")
                     .alias("mask"))

    def step(state, t):
        content = state["at"] + F.length(opening(t))
        end = content + F.length(t["text"]) + F.lit(len(END))
        return F.struct(end.alias("at"), F.when(own(t), F.concat(state["mask"], F.array(F.struct(
            content.alias("start"), end.alias("end"))))).otherwise(state["mask"]).alias("mask"))

    return all_.select(
        "conv_id", "participant", "part", F.size("turns").alias("n_turns"),
        F.size(F.filter("turns", own)).alias("n_own"), text.alias("text"),
        F.aggregate("turns", start, step)["mask"].alias("mask"))


def op4_chat_perspectives(spark, sf_dir: str) -> DataFrame:
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return perspectives(read_table(spark, sf_dir, "conversations")).select(
        "conv_id", "participant", "part", F.col("n_turns").cast("bigint").alias("n_turns"),
        F.col("n_own").cast("bigint").alias("n_own"), "text",
        F.array_join(spans, ",").alias("mask"))


OP4_SQL = r"""
WITH t AS (
  SELECT conv_id, turn,
         regexp_replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '[\r\n]', ' ', 'g') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
n AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 AS pos FROM t),
p AS (SELECT DISTINCT conv_id, role AS participant FROM t WHERE role <> 'system'),
r AS (
  SELECT n.conv_id, participant, pos, pos // 256 AS part, text, role = participant AS own,
         CASE WHEN role = participant THEN '<|im_start|>assistant' || chr(10)
              WHEN role = 'system' THEN '<|im_start|>system' || chr(10)
              ELSE '<|im_start|>user name=' || role || chr(10) END AS opening
  FROM n JOIN p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
s AS (
  SELECT *, sum(length(opening) + length(text) + 11) OVER (
    PARTITION BY conv_id, participant, part ORDER BY pos) AS stop FROM r)
SELECT conv_id, participant, part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(opening || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text,
       coalesce(string_agg(CAST(stop - length(text) - 11 AS BIGINT) || ':' || CAST(stop AS BIGINT),
                           ',' ORDER BY pos) FILTER (own), '') AS mask
FROM s GROUP BY conv_id, participant, part
"""
