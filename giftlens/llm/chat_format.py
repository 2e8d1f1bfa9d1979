"""Chat formatting with multi-party perspective rotation, in DataFrame and SQL
functions only.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant and the others as named users, and the spans of the
assistant's words are listed as the loss mask.

A conversation is cut into parts of a bounded number of turns, by turn number
and not by a rank over the whole conversation, so a conversation that holds a
third of all rows is spread over many tasks; one of usual length is one part.
Places are counted over the whole rendering, and ``join_parts`` puts it together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from giftlens.llm.common import null_safe, read

UNKNOWN = "unknown"
SYSTEM = "system"


@dataclass(frozen=True)
class ChatParams:
    """``part_turns``: turn numbers to a part, and the most rows of one."""

    part_turns: int = 512


def _plain(c: Column) -> Column:
    """Control tokens inside a text are taken apart, so they can't close a turn."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"<\|", "< |")


def rotate(conversations: DataFrame, p: ChatParams = ChatParams()) -> DataFrame:
    """``(conv_id, perspective, part, begin, n_turns, rendered, mask)``: a row for each
    participant of a conversation and each of its parts.  ``begin`` is where the
    part begins in the rendering of the whole conversation.

    Participants are the distinct roles but ``system``, whose turns all see.  A
    turn is ``<|im_start|>NAME\\nTEXT<|im_end|>\\n``, with NAME ``assistant``
    for the perspective's speaker, ``user name=ROLE`` for others.  ``mask`` is
    the list of start:end offsets (code points of the whole rendering, end
    exclusive, comma-joined) of the assistant's TEXT and end token.  Order is by turn, role, text; ties and
    repeated rows stay, one after the other.  A null role is ``unknown``, a null
    text empty, a null turn comes in part -1 before all others (turns count from 0).  Conversations
    with only system turns have no participant and no row; a null conv_id is a
    conversation like any other.  Other columns are ignored.
    """
    role = F.coalesce(_plain(F.col("role")), F.lit(UNKNOWN))
    role = F.when(F.col("role").isNull(), UNKNOWN).otherwise(role)
    t = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                             role.alias("role"), _plain(F.col("text")).alias("text"))
    t = t.withColumn("cell", F.coalesce(F.floor(F.col("turn") / p.part_turns), F.lit(-1)).cast("long"))
    rank = F.row_number().over(Window.partitionBy("conv_id", "cell").orderBy("turn", "role", "text"))
    t = t.withColumn("rank", rank).withColumn("sub", F.floor((F.col("rank") - 1) / p.part_turns))
    parts = t.groupBy("conv_id", "cell", "sub").agg(
        F.sort_array(F.collect_list(F.struct("rank", "role", "text"))).alias("turns"))
    begins = _begins(t)
    both = parts.join(begins, null_safe(parts, begins, [("conv_id", "who_conv"), ("cell", "who_cell"), ("sub", "who_sub")]))

    def head(x):
        name = (F.when(x["role"] == F.col("perspective"), "assistant").when(x["role"] == SYSTEM, SYSTEM)
                .otherwise(F.concat(F.lit("user name="), x["role"])))
        return F.concat(F.lit("<|im_start|>"), name, F.lit("\n"))

    segments = F.transform("turns", lambda x: F.struct(
        head(x).alias("head"), F.concat(x["text"], F.lit("<|im_end|>")).alias("body"),
        (x["role"] == F.col("perspective")).alias("own")))
    both = both.select("conv_id", "perspective", F.struct("cell", "sub").alias("at"), "begin", segments.alias("seg"))
    nothing = F.struct(F.col("begin").alias("at"), F.array().cast("array<string>").alias("mask"))

    def step(acc, x):
        start = acc["at"] + F.length(x["head"])
        end = start + F.length(x["body"])
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        return F.struct((end + 1).alias("at"), F.when(x["own"], F.concat(acc["mask"], F.array(span)))
                        .otherwise(acc["mask"]).alias("mask"))

    return both.select(
        "conv_id", "perspective", F.concat_ws(".", F.col("at.cell").cast("string"), F.col("at.sub").cast("string"))
        .alias("part"), "begin", F.size("seg").cast("long").alias("n_turns"),
        F.array_join(F.transform("seg", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(F.aggregate("seg", nothing, step, lambda a: a["mask"]), ",").alias("mask"))


def _begins(t: DataFrame) -> DataFrame:
    """(who_conv, who_cell, who_sub, perspective, begin) for every part and participant.

    A part is as long for a participant as for a reader of named users only, but that
    each of their own turns says ``assistant`` instead of ``user name=ROLE``: sums per
    part and per role's turns before it give its begin, and no text is looked at twice."""
    name = F.when(F.col("role") == SYSTEM, F.length(F.lit(SYSTEM))).otherwise(F.length(F.lit("user name=")) + F.length("role"))
    frame = len("<|im_start|>" + "\n" + "<|im_end|>" + "\n")
    at = ["conv_id", "cell", "sub"]
    roles = t.groupBy(*at, "role").agg(F.count(F.lit(1)).alias("n"), F.sum((name + F.length("text") + frame).cast("long")).alias("size"))
    before = Window.unboundedPreceding, -1
    sizes = roles.groupBy(*at).agg(F.sum("size").alias("size"))
    over = Window.partitionBy("conv_id").orderBy("cell", "sub").rowsBetween(*before)
    sizes = sizes.select(*at, F.coalesce(F.sum("size").over(over), F.lit(0)).alias("plain"))
    who = roles.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("who_conv"), F.col("role").alias("perspective")).distinct()
    every = sizes.join(who, null_safe(sizes, who, [("conv_id", "who_conv")]))
    own = roles.select(F.col("conv_id").alias("own_conv"), F.col("cell").alias("own_cell"), F.col("sub").alias("own_sub"),
                       F.col("role").alias("own_role"), "n")
    every = every.join(own, null_safe(every, own, [("conv_id", "own_conv"), ("cell", "own_cell"), ("sub", "own_sub"),
                                                   ("perspective", "own_role")]), "left")
    turns = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id", "perspective").orderBy("cell", "sub").rowsBetween(*before)), F.lit(0))
    shorter = F.length(F.lit("user name=")) + F.length("perspective") - F.length(F.lit("assistant"))
    return every.select(F.col("conv_id").alias("who_conv"), F.col("cell").alias("who_cell"), F.col("sub").alias("who_sub"), "perspective",
                        (F.col("plain") - turns * shorter).cast("long").alias("begin"))


def join_parts(parts: DataFrame) -> DataFrame:
    """``(conv_id, perspective, n_turns, rendered, mask)``: ``rotate``'s parts put together,
    a row for each participant of a conversation.  A row holds a whole rendering, so
    this is for conversations of which one fits into a task."""
    rows = F.sort_array(F.collect_list(F.struct("begin", "part", "rendered", "mask")))
    t = parts.groupBy("conv_id", "perspective").agg(F.sum("n_turns").alias("n_turns"), rows.alias("rows"))
    masks = F.filter(F.col("rows.mask"), lambda m: m != "")
    return t.select("conv_id", "perspective", "n_turns", F.array_join("rows.rendered", "").alias("rendered"), F.array_join(masks, ",").alias("mask"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(read(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(replace(role, '<|', '< |'), 'unknown') AS role,
    replace(coalesce(text, ''), '<|', '< |') AS text, coalesce(floor(turn / 512), -1)::BIGINT AS cell
  FROM conversations
), r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, cell ORDER BY turn, role, text) AS rank FROM t
), s AS (SELECT *, ((rank - 1) // 512)::BIGINT AS sub FROM r),
who AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
x AS (
  SELECT s.*, perspective, role = perspective AS own, '<|im_start|>' || CASE
    WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
    ELSE 'user name=' || role END || chr(10) AS head, text || '<|im_end|>' AS body
  FROM s JOIN who ON s.conv_id IS NOT DISTINCT FROM who.conv_id
), y AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER w - length(body) - 1 AS start
  FROM x WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY cell, sub, rank)
)
SELECT conv_id, perspective, cell || '.' || sub AS part, min(start - length(head))::BIGINT AS begin, count(*) AS n_turns,
  string_agg(head || body || chr(10), '' ORDER BY rank) AS rendered,
  coalesce(string_agg(start::BIGINT || ':' || (start + length(body))::BIGINT, ',' ORDER BY rank) FILTER (own), '') AS mask
FROM y GROUP BY conv_id, perspective, cell, sub
"""
