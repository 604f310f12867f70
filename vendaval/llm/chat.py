"""Chat formatting by rotating the perspective: each participant in turn is the assistant, all others are named users.

Turns are ranked over the whole conversation and gathered in parts of PART turns, so that a conversation of any length is
rendered in rows of bounded turns; the parts in order are the dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Turns in a rendered row.
PART = 256
#: Roles that stand beside the dialogue and are rendered as they are for everyone.
CONTEXT = ("system",)
#: Turns that one task ranks; longer conversations are ranked from the totals of their stretches.
STRETCH = 20_000
END = "<|end|>\n"


def ranked(df: DataFrame) -> DataFrame:
    """conv_id, role, text, and ``at``: the rank of the turn in its conversation from 0.

    Order: turn (null last), role, text. A range sort over all turns spreads a long conversation over tasks; a number for
    each row makes even equal rows separable. Counts of the stretches give each its start.
    """
    spark = df.sparkSession
    keys = ["conv_id", F.col("turn").isNull(), "turn", "role", "text", "n"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // STRETCH))
    spread = df.select("conv_id", "turn", "role", "text").withColumn("n", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    held = cut_lineage(spread.withColumn("stretch", F.spark_partition_id()), "turns")
    counts = held.groupBy("conv_id", "stretch").agg(F.count(F.lit(1)).alias("turns"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv_id", "stretch").orderBy(F.col("turn").isNull(), "turn", "role", "text", "n")
    own = held.withColumn("r", F.row_number().over(inside) - 1)
    return own.join(starts, own["conv_id"].eqNullSafe(starts["c"]) & (own["stretch"] == starts["s"])).select(
        "conv_id", "role", "text", (F.col("start") + F.col("r")).alias("at")
    )


def _segment(turn: Column, speaker: Column) -> Column:
    """(head, body, mine) of one turn from a speaker's point of view."""
    role = F.coalesce(turn["role"], F.lit("unknown"))
    mine = F.coalesce(turn["role"] == speaker, F.lit(False))
    head = F.when(mine, F.lit("<|assistant|>\n")).when(role.isin(*CONTEXT), F.concat(F.lit("<|"), role, F.lit("|>\n"))).otherwise(
        F.concat(F.lit("<|user|>"), role, F.lit("\n"))
    )
    return F.struct(head.alias("head"), F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(END)).alias("body"), mine.alias("mine"))


def perspectives(df: DataFrame) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, mask for each conversation, participant and part.

    Input: conv_id, turn, role, text; other columns are left out. A participant is a role other than CONTEXT and null.
    ``mask`` holds (start, end) character spans of the text that the perspective speaks, its end mark included; a part in
    which it is silent has none. Null texts are empty turns, a null role is the user ``unknown``, rows with a null conv_id
    are one conversation; repeated rows are repeated turns. A conversation without participants has no rendering.
    """
    turns = ranked(df)
    parts = turns.groupBy("conv_id", F.floor(F.col("at") / PART).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("at", "role", "text"))).alias("turns")  # at most PART turns
    )
    speakers = df.where(F.col("role").isNotNull() & ~F.col("role").isin(*CONTEXT)).select(F.col("conv_id").alias("c"), F.col("role").alias("perspective")).distinct()
    each = parts.join(speakers, parts["conv_id"].eqNullSafe(speakers["c"]))
    seen = each.select("conv_id", "perspective", "part", F.transform("turns", lambda t: _segment(t, F.col("perspective"))).alias("segments"))
    span = "array<struct<start:int,end:int>>"
    spans = F.aggregate(
        "segments",
        F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("spans")),
        lambda a, s: F.struct(
            (a["at"] + F.length(s["head"]) + F.length(s["body"])).alias("at"),
            F.when(
                s["mine"],
                F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(s["head"])).alias("start"), (a["at"] + F.length(s["head"]) + F.length(s["body"])).alias("end")))),
            ).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    return seen.select(
        "conv_id", "perspective", "part", F.size("segments").alias("n_turns"),
        F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"])), "").alias("text"), spans.alias("mask"),
    )


def renderings(df: DataFrame) -> DataFrame:
    """``perspectives`` with the mask as text, ``start:end`` joined by commas."""
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return perspectives(df).select(
        "conv_id", "perspective", F.col("part").cast("long").alias("part"), F.col("n_turns").cast("long").alias("n_turns"), "text", spans.alias("mask")
    )


#: The same rows over the test tables.
SQL = f"""
WITH t AS (
  SELECT conv_id, role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) - 1 AS k
  FROM conversations
), p AS (
  SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'
), s AS (
  SELECT t.conv_id, perspective, k // {PART} AS part, k, coalesce(role = perspective, false) AS mine,
         CASE WHEN role = perspective THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user|>' || coalesce(role, 'unknown') || chr(10) END AS head,
         text || '<|end|>' || chr(10) AS body
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, part ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + length(head) AS begins
  FROM s
)
SELECT conv_id, perspective, CAST(part AS BIGINT) AS part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY k) AS text,
       coalesce(string_agg(CAST(begins AS BIGINT) || ':' || CAST(begins + length(body) AS BIGINT), ',' ORDER BY k) FILTER (WHERE mine), '') AS mask
FROM o GROUP BY ALL
"""
