"""Multi-party chat: the dialogue once from the seat of every participant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import running

#: Turn numbers of one part of a dialogue; a longer dialogue is rendered in parts, so none grows without bound.
PART = 256


def rotate(turns: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, speaker, part, n_turns, n_rows, dialogue, mask): one row per participant and part.

    The speaker's turns become the assistant's, those of others a user's with the name in front; system
    turns stay.  mask lists start:end, in code points of the dialogue, of what the speaker says with
    its end mark.  Null role counts as "unknown", null text as empty, null turn as -1.  Turns follow
    turn, role and text; equal rows are one turn and count in n_rows.  A conversation of system turns
    alone has no participant and no row.
    """
    rows = turns.select("conv_id", F.coalesce("turn", F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    seats = rows.where("role <> 'system'").select(F.col("conv_id").alias("c"), F.col("role").alias("speaker")).distinct()
    rows = rows.join(seats, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    seat = F.when(F.col("role") == "system", "system").when(F.col("role") == F.col("speaker"), "assistant").otherwise("user")
    head = F.concat(F.lit("<|"), seat, F.lit("|>\n"), F.when(seat == "user", F.concat("role", F.lit(": "))).otherwise(""))
    rows = rows.select(
        "conv_id", "speaker", F.floor(F.col("turn") / part).cast("long").alias("part"),
        F.struct("turn", "role", "text", F.length(head).alias("head"), F.concat(head, "text", F.lit("<|end|>\n")).alias("said"), (seat == "assistant").alias("own"), "copies").alias("t"),
    )
    rows = rows.groupBy("conv_id", "speaker", "part").agg(F.sort_array(F.collect_list("t")).alias("t"))
    rows = rows.withColumn("e", running(F.transform("t", lambda t: F.length(t["said"])), lambda a, b: a + b))
    own = F.filter(F.zip_with("t", "e", lambda t, e: F.when(t["own"], F.concat(e - F.length(t["said"]) + t["head"], F.lit(":"), e - 1))), lambda s: s.isNotNull())
    return rows.select(
        "conv_id", "speaker", "part", F.size("t").cast("long").alias("n_turns"), F.aggregate("t", F.lit(0).cast("long"), lambda a, t: a + t["copies"]).alias("n_rows"),
        F.array_join(F.transform("t", lambda t: t["said"]), "").alias("dialogue"), F.array_join(own, ",").alias("mask"),
    )


#: The same in DuckDB.
SQL = f"""
WITH rows_ AS (SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text, count(*) AS copies FROM conversations GROUP BY ALL),
seats AS (SELECT DISTINCT conv_id, role AS speaker FROM rows_ WHERE role <> 'system'),
said AS (SELECT r.conv_id, s.speaker, CAST(floor(r.turn / {PART}) AS BIGINT) AS part, r.turn, r.role, r.text, r.copies,
  CASE WHEN r.role = 'system' THEN 'system' WHEN r.role = s.speaker THEN 'assistant' ELSE 'user' END AS seat
  FROM rows_ r JOIN seats s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
head AS (SELECT *, '<|' || seat || '|>' || chr(10) || CASE WHEN seat = 'user' THEN role || ': ' ELSE '' END AS h FROM said),
whole AS (SELECT *, h || text || '<|end|>' || chr(10) AS w FROM head),
placed AS (SELECT *, sum(length(w)) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS e FROM whole)
SELECT conv_id, speaker, part, count(*) AS n_turns, CAST(sum(copies) AS BIGINT) AS n_rows, string_agg(w, '' ORDER BY turn, role, text) AS dialogue,
  coalesce(string_agg(CASE WHEN seat = 'assistant' THEN CAST(e - length(w) + length(h) AS VARCHAR) || ':' || CAST(e - 1 AS VARCHAR) END, ',' ORDER BY turn, role, text), '') AS mask
FROM placed GROUP BY conv_id, speaker, part
"""
