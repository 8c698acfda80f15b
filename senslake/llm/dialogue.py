"""Chat formatting: every participant's perspective on a conversation, with loss masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Turns per part of a dialogue: a conversation of any length is rendered in bounded pieces.
PART = 64
END = "\n<|end|>"
#: What names may not hold, percent-encoded (the percent sign first).
_NAME = {"%": "%25", "<": "%3C", ">": "%3E", "|": "%7C", "\n": "%0A", "\r": "%0D"}


def _name(col):
    """A participant's name as it stands in a marker."""
    for a, b in _NAME.items():
        col = F.replace(col, F.lit(a), F.lit(b))
    return col


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part: int = PART) -> DataFrame:
    """(conv_id, perspective, part, n_messages, n_target, text, mask): one dialogue per participant and part.

    In ``perspective``'s dialogue its own messages are the assistant's, every other participant is a user with a name, and
    ``system`` stays system. ``mask`` lists start:end (code points in ``text``, ends exclusive) of the
    assistant's messages with their end marks. Messages run by (turn, role, text); part ``p`` holds turns ``part * p`` up to
    ``part * (p + 1) - 1``, so normal conversations are one row per perspective and no group is longer than a part.

    Neither texts nor names can forge a marker: ``<|`` in a text becomes ``<\\|``, and the characters % < > | and line ends of a name are percent-encoded
    (the column ``perspective`` keeps the name as it is). ``system`` and unnamed speakers (null role, rendered as ``<|user|>``) have no perspective;
    conversations of them alone give no row. Null text is empty. A null turn
    comes first, in part -1. A null conversation id groups nothing: each such row is a conversation of its own. Rows that repeat a
    message entirely are rendered as often as they come, counted before any shuffle of texts. Extra columns are ignored; an empty table gives an empty result.
    Built-in functions only."""
    base = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("speaker"),
                        F.replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("<|"), F.lit("<\\|")).alias("message"))
    key = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    m = (base.select("*", key.alias("own")).groupBy("conv_id", "own", "turn", "speaker", "message").agg(F.count("*").cast("int").alias("n"))
         .withColumn("part", F.coalesce(F.floor(F.col("turn") / part), F.lit(-1))))
    who = (m.where("speaker <> 'system'")
           .select(F.col("conv_id").alias("c"), F.col("own").alias("o"), F.col("speaker").alias("perspective")).distinct())
    both = m.join(who, m["conv_id"].eqNullSafe(who["c"]) & (m["own"] == who["o"]))
    mine = F.col("speaker").eqNullSafe(F.col("perspective"))
    head = (F.when(mine, F.lit("<|assistant|>\n")).when(F.col("speaker") == "system", F.lit("<|system|>\n")).when(F.col("speaker").isNull(), F.lit("<|user|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), _name(F.col("speaker")), F.lit("|>\n"))))
    seg = both.select("conv_id", "own", "perspective", "part", "turn", "speaker", "message", "n", mine.alias("mine"), head.alias("head"),
                      F.concat(head, F.col("message"), F.lit(END + "\n")).alias("one"))
    w = Window.partitionBy("conv_id", "own", "perspective", "part").orderBy(F.col("turn").asc_nulls_first(), "speaker", "message")
    size = F.length("one")
    at = seg.select("*", size.alias("size"), (F.sum(size * F.col("n")).over(w) - size * F.col("n")).alias("start"), F.row_number().over(w).alias("pos"))
    first = F.col("start") + F.length("head")
    marks = F.expr(f"array_join(transform(sequence(0, n - 1), i -> concat(cast(start + length(head) + i * size as string), ':', cast(start + length(head) + i * size + length(message) + {len(END)} as string))), ',')")
    row = at.select("conv_id", "own", "perspective", "part", "n", "mine", F.struct("pos", F.expr("repeat(one, n)").alias("t"), F.when(F.col("mine"), marks).alias("k")).alias("s"))
    out = row.groupBy("conv_id", "own", "perspective", "part").agg(F.sum("n").alias("n_messages"), F.sum(F.when(F.col("mine"), F.col("n")).otherwise(0)).alias("n_target"), F.sort_array(F.collect_list("s")).alias("s"))
    return out.select("conv_id", "perspective", "part", "n_messages", "n_target", F.array_join("s.t", "").alias("text"), F.array_join("s.k", ",").alias("mask"))


def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every participant's dialogues of all conversations."""
    return perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP4_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, role AS speaker, replace(coalesce(text, ''), '<|', '<\|') AS message, coalesce(floor(turn / 64)::BIGINT, -1) AS part,
         CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE -1 END AS own
  FROM conversations),
who AS (SELECT DISTINCT conv_id, own, speaker AS perspective FROM m WHERE speaker <> 'system'),
s AS (
  SELECT m.*, perspective, coalesce(speaker = perspective, false) AS mine,
         CASE WHEN speaker = perspective THEN '<|assistant|>' || chr(10) WHEN speaker = 'system' THEN '<|system|>' || chr(10) WHEN speaker IS NULL THEN '<|user|>' || chr(10)
              ELSE '<|user name=' || replace(replace(replace(replace(replace(replace(speaker, '%', '%25'), '<', '%3C'), '>', '%3E'), '|', '%7C'), chr(10), '%0A'), chr(13), '%0D')
                || '|>' || chr(10) END AS head
  FROM m JOIN who ON m.conv_id IS NOT DISTINCT FROM who.conv_id AND m.own = who.own),
t AS (SELECT *, head || message || chr(10) || '<|end|>' || chr(10) AS one FROM s),
r AS (
  SELECT *, row_number() OVER w AS pos, coalesce(sum(length(one)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM t WINDOW w AS (PARTITION BY conv_id, own, perspective, part ORDER BY turn NULLS FIRST, speaker, message))
SELECT conv_id, perspective, part, count(*) AS n_messages, (count(*) FILTER (WHERE mine))::BIGINT AS n_target, string_agg(one, '' ORDER BY pos) AS text,
       coalesce(string_agg((start + length(head))::VARCHAR || ':' || (start + length(head) + length(message) + 8)::VARCHAR, ',' ORDER BY pos) FILTER (WHERE mine), '') AS mask
FROM r GROUP BY conv_id, own, perspective, part
"""
