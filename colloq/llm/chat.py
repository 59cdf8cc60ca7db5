"""Chat formatting with multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered with that speaker as the assistant and all others as
named users; the mask marks what the assistant says, up to and with its end mark. System turns are shown to every
perspective and are nobody's. A conversation is rendered in parts of ``PART`` turn numbers, a row each, so no
task and no row grows with a long conversation; the whole rendering is its parts one after another, and ``start``
is where a part begins in it. All of it is DataFrame operations.

Marks of the template inside a turn's text lose their bar's plain form (``<|im_end|>`` becomes ``<\\|im_end|>``), so
no text can open or close a turn; speakers' names are shown with the same care, and line ends in them as spaces.

Defined results: turns are ordered by turn (null first), role and text, repeated rows are all rendered; a null text is
empty; a null role is the speaker ``unknown``; rows with a null conv_id belong to no conversation and
give nothing; a conversation of system turns only has no perspective and gives nothing; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import load

PART = 512


def rotate(turns: DataFrame, speaker: str = "role", system: str = "system", part: int = PART) -> DataFrame:
    """(conv_id, perspective, part, start, n_turns, n_trained, text, mask): mask as start:end, comma-joined, in code points of the part."""
    who = F.coalesce(F.col(speaker), F.lit("unknown"))
    body = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"<\|(im_start|im_end)\|>", r"<\\|$1|>")
    shown = F.regexp_replace(F.regexp_replace(who, r"[\r\n]+", " "), r"<\|(im_start|im_end)\|>", r"<\\|$1|>")
    rows = turns.filter("conv_id IS NOT NULL").select(
        "conv_id", F.floor(F.coalesce("turn", F.lit(0)) / part).cast("bigint").alias("part"), F.struct("turn", who.alias("who"), body.alias("body"), shown.alias("shown")).alias("t")
    )
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    speakers = rows.select("conv_id", F.col("t.who").alias("perspective")).distinct().filter(F.col("perspective") != system)
    each = parts.join(speakers, "conv_id")
    shown = F.expr(
        f"""transform(ts, t -> named_struct(
            'head', CASE WHEN t.who = '{system}' THEN '<|im_start|>system\n' WHEN t.who = perspective THEN '<|im_start|>assistant\n'
                ELSE concat('<|im_start|>user name=', t.shown, '\n') END,
            'body', concat(t.body, '<|im_end|>'), 'own', t.who = perspective))"""
    )
    spans = F.expr(
        """aggregate(ms, named_struct('at', 0, 'out', CAST(array() AS ARRAY<STRING>)), (a, m) -> named_struct(
            'at', a.at + length(m.head) + length(m.body) + 1,
            'out', IF(m.own, concat(a.out, array(concat(a.at + length(m.head), ':', a.at + length(m.head) + length(m.body)))), a.out)), a -> a.out)"""
    )
    drawn = each.select("conv_id", "perspective", "part", shown.alias("ms"))
    drawn = drawn.select(
        "conv_id",
        "perspective",
        "part",
        F.size("ms").cast("bigint").alias("n_turns"),
        F.expr("CAST(size(filter(ms, m -> m.own)) AS BIGINT)").alias("n_trained"),
        F.expr("array_join(transform(ms, m -> concat(m.head, m.body, '\n')), '')").alias("text"),
        F.array_join(spans, ",").alias("mask"),
    )
    # What stands before a part comes from lengths alone: one number a part, two thousand for a conversation of a million turns.
    length = F.expr("aggregate(ms, 0L, (a, m) -> a + length(m.head) + length(m.body) + 1)").alias("length")
    before = Window.partitionBy("conv_id", "perspective").orderBy("part")
    keys = ["conv_id", "perspective", "part"]
    starts = each.select(*keys, shown.alias("ms")).select(*keys, length).withColumn("start", F.sum("length").over(before) - F.col("length")).drop("length")
    return drawn.join(starts, keys).select(*keys, "start", "n_turns", "n_trained", "text", "mask")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(load(spark, sf_dir, "conversations"))


SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS who, regexp_replace(regexp_replace(coalesce(role, 'unknown'), '[\r\n]+', ' ', 'g'), '<\\|(im_start|im_end)\\|>', '<\\\\|\\1|>', 'g') AS named, CAST(floor(coalesce(turn, 0) / {PART}) AS BIGINT) AS part,
    regexp_replace(coalesce(text, ''), '<\\|(im_start|im_end)\\|>', '<\\\\|\\1|>', 'g') AS body
  FROM conversations WHERE conv_id IS NOT NULL),
people AS (SELECT DISTINCT conv_id, who AS perspective FROM turns WHERE who <> 'system'),
shown AS (
  SELECT conv_id, perspective, part, turn, who, body, who = perspective AS own,
    CASE WHEN who = 'system' THEN '<|im_start|>system' || chr(10) WHEN who = perspective THEN '<|im_start|>assistant' || chr(10)
      ELSE '<|im_start|>user name=' || named || chr(10) END AS head
  FROM turns JOIN people USING (conv_id)),
placed AS (
  SELECT *, row_number() OVER w AS nth, sum(length(head) + length(body) + 11) OVER w - length(body) - 11 AS pos
  FROM shown WINDOW w AS (PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, who, body ROWS UNBOUNDED PRECEDING)),
parts AS (
  SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (own) AS n_trained,
    string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY nth) AS text,
    coalesce(string_agg(CAST(pos AS BIGINT) || ':' || CAST(pos + length(body) + 10 AS BIGINT), ',' ORDER BY nth) FILTER (own), '') AS mask
  FROM placed GROUP BY ALL)
SELECT conv_id, perspective, part,
  CAST(sum(length(text)) OVER (PARTITION BY conv_id, perspective ORDER BY part) - length(text) AS BIGINT) AS start,
  n_turns, n_trained, text, mask FROM parts
"""
