"""The driver tables as the engine's model: posts with language signals, coded records, interview turns, coded notes.

Each view is a list of expressions that Spark and an independent SQL engine both read, so a query and its oracle
start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXTS = [
    "I think it is probably fine, maybe.",
    "This tool wouldn''t let me export; I had to restart and I gave up.",
    "Um, you know, it kept crashing... (pause) and then it worked again for us.",
    "Agreed",
    "nope, not true",
    "I switched to another app because the old one was slow and moved back later.",
    "I ended up using a spreadsheet, manually, as a workaround every single week.",
    "Sign up here with my promo code for the best deal ever seen",
    "It is good.",
    "The search is fast and the price seems fair to me and to my whole team.",
    "Ask @helper or u/someone about sync, they kind of know why it fails on mobile.",
]

POSTS = {
    "ord": "event_id",
    "post_id": "'E' || CAST(event_id AS VARCHAR(20))",
    "source_type": "CASE WHEN event_id % 23 = 0 THEN 'interview' ELSE 'forum' END",
    "source": "'s' || CAST(user_id % 3 AS VARCHAR(20))",
    "thread": "'T' || CAST(event_id % 40 AS VARCHAR(20))",
    "parent_id": "CASE WHEN event_id % 9 = 0 OR event_id < 40 THEN NULL ELSE 'E' || CAST(event_id - 40 AS VARCHAR(20)) END",
    "role": "CASE WHEN event_id % 13 = 0 THEN 'unknown' ELSE 'participant' END",
    "kind": "CASE WHEN event_id % 9 = 0 THEN 'post' ELSE 'comment' END",
    "headline": "event_id % 45 = 0",
    "promotional": "event_id % 11 = 7",
    "score": "CAST(floor(value) AS INTEGER) % 50",
    "person": "'u' || CAST(user_id AS VARCHAR(20))",
    "time": "ts",
    "text": "CASE event_id % 11 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(TEXTS)) + " END",
}

RECORDS = {
    "ord": "event_id",
    "post_id": "'E' || CAST(event_id AS VARCHAR(20))",
    "person": "'u' || CAST(user_id AS VARCHAR(20))",
    "thread": "'T' || CAST(event_id % 40 AS VARCHAR(20))",
    "source": "'s' || CAST(user_id % 3 AS VARCHAR(20))",
    "search_term": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'q' || CAST(event_id % 4 AS VARCHAR(20)) END",
    "time": "ts",
    "overall": "CASE event_type WHEN 'error' THEN -2 WHEN 'signup' THEN -1 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE 0 END",
    "stance": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 5 AS INTEGER) - 2 END",
}
#: Aspects of a record: (name, condition, score).
ASPECTS = [
    ("speed", "event_id % 4 <= 1", "CAST(event_id % 5 AS INTEGER) - 2"),
    ("price", "event_id % 4 = 1", "CAST(event_id % 3 AS INTEGER) - 2"),
    ("design", "event_id % 4 = 2", "CAST(event_id % 4 AS INTEGER) - 1"),
    ("sync", "event_id % 6 = 5", "CAST(user_id % 4 AS INTEGER) - 2"),
    ("rare", "event_id = 17", "-1"),
]

#: Coded notes on posts: force, friction, severity, aspect and tags.
NOTES = {
    "ord": "event_id",
    "post_id": "'E' || CAST(event_id AS VARCHAR(20))",
    "person": "'u' || CAST(user_id AS VARCHAR(20))",
    "source_type": "CASE WHEN event_id % 23 = 0 THEN 'interview' ELSE 'forum' END",
    "aspect": "CASE event_id % 5 WHEN 0 THEN 'speed' WHEN 1 THEN 'price' WHEN 2 THEN 'design' WHEN 3 THEN 'sync' ELSE 'other' END",
    "force": "CASE user_id % 5 WHEN 0 THEN 'push' WHEN 1 THEN 'pull' WHEN 2 THEN 'anxiety' WHEN 3 THEN 'habit' ELSE 'none' END",
    "evidence": "CASE event_id % 4 WHEN 0 THEN 'hypothetical' WHEN 1 THEN 'opinion' WHEN 2 THEN 'specific_incident' ELSE 'observed' END",
    "friction": "event_id % 2 = 0",
    "success": "event_id % 7 = 0",
    "severity": "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 3 AS INTEGER) + 1 END",
    "sentiment": "CAST(event_id % 5 AS INTEGER) - 2",
    "score": "CAST(floor(value) AS INTEGER) % 50",
    "strong": "event_id % 4 >= 2",
    "topic": "'t' || CAST(event_id % 17 AS VARCHAR(20))",
    "second": "CASE WHEN event_id % 3 = 0 THEN 'product:p' || CAST(event_id % 6 AS VARCHAR(20)) ELSE 'x' || CAST(event_id % 5 AS VARCHAR(20)) END",
}


def cte(name: str, columns: dict[str, str], table: str, where: str = "TRUE") -> str:
    """The view as a common table expression."""
    return f"{name} AS (SELECT " + ", ".join(f"{v} AS {k}" for k, v in columns.items()) + f" FROM {table} WHERE {where})"


def select(spark: SparkSession, sf_dir: str, columns: dict[str, str], table: str, where: str = "TRUE") -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{table}.parquet").filter(where)
    return rows.select(*[F.expr(v).alias(k) for k, v in columns.items()])


ASPECT_SQL = " UNION ALL ".join(
    f"SELECT event_id AS ord, 'E' || CAST(event_id AS VARCHAR(20)) AS post_id, 'u' || CAST(user_id AS VARCHAR(20)) AS person, "
    f"'T' || CAST(event_id % 40 AS VARCHAR(20)) AS thread, '{a}' AS aspect, {s} AS score FROM events WHERE {c}"
    for a, c, s in ASPECTS
)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    entries = [F.when(F.expr(c), F.struct(F.lit(a).alias("key"), F.expr(s).cast("int").alias("value"))) for a, c, s in ASPECTS]
    held = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return rows.select(*[F.expr(v).alias(k) for k, v in RECORDS.items()], F.map_from_entries(held).alias("aspects"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, POSTS, "events")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, NOTES, "events").withColumn("tags", F.array("topic", "second"))


R = cte("records", RECORDS, "events")
P = cte("posts", POSTS, "events")
N = cte("notes", NOTES, "events")
A = f"aspect_rows AS ({ASPECT_SQL})"
#: The status rule and a percentage, as SQL.
STATUS = "CASE WHEN n_people < 20 THEN 'counts-only' WHEN n_items < 60 THEN 'early-signal' ELSE 'full' END"
