"""All sources as one table of posts with stable numbers, in order, and what breaks its rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import conversation
from .rows import POST_RULES, violations

POST = (
    "post_id", "source_type", "source", "thread_id", "thread_title", "search_term", "parent_id", "author", "role", "kind", "timestamp", "date_approx", "score", "start_s", "end_s",
    "promotional", "headline", "text", "capture_method", "raw_ref",
)


def _two(n):
    """A number with at least two digits."""
    text = n.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def thread_numbers(rows: DataFrame, known: DataFrame, source_type: str, prefix: str) -> DataFrame:
    """(key, thread_id): known threads keep their numbers; new ones follow, forum threads by first time and then origin, interviews by name.

    ``rows``: key, origin, timestamp; ``known``: source_type, key, n.
    """
    first = rows.groupBy("key").agg(F.min("timestamp").alias("t"), F.min("origin").alias("o"))
    held = known.filter(F.col("source_type") == source_type).select("key", "n")
    most = held.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    new = first.join(held, "key", "left_anti")
    place = F.row_number().over(Window.orderBy(F.asc_nulls_first("t"), "o", "key"))  # a row a thread of one study
    new = new.select("key", place.alias("p")).join(F.broadcast(most)).select("key", (F.col("most") + F.col("p")).alias("n"))
    both = held.join(first.select("key"), "key", "left_semi").unionByName(new)
    return both.select("key", "n", F.concat(F.lit(prefix), _two(F.col("n"))).alias("thread_id"))


def number(rows: DataFrame, threads: DataFrame, known_posts: DataFrame, letter: str) -> DataFrame:
    """Thread rows (key, place, parent_place, author, text ..) with post_id and parent_id; ``known_posts``: thread, key, n."""
    own = rows.join(threads.select("key", "thread_id"), "key")
    ids = conversation.stable_ids(own.select(F.col("place").alias("ord"), F.col("thread_id").alias("thread"), "author", "text"), known_posts)
    name = F.concat(F.col("thread"), F.lit(f"-{letter}"), _two(F.col("n")))
    ids = ids.select(F.col("thread").alias("thread_id"), F.col("ord").alias("place"), name.alias("post_id"))
    up = ids.select("thread_id", F.col("place").alias("parent_place"), F.col("post_id").alias("parent_id"))
    return own.join(ids, ["thread_id", "place"]).join(up, ["thread_id", "parent_place"], "left")


def posts(forum: DataFrame, interviews: DataFrame) -> DataFrame:
    """Numbered rows of both kinds as posts, with ``ord``: forum threads first, threads by id, posts in tree order."""

    def shaped(rows: DataFrame, source_type: str) -> DataFrame:
        have = {"source_type": F.lit(source_type), "thread_title": F.col("title") if "title" in rows.columns else F.lit(None), "raw_ref": F.col("ref")}
        kinds = {"start_s": "double", "end_s": "double", "timestamp": "timestamp_ntz", "score": "int", "date_approx": "boolean", "promotional": "boolean", "headline": "boolean"}
        empty = {"date_approx": False, "promotional": False, "headline": False}
        cells = []
        for c in POST:
            value = have.get(c) if c in have else F.col(c) if c in rows.columns else F.lit(empty.get(c))
            cells.append(value.cast(kinds.get(c, "string")).alias(c))
        return rows.select(*cells, "place")

    both = shaped(forum, "forum").unionByName(shaped(interviews, "interview"))
    order = F.struct((F.col("source_type") != "forum").alias("i"), F.col("thread_id").alias("t"), F.col("place").alias("p"))
    return both.withColumn("ord", order).drop("place")


def problems(rows: DataFrame) -> DataFrame:
    """(post_id, rule) of posts that break a rule, and of ids that occur twice."""
    twice = rows.groupBy("post_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("post_id", F.lit("id occurs twice").alias("rule"))
    return violations(rows, ["post_id"], POST_RULES).unionByName(twice)
