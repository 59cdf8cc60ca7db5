"""Capture files: transcribed forum threads, one JSON object a file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import conversation, matching
from ..workspace import written
from .rows import union

SCHEMA = (
    "source_file string, site string, url string, captured string, thread_title string, search_query string, "
    "posts array<struct<id: string, author: string, date: string, date_approx: boolean, parent: string, score: int, text: string, headline: boolean>>, _bad string"
)
# Suffixes of pastes and of images.
TEXTS = (".txt", ".md", ".html", ".htm")
IMAGES = (".png", ".jpg", ".jpeg", ".webp", ".gif")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Capture files as rows, with ``file``; what is no JSON has ``_bad``."""
    rows = spark.read.schema(SCHEMA).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.select("*", F.col("_metadata.file_name").alias("file"))


def _date(c):
    return F.when(F.regexp_like(c, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$")), F.try_to_date(c, "yyyy-M-d"))


def _suffix(c):
    return F.lower(F.regexp_extract(c, r"(\.[^./]+)$", 1))


def items(captures: DataFrame) -> DataFrame:
    """A row a captured post: file, its place there (``nth``), and its fields, with straight quotes."""
    each = captures.select("file", "source_file", "site", "thread_title", "search_query", F.posexplode("posts").alias("nth", "p"))
    rows = each.select("file", "source_file", "site", "thread_title", "search_query", "nth", "p.*")
    return rows.withColumn("text", F.trim(x.clean_quotes(F.coalesce("text", F.lit("")))))


def problems(captures: DataFrame, sources: DataFrame) -> DataFrame:
    """(file, id, problem): all that is wrong; ``sources`` (source_file) lists the files that exist.

    A file that cannot be used has its first problem; others have all problems of their posts. Posts are rows that meet the ids of
    their capture in a join, so no row holds the ids of a whole file.
    """
    known = captures.join(sources.select("source_file").distinct().withColumn("_there", F.lit(True)), "source_file", "left")
    whole = (
        F.when(F.col("_bad").isNotNull(), "not valid JSON")
        .when(F.col("_there").isNull(), "source file not found")
        .when(~_suffix(F.col("source_file")).isin(*TEXTS, *IMAGES), "source file is neither text nor image")
        .when(F.coalesce(F.size("posts"), F.lit(0)) < 1, "no posts")
    )
    judged = known.withColumn("problem", whole).withColumn("_c", F.monotonically_increasing_id())
    each = judged.select("_c", "file", "problem", F.explode_outer(F.when(F.col("problem").isNull(), F.col("posts"))).alias("p"))
    told = each.select("_c", "file", "problem", "p.id", "p.parent", (F.trim(F.coalesce("p.text", F.lit(""))) == "").alias("_empty"), ((F.coalesce("p.date", F.lit("")) != "") & _date(F.col("p.date")).isNull()).alias("_undated"))
    told = written(told, "capture-posts")  # a row a post, or a file that cannot be used
    posts = told.filter("problem IS NULL").withColumn("_id", F.coalesce("id", F.lit("")))
    ids = posts.groupBy("_c", "_id").agg(F.count(F.lit(1)).alias("n"), F.first("file").alias("file"))
    say = lambda df, problem: df.select("file", "id", F.lit(problem).alias("problem"))
    twice = ids.filter("n > 1").select("_c", "file").distinct().withColumn("id", F.lit(None).cast("string"))
    lost = posts.filter("parent <> ''").join(ids.select("_c", F.col("_id").alias("parent")), ["_c", "parent"], "left_anti")
    parts = [say(twice, "duplicate post ids"), say(posts.filter("_empty"), "empty text"), say(lost, "parent not in this capture"), say(posts.filter("_undated"), "date is not YYYY-MM-DD")]
    return union([told.filter("problem IS NOT NULL").select("file", F.lit(None).cast("string").alias("id"), "problem"), *parts])


def warnings(captures: DataFrame) -> DataFrame:
    return captures.filter(F.col("_bad").isNull() & _date(F.col("captured")).isNull()).select("file", F.lit("no valid captured date").alias("warning"))


def deduplicated(posts: DataFrame) -> DataFrame:
    """``posts`` (of ``items``) without exact copies and near copies of what came before, over all files in their order."""
    own = posts.withColumn("ord", F.concat_ws("\u0000", "file", F.lpad(F.col("nth").cast("string"), 10, "0")))
    exact = matching.exact_drop(own).filter(~F.col("dropped")).drop("dropped")
    kept = matching.near_kept(exact.select(F.col("ord").alias("id"), "text")).filter("kept").select(F.col("id").alias("ord"))
    return exact.join(kept, "ord", "left_semi").drop("ord")


def threads(posts: DataFrame) -> DataFrame:
    """Posts as thread rows in reply order: key, place, parent_place, kind, timestamp, flags, method."""
    tree = conversation.reply_tree(posts.select(F.col("file").alias("thread"), "id", "parent", F.lit(0).alias("score"), F.col("nth").alias("ord")), by_score=False)
    tree = tree.withColumnRenamed("thread", "file")
    own = posts.join(tree, ["file", "id"])
    first = own.groupBy("file").agg(F.min("nth").alias("_first"))
    above = tree.select("file", F.col("id").alias("parent"), F.col("place").alias("parent_place"))
    own = own.join(first, "file").join(above, ["file", "parent"], "left")
    opening = (F.col("place") == 1) & (F.col("depth") == 0) & (F.col("nth") == F.col("_first"))
    day = _date(F.col("date"))
    return own.select(
        F.col("file").alias("key"), F.coalesce("site", F.lit("unknown site")).alias("source"), F.col("thread_title").alias("title"), F.col("search_query").alias("search_term"),
        "place", "parent_place", F.when(opening, "post").otherwise("comment").alias("kind"), F.when(F.trim("author") != "", F.col("author")).alias("author"),
        F.lit("participant").alias("role"), (day.cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).alias("timestamp"),
        (F.coalesce("date_approx", F.lit(False)) & day.isNotNull()).alias("date_approx"), "score", x.is_promotional(F.col("text")).alias("promotional"),
        (F.coalesce("headline", F.lit(False)) & (F.col("nth") == F.col("_first"))).alias("headline"), "text",
        F.when(_suffix(F.col("source_file")).isin(*IMAGES), "screenshot").otherwise("paste").alias("capture_method"), F.concat_ws("#", "source_file", "id").alias("ref"),
    )
