"""Pasted forum pages: a page's lines become comments by window and array functions, and then a capture.

A comment starts at a line (the name) that is followed by at most two badges, a bullet and an age or an ad mark. Starts number the blocks of a page;
block 0 is its header. All of it is DataFrame operations; a page is one paste, so its lines are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as x

# Marks of the page layout.
AGE = r"^(\d+)\s?(s|m|min|h|hr|d|w|mo|y|yr)s?\.? ago$"
BADGES = ("OP", "MOD", "Mod", "ADMIN", "Admin")
FILLER = r"^(Continue this thread|View more comments|\d+ more repl(y|ies)|Reply|Share|Award|Downvote|.+ avatar)$"
BOT_TEXTS = ("i am a bot", "i detect haikus", "this action was performed automatically")
GONE = ("Comment deleted by user", "[deleted]", "[removed]")
DOMAIN = r"^[\w-]+(\.[\w-]+)+$"
COUNT = r"^-?\d+(\.\d+)?[kK]?$"
LEAST_STARTS = 3
LEAST_QUOTE = 20


def _lines(pages: DataFrame) -> DataFrame:
    """(file, captured, pos, s, age_at, block): lines with the block that they belong to."""
    split = F.split(F.regexp_replace("text", "\r\n", "\n"), "\n")
    rows = pages.select("file", "captured", F.posexplode(split).alias("pos", "s")).withColumn("s", F.trim("s"))
    w = Window.partitionBy("file").orderBy("pos")
    after = [F.lead("s", k).over(w) for k in range(1, 5)]
    rows = rows.withColumns({f"l{k + 1}": c for k, c in enumerate(after)})
    dated = lambda c: F.regexp_like(c, F.lit(AGE)) | (c == "Ad")
    badge = lambda c: F.col(c).isin(*BADGES)
    bullet = F.lit("•")
    age_at = (
        F.when((F.col("s") == "") | badge("s"), None)
        .when((F.col("l1") == bullet) & dated(F.col("l2")), 2)
        .when(badge("l1") & (F.col("l2") == bullet) & dated(F.col("l3")), 3)
        .when(badge("l1") & badge("l2") & (F.col("l3") == bullet) & dated(F.col("l4")), 4)
    )
    rows = rows.withColumn("age_at", age_at).drop("l1", "l2", "l3", "l4")
    return rows.withColumn("block", F.count("age_at").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def _first(lines: Column, test) -> Column:
    return F.try_element_at(F.filter(lines, test), F.lit(1))


def _filled(lines: Column) -> Column:
    return F.filter(lines, lambda s: s != "")


def parse(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pages`` (file, text, captured date) -> headers (a row a page) and comments (file, nth, author, op, date, score, text, status).

    ``recognised`` is false for pages with fewer than three comment starts; they have no comments.
    """
    lines = _lines(pages)
    blocks = lines.groupBy("file", "captured", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda r: r["s"]).alias("ls"), F.max(F.when(F.col("age_at").isNotNull(), F.struct(-F.col("pos"), "age_at"))["age_at"]).alias("age_at")
    )
    size = Window.partitionBy("file")
    blocks = blocks.withColumn("starts", F.max("block").over(size))
    return _headers(blocks, lines, pages), _comments(blocks.filter(f"block > 0 AND starts >= {LEAST_STARTS}"))


def _comments(blocks: DataFrame) -> DataFrame:
    own = blocks.select(
        "file", "captured", "block", F.col("ls")[0].alias("author"), F.array_contains(F.slice("ls", 2, F.col("age_at") - 1), "OP").alias("op"),
        F.expr("ls[age_at]").alias("age"), F.expr("slice(ls, age_at + 2, size(ls))").alias("body"),
    )
    up = F.array_position("body", F.lit("Upvote")).cast("int")
    full = F.array_max(F.transform("body", lambda s, i: F.when((s == "") | F.regexp_like(s, F.lit(FILLER)), 0).otherwise(i + 1)))
    own = own.withColumns({"up": up, "end": F.coalesce(full, F.lit(0))})
    last = F.expr("IF(end > 0, body[end - 1], NULL)")
    counted = F.coalesce(F.regexp_like(last, F.lit(COUNT)), F.lit(False))
    marked = F.col("up") > 0
    following = _first(F.expr("slice(body, up + 1, size(body))"), lambda s: s != "")
    own = own.withColumn("score", F.when(marked, x.votes(following)).when(counted, x.votes(last)))
    own = own.withColumn("stop", F.when(marked, F.col("up") - 1).otherwise(F.col("end") - counted.cast("int")))
    said = F.expr("slice(body, 1, stop)")
    lead = lambda s: s.startswith("Edited ") | s.startswith("Profile Badge") | (s == "•") | (s == "Comment Image")
    own = own.withColumn("said", said)
    begin = F.array_min(F.transform("said", lambda s, i: F.when(~lead(s), i + 1)))
    own = own.withColumn("said", F.when(begin.isNotNull(), F.filter(F.slice("said", begin, F.size("said")), lambda s: s != "Comment Image")).otherwise(F.array().cast("array<string>")))
    text = F.regexp_replace(F.regexp_replace(F.array_join("said", "\n"), r"^\s+|\s+$", ""), r"\n{3,}", "\n\n")
    own = own.withColumn("text", text)
    name = F.lower("author")
    bot = (name == "automoderator") | name.endswith("bot")
    for b in BOT_TEXTS:
        bot = bot | F.contains(F.lower("text"), F.lit(b))
    status = (
        F.when(F.col("age") == "Ad", "ad")
        .when((F.col("author") == "[deleted]") | F.col("text").isin(*GONE), "deleted")
        .when(bot, "bot")
        .when(F.col("text") == "", "image_only")
        .otherwise("comment")
    )
    own = own.withColumn("status", status)
    nth = F.when(F.col("status") == "comment", F.count_if(F.col("status") == "comment").over(Window.partitionBy("file").orderBy("block")))
    return own.select("file", "block", nth.alias("nth"), "author", "op", x.age_to_date(F.col("age"), F.col("captured")).alias("date"), "score", "text", "status")


def _headers(blocks: DataFrame, lines: DataFrame, pages: DataFrame) -> DataFrame:
    more = F.sum(F.regexp_extract("s", r"^(\d+) more repl(?:y|ies)$", 1).try_cast("int")).alias("more_replies")
    folded = lines.groupBy("file").agg(F.coalesce(more, F.lit(0)).alias("more_replies"), F.count_if(F.col("s").isin("Continue this thread", "View more comments")).alias("continue_threads"))
    starts = lines.groupBy("file").agg(F.max("block").alias("starts"))
    head = blocks.filter("block = 0").select("file", F.col("ls").alias("h"))
    head = pages.select("file", "captured").join(starts, "file").join(head, "file", "left").withColumn("h", F.coalesce("h", F.array().cast("array<string>")))
    community = F.regexp_extract(F.coalesce(_first(F.col("h"), lambda s: F.regexp_like(s, F.lit(r"^r/\w+ - "))), F.lit("")), r"^(r/\w+) - ", 1)
    head = head.withColumns({"community": F.when(community != "", community), "title": F.coalesce(_first(F.col("h"), lambda s: s != ""), F.lit(""))})
    place = lambda test: F.array_min(F.transform("h", lambda s, i: F.when(test(s), i + 1)))
    head = head.withColumns({"up": F.array_position("h", F.lit("Upvote")).cast("int"), "open": F.array_position("h", F.lit("Open")).cast("int")})
    mark = F.when(F.col("up") > 0, F.col("up")).when(F.col("open") > 0, F.col("open"))
    head = head.withColumn("votes", F.when(mark.isNotNull(), x.votes(_first(F.slice("h", mark + 1, F.size("h")), lambda s: s != ""))))
    head = head.withColumns({"stop": F.coalesce(place(lambda s: s.isin("Open", "Upvote")), F.size("h") + 1), "named": F.when(F.col("community").isNotNull(), place(lambda s: s.startswith(F.col("community"))))})
    head = head.withColumn("begin", F.when(F.col("named").isNotNull(), F.col("named") + 1).otherwise(2))
    domain = lambda s: F.regexp_like(s, F.lit(DOMAIN))
    at_begin = F.try_element_at("h", "begin")
    head = head.withColumn("begin", F.col("begin") + F.when((F.col("begin") < F.col("stop")) & domain(at_begin), 1).otherwise(0))
    head = head.withColumn("body", F.when(F.col("begin") < F.col("stop"), F.slice("h", F.col("begin"), F.col("stop") - F.col("begin"))).otherwise(F.array().cast("array<string>")))
    tail = lambda s: F.regexp_like(s, F.lit(COUNT)) | s.isin("·", "") | s.endswith(" avatar")
    kept = F.coalesce(F.array_max(F.transform("body", lambda s, i: F.when(~tail(s), i + 1))), F.lit(0))
    head = head.withColumn("kept", kept)
    dropped = F.expr("reverse(slice(body, kept + 1, size(body)))")
    in_body = x.votes(_first(dropped, lambda s: F.regexp_like(s, F.lit(COUNT))))
    linked = F.exists(F.slice("h", 1, F.col("stop") - 1), domain)
    text = F.trim(F.array_join(_filled(F.expr("slice(body, 1, kept)")), "\n"))
    return head.join(folded, "file").select(
        "file", "captured", (F.col("starts") >= LEAST_STARTS).alias("recognised"), "community", "title", linked.alias("link_post"), text.alias("post_text"),
        F.coalesce("votes", in_body).alias("post_votes"), "more_replies", "continue_threads",
    )


def split_quotes(comments: DataFrame, openings: DataFrame) -> DataFrame:
    """``parent`` (nth of an earlier post, the latest that fits) and ``text`` without its first paragraph, where that is quoted from there.

    ``comments``: file, nth (from 1), text; ``openings``: file, text, the post itself, which is nth 0. Whether a paragraph is a quote does not
    change when quotes are taken out of earlier posts: what an earlier post quotes stands in one before it.
    """
    parts = F.split("text", "\n\n")
    own = comments.select("file", "nth", "text", F.trim(F.regexp_replace(parts[0], "^>+", "")).alias("first"), F.size(parts).alias("n"))
    asked = own.filter((F.col("n") > 1) & (F.length("first") >= LEAST_QUOTE)).select("file", "nth", "first")
    before = openings.select("file", F.lit(0).alias("at"), F.col("text").alias("said")).unionByName(own.select("file", F.col("nth").alias("at"), F.col("text").alias("said")))
    fits = lambda said: asked.join(said, "file").filter((F.col("at") < F.col("nth")) & F.contains("said", F.col("first")))
    quoting = fits(before).select("file", F.col("nth").alias("at")).distinct().withColumn("_q", F.lit(True))
    rest = F.trim(F.expr("substring(said, locate('\n\n', said) + 2)"))
    stripped = before.join(quoting, ["file", "at"], "left").withColumn("said", F.when(F.col("_q"), rest).otherwise(F.col("said"))).drop("_q")
    found = fits(stripped).groupBy("file", "nth").agg(F.max("at").alias("parent"))
    out = comments.join(found, ["file", "nth"], "left")
    return out.withColumn("text", F.when(F.col("parent").isNotNull(), F.trim(F.expr("substring(text, locate('\n\n', text) + 2)"))).otherwise(F.col("text")))


def to_captures(headers: DataFrame, comments: DataFrame) -> DataFrame:
    """Recognised pages as capture posts: file, site, id (p1 ..), author, date, date_approx, parent, score, text, headline."""
    said = comments.filter("status = 'comment'")
    facts = said.groupBy("file").agg(F.min("date").alias("first"), F.min_by("author", F.when(F.col("op"), F.col("nth"))).alias("op"))
    head = headers.filter("recognised").join(facts, "file", "left")
    text = F.when(F.col("link_post") | (F.col("post_text") == ""), F.col("title")).otherwise(F.col("post_text"))
    opening = head.select(
        "file", F.lit(0).alias("nth"), F.col("op").alias("author"), F.col("first").alias("date"), F.lit(None).cast("int").alias("parent"),
        F.col("post_votes").alias("score"), text.alias("text"), F.col("link_post").alias("headline"),
    )
    replies = split_quotes(said.select("file", F.col("nth").cast("int").alias("nth"), "author", "date", "score", "text"), opening.select("file", "text"))
    posts = opening.unionByName(replies.select("file", "nth", "author", "date", "parent", "score", "text", F.lit(False).alias("headline")))
    name = lambda c: F.concat(F.lit("p"), (F.col(c) + 1).cast("string"))
    site = F.when(F.col("community").isNotNull(), F.concat(F.lit("forum/"), "community")).otherwise("forum").alias("site")
    return posts.join(head.select("file", site, "title", "captured"), "file").select(
        "file", "site", "title", "captured", "nth", name("nth").alias("id"), "author", "date", F.col("date").isNotNull().alias("date_approx"),
        F.when(F.col("parent").isNotNull(), name("parent")).alias("parent"), "score", "text", "headline",
    )
