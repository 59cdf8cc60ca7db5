"""From sample and labels to records, and the sections that are counts: interviews, collection, rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import thresholds as t
from ..functions import text as x
from ..sources.rows import InputProblem

#: Tags that name a pattern, not a topic (fixed values).
PATTERN_TAGS = ("workaround", "request", "mental-model", "contradiction", "trust", "question")


def assemble(sample: DataFrame, posts: DataFrame, labels: DataFrame, aspect_variable: str | None = None) -> DataFrame:
    """Records of the measurement sample: its posts with overall score, aspects and stance from the labels (post_id, values: JSON).

    Every post of the sample needs a label; ``unlabelled`` names those without, and it is an error here.
    """
    missing = unlabelled(sample, labels).limit(5).collect()
    if missing:
        raise InputProblem("no label for " + ", ".join(r.post_id for r in missing))
    v = F.parse_json("values")
    own = labels.select("post_id", v.alias("v"))
    aspects = F.expr(f"try_variant_get(v, '$.{aspect_variable}', 'map<string,int>')") if aspect_variable else F.lit(None)
    coded = own.select(
        "post_id", F.expr("variant_get(v, '$.overall', 'int')").alias("overall"),
        F.coalesce(aspects.cast("map<string,int>"), F.create_map().cast("map<string,int>")).alias("aspects"), F.expr("try_variant_get(v, '$.stance', 'int')").alias("stance"),
    )
    forum = posts.filter("source_type = 'forum'").select("ord", "post_id", "person", "thread", "source", "search_term", "time")
    return sample.select("post_id").join(forum, "post_id").join(coded, "post_id")


def unlabelled(sample: DataFrame, labels: DataFrame) -> DataFrame:
    return sample.select("post_id").join(labels, "post_id", "left_anti")


def interview_counts(turns: DataFrame) -> DataFrame:
    """One row: transcripts, participants and their turns; ``turns``: thread, person, role."""
    said = F.col("role") == "participant"
    return turns.agg(F.count_distinct("thread").alias("transcripts"), F.count_distinct(F.when(said, F.col("person"))).alias("participants"), F.count_if(said).alias("turns"))


def interview_codes(turns: DataFrame, codes: DataFrame) -> DataFrame:
    """(variable, value, n): codes of participants' turns; a null is no code. ``codes``: post_id, variable, value."""
    said = turns.filter("role = 'participant'").select("post_id")
    return codes.filter("value IS NOT NULL").join(said, "post_id", "left_semi").groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def collection_sources(posts: DataFrame, log: DataFrame) -> DataFrame:
    """Each forum source: threads, posts, ways of capture, search terms, and searches logged; ``log``: source."""
    logged = log.groupBy("source").agg(F.count(F.lit(1)).alias("searches_logged"))
    own = posts.filter("source_type = 'forum'").groupBy("source").agg(
        F.count_distinct("thread").alias("threads"), F.count(F.lit(1)).alias("posts"), F.array_sort(F.collect_set("capture_method")).alias("capture"), F.array_sort(F.collect_set("search_term")).alias("search_terms")
    )
    return own.join(logged, "source", "left").fillna(0, ["searches_logged"])


def collection_totals(posts: DataFrame) -> DataFrame:
    forum = F.col("source_type") == "forum"
    day = F.when(forum, F.to_date("time"))
    return posts.agg(
        F.count_if(forum).alias("forum_posts"), F.count_distinct(F.when(forum & (F.col("role") == "participant"), F.col("person"))).alias("forum_people"),
        F.count_distinct(F.when(forum, F.col("thread"))).alias("forum_threads"), F.count_if(~forum).alias("interview_turns"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
    )


def search_totals(log: DataFrame) -> DataFrame:
    """One row: searches logged, neutral ones, results seen and kept, and searches that kept nothing."""
    some = lambda c: F.when(F.sum(c) > 0, F.sum(c)).alias(c)
    return log.agg(F.count(F.lit(1)).alias("logged"), F.count_if("neutral").alias("neutral"), some("results_seen"), some("kept"), F.count_if(F.col("kept") == 0).alias("kept_nothing"))


def round_changes(rounds: DataFrame) -> DataFrame:
    """Rounds (round, pct) with the change in points since the one before; null where either has no percentage."""
    before = rounds.select((F.col("round") + 1).alias("round"), F.col("pct").alias("_was"))
    return rounds.join(before, "round", "left").withColumn("change_pts", F.round(F.col("pct") - F.col("_was"), 1)).drop("_was")


def sample_summary(records: DataFrame) -> DataFrame:
    """One row: items, people, threads and status; word statistics are shown (``show_words``) only for a full sample."""
    out = records.agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("person").alias("n_people"), F.count_distinct("thread").alias("n_threads"))
    return out.withColumn("status", t.result_status(F.col("n_people"), F.col("n_items"))).withColumn("show_words", F.col("status") == "full")


def topics(notes: DataFrame) -> DataFrame:
    """(post_id, topic) of coded forum posts, for the heard-enough curve: tags that name topics; a post without any has one null."""
    rows = notes.filter("source_type = 'forum'").select("post_id", F.filter("tags", lambda x: ~x.isin(*PATTERN_TAGS)).alias("ts"))
    return rows.select("post_id", F.explode_outer("ts").alias("topic"))


def verdict(shares: DataFrame, drivers: DataFrame) -> DataFrame:
    """(verdict): a sentence that stays within the data; ``shares``: negative and positive rows of ``stats.shares``; ``drivers``: aspect, rank."""
    one = shares.agg(
        *[F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{m}_{c}") for m in ("negative", "positive") for c in ("pct", "k", "n")], F.max("status").alias("status")
    )
    small = F.col("status") == "early-signal"
    names = drivers.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "aspect"))), lambda r: r["aspect"]).alias("names"))
    top = F.slice("names", 1, F.when(small, 2).otherwise(3))
    listed = F.when(F.size(top) > 1, F.concat(F.array_join(F.slice(top, 1, F.size(top) - 1), ", "), F.lit(" and "), F.element_at(top, -1))).otherwise(F.array_join(top, ""))
    about = F.when(F.size(top) > 0, F.concat(F.when(small, ", mostly about ").otherwise(", driven by "), listed)).otherwise("")
    gap = F.col("negative_pct") - F.col("positive_pct")
    lead = F.when(small, "Leaning ").otherwise("Mostly ")
    mood = F.when(gap > 15, F.concat(lead, F.lit("negative"))).when(gap < -15, F.concat(lead, F.lit("positive"))).otherwise("Mixed")
    count = F.concat(F.lit("Too few people to measure: "), F.col("negative_k").cast("string"), F.lit(" of "), F.col("negative_n").cast("string"), F.lit(" sampled comments were negative"))
    tail = F.when(small, ", in a small sample").otherwise("")
    return one.crossJoin(F.broadcast(names)).select(F.when(F.col("status") == "counts-only", count).otherwise(F.concat(mood, about, tail)).alias("verdict"))  # one row each


def switching_posts(posts: DataFrame) -> DataFrame:
    """Forum participants' posts of eight or more words with a time, and whether they speak of switching."""
    own = posts.filter("source_type = 'forum' AND role = 'participant' AND time IS NOT NULL")
    return own.filter(x.n_words(F.col("text")) >= 8).select("time", "person", (x.lexicon_count(F.col("text"), "switching") > 0).alias("flagged"))
