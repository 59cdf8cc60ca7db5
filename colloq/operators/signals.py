"""Language signals of posts: lexicon counts, reply echoes, response gaps, densities and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import thresholds as t
from ..functions import text as x
from ..functions.lexicon import ECHO_MAX_WORDS, HESITATION, LEXICON

LEXICAL_FLAGS = {
    "constraint": "constraint_language",
    "implicit_request": "implicit_request",
    "workaround": "workaround_language",
    "switching": "switching_language",
}
RATE_FLAGS = (*LEXICAL_FLAGS.values(), "hesitation_cluster")


def counts(posts: DataFrame, categories=tuple(LEXICON)) -> DataFrame:
    """A column ``n_<category>`` for each category."""
    return posts.withColumns({f"n_{c}": x.lexicon_count(F.col("text"), c) for c in categories})


def response_gap(turns: DataFrame) -> DataFrame:
    """Seconds since the turn before, where that is no participant's; ``turns``: thread, ord, role, start_s, end_s."""
    w = Window.partitionBy("thread").orderBy("ord")
    asked = F.lag("role").over(w) != "participant"
    gap = F.round(F.col("start_s") - F.lag("end_s").over(w), 2)
    return turns.withColumn("response_gap_s", F.when(asked & (F.col("role") == "participant"), gap))


def reply_echoes(posts: DataFrame) -> DataFrame:
    """(post_id, n_replies, echo_agree, echo_disagree) of participants' replies, from one aggregation by parent."""
    short = x.n_words(F.col("text")) <= ECHO_MAX_WORDS
    replies = posts.filter("parent_id IS NOT NULL AND role = 'participant'").groupBy(F.col("parent_id").alias("post_id"))
    return replies.agg(
        F.count(F.lit(1)).alias("n_replies"),
        F.count_if(short & x.agrees(F.col("text"))).alias("echo_agree"),
        F.count_if(short & x.disagrees(F.col("text"))).alias("echo_disagree"),
    )


def density(posts: DataFrame) -> DataFrame:
    """Hesitation markers per 100 words (20 words at least), of participants."""
    own = counts(posts.filter("role = 'participant'")).withColumn("words", x.n_words(F.col("text")))
    own = own.withColumn("hesitation", sum((F.col(f"n_{c}") for c in HESITATION), F.lit(0)))
    return own.withColumn("density", F.round(100.0 * F.col("hesitation") / F.greatest("words", F.lit(20)), 2))


def thread_stats(signals: DataFrame) -> DataFrame:
    """(thread, mean, sd, score_cut): densities of posts of 8 or more words, and the score at int(.9 (n - 1)), 5 at least.

    The cut is found by counting scores, not by gathering a thread's posts.
    """
    own = signals.groupBy("thread").agg(
        F.coalesce(F.avg(F.when(F.col("words") >= 8, F.col("density"))), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_pop(F.when(F.col("words") >= 8, F.col("density"))), F.lit(0.0)).alias("sd"),
        F.count(F.lit(1)).alias("n"),
    )
    score = F.coalesce("score", F.lit(0)).alias("s")
    by_score = signals.groupBy("thread", score).agg(F.count(F.lit(1)).alias("m"))
    upto = F.sum("m").over(Window.partitionBy("thread").orderBy("s"))
    at = by_score.withColumn("upto", upto).join(own.select("thread", "n"), "thread")
    cut = at.filter(F.col("upto") > F.floor(0.9 * (F.col("n") - 1))).groupBy("thread").agg(F.min("s").alias("s"))
    return own.join(cut, "thread").select("thread", "mean", "sd", F.greatest("s", F.lit(5)).alias("score_cut"))


def signals(posts: DataFrame, gap_s: float = 2.0, sd_mult: float = 1.0) -> DataFrame:
    """All signals of participants' posts with their flags; ``posts`` may carry start_s and end_s for interviews."""
    base = posts if "start_s" in posts.columns else posts.withColumns({"start_s": F.lit(None).cast("double"), "end_s": F.lit(None).cast("double")})
    own = density(response_gap(base)).join(reply_echoes(posts), "post_id", "left")
    own = own.fillna(0, ["n_replies", "echo_agree", "echo_disagree"]).join(thread_stats(own), "thread")
    forum = F.col("source_type") == "forum"
    cluster = ~forum & (F.col("words") >= 8) & (F.col("hesitation") >= 3) & (F.col("density") >= F.col("mean") + sd_mult * F.col("sd")) & (F.col("sd") > 0)
    engaged = forum & (F.col("words") >= 5) & ((F.coalesce("score", F.lit(0)) >= F.col("score_cut")) | (F.col("echo_agree") >= 2))
    flags = [
        F.when(cluster, "hesitation_cluster"),
        *[F.when(F.col(f"n_{c}") > 0, f) for c, f in LEXICAL_FLAGS.items()],
        F.when(F.col("response_gap_s") >= gap_s, "long_response_gap"),
        F.when(engaged, "high_engagement"),
    ]
    return own.withColumn("flags", F.filter(F.array(*flags), lambda f: f.isNotNull()))


def thread_summary(found: DataFrame) -> DataFrame:
    """Rates per 100 words and flag counts of each thread."""
    words = F.greatest(F.sum("words"), F.lit(1))
    rates = [F.round(100.0 * F.sum(f"n_{c}") / words, 2).alias(f"{c}_rate") for c in LEXICON]
    return found.groupBy("thread").agg(F.count(F.lit(1)).alias("turns"), F.sum("words").alias("words"), *rates, F.sum(F.size("flags")).alias("n_flags"))


def flag_counts(found: DataFrame) -> DataFrame:
    """(thread, flag, n) of forum threads, without the flags that only interviews have."""
    rows = found.filter("source_type = 'forum'").select("thread", F.explode("flags").alias("flag"))
    return rows.filter(~F.col("flag").isin("hesitation_cluster", "long_response_gap")).groupBy("thread", "flag").agg(F.count(F.lit(1)).alias("n"))


def signal_rates(found: DataFrame) -> DataFrame:
    """Each flag's share of forum posts of 5 or more words."""
    base = found.filter("source_type = 'forum' AND words >= 5")
    out = base.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("person").alias("n_people"), *[F.count_if(F.array_contains("flags", f)).alias(f) for f in RATE_FLAGS]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("k")) for f in RATE_FLAGS])).alias("r")
    out = out.select("n", "n_people", rows).select("r.flag", "r.k", "n", "n_people")
    out = out.withColumn("status", t.result_status(F.col("n_people"), F.col("n")))
    return out.withColumn("pct", F.when(F.col("status") != "counts-only", t.pct(F.col("k"), F.col("n"))))


def switching_by_period(posts: DataFrame, unit: str) -> DataFrame:
    """Posts of 8 or more words with switching language, by period."""
    base = posts.filter("source_type = 'forum' AND role = 'participant' AND time IS NOT NULL").filter(x.n_words(F.col("text")) >= 8)
    hit = x.lexicon_count(F.col("text"), "switching") > 0
    out = base.groupBy(x.period_key(F.col("time"), unit).alias("period")).agg(
        F.count_if(hit).alias("k"), F.count(F.lit(1)).alias("n"), F.count_distinct("person").alias("n_people")
    )
    return out.withColumn("status", t.result_status(F.col("n_people"), F.col("n")))
