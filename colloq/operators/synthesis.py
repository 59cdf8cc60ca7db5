"""Counts over coded notes: groups, forces, opportunities, tags, picks, and hypotheses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import thresholds as t
from ..functions import text as x
from ..workspace import written
from . import matching, stats

FORCES = ("push", "pull", "anxiety", "habit")
ENTITY = r"^(product|entity|brand):"


def voices() -> list[Column]:
    inside = F.col("source_type") == "interview"
    return [
        F.count_distinct("person").alias("voices"),
        F.count_distinct(F.when(~inside, F.col("person"))).alias("forum"),
        F.count_distinct(F.when(inside, F.col("person"))).alias("interview"),
    ]


def group(notes: DataFrame, key: str = "aspect") -> DataFrame:
    """Notes, people, severity and strong ones of each group."""
    sev = F.coalesce("severity", F.lit(0))
    return notes.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *voices(), F.max(sev).alias("max_sev"), F.round(F.avg(sev), 1).alias("mean_sev"), F.count_if("strong").alias("strong")
    )


def pains(notes: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(F.desc(F.col("voices") * F.col("max_sev")), F.desc("n"), "aspect"))
    return group(notes.filter("friction")).withColumn("rank", rank)


def successes(notes: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(F.desc("voices"), F.desc("n"), "aspect"))
    return group(notes.filter("success")).withColumn("rank", rank)


def force_balance(notes: DataFrame, key: str) -> DataFrame:
    return notes.groupBy(key).agg(*[F.count_if(F.col("force") == f).alias(f) for f in FORCES], F.count(F.lit(1)).alias("n"), *voices())


def forces_reach(notes: DataFrame) -> DataFrame:
    return notes.filter(F.col("force").isin(*FORCES)).groupBy("force").agg(F.count(F.lit(1)).alias("n"), *voices())


def opportunity_rank(notes: DataFrame, key: str = "aspect") -> DataFrame:
    """voices x (1 + mean severity of friction)."""
    sev = F.round(F.coalesce(F.avg(F.when(F.col("friction"), F.coalesce("severity", F.lit(0)))), F.lit(0.0)), 1)
    out = notes.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *voices(), sev.alias("mean_sev"))
    return out.withColumn("rank_score", F.round(F.col("voices") * (1 + F.col("mean_sev")), 2))


def products(notes: DataFrame) -> DataFrame:
    rows = notes.withColumn("tag", F.explode("tags")).filter(F.col("tag").rlike(ENTITY)).withColumn("name", F.regexp_replace("tag", "^[^:]*:", ""))
    forces = [F.count_if(F.col("force") == f).alias(f) for f in FORCES]
    return rows.groupBy("name").agg(*forces, F.count(F.lit(1)).alias("n"), F.count_distinct("person").alias("voices"), (F.round(F.avg("sentiment"), 2) + 0.0).alias("mean_sentiment"))


def tag_pairs(notes: DataFrame, least: int = 2, top: int = 15) -> DataFrame:
    """Unordered pairs of a note's tags; a note has a handful of tags, so its pairs are few."""
    tags = F.array_sort(F.array_distinct(F.filter("tags", lambda x: ~x.rlike(ENTITY))))
    pairs = notes.select(tags.alias("ts")).select("ts", F.explode("ts").alias("a")).select("a", F.explode("ts").alias("b")).filter("a < b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), "a", "b").limit(top)


def evidence_mix(notes: DataFrame) -> DataFrame:
    return notes.groupBy("evidence").agg(F.count(F.lit(1)).alias("n"))


def diverse_pick(notes: DataFrame, k: int = 3) -> DataFrame:
    """Up to k notes an aspect: distinct people first, then strong, severe and well scored ones."""
    order = [F.desc("strong"), F.desc(F.coalesce("severity", F.lit(0))), F.desc(F.coalesce("score", F.lit(0))), "ord"]
    own = F.row_number().over(Window.partitionBy("aspect", "person").orderBy(*order))
    first = notes.withColumn("own", own).filter(F.col("own") <= k)
    rank = F.row_number().over(Window.partitionBy("aspect").orderBy(F.col("own") > 1, *order))
    return first.withColumn("rank", rank).filter(F.col("rank") <= k).select("aspect", "post_id", "rank")


def unexamined(detail: DataFrame, notes: DataFrame, top: int = 12) -> DataFrame:
    """Flagged posts without a note, best scored first."""
    rest = detail.filter(F.size("flags") > 0).join(notes.select("post_id"), "post_id", "left_anti")
    return rest.orderBy(F.desc(F.coalesce("score", F.lit(0))), "ord").limit(top)


def orphans(cited: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Cited ids that do not exist."""
    return cited.join(known.select(key), key, "left_anti")


# --- Hypotheses -----------------------------------------------------------------------------------------------------


def lean(p: Column) -> Column:
    return F.when(p >= t.LEAN_FOR, "for").when(p <= t.LEAN_AGAINST, "against").otherwise("unclear")


def aspect_measures(records: DataFrame, kind: str) -> DataFrame:
    """Measures of each aspect for replicates: share_of_negative, negative_rate or mention_rate."""
    rows = stats.aspect_rows(records)
    neg = F.col("score") < 0
    if kind == "negative_rate":
        return stats.measure(rows, F.col("aspect"), neg)
    own = stats.measure(rows, F.col("aspect"), neg if kind == "share_of_negative" else F.lit(1), F.lit(0), F.lit(True))
    base = rows.filter(neg) if kind == "share_of_negative" else records
    names = F.broadcast(rows.select("aspect").distinct())  # aspects of a codebook
    return own.unionByName(stats.measure(base.drop("aspect").join(names), F.col("aspect"), F.lit(0), F.lit(1)))


def greater(records: DataFrame, kind: str, a: str, b: str, by: str, draws: int, seed: int) -> DataFrame:
    """Percent of draws, of those that can tell, in which aspect a's measure is greater than b's, and its lean."""
    reps = stats.replicates(aspect_measures(records, kind), by, draws, seed)
    rate = F.coalesce("rate", F.lit(0.0)) if kind == "share_of_negative" else F.col("rate")
    wide = reps.groupBy("draw").agg(F.max(F.when(F.col("measure") == a, rate)).alias("ra"), F.max(F.when(F.col("measure") == b, rate)).alias("rb"))
    known = wide.filter("ra IS NOT NULL AND rb IS NOT NULL")
    out = known.agg((100.0 * F.count_if(F.col("ra") > F.col("rb")) / F.count(F.lit(1))).alias("probability"))
    return out.withColumn("lean", lean(F.col("probability")))


def above(records: DataFrame, kind: str, threshold: float, by: str, draws: int, seed: int) -> DataFrame:
    """For each aspect the percent of draws in which its measure is above a threshold."""
    reps = stats.replicates(aspect_measures(records, kind), by, draws, seed).filter("rate IS NOT NULL")
    out = reps.groupBy("measure").agg((100.0 * F.count_if(F.col("rate") > threshold) / F.count(F.lit(1))).alias("probability"))
    return out.withColumn("lean", lean(F.col("probability")))


def voices_lean(notes: DataFrame, side: Column) -> DataFrame:
    """Voices for and against: two or more, and twice the other side's."""
    out = notes.withColumn("_s", side).agg(
        F.count_distinct(F.when(F.col("_s") == "for", F.col("person"))).alias("voices_for"), F.count_distinct(F.when(F.col("_s") == "against", F.col("person"))).alias("voices_against")
    )
    f, a = F.col("voices_for"), F.col("voices_against")
    return out.withColumn("lean", F.when((f >= 2) & (f >= 2 * a), "for").when((a >= 2) & (a >= 2 * f), "against").otherwise("unclear"))


def proportion_range(people: DataFrame, draws: int, seed: int) -> DataFrame:
    """Range of a share of people (person, hit), by drawing people again; null for fewer than 20."""
    m = people.select(F.lit("proportion").alias("measure"), "person", F.lit("t").alias("thread"), F.col("hit").cast("bigint").alias("num"), F.lit(1).cast("bigint").alias("den"), F.lit(True).alias("rests"))
    return stats.shares(m).join(stats.ranges(m, "person", draws, seed), "measure").drop("measure")


def probability(hits: DataFrame) -> DataFrame:
    """(probability) from a hit (true, false, null: cannot tell) of each draw of one resampling."""
    return hits.filter("hit IS NOT NULL").agg(F.round(100.0 * F.count_if("hit") / F.count(F.lit(1)), 1).alias("probability"))


def judged(signals: DataFrame, hypotheses: DataFrame, sample_items: int, sample_people: int) -> DataFrame:
    """Lean, strength and priority of hypotheses (id, origin, importance) from their signals (id, lean, voices, measured).

    ``voices`` counts the people a signal rests on; a measured one that leans rests on the whole sample.
    """
    small = sample_items < t.MIN_ITEMS_FOR_FULL
    said = F.col("lean") != "unclear"
    each = signals.groupBy("id").agg(
        F.coalesce(F.bool_or(F.when(said, F.col("lean") == "for")), F.lit(False)).alias("f"), F.coalesce(F.bool_or(F.when(said, F.col("lean") == "against")), F.lit(False)).alias("a"),
        F.max(F.when(F.col("measured") & said, F.greatest("voices", F.lit(sample_people))).otherwise(F.col("voices"))).alias("voices"),
    )
    rows = hypotheses.join(each, "id", "left").fillna(False, ["f", "a"]).fillna(0, ["voices"])
    leans = F.when(F.col("f") & F.col("a"), "mixed").when(F.col("f"), "leans for").when(F.col("a"), "leans against").otherwise("can't tell from this data")
    strength = F.when((F.col("voices") < 5) | F.lit(small), "weak").when(F.col("voices") < 15, "moderate").otherwise("strong")
    rows = rows.withColumn("lean", leans).withColumn("strength", strength)
    evidenced = (F.col("strength") != "weak") & F.col("lean").isin("leans for", "leans against")
    priority = F.when(F.col("importance") == "low", "park for now").when(F.col("origin") == "formed", "test first").when(evidenced, "build on it, keep checking").otherwise("test first")
    warning = F.when((F.col("origin") == "formed") & (F.col("lean") == "leans against"), "formed from this data, which leans against it")
    return rows.select("id", "origin", "importance", "lean", "strength", "voices", priority.alias("priority"), warning.alias("warning"))


def one_sided(verdicts: DataFrame) -> DataFrame:
    """A row with a warning if there are only stated hypotheses and all lean for."""
    out = verdicts.agg(F.bool_and((F.col("origin") == "stated") & (F.col("lean") == "leans for")).alias("all"))
    return out.filter("all").select(F.lit("only stated hypotheses, all leaning for: add a rival").alias("warning"))


def proportion_lean(ranges: DataFrame) -> DataFrame:
    """Lean of a share of people by its range: wholly above 50, wholly below, or unclear (also without a range)."""
    shown = F.col("status") != "counts-only"
    return ranges.withColumn("lean", F.when(shown & (F.col("lo") > 50), "for").when(shown & (F.col("hi") < 50), "against").otherwise("unclear"))


# --- What notes rest on ----------------------------------------------------------------------------------------------------


def nuggets(observations: DataFrame, detail: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Observations (ord, post_id, observation, quote) with their posts and codes, and (post_id, level, problem) about them.

    An observation needs a post of the detail selection (post_id, person, source_type, text), one a post, whose text holds the quote.
    """
    nth = F.row_number().over(Window.partitionBy("post_id").orderBy("ord"))
    known = observations.withColumn("nth", nth).join(detail, "post_id", "left").withColumn("_in", F.col("text").isNotNull())
    first = known.filter("_in AND nth = 1")
    checked = matching.elided_check(first.withColumnsRenamed({"quote": "said", "text": "source"})).withColumnsRenamed({"said": "quote", "source": "text"})
    full = written(checked.join(codes.withColumn("_coded", F.lit(True)), "post_id", "left"), "nuggets")
    say = lambda df, level, problem: df.select("post_id", F.lit(level).alias("level"), F.lit(problem).alias("problem"))
    found = [
        say(known.filter("NOT _in"), "error", "not in the detail selection"),
        say(known.filter("_in AND nth > 1"), "error", "a post gets one observation"),
        say(full.filter(F.col("status").isin("tidied", "failed")), "error", "the quote is not verbatim"),
        say(full.filter(x.n_words(F.col("quote")) < 3), "warning", "very short quote"),
        say(full.filter(x.loose(F.col("observation")) == x.loose(F.col("quote"))), "warning", "the observation repeats the quote"),
        say(full.filter("_coded IS NULL"), "warning", "not coded yet"),
        say(full.filter("evidence = 'observed' AND source_type = 'forum'"), "warning", "coded as observed, from a forum"),
    ]
    problems = found[0]
    for more in found[1:]:
        problems = problems.unionByName(more)
    return full.drop("nth", "_in", "_coded"), problems


def cite_problems(cites: DataFrame, notes: DataFrame) -> DataFrame:
    """(kind, id, post_id): cited posts without a note; ``cites``: kind, id, post_id."""
    return cites.join(notes.select("post_id").distinct(), "post_id", "left_anti").select("kind", "id", "post_id")


def repeated_ids(items: DataFrame) -> DataFrame:
    """Ids (kind, id) that occur more than once over all kinds."""
    return items.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id")


def insight_checks(insights: DataFrame, cites: DataFrame, notes: DataFrame, transcripts: int) -> DataFrame:
    """(id, warning) of insights (id, confidence): one voice, 'high' without enough behind it, no counter-evidence.

    ``cites``: id, side (for or against), post_id; ``notes``: post_id, person, source_type, thread, strong.
    """
    held = cites.join(notes, "post_id")
    inside = F.col("source_type") == "interview"
    by = held.filter("side = 'for'").groupBy("id").agg(
        F.count_distinct("person").alias("voices"), F.count_distinct(F.when(~inside, F.col("person"))).alias("forum"),
        F.count_distinct(F.when(inside, F.col("thread"))).alias("talks"), F.count_if("strong").alias("strong"),
    )
    against = cites.filter("side = 'against'").select("id").distinct().withColumn("_c", F.lit(True))
    rows = insights.join(by, "id", "left").join(against, "id", "left").fillna(0, ["voices", "forum", "talks", "strong"])
    reach = (F.col("forum") >= 5) | (F.lit(transcripts > 0) & (F.col("talks") >= max(3, transcripts // 3)))
    each = F.array(
        F.when(F.col("voices") == 1, "one voice"),
        F.when((F.col("confidence") == "high") & (~reach | (F.col("strong") == 0)), "high without enough behind it"),
        F.when(F.col("_c").isNull(), "no counter-evidence"),
    )
    return rows.select("id", F.explode(F.filter(each, lambda w: w.isNotNull())).alias("warning"))


JOB = r"(?is)^when .+,? i want to .+,? so (?:that )?i can .+"


def job_checks(jobs: DataFrame, cites: DataFrame, notes: DataFrame) -> DataFrame:
    """(id, warning) of jobs (id, job): not told as a job story, fewer than two forces."""
    forces = cites.join(notes.select("post_id", "force"), "post_id").filter(F.col("force").isin(*FORCES)).groupBy("id").agg(F.count_distinct("force").alias("forces"))
    rows = jobs.join(forces, "id", "left").fillna(0, ["forces"])
    each = F.array(F.when(~F.col("job").rlike(JOB), "no job story"), F.when(F.col("forces") < 2, "fewer than two forces"))
    return rows.select("id", F.explode(F.filter(each, lambda w: w.isNotNull())).alias("warning"))


def questions(notes: DataFrame) -> DataFrame:
    """Groups of notes tagged as questions, most first."""
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "aspect"))
    return group(notes.filter(F.array_contains("tags", "question"))).withColumn("rank", rank)


def frames(notes: DataFrame, known: list[str]) -> DataFrame:
    """Notes, voices and aspects of each frame of the codebook that occurs; ``notes`` has frame."""
    rows = notes.filter(F.col("frame").isin([f for f in known if f != "none"]))
    return rows.groupBy("frame").agg(F.count(F.lit(1)).alias("n"), *voices(), F.array_sort(F.collect_set("aspect")).alias("aspects"))


def driver_evidence(drivers: DataFrame, notes: DataFrame, k: int = 3) -> DataFrame:
    """(aspect, post_id, rank) of up to k notes about each driver (aspect), by aspect or tag; a driver without any has a null post."""
    tagged = notes.select("*", F.explode(F.array_union(F.array("aspect"), "tags")).alias("about")).drop("aspect").withColumnRenamed("about", "aspect")
    picked = diverse_pick(tagged.join(F.broadcast(drivers.select("aspect")), "aspect", "left_semi"), k)
    return drivers.select("aspect").join(picked, "aspect", "left")
