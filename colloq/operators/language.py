"""Keyness of two groups' words, false-discovery control, and shared phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as x
from ..functions.lexicon import stop_words
from ..workspace import written

Q, TOP = 0.05, 15
MIN_FREQ, MIN_REACH = 5, 3
PHRASE_REACH, PHRASE_TOP = 3, 30


def _tokens(items: DataFrame, *keep) -> DataFrame:
    """A row for each token (a) with the two after it (b, c)."""
    read = items.select(*keep, x.tokens(F.col("text")).alias("ts"))
    return read.select("*", F.explode(x.triples(F.col("ts"))).alias("t")).select("*", "t.*").drop("ts", "t")


def term_counts(items: DataFrame) -> DataFrame:
    """(side, term, freq, reach) of comments (text, person, overall); neutral ones are left out."""
    side = F.when(F.col("overall") < 0, "negative").when(F.col("overall") > 0, "positive").alias("side")
    read = _tokens(items.filter("overall <> 0"), side, "person")
    rows = read.select("side", "person", F.explode(x.terms(F.col("a"), F.col("b"), stop_words())).alias("term")).dropna(subset=["term"])
    return rows.groupBy("side", "term").agg(F.count(F.lit(1)).alias("freq"), F.count_distinct("person").alias("reach"))


def keyness(counts: DataFrame, min_freq: int = MIN_FREQ, min_reach: int = MIN_REACH) -> DataFrame:
    """Terms that are frequent on their side, with log-likelihood and log-ratio against the other."""
    single = F.when(~F.contains("term", F.lit(" ")), F.col("freq")).otherwise(0)
    totals = counts.agg(*[F.greatest(F.coalesce(F.sum(F.when(F.col("side") == s, single)), F.lit(0)), F.lit(1)).alias(s) for s in ("negative", "positive")])
    sides = counts.groupBy("term").agg(*[F.coalesce(F.max(F.when(F.col("side") == s, F.col(c))), F.lit(0)).alias(f"{s}_{c}") for s in ("negative", "positive") for c in ("freq", "reach")])

    def of(side: str, other: str) -> DataFrame:
        return sides.join(F.broadcast(totals)).select(  # one row
            F.lit(side).alias("side"), "term", F.col(f"{side}_freq").alias("freq"), F.col(f"{other}_freq").alias("other_freq"),
            F.col(f"{side}_reach").alias("reach"), F.col(side).alias("c"), F.col(other).alias("d"),
        )

    both = of("negative", "positive").unionByName(of("positive", "negative")).filter((F.col("freq") >= min_freq) & (F.col("reach") >= min_reach))
    parts = [F.col(c) for c in ("freq", "other_freq", "c", "d")]
    return both.withColumn("log_ratio", x.log_ratio(*parts)).filter("log_ratio > 0").withColumn("g2", x.g2(*parts)).drop("c", "d")


def adjusted(tested: DataFrame) -> DataFrame:
    """p and Benjamini-Hochberg q over all tested terms (a few thousand, whatever the corpus)."""
    tested = tested.withColumn("p", x.chi2_tail(F.col("g2")))
    up = Window.orderBy("p", "side", "term")
    down = Window.orderBy(F.desc("rank")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = tested.withColumns({"rank": F.row_number().over(up), "m": F.count(F.lit(1)).over(Window.partitionBy())})
    return ranked.withColumn("q", F.least(F.lit(1.0), F.min(F.col("p") * F.col("m") / F.col("rank")).over(down))).drop("rank", "m")


def report(tested: DataFrame, rule: str = "adjusted", top: int = TOP) -> DataFrame:
    """The strongest terms of each side: q at most .05, or by the older rule a log-likelihood of 3.84."""
    kept = tested.filter(F.col("q") <= Q) if rule == "adjusted" else tested.filter("g2 >= 3.84")
    rank = F.row_number().over(Window.partitionBy("side").orderBy(F.desc(F.round("g2", 1)), F.desc("reach"), "term"))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= top)


def phrase_counts(items: DataFrame, min_reach: int = PHRASE_REACH) -> DataFrame:
    """(phrase, reach, freq) used by at least ``min_reach`` people; ``items``: text, person."""
    found = x.phrases(F.col("a"), F.col("b"), F.col("c"), stop_words())
    rows = _tokens(items, "person").select("person", F.explode(found).alias("phrase")).dropna(subset=["phrase"])
    return rows.groupBy("phrase").agg(F.count_distinct("person").alias("reach"), F.count(F.lit(1)).alias("freq")).filter(F.col("reach") >= min_reach)


def shared_phrases(counted: DataFrame, top: int = PHRASE_TOP, step: int = 64) -> DataFrame:
    """The widest phrases; one that overlaps a kept phrase and has at least .8 of its reach is dropped.

    Greedy by rank, in rounds: each brings the first ``step`` phrases that no kept one drops, so however many overlap, the driver reads
    at most ``step`` rows a round, and there are at most ``top`` rounds.
    """
    spark = counted.sparkSession
    counted = written(counted, "phrase-counts")
    order = [F.desc("reach"), F.desc(F.size(F.split("phrase", " "))), F.desc("freq"), "phrase"]
    kept: list[tuple[str, int, int]] = []
    pairs = lambda p: list(zip(p.split(), p.split()[1:]))
    drops = lambda p, reach: any(reach >= 0.8 * r and (p in q or set(pairs(p)) & set(pairs(q))) for q, r, _ in kept)
    words = F.split("phrase", " ")
    own = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))
    rest = counted.withColumn("_pairs", own)
    while len(kept) < top:
        free = rest
        for q, r, _ in kept:
            shared = F.arrays_overlap("_pairs", F.array(*[F.lit(" ".join(p)) for p in pairs(q)]))
            free = free.filter(~((F.col("reach") >= 0.8 * r) & (F.contains(F.lit(q), F.col("phrase")) | shared)) & (F.col("phrase") != q))
        found = free.orderBy(*order).select("phrase", "reach", "freq").limit(step).collect()
        if not found:
            break
        for phrase, reach, freq in found:
            if len(kept) < top and not drops(phrase, reach):
                kept.append((phrase, reach, freq))
    return spark.createDataFrame(kept, "phrase string, reach bigint, freq bigint")
