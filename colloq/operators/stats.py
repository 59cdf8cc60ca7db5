"""Shares with their bases and resampled ranges, and the measures built from them.

A measure is data: rows (measure, person, thread, num, den, rests). Many measures are counted in one pass; for ranges they
are added up to (measure, cluster) first, so the cost is draws x clusters x measures and not draws x records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import thresholds as t
from ..functions import text as x
from ..workspace import written

#: Weights of clusters in draws that are sent to all tasks: some 20 MB.
BROADCAST_WEIGHTS = 500_000


def shares(measures: DataFrame) -> DataFrame:
    """(measure, k, n, n_people, n_items, status, pct); pct is null where only counts may be shown."""
    base = F.col("rests")
    out = measures.groupBy("measure").agg(
        F.sum("num").alias("k"), F.sum("den").alias("n"), F.count_distinct(F.when(base, F.col("person"))).alias("n_people"), F.count_if(base).alias("n_items")
    )
    status = t.result_status(F.col("n_people"), F.col("n_items"))
    return out.withColumn("status", status).withColumn("pct", F.when(F.col("status") != "counts-only", t.pct(F.col("k"), F.col("n"))))


def measure(records: DataFrame, name: Column | str, num: Column, den: Column | None = None, rests: Column | None = None) -> DataFrame:
    den = F.lit(1) if den is None else den.cast("bigint")
    return records.select(
        (F.lit(name) if isinstance(name, str) else name).alias("measure"),
        "person",
        "thread",
        num.cast("bigint").alias("num"),
        den.cast("bigint").alias("den"),
        (den > 0 if rests is None else rests).alias("rests"),
    )


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def boot_weights(clusters: DataFrame, draws: int, seed: int) -> DataFrame:
    """(draw, cluster, w): how often each cluster is drawn when as many are drawn as there are.

    Draws are hashes of (seed, draw, slot), so they need no order and no state; clusters are numbered by id.
    ``clusters`` (cluster) is the sample's, which the caps bound.
    """
    numbered = clusters.select("cluster").distinct().withColumn("pos", F.row_number().over(Window.orderBy("cluster")) - 1)
    n = numbered.count()
    slots = clusters.sparkSession.range(draws * n).select((F.col("id") / n).cast("bigint").alias("draw"), (F.col("id") % n).alias("slot"))
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(seed), "draw", "slot"), 256), 1, 8), 16, 10).cast("bigint")
    return slots.select("draw", (h % n).cast("int").alias("pos")).join(numbered, "pos").groupBy("draw", "cluster").agg(F.count(F.lit(1)).alias("w"))


def interval(values: Column) -> tuple[Column, Column]:
    """The values at int(.025 (m - 1)) and int(.975 (m - 1)) of the sorted ones, without nulls."""
    s = F.array_sort(F.collect_list(values))
    at = lambda p: F.try_element_at(s, (F.floor(F.lit(p) * (F.size(s) - 1)) + 1).cast("int"))
    return at(0.025), at(0.975)


def replicates(measures: DataFrame, by: str, draws: int, seed: int) -> DataFrame:
    """(measure, draw, rate): 100 x weighted num / weighted den, null without a base."""
    sums = measures.groupBy("measure", F.col(by).alias("cluster")).agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
    weights = boot_weights(measures.select(F.col(by).alias("cluster")), draws, seed)
    top, base = F.sum(F.col("w") * F.col("num")), F.sum(F.col("w") * F.col("den"))
    out = sums.join(weights, "cluster").groupBy("measure", "draw").agg(top.alias("top"), base.alias("base"))
    return out.select("measure", "draw", "top", "base", t.pct(F.col("top"), F.col("base")).alias("rate"))


def ranges(measures: DataFrame, by: str, draws: int, seed: int) -> DataFrame:
    lo, hi = interval(F.col("rate"))
    return replicates(measures, by, draws, seed).groupBy("measure").agg(lo.alias("lo"), hi.alias("hi"))


def wider(people: DataFrame, threads: DataFrame) -> DataFrame:
    """Both ranges of each measure and the wider as its range; people's if they tie."""
    both = people.withColumnsRenamed({"lo": "people_lo", "hi": "people_hi"}).join(
        threads.withColumnsRenamed({"lo": "threads_lo", "hi": "threads_hi"}), "measure", "left"
    )
    use_threads = F.coalesce((F.col("threads_hi") - F.col("threads_lo")) > (F.col("people_hi") - F.col("people_lo")), F.col("people_lo").isNull())
    return both.withColumn("range_from", F.when(use_threads, "threads").otherwise("people")).withColumns(
        {side: F.when(use_threads, F.col(f"threads_{side}")).otherwise(F.col(f"people_{side}")) for side in ("lo", "hi")}
    )


def share_table(measures: DataFrame, draws: int = t.BOOT_DRAWS, seed: int = 0) -> DataFrame:
    """Shares with ranges; ranges are null where only counts may be shown, threads' with fewer than two threads."""
    people = ranges(measures, "person", draws, seed)
    if measures.select("thread").distinct().limit(2).count() < 2:
        threads = people.limit(0)
    else:
        threads = ranges(measures, "thread", draws, seed)
    out = shares(measures).join(wider(people, threads), "measure", "left")
    shown = F.col("status") != "counts-only"
    return out.withColumns({c: F.when(shown, F.col(c)) for c in ("people_lo", "people_hi", "threads_lo", "threads_hi", "lo", "hi", "range_from")})


# --- Measures ----------------------------------------------------------------------------------------------------


def headline(records: DataFrame) -> DataFrame:
    o = F.col("overall")
    return union([measure(records, "negative", o < 0), measure(records, "neutral", o == 0), measure(records, "positive", o > 0)])


def people_net_negative(records: DataFrame) -> DataFrame:
    """People whose mean score is below 0: k of n people."""
    by = records.groupBy("person").agg(F.avg("overall").alias("mean"), F.count(F.lit(1)).alias("m"))
    out = by.agg(F.count_if(F.col("mean") < 0).alias("k"), F.count(F.lit(1)).alias("n"), F.sum("m").alias("n_items"))
    status = t.result_status(F.col("n"), F.col("n_items"))
    return out.withColumn("status", status).withColumn("pct", F.when(F.col("status") != "counts-only", t.pct(F.col("k"), F.col("n"))))


def net_negative_range(records: DataFrame, by: str, draws: int, seed: int) -> DataFrame:
    """Range of the share of net-negative people; in a draw a person counts by the mean weight of their comments."""
    told = records.select(F.col(by).alias("cluster"), "person", "overall").repartition("person")
    own = told.groupBy("person", "cluster").agg(F.sum("overall").alias("s"), F.count(F.lit(1)).alias("m"))
    own = own.withColumn("all", F.sum("m").over(Window.partitionBy("person")))
    clusters = written(records.select(F.col(by).alias("cluster")).distinct(), "clusters")
    weights = boot_weights(clusters, draws, seed)
    if by == "person":  # a person is one cluster, with one weight a draw
        person = own.join(weights, "cluster").select("draw", "person", (F.col("w") * F.col("s")).alias("s"), F.col("w").alias("mult"))
    else:
        few = draws * clusters.count() <= BROADCAST_WEIGHTS  # then rows stay with their person, where draws are added up without a shuffle
        person = own.join(F.broadcast(weights) if few else weights, "cluster").groupBy("person", "draw")
        person = person.agg(F.sum(F.col("w") * F.col("s")).alias("s"), F.sum(F.col("w") * F.col("m")).alias("m"), F.first("all").alias("all")).withColumn("mult", F.col("m") / F.col("all"))
    rate = person.groupBy("draw").agg((100 * F.sum(F.when(F.col("s") < 0, F.col("mult")).otherwise(0.0)) / F.sum("mult")).alias("rate"))
    lo, hi = interval(F.col("rate"))
    return rate.agg(lo.alias("lo"), hi.alias("hi"))


def aspect_rows(records: DataFrame) -> DataFrame:
    """A row for each aspect of each record: ord, person, thread, aspect, score."""
    return records.select("ord", "person", "thread", F.explode("aspects").alias("a", "score")).select(
        "ord", "person", "thread", F.lower(F.trim("a")).alias("aspect"), "score"
    )


def aspect_table(records: DataFrame) -> DataFrame:
    """Each aspect's mentions, people, mean, strong negatives, and its part of all negative and positive mentions."""
    rows = aspect_rows(records)
    own = rows.groupBy("aspect").agg(
        F.count(F.lit(1)).alias("mentions"),
        F.count_distinct("person").alias("people"),
        F.avg("score").alias("mean"),
        F.count_if(F.col("score") <= -2).alias("strong_negative"),
        F.count_if(F.col("score") < 0).alias("negative"),
        F.count_if(F.col("score") > 0).alias("positive"),
        F.min("ord").alias("first_seen"),
    )
    total = own.agg(F.sum("negative").alias("all_negative"), F.sum("positive").alias("all_positive"))
    base = records.agg(F.count(F.lit(1)).alias("n_items"), F.count_distinct("person").alias("n_people"))
    return (
        own.join(F.broadcast(total)).join(F.broadcast(base))  # one row each
        .withColumns(
            {
                "negative_rate": t.pct(F.col("negative"), F.col("mentions")),
                "share_of_negative": t.pct(F.col("negative"), F.col("all_negative")),
                "share_of_positive": t.pct(F.col("positive"), F.col("all_positive")),
                "mention_rate": t.pct(F.col("mentions"), F.col("n_items")),
                "status": t.result_status(F.col("n_people"), F.col("n_items")),
            }
        )
    )


def driver_ranking(records: DataFrame, side: str = "negative", min_mentions: int = t.MIN_MENTIONS) -> DataFrame:
    """Aspects by their part of all mentions on a side; ties by mean (drivers only), then by first mention."""
    share = F.coalesce(F.round(f"share_of_{side}", 1), F.lit(0.0))
    table = aspect_table(records).filter(F.col("mentions") >= min_mentions).withColumn("share", share).filter("share > 0")
    order = [F.desc("share"), *([F.round("mean", 2)] if side == "negative" else []), "first_seen"]
    return table.select("aspect", "mentions", "share", F.row_number().over(Window.orderBy(*order)).alias("rank"))


def top_driver(records: DataFrame, by: str, draws: int, seed: int, min_mentions: int = t.MIN_MENTIONS) -> DataFrame:
    """(aspect, probability): percent of draws in which a ranked aspect has the most negative mentions; ties alphabetical."""
    rows = aspect_rows(records)
    ranked = rows.groupBy("aspect").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") >= min_mentions).select("aspect")
    sums = rows.filter("score < 0").join(ranked, "aspect", "left_semi").groupBy("aspect", F.col(by).alias("cluster")).agg(F.count(F.lit(1)).alias("neg"))
    weights = boot_weights(records.select(F.col(by).alias("cluster")), draws, seed)
    each = sums.join(weights, "cluster").groupBy("draw", "aspect").agg(F.sum(F.col("w") * F.col("neg")).alias("neg"))
    best = each.groupBy("draw").agg(F.min_by("aspect", F.struct(-F.col("neg"), F.col("aspect"))).alias("aspect"))
    won = best.groupBy("aspect").agg(F.count(F.lit(1)).alias("wins"))
    return ranked.join(won, "aspect", "left").select("aspect", (100.0 * F.coalesce("wins", F.lit(0)) / draws).alias("probability"))


def nearer_half(people: Column, threads: Column) -> Column:
    """Of two probabilities the one nearer 50; people's if they tie or the other is missing."""
    return F.when(people.isNull() | (F.abs(threads - 50) < F.abs(people - 50)), threads).otherwise(people)


def stance_measures(records: DataFrame) -> DataFrame:
    s, has = F.col("stance"), F.col("stance").isNotNull()
    return union(
        [
            measure(records, "expressing", has, F.lit(1), F.lit(True)),
            *[measure(records, n, F.coalesce(c, F.lit(False)), has.cast("int"), has) for n, c in (("in_favour", s > 0), ("against", s < 0), ("neither", s == 0))],
        ]
    )


def top_aspects(records: DataFrame, group: Column, most: int) -> DataFrame:
    """(grp, aspect, n, rank): the aspects most mentioned in each group, ties by first mention."""
    rows = records.withColumn("grp", group).filter("grp IS NOT NULL").select("grp", "ord", F.explode(F.map_keys("aspects")).alias("aspect"))
    own = rows.groupBy("grp", F.lower("aspect").alias("aspect")).agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("_first"))
    rank = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), "_first", "aspect"))
    return own.withColumn("rank", rank).filter(F.col("rank") <= most).drop("_first")


def compare(records: DataFrame, num: Column, side: Column, draws: int, seed: int, name: Column | str = "negative") -> DataFrame:
    """Before against after: counts of both sides, difference in points, its ranges by people, and the verdict.

    ``side`` is 'before', 'after' or null for each record.
    """
    both = records.withColumn("_side", side).filter("_side IS NOT NULL").withColumn("_m", F.lit(name) if isinstance(name, str) else name)
    n = num.cast("bigint")
    is_ = lambda s: F.col("_side") == s
    base = both.groupBy(F.col("_m").alias("measure")).agg(
        *[F.sum(F.when(is_(s), n).otherwise(0)).alias(f"k_{s}") for s in ("before", "after")],
        *[F.count_if(is_(s)).alias(f"n_{s}") for s in ("before", "after")],
        F.count_distinct("person").alias("n_people"),
    )
    m = both.select(F.concat_ws("\u0001", "_m", "_side").alias("measure"), "person", "thread", n.alias("num"), F.lit(1).cast("bigint").alias("den"), F.lit(True).alias("rests"))
    reps = replicates(m, "person", draws, seed).select(F.split("measure", "\u0001").alias("p"), "draw", "rate")
    wide = reps.groupBy(F.col("p")[0].alias("measure"), "draw").agg(
        (F.max(F.when(F.col("p")[1] == "after", F.col("rate"))) - F.max(F.when(F.col("p")[1] == "before", F.col("rate")))).alias("d")
    )
    lo, hi = interval(F.col("d"))
    out = base.join(wide.groupBy("measure").agg(lo.alias("lo"), hi.alias("hi")), "measure", "left")
    enough = (F.col("n_before") >= t.MIN_PER_SIDE) & (F.col("n_after") >= t.MIN_PER_SIDE) & F.col("lo").isNotNull()
    few = F.col("n_people") < t.MIN_PEOPLE_FOR_RANGES
    return out.withColumn("diff_pts", F.when(~few, t.pct(F.col("k_after"), F.col("n_after")) - t.pct(F.col("k_before"), F.col("n_before")))).withColumn(
        "verdict", F.when(few | ~enough, "insufficient data").when(F.col("lo") > 0, "rose").when(F.col("hi") < 0, "fell").otherwise("no clear change")
    )


def period_unit(records: DataFrame) -> DataFrame:
    """(span_days, unit): month over 60 days, week over 14, else null."""
    span = F.floor((F.unix_timestamp(F.max("time")) - F.unix_timestamp(F.min("time"))) / 86400).alias("span_days")
    return records.agg(span).withColumn("unit", F.when(F.col("span_days") > 60, "month").when(F.col("span_days") > 14, "week"))


def by_period(records: DataFrame, unit: str) -> DataFrame:
    timed = records.filter("time IS NOT NULL").withColumn("period", x.period_key(F.col("time"), unit))
    out = shares(measure(timed, F.col("period"), F.col("overall") < 0)).withColumnRenamed("measure", "period")
    return out.withColumn("usable", F.col("n_items") >= t.MIN_PER_SIDE)


def by_source(records: DataFrame) -> DataFrame:
    """Each source's part of the sample, its negative share, and whether it has more than half."""
    total = records.agg(F.count(F.lit(1)).alias("n_all"))
    own = shares(measure(records, F.col("source"), F.col("overall") < 0)).withColumnRenamed("measure", "source")
    sources = Window.partitionBy(F.lit(1))
    return own.join(F.broadcast(total)).withColumns(
        {"share_of_sample": t.pct(F.col("n"), F.col("n_all")), "dominant": (F.count(F.lit(1)).over(sources) > 1) & (F.round(t.pct(F.col("n"), F.col("n_all")), 1) > 50)}
    )


def leave_one_out(records: DataFrame, largest: int = t.LARGEST_THREADS) -> DataFrame:
    """Negative share without each source, search term and large thread.

    One pass of grouping sets gives what each removal takes away; people of the rest are all people less those who
    only occur inside, found from one row a person and group.
    """
    flag = records.withColumn("neg", (F.col("overall") < 0).cast("bigint"))
    kinds = union(
        [flag.select(F.lit(kind).alias("kind"), F.col(c).alias("removed"), "person", "neg") for kind, c in (("source", "source"), ("search_term", "search_term"), ("thread", "thread"))]
    ).filter("removed IS NOT NULL")
    inside = kinds.groupBy("kind", "removed", "person").agg(F.count(F.lit(1)).alias("n"), F.sum("neg").alias("k"))
    size = flag.groupBy("person").agg(F.count(F.lit(1)).alias("all"))
    gone = inside.join(size, "person").groupBy("kind", "removed").agg(F.sum("n").alias("n_in"), F.sum("k").alias("k_in"), F.count_if(F.col("n") == F.col("all")).alias("people_gone"))
    w = Window.partitionBy("kind")
    gone = gone.withColumns({"of_kind": F.count(F.lit(1)).over(w), "rank": F.row_number().over(w.orderBy(F.desc("n_in"), "removed"))})
    gone = gone.filter((F.col("kind") == "search_term") | (F.col("of_kind") > 1)).filter((F.col("kind") != "thread") | (F.col("rank") <= largest))
    total = flag.agg(F.count(F.lit(1)).alias("n_all"), F.sum("neg").alias("k_all"), F.count_distinct("person").alias("p_all"))
    out = gone.join(F.broadcast(total)).select(
        "kind", "removed", (F.col("k_all") - F.col("k_in")).alias("k"), (F.col("n_all") - F.col("n_in")).alias("n"), (F.col("p_all") - F.col("people_gone")).alias("n_people")
    )
    out = out.filter("n > 0").withColumn("status", t.result_status(F.col("n_people"), F.col("n")))
    return out.withColumn("pct", F.when(F.col("status") != "counts-only", t.pct(F.col("k"), F.col("n"))))


def cap_weights(sample: DataFrame, pool: DataFrame, summary: DataFrame, cap: int = t.PERSON_CAP) -> DataFrame:
    """Each sampled post with the number of eligible posts it stands for."""
    eligible = pool.groupBy("person").agg(F.count(F.lit(1)).alias("e"))
    w = (F.col("e") / F.least("e", F.lit(cap))) * (F.col("after_cap") / F.col("sampled"))
    return sample.join(eligible, "person").join(summary, "thread").withColumn("weight", w)


def without_caps(weighted: DataFrame) -> DataFrame:
    out = weighted.agg(F.count_distinct("person").alias("n_people"), F.count(F.lit(1)).alias("n_items"), F.sum("weight").alias("total"), F.sum(F.when(F.col("overall") < 0, F.col("weight")).otherwise(0.0)).alias("neg"))
    out = out.withColumn("status", t.result_status(F.col("n_people"), F.col("n_items")))
    return out.select("n_people", "n_items", "status", F.when(F.col("status") != "counts-only", 100 * F.col("neg") / F.col("total")).alias("pct"))


def _between(tags: DataFrame, posts: DataFrame, runs: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(run, cuts): the sorted places of the first posts of topics; (run, ahead, held, n): posts by the cuts ahead of them, the cuts' own apart.

    Numbers as places are kept in a hash map of runs and topics; other values would be sorted with every post of every run.
    """
    first = tags.filter("topic IS NOT NULL").crossJoin(runs).select("run", "topic", at.alias("at")).groupBy("run", "topic").agg(F.min("at").alias("at"))
    cuts = written(first.groupBy("run").agg(F.sort_array(F.collect_set("at")).alias("cuts"), F.sort_array(F.collect_list("at")).alias("every")), "cuts")
    ahead = F.size(F.filter("every", lambda c: c < F.col("at"))).alias("ahead")
    placed = posts.crossJoin(runs).select("run", at.alias("at")).join(F.broadcast(cuts), "run").select("run", ahead, F.array_contains("cuts", F.col("at")).alias("held"))
    return cuts.select("run", F.col("every").alias("cuts")), written(placed.groupBy("run", "ahead", "held").agg(F.count(F.lit(1)).alias("n")), "between")


def heard_range(tags: DataFrame, orders: int, seed: int) -> DataFrame:
    """Topics found after so many posts, over ``orders`` random reading orders: (place, mean, low, high, last_posts, last_new).

    ``low`` and ``high`` hold 95 % of the orders; ``last_new`` is what the last tenth of the posts adds to the mean. ``tags``: post_id,
    topic. Places come from counts of posts between the first posts of topics, so no order is sorted as a whole.
    """
    posts = written(tags.select("post_id").distinct(), "read-posts")
    runs = F.broadcast(tags.sparkSession.range(orders).select(F.col("id").alias("run")))
    h = F.sha2(F.concat_ws(":", F.lit(seed), "run", "post_id"), 256)
    for at in (F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint"), F.struct(h.alias("h"), "post_id")):
        cuts, between = _between(tags, posts, runs, at)
        if not between.filter("held AND n > 1").limit(1).count():  # numbers tell the posts apart where it matters; else whole hashes do
            break
    between = between.select("run", F.col("ahead"), "n").groupBy("run", "ahead").agg(F.sum("n").alias("n"))
    places = cuts.select("run", F.posexplode("cuts").alias("nth", "_at")).select("run", "nth").join(between, "run").filter("ahead <= nth").groupBy("run", "nth").agg(F.sum("n").alias("place"))
    new = places.groupBy("run", "place").agg(F.count(F.lit(1)).alias("new"))
    steps = new.select("place").unionByName(tags.sparkSession.range(1, 2).select(F.col("id").alias("place"))).distinct()
    so_far = F.sum(F.coalesce("new", F.lit(0))).over(Window.partitionBy("run").orderBy("place"))
    found = steps.crossJoin(runs).join(new, ["run", "place"], "left").select("place", so_far.alias("found"))
    n = posts.count()
    held = found.groupBy("place").agg(F.avg("found").alias("mean"), F.percentile("found", F.lit(0.025)).alias("low"), F.percentile("found", F.lit(0.975)).alias("high"))
    held = held.withColumn("upto", F.coalesce(F.lead("place").over(Window.orderBy("place")) - 1, F.lit(n).cast("bigint"))).filter("place <= upto")
    last = max(1, n // 10)
    at_end = lambda k: F.max(F.when(F.lit(k).between(F.col("place"), F.col("upto")), F.col("mean")))
    gain = held.agg((at_end(n) - at_end(n - last)).alias("last_new"))
    return held.crossJoin(F.broadcast(gain)).select(F.explode(F.sequence("place", "upto")).alias("place"), "mean", "low", "high", F.lit(last).alias("last_posts"), "last_new")


def heard_enough(tags: DataFrame, orders: int, seed: int) -> DataFrame:
    """(place, mean) of ``heard_range``."""
    return heard_range(tags, orders, seed).select("place", F.round("mean", 6).alias("mean"))


# --- Whole sections ------------------------------------------------------------------------------------------------------


def headline_mean(records: DataFrame) -> DataFrame:
    """The mean overall score, null where only counts may be shown."""
    out = records.agg(F.avg("overall").alias("_m"), F.count(F.lit(1)).alias("n_items"), F.count_distinct("person").alias("n_people"))
    status = t.result_status(F.col("n_people"), F.col("n_items"))
    return out.withColumn("status", status).select("n_items", "n_people", "status", F.when(F.col("status") != "counts-only", F.round("_m", 2)).alias("mean"))


def most_common(records: DataFrame, most: int) -> DataFrame:
    """(aspect, n, rank): the aspects most mentioned, ties by first mention."""
    return top_aspects(records, F.lit("all"), most).drop("grp")


def event(records: DataFrame, day: str, draws: int, seed: int, top: int = t.TOP_SHIFTS) -> DataFrame:
    """Before and after midnight of a day: negative share, share in favour (if both sides have positions), and the aspects that rose or fell most.

    Each row is a measure with ``kind`` and, for aspects, ``rank``. Bases of aspects are counted once, not once an aspect.
    """
    side = F.when(F.col("time").isNull(), None).when(F.col("time") < F.lit(day).cast("timestamp_ntz"), "before").otherwise("after")
    told = records.withColumn("_at", side).filter("_at IS NOT NULL")
    parts = [compare(told, F.col("overall") < 0, F.col("_at"), draws, seed).withColumn("kind", F.lit("measure"))]
    voiced = told.filter("stance IS NOT NULL")
    if voiced.select("_at").distinct().count() == 2:
        parts.append(compare(voiced, F.col("stance") > 0, F.col("_at"), draws, seed, "in_favour").withColumn("kind", F.lit("measure")))
    shifts = aspect_shifts(told, draws, seed).filter(F.col("verdict").isin("rose", "fell"))
    rank = F.row_number().over(Window.orderBy(F.desc(F.abs("diff_pts")), "measure"))
    parts.append(shifts.withColumn("rank", rank).filter(F.col("rank") <= top).withColumn("kind", F.lit("aspect")))
    return union([p if "rank" in p.columns else p.withColumn("rank", F.lit(None).cast("int")) for p in parts])


def aspect_shifts(told: DataFrame, draws: int, seed: int) -> DataFrame:
    """``compare`` of mentioning each aspect, from sums by person and side: records are not crossed with aspects."""
    base = told.groupBy("person", "_at").agg(F.count(F.lit(1)).alias("den"))
    said = told.select("person", "_at", F.explode(F.array_distinct(F.transform(F.map_keys("aspects"), lambda a: F.lower(F.trim(a))))).alias("measure"))
    num = said.groupBy("measure", "person", "_at").agg(F.count(F.lit(1)).alias("num"))
    weights = boot_weights(told.select(F.col("person").alias("cluster")), draws, seed)
    of_draw = base.join(weights, base["person"] == weights["cluster"]).groupBy("draw", "_at").agg(F.sum(F.col("w") * F.col("den")).alias("base"))
    top = num.join(weights, num["person"] == weights["cluster"]).groupBy("measure", "draw", "_at").agg(F.sum(F.col("w") * F.col("num")).alias("top"))
    names = num.select("measure").distinct()
    every = names.join(F.broadcast(of_draw))  # draws x 2 rows for each aspect
    rate = every.join(top, ["measure", "draw", "_at"], "left").withColumn("rate", t.pct(F.coalesce("top", F.lit(0)), F.col("base")))
    of = lambda s: F.max(F.when(F.col("_at") == s, F.col("rate")))
    lo, hi = interval(F.col("d"))
    spread = rate.groupBy("measure", "draw").agg((of("after") - of("before")).alias("d")).groupBy("measure").agg(lo.alias("lo"), hi.alias("hi"))
    total = lambda c, s: F.coalesce(F.sum(F.when(F.col("_at") == s, F.col(c))), F.lit(0))
    k = num.groupBy("measure").agg(*[total("num", s).alias(f"k_{s}") for s in ("before", "after")])
    n = base.agg(*[total("den", s).alias(f"n_{s}") for s in ("before", "after")], F.count_distinct("person").alias("n_people"))
    out = k.join(F.broadcast(n)).join(spread, "measure", "left")
    return with_verdict(out).select("measure", "k_before", "k_after", "n_before", "n_after", "n_people", "lo", "hi", "diff_pts", "verdict")


def with_verdict(out: DataFrame, words: tuple[str, str] = ("rose", "fell")) -> DataFrame:
    """``diff_pts`` and ``verdict`` from counts and the range of the difference."""
    enough = (F.col("n_before") >= t.MIN_PER_SIDE) & (F.col("n_after") >= t.MIN_PER_SIDE) & F.col("lo").isNotNull()
    few = F.col("n_people") < t.MIN_PEOPLE_FOR_RANGES
    diff = F.when(~few, t.pct(F.col("k_after"), F.col("n_after")) - t.pct(F.col("k_before"), F.col("n_before")))
    verdict = F.when(few | ~enough, "insufficient data").when(F.col("lo") > 0, words[0]).when(F.col("hi") < 0, words[1]).otherwise("no clear change")
    return out.withColumn("diff_pts", diff).withColumn("verdict", verdict)


def direction(records: DataFrame, draws: int, seed: int) -> DataFrame:
    """One row: the span, the unit it asks for, the usable periods, and the first against the last of them.

    status: 'no timestamps', 'single window' (two weeks or less) or 'ok'; the trend is null with fewer than two usable periods.
    """
    timed = records.filter("time IS NOT NULL")
    span, unit = period_unit(timed).first()
    shape = "status string, span_days bigint, unit string, first string, last string, usable int, k_before bigint, k_after bigint, n_before bigint, n_after bigint, lo double, hi double, diff_pts double, verdict string"
    one = lambda status, usable=0: records.sparkSession.createDataFrame([(status, span, unit, None, None, usable, *[None] * 8)], shape)
    if span is None:
        return one("no timestamps")
    if unit is None:
        return one("single window")
    key = x.period_key(F.col("time"), unit)
    good = by_period(records, unit).filter("usable").agg(F.min("period").alias("first"), F.max("period").alias("last"), F.count(F.lit(1)).cast("int").alias("usable")).first()
    if good[2] < 2:
        return one("ok", good[2])
    side = F.when(key == good[0], "before").when(key == good[1], "after")
    found = with_verdict(compare(timed, F.col("overall") < 0, side, draws, seed).drop("verdict", "diff_pts"), ("worsening", "improving"))
    facts = [F.lit("ok").alias("status"), F.lit(span).cast("bigint").alias("span_days"), F.lit(unit).alias("unit"), F.lit(good[0]).alias("first"), F.lit(good[1]).alias("last"), F.lit(good[2]).alias("usable")]
    return found.select(*facts, "k_before", "k_after", "n_before", "n_after", "lo", "hi", "diff_pts", "verdict")


def period_aspects(records: DataFrame, unit: str, most: int = t.TOP_PERIOD) -> DataFrame:
    """(period, aspect, n, rank): the aspects most mentioned in each period."""
    timed = records.filter("time IS NOT NULL")
    return top_aspects(timed, x.period_key(F.col("time"), unit), most).withColumnRenamed("grp", "period")


def loo_summary(removals: DataFrame, records: DataFrame) -> DataFrame:
    """One row over ``leave_one_out``: how many removals have a percentage, their least and greatest, and the one that moves the share most.

    Of equal moves the first counts: sources, then search terms, then threads, each in order.
    """
    base = shares(measure(records, "negative", F.col("overall") < 0)).select(F.col("pct").alias("base"))
    rank = F.when(F.col("kind") == "source", 0).when(F.col("kind") == "search_term", 1).otherwise(2)
    moved = removals.filter("pct IS NOT NULL").join(F.broadcast(base)).withColumn("by", F.round(F.round("pct", 1) - F.round("base", 1), 1))
    first = F.min(F.struct((-F.abs("by")).alias("m"), rank.alias("r"), "removed", "kind", "by"))
    out = moved.agg(F.count(F.lit(1)).alias("removals_with_pct"), F.min("pct").alias("min_pct"), F.max("pct").alias("max_pct"), first.alias("f"))
    return out.select("removals_with_pct", "min_pct", "max_pct", "f.kind", "f.removed", F.col("f.by").alias("change_pts"))


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The earlier method's interval of a share, in percent."""
    p, zz = k / n, z * z
    middle, spread = p + zz / (2 * n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    return 100 * F.greatest(F.lit(0.0), (middle - spread) / (1 + zz / n)), 100 * F.least(F.lit(1.0), (middle + spread) / (1 + zz / n))


def newcombe(k1: Column, n1: Column, k2: Column, n2: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The earlier method's interval of a difference of two shares, second less first, in points."""
    (l1, u1), (l2, u2) = wilson(k1, n1, z), wilson(k2, n2, z)
    p1, p2 = 100 * k1 / n1, 100 * k2 / n2
    square = lambda c: c * c
    return p2 - p1 - F.sqrt(square(p2 - l2) + square(u1 - p1)), p2 - p1 + F.sqrt(square(u2 - p2) + square(p1 - l1))
