"""Frame, person and thread caps, the stable draw, and the detail selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import thresholds as t
from ..functions import text as x
from ..workspace import written


def frame(posts: DataFrame, min_words: int = t.MIN_WORDS) -> DataFrame:
    """Forum posts with ``left_out``: the first rule that leaves a post out, null for eligible ones."""
    reply = F.col("kind") != "post"
    left = (
        F.when(F.col("role") != "participant", "removed_or_unknown")
        .when(F.col("headline"), "headline")
        .when(F.col("promotional"), "promotional")
        .when(reply & x.is_echo(F.col("text")), "echo_reply")
        .when(reply & (x.n_words(F.col("text")) < min_words), "short")
    )
    return posts.filter(F.col("source_type") == "forum").withColumn("left_out", left)


def left_out_counts(posts: DataFrame) -> DataFrame:
    return frame(posts).groupBy(F.coalesce("left_out", F.lit("eligible")).alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def with_key(posts: DataFrame, seed: int) -> DataFrame:
    return posts.withColumn("draw_key", x.draw_key(seed, F.col("person"), F.col("text")))


def person_cap(pool: DataFrame, seed: int, cap: int = t.PERSON_CAP) -> DataFrame:
    """At most ``cap`` posts a person, the first in the random order.

    A filter on the rank of a window, which Spark turns into a group limit before the shuffle, so a person with a
    third of all posts sends ``cap`` of them a task.
    """
    w = Window.partitionBy("person").orderBy("draw_key", "post_id")
    return with_key(pool, seed).withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= cap).drop("_rank")


def thread_cap_size(capped: DataFrame, target: int = t.MEASUREMENT_SIZE, pct: int = t.THREAD_CAP_PCT) -> DataFrame:
    """(n, cap): the largest sample, up to ``target``, for which no thread need give more than ``pct`` percent; (0, 0) if none.

    Thread sizes are cut at the target and counted, so what is tried against each size has at most ``target`` rows.
    """
    sizes = capped.groupBy("thread").agg(F.least(F.count(F.lit(1)), F.lit(target)).alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("m"))
    tried = sizes.sparkSession.range(1, target + 1).select(F.col("id").alias("n"), F.floor(F.col("id") * pct / 100).alias("cap"))
    held = tried.join(F.broadcast(sizes)).groupBy("n", "cap").agg(F.sum(F.least("s", "cap") * F.col("m")).alias("give"))
    best = held.filter("give >= n").agg(F.max(F.struct("n", "cap")).alias("b"))
    return best.select(F.coalesce("b.n", F.lit(0)).alias("n"), F.coalesce("b.cap", F.lit(0)).alias("cap"))


def draw(capped: DataFrame, n: int, cap: int) -> DataFrame:
    """In the random order, at most ``cap`` posts of a thread, until ``n`` are taken."""
    w = Window.partitionBy("thread").orderBy("draw_key", "post_id")
    open_ = capped.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= cap).drop("_rank")
    return open_.orderBy("draw_key", "post_id").limit(n)


def measurement_sample(pool: DataFrame, seed: int, size: int = t.MEASUREMENT_SIZE, cap: int = t.PERSON_CAP, pct: int = t.THREAD_CAP_PCT) -> DataFrame:
    """The doubly capped random sample; an error if no size fits the thread cap."""
    capped = written(person_cap(pool, seed, cap), "capped-pool")
    n, most = thread_cap_size(capped, size, pct).first()
    if not n and capped.limit(1).count():
        raise ValueError(f"no sample fits a thread cap of {pct}%: posts must come from at least {-(-100 // pct)} threads")
    return draw(capped, n, most)


def frame_summary(pool: DataFrame, capped: DataFrame, sample: DataFrame) -> DataFrame:
    """For each thread: eligible posts, those after the person cap, and those sampled."""
    parts = [d.select("thread", F.lit(k).alias("k")) for k, d in (("e", pool), ("c", capped), ("s", sample))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    count = lambda k, name: F.count_if(F.col("k") == k).alias(name)
    return rows.groupBy("thread").agg(count("e", "eligible"), count("c", "after_cap"), count("s", "sampled"))


def topup(posts: DataFrame, taken: DataFrame, wanted: DataFrame) -> DataFrame:
    """Forum posts asked for by id that are no headline and not taken yet."""
    forum = posts.filter((F.col("source_type") == "forum") & ~F.col("headline"))
    return forum.join(wanted.select("post_id"), "post_id", "left_semi").join(taken.select("post_id"), "post_id", "left_anti")


def detail_selection(pool: DataFrame, budget: int = t.DETAIL_BUDGET, per_person: int = t.DETAIL_PER_PERSON, clusters: DataFrame | None = None) -> DataFrame:
    """Purposive selection (post_id, person, reasons in the order they came): all posts of a small pool, else opening posts, top scores,
    flagged ones, and then the nearest of each cluster.

    ``pool`` has ord, post_id, person, kind, score, flags; ``clusters`` (post_id, cluster, place: from the nearest on) is optional. Each step goes
    through its posts in order until its quota or the budget is used up. A post that is selected already gets the step's reason
    besides, if the step came to it; others count against the quota, and comments against their person's cap. What a step takes
    are ranked rows and a limit, so nothing is gathered but what is selected.
    """
    if pool.limit(budget + 1).count() <= budget:
        return pool.select("post_id", "person", F.array(F.lit("all")).alias("reasons"))
    pool = written(pool, "detail-pool")
    clusters = None if clusters is None else written(clusters, "detail-clusters")
    picked = pool.filter("kind = 'post'").select("post_id", "person", F.lit(0).alias("step"), F.lit("post").alias("reason"))
    picked = written(picked, "detail-picked")
    score = F.desc(F.coalesce("score", F.lit(0)))
    flagged = F.concat(F.lit("flag:"), F.array_join(F.array_sort("flags"), ","))
    steps = [
        (pool, int(budget * 0.2), [score, F.asc("ord")], F.lit("top_score")),
        (pool.filter(F.size("flags") > 0), int(budget * 0.4), [F.desc(F.size("flags")), score, F.asc("ord")], flagged),
    ]
    if clusters is not None:
        total = pool.count()
        sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "cluster").collect()  # at most twelve
        for c, n in sizes:
            of = pool.join(clusters.filter(F.col("cluster") == c).select("post_id", "place"), "post_id")
            steps.append((of, lambda left, n=n: max(1, round(left * n / total)), [F.asc("place"), F.asc("ord")], F.lit(f"cluster:C{c + 1:02d}")))
    left = None
    for number, (rows, quota, order, reason) in enumerate(steps, 1):
        taken = picked.select("post_id").distinct()
        room = budget - taken.count()
        if callable(quota):  # shares are of what the steps before the clusters left
            left = room if left is None else left
            quota = quota(left)
        if room <= 0:
            break
        held = picked.select("post_id", "person").distinct().groupBy("person").agg(F.count(F.lit(1)).alias("_held"))
        marked = rows.join(taken.withColumn("_in", F.lit(True)), "post_id", "left").join(held, "person", "left")
        free = marked.filter("_in IS NULL")
        rank = F.row_number().over(Window.partitionBy("person").orderBy(*order))
        open_ = free.withColumn("_rank", rank).filter((F.col("kind") == "post") | (F.col("_rank") <= per_person - F.coalesce("_held", F.lit(0))))
        most = min(quota, room)
        new = open_.orderBy(*order).limit(most).withColumn("_place", F.row_number().over(Window.orderBy(*order)))
        new = written(new.select("post_id", "person", "_place", *[c for c in rows.columns if c not in ("post_id", "person")]), "detail-step")
        more = new.select("post_id", "person", F.lit(number).alias("step"), reason.alias("reason"))
        seen = marked.filter("_in")
        if new.count() == most:  # the step ended at its last new post
            keys = {f"_k{k}": c for k, c in enumerate(_plain(order))}
            last = new.filter(F.col("_place") == most).select(F.struct(*[c.alias(k) for k, c in keys.items()]).alias("_last"))
            seen = seen.join(F.broadcast(last)).filter(F.struct(*[c.alias(k) for k, c in keys.items()]) < F.col("_last"))
        again = seen.select("post_id", "person", F.lit(number).alias("step"), reason.alias("reason"))
        picked = written(picked.unionByName(more).unionByName(again), "detail-picked")
    reasons = F.transform(F.array_sort(F.collect_list(F.struct("step", "reason"))), lambda r: r["reason"])
    return picked.groupBy("post_id", "person").agg(reasons.alias("reasons"))


def _plain(order: list) -> list:
    """Sort keys of the detail steps as values that ascend."""
    score = -F.coalesce(F.col("score"), F.lit(0))
    if len(order) == 3:
        return [-F.size("flags"), score, F.col("ord")]
    return [F.col("place"), F.col("ord")] if "place" in str(order[0]) else [score, F.col("ord")]


def with_interviews(selected: DataFrame, turns: DataFrame, topups: DataFrame | None = None) -> DataFrame:
    """The selection with all participants' turns of interviews and, unless they are in it, posts that were asked for (post_id, person, reason)."""
    out = selected.unionByName(turns.filter("source_type = 'interview' AND role = 'participant'").select("post_id", "person", F.array(F.lit("interview")).alias("reasons")))
    if topups is not None:
        rest = topups.join(selected.select("post_id"), "post_id", "left_anti")
        out = out.unionByName(rest.select("post_id", "person", F.array(F.concat(F.lit("topup: "), "reason")).alias("reasons")))
    return out


def selection_summary(selected: DataFrame, per_person: int = t.DETAIL_PER_PERSON) -> DataFrame:
    """(what, n): selected posts by their first reason, and people at the cap."""
    first = F.split(F.col("reasons")[0], ":")[0]
    by = selected.groupBy(F.concat(F.lit("first:"), first).alias("what")).agg(F.count(F.lit(1)).alias("n"))
    people = selected.groupBy("person").agg(F.count(F.lit(1)).alias("m")).agg(F.lit("people_at_cap").alias("what"), F.count_if(F.col("m") >= per_person).alias("n"))
    return by.unionByName(people)


def ids_hash(ids: DataFrame, column: str = "post_id") -> str:
    """Digest of a sample's ids, in order; a sample is bounded by its size."""
    joined = F.array_join(F.array_sort(F.collect_list(F.col(column).cast("string"))), "\n")
    return ids.agg(F.sha2(joined, 256)).first()[0]


def content_hash(rows: DataFrame) -> DataFrame:
    """(n, digest) of a table of any size, whatever the order of its rows: sums of two halves of the rows' digests."""
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)])), 256)
    part = lambda k: F.sum(F.conv(F.substring("_h", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)"))
    out = rows.select(row.alias("_h")).agg(F.count(F.lit(1)).alias("n"), part(0).alias("_a"), part(1).alias("_b"))
    return out.select("n", F.sha2(F.concat_ws(":", "n", "_a", "_b"), 256).alias("digest"))
