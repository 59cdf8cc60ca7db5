"""Queries of sampling and statistics on the driver tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as x
from ..operators import sampling, stats
from . import views as v

SEED, DRAWS = 11, 200

_PCT = "CASE WHEN n_people >= 20 AND n > 0 THEN 100.0::DOUBLE * k / n END"
_ECHO = r"(length(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) <= 15 AND (regexp_matches(text, '^\W*(?:this|same|agreed|agree|yep|yes|exactly)\b', 'i') OR regexp_matches(text, '^\W*(?:no|nah|nope|disagree)\b', 'i')))"
_WORDS = r"length(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"
_FRAME = f"""framed AS (SELECT *, CASE WHEN role <> 'participant' THEN 'removed_or_unknown' WHEN headline THEN 'headline' WHEN promotional THEN 'promotional'
  WHEN kind <> 'post' AND {_ECHO} THEN 'echo_reply' WHEN kind <> 'post' AND {_WORDS} < 8 THEN 'short' END AS left_out FROM posts WHERE source_type = 'forum'),
pool AS (SELECT * FROM framed WHERE left_out IS NULL),
keyed AS (SELECT *, sha256('{SEED}' || chr(0) || person || chr(0) || text) AS draw_key FROM pool),
capped AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY person ORDER BY draw_key, post_id) <= 5),
sizes AS (SELECT thread, count(*) AS s FROM capped GROUP BY thread),
best AS (SELECT coalesce(max(n), 0) AS n, coalesce(max(n) * 10 // 100, 0) AS cap FROM
  (SELECT n, n * 10 // 100 AS c, sum(least(s, n * 10 // 100)) AS give FROM range(1, 151) AS r(n), sizes GROUP BY n) WHERE give >= n),
drawn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY draw_key, post_id) AS place FROM capped) WHERE place <= (SELECT cap FROM best)
  ORDER BY draw_key, post_id LIMIT (SELECT n FROM best))"""


def _boot(cluster: str, name: str) -> str:
    return f"""{name}_c AS (SELECT cluster, row_number() OVER (ORDER BY cluster) - 1 AS pos FROM (SELECT DISTINCT {cluster} AS cluster FROM records)),
{name}_w AS (SELECT draw, cluster, count(*) AS w FROM (SELECT draw, slot,
    CAST('0x' || substr(sha256('{SEED}:' || draw || ':' || slot), 1, 8) AS BIGINT) % (SELECT count(*) FROM {name}_c) AS pos
    FROM range({DRAWS}) AS d(draw), range((SELECT count(*) FROM {name}_c)) AS s(slot)) JOIN {name}_c USING (pos) GROUP BY draw, cluster)"""


def _range(cluster: str, name: str, source: str = "m") -> str:
    """(measure, lo, hi) from ``source`` (measure, person, thread, num, den)."""
    return f"""{name}_s AS (SELECT measure, {cluster} AS cluster, sum(num) AS num, sum(den) AS den FROM {source} GROUP BY ALL),
{name}_r AS (SELECT measure, draw, CASE WHEN sum(w * den) > 0 THEN 100.0::DOUBLE * sum(w * num) / sum(w * den) END AS rate FROM {name}_s JOIN {name}_w USING (cluster) GROUP BY ALL),
{name} AS (SELECT measure, s[CAST(floor(0.025 * (len(s) - 1)) AS INT) + 1] AS lo, s[CAST(floor(0.975 * (len(s) - 1)) AS INT) + 1] AS hi
  FROM (SELECT measure, list_sort(list(rate) FILTER (rate IS NOT NULL)) AS s FROM {name}_r GROUP BY measure))"""


_HEAD = """m AS (SELECT 'negative' AS measure, person, thread, CAST(overall < 0 AS BIGINT) AS num, 1 AS den FROM records
  UNION ALL SELECT 'neutral', person, thread, CAST(overall = 0 AS BIGINT), 1 FROM records
  UNION ALL SELECT 'positive', person, thread, CAST(overall > 0 AS BIGINT), 1 FROM records)"""
_SHARES = f"""SELECT measure, CAST(k AS BIGINT) AS k, n, n_people, n_items, {v.STATUS} AS status, {_PCT} AS pct FROM
 (SELECT measure, sum(num) AS k, CAST(sum(den) AS BIGINT) AS n, count(DISTINCT CASE WHEN rests THEN person END) AS n_people, count(*) FILTER (rests) AS n_items FROM mm GROUP BY measure)"""


def _pool(spark, sf):
    return sampling.frame(v.posts(spark, sf)).filter("left_out IS NULL")


def _summary(spark, sf):
    pool = _pool(spark, sf)
    capped = sampling.person_cap(pool, SEED)
    return sampling.frame_summary(pool, capped, sampling.measurement_sample(pool, SEED))


def _uncapped(spark, sf):
    pool = _pool(spark, sf)
    sample = sampling.measurement_sample(pool, SEED)
    scores = v.records(spark, sf).select("post_id", "overall")
    return stats.cap_weights(sample, pool, _summary(spark, sf)).join(scores, "post_id")


def _records(f):
    return lambda spark, sf: f(v.records(spark, sf))


def _driver(spark, sf):
    return stats.driver_ranking(v.records(spark, sf))


def _compare(r):
    return stats.compare(r, F.col("overall") < 0, F.when(F.col("time") < "2024-01-16", "before").otherwise("after"), DRAWS, SEED)


def _shifts(r):
    named = r.crossJoin(r.sparkSession.createDataFrame([(a,) for a, *_ in v.ASPECTS], "a string").hint("broadcast"))
    side = F.when(F.col("time") < "2024-01-16", "before").otherwise("after")
    return stats.compare(named, F.map_contains_key("aspects", F.col("a")), side, DRAWS, SEED, F.col("a"))


_BEFORE = "CASE WHEN time < TIMESTAMP '2024-01-16' THEN 'before' ELSE 'after' END"
_COMPARE = f"""both_ AS (SELECT measure, {_BEFORE} AS side, person, thread, num FROM mm),
base AS (SELECT measure, CAST(sum(num) FILTER (side = 'before') AS BIGINT) AS k_before, CAST(sum(num) FILTER (side = 'after') AS BIGINT) AS k_after,
  count(*) FILTER (side = 'before') AS n_before, count(*) FILTER (side = 'after') AS n_after, count(DISTINCT person) AS n_people FROM both_ GROUP BY measure),
s AS (SELECT measure, side, person AS cluster, sum(num) AS num, count(*) AS den FROM both_ GROUP BY ALL),
reps AS (SELECT measure, draw, side, CASE WHEN sum(w * den) > 0 THEN 100.0::DOUBLE * sum(w * num) / sum(w * den) END AS rate FROM s JOIN pw_w USING (cluster) GROUP BY ALL),
d AS (SELECT measure, draw, max(rate) FILTER (side = 'after') - max(rate) FILTER (side = 'before') AS d FROM reps GROUP BY ALL),
iv AS (SELECT measure, s[CAST(floor(0.025 * (len(s) - 1)) AS INT) + 1] AS lo, s[CAST(floor(0.975 * (len(s) - 1)) AS INT) + 1] AS hi
  FROM (SELECT measure, list_sort(list(d) FILTER (d IS NOT NULL)) AS s FROM d GROUP BY measure)),
j AS (SELECT *, n_before >= 15 AND n_after >= 15 AND lo IS NOT NULL AS enough FROM base LEFT JOIN iv USING (measure))
SELECT measure, k_before, k_after, n_before, n_after, n_people, lo, hi,
  CASE WHEN n_people >= 20 THEN 100.0::DOUBLE * k_after / n_after - 100.0::DOUBLE * k_before / n_before END AS diff_pts,
  CASE WHEN n_people < 20 OR NOT enough THEN 'insufficient data' WHEN lo > 0 THEN 'rose' WHEN hi < 0 THEN 'fell' ELSE 'no clear change' END AS verdict FROM j"""

_ASPECT_TABLE = """own AS (SELECT aspect, count(*) AS mentions, count(DISTINCT person) AS people, avg(score) AS mean, count(*) FILTER (score <= -2) AS strong_negative,
  count(*) FILTER (score < 0) AS negative, count(*) FILTER (score > 0) AS positive, min(ord) AS first_seen FROM aspect_rows GROUP BY aspect),
tbl AS (SELECT own.*, CAST(sum(negative) OVER () AS BIGINT) AS all_negative, CAST(sum(positive) OVER () AS BIGINT) AS all_positive, n_items, n_people FROM own,
  (SELECT count(*) AS n_items, count(DISTINCT person) AS n_people FROM records))"""

_LOO = """k AS (SELECT 'source' AS kind, source AS removed, person, overall FROM records UNION ALL SELECT 'search_term', search_term, person, overall FROM records WHERE search_term IS NOT NULL
  UNION ALL SELECT 'thread', thread, person, overall FROM records),
g AS (SELECT kind, removed, count(*) AS c, count(*) OVER (PARTITION BY kind) AS of_kind, row_number() OVER (PARTITION BY kind ORDER BY count(*) DESC, removed) AS r FROM k GROUP BY kind, removed),
chosen AS (SELECT kind, removed FROM g WHERE (kind = 'search_term' OR of_kind > 1) AND (kind <> 'thread' OR r <= 5)),
rest AS (SELECT c.kind, c.removed, r.person, r.overall FROM chosen c JOIN records r ON
  CASE c.kind WHEN 'source' THEN r.source WHEN 'thread' THEN r.thread ELSE r.search_term END IS DISTINCT FROM c.removed),
o AS (SELECT kind, removed, count(*) FILTER (overall < 0) AS k, count(*) AS n, count(DISTINCT person) AS n_people, count(*) AS n_items FROM rest GROUP BY ALL)"""

def _tags(spark, sf):
    return v.select(spark, sf, {"post_id": v.POSTS["post_id"], "topic": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 't' || CAST(event_id % 17 AS VARCHAR(20)) END"}, "events")


def _heard(spark, sf):
    return stats.heard_enough(_tags(spark, sf), 40, SEED)


def _heard_range(spark, sf):
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "low", "high")]
    return stats.heard_range(_tags(spark, sf), 40, SEED).select("place", *rounded, "last_posts", F.round("last_new", 6).alias("last_new"))


def _period_sql(key: str) -> str:
    return f"WITH {v.R}, mm AS (SELECT {key} AS measure, person, CAST(overall < 0 AS BIGINT) AS num, 1 AS den, TRUE AS rests FROM records WHERE time IS NOT NULL), sh AS ({_SHARES}) SELECT * RENAME (measure AS period), n_items >= 15 AS usable FROM sh"


QUERIES = {
    "frame_left_out": lambda s, d: sampling.left_out_counts(v.posts(s, d)),
    "person_cap": lambda s, d: sampling.person_cap(_pool(s, d), SEED).select("post_id", "person", "draw_key"),
    "thread_cap_size": lambda s, d: sampling.thread_cap_size(sampling.person_cap(_pool(s, d), SEED)),
    "hash_draw": lambda s, d: sampling.measurement_sample(_pool(s, d), SEED).select("post_id", "thread", "person"),
    "frame_summary": _summary,
    "headline_share": _records(lambda r: stats.shares(stats.headline(r))),
    "people_net_negative": _records(stats.people_net_negative),
    "net_negative_range": _records(lambda r: stats.net_negative_range(r, "thread", DRAWS, SEED).select(F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))),
    "boot_range_people": _records(lambda r: stats.ranges(stats.headline(r), "person", DRAWS, SEED)),
    "boot_range_threads": _records(lambda r: stats.ranges(stats.headline(r), "thread", DRAWS, SEED)),
    "boot_wider": _records(lambda r: stats.share_table(stats.headline(r), DRAWS, SEED)),
    "aspect_table": _records(stats.aspect_table),
    "driver_rank": _driver,
    "strength_rank": _records(lambda r: stats.driver_ranking(r, "positive")),
    "top_driver_prob": _records(lambda r: stats.top_driver(r, "person", DRAWS, SEED)),
    "stance_split": _records(lambda r: stats.shares(stats.stance_measures(r))),
    "stance_talks_about": _records(lambda r: stats.top_aspects(r, F.when(F.col("stance") > 0, "in_favour").when(F.col("stance") < 0, "against"), 6)),
    "event_before_after": _records(_compare),
    "aspect_shifts": _records(_shifts),
    "period_unit": _records(stats.period_unit),
    "period_direction": _records(lambda r: stats.by_period(r, "week")),
    "period_months": _records(lambda r: stats.by_period(r, "month")),
    "by_source": _records(stats.by_source),
    "leave_one_out": _records(stats.leave_one_out),
    "cap_weights": lambda s, d: _uncapped(s, d).select("post_id", F.round("weight", 9).alias("weight")),
    "uncapped_estimate": lambda s, d: stats.without_caps(_uncapped(s, d)).withColumn("pct", F.round("pct", 6)),
    "saturation_curve": _heard,
    "saturation_range": _heard_range,
}

_W = f"WITH {v.P}, {_FRAME} "
ORACLE = {
    "frame_left_out": _W + "SELECT coalesce(left_out, 'eligible') AS rule, count(*) AS n FROM framed GROUP BY 1",
    "person_cap": _W + "SELECT post_id, person, draw_key FROM capped",
    "thread_cap_size": _W + "SELECT n, cap FROM best",
    "hash_draw": _W + "SELECT post_id, thread, person FROM drawn",
    "frame_summary": _W + "SELECT thread, count(*) AS eligible, count(*) FILTER (post_id IN (SELECT post_id FROM capped)) AS after_cap, count(*) FILTER (post_id IN (SELECT post_id FROM drawn)) AS sampled FROM pool GROUP BY thread",
    "headline_share": f"WITH {v.R}, {_HEAD}, mm AS (SELECT *, TRUE AS rests FROM m) {_SHARES}",
    "people_net_negative": f"WITH {v.R}, p AS (SELECT person, avg(overall) AS mean, count(*) AS m FROM records GROUP BY person), o AS (SELECT count(*) FILTER (mean < 0) AS k, count(*) AS n, CAST(sum(m) AS BIGINT) AS n_items, count(*) AS n_people FROM p) SELECT k, n, n_items, {v.STATUS} AS status, {_PCT} AS pct FROM o",
    "net_negative_range": f"""WITH {v.R}, {_boot('thread', 'tw')}, own AS (SELECT thread AS cluster, person, sum(overall) AS s, count(*) AS m FROM records GROUP BY ALL),
sz AS (SELECT person, count(*) AS a FROM records GROUP BY person), pd AS (SELECT draw, person, sum(w * s) AS s, sum(w * m) AS m FROM own JOIN tw_w USING (cluster) GROUP BY ALL),
r AS (SELECT draw, 100 * sum(CASE WHEN s < 0 THEN m::DOUBLE / a ELSE 0 END) / sum(m::DOUBLE / a) AS rate FROM pd JOIN sz USING (person) GROUP BY draw),
l AS (SELECT list_sort(list(rate)) AS s FROM r) SELECT round(s[CAST(floor(0.025 * (len(s) - 1)) AS INT) + 1], 6) AS lo, round(s[CAST(floor(0.975 * (len(s) - 1)) AS INT) + 1], 6) AS hi FROM l""",
    "boot_range_people": f"WITH {v.R}, {_HEAD}, {_boot('person', 'pw')}, {_range('person', 'pw')} SELECT measure, lo, hi FROM pw",
    "boot_range_threads": f"WITH {v.R}, {_HEAD}, {_boot('thread', 'tw')}, {_range('thread', 'tw')} SELECT measure, lo, hi FROM tw",
    "boot_wider": f"""WITH {v.R}, {_HEAD}, mm AS (SELECT *, TRUE AS rests FROM m), {_boot('person', 'pw')}, {_range('person', 'pw')}, {_boot('thread', 'tw')}, {_range('thread', 'tw')},
sh AS ({_SHARES}) SELECT sh.*, pw.lo AS people_lo, pw.hi AS people_hi, tw.lo AS threads_lo, tw.hi AS threads_hi, CASE WHEN tw.hi - tw.lo > pw.hi - pw.lo THEN 'threads' ELSE 'people' END AS range_from,
CASE WHEN tw.hi - tw.lo > pw.hi - pw.lo THEN tw.lo ELSE pw.lo END AS lo, CASE WHEN tw.hi - tw.lo > pw.hi - pw.lo THEN tw.hi ELSE pw.hi END AS hi FROM sh JOIN pw USING (measure) JOIN tw USING (measure)""",
    "aspect_table": f"""WITH {v.R}, {v.A}, {_ASPECT_TABLE} SELECT *, 100.0::DOUBLE * negative / mentions AS negative_rate, 100.0::DOUBLE * negative / all_negative AS share_of_negative,
100.0::DOUBLE * positive / all_positive AS share_of_positive, 100.0::DOUBLE * mentions / n_items AS mention_rate, {v.STATUS} AS status FROM tbl""",
    "driver_rank": f"WITH {v.R}, {v.A}, {_ASPECT_TABLE}, s AS (SELECT *, round(100.0::DOUBLE * negative / all_negative, 1) AS share FROM tbl WHERE mentions >= 3) SELECT aspect, mentions, share, CAST(row_number() OVER (ORDER BY share DESC, round(mean, 2), first_seen) AS INTEGER) AS rank FROM s WHERE share > 0",
    "strength_rank": f"WITH {v.R}, {v.A}, {_ASPECT_TABLE}, s AS (SELECT *, round(100.0::DOUBLE * positive / all_positive, 1) AS share FROM tbl WHERE mentions >= 3) SELECT aspect, mentions, share, CAST(row_number() OVER (ORDER BY share DESC, first_seen) AS INTEGER) AS rank FROM s WHERE share > 0",
    "top_driver_prob": f"""WITH {v.R}, {v.A}, {_boot('person', 'pw')}, ranked AS (SELECT aspect FROM aspect_rows GROUP BY aspect HAVING count(*) >= 3),
e AS (SELECT draw, aspect, sum(w) AS neg FROM aspect_rows JOIN pw_w ON cluster = person WHERE score < 0 AND aspect IN (SELECT aspect FROM ranked) GROUP BY ALL),
b AS (SELECT draw, aspect FROM e QUALIFY row_number() OVER (PARTITION BY draw ORDER BY neg DESC, aspect) = 1)
SELECT r.aspect, 100.0::DOUBLE * count(b.draw) / {DRAWS} AS probability FROM ranked r LEFT JOIN b USING (aspect) GROUP BY r.aspect""",
    "stance_split": f"""WITH {v.R}, mm AS (SELECT 'expressing' AS measure, person, CAST(stance IS NOT NULL AS BIGINT) AS num, 1 AS den, TRUE AS rests FROM records
UNION ALL SELECT 'in_favour', person, CAST(coalesce(stance > 0, FALSE) AS BIGINT), CAST(stance IS NOT NULL AS BIGINT), stance IS NOT NULL FROM records
UNION ALL SELECT 'against', person, CAST(coalesce(stance < 0, FALSE) AS BIGINT), CAST(stance IS NOT NULL AS BIGINT), stance IS NOT NULL FROM records
UNION ALL SELECT 'neither', person, CAST(coalesce(stance = 0, FALSE) AS BIGINT), CAST(stance IS NOT NULL AS BIGINT), stance IS NOT NULL FROM records) {_SHARES}""",
    "stance_talks_about": f"""WITH {v.R}, {v.A}, j AS (SELECT CASE WHEN stance > 0 THEN 'in_favour' WHEN stance < 0 THEN 'against' END AS grp, a.aspect, a.ord FROM aspect_rows a JOIN records USING (post_id)),
g AS (SELECT grp, aspect, count(*) AS n, min(ord) AS f FROM j WHERE grp IS NOT NULL GROUP BY ALL) SELECT grp, aspect, n, CAST(row_number() OVER (PARTITION BY grp ORDER BY n DESC, f, aspect) AS INTEGER) AS rank FROM g QUALIFY rank <= 6""",
    "event_before_after": f"WITH {v.R}, {_boot('person', 'pw')}, mm AS (SELECT 'negative' AS measure, person, thread, time, CAST(overall < 0 AS BIGINT) AS num FROM records), {_COMPARE}",
    "aspect_shifts": f"WITH {v.R}, {v.A}, {_boot('person', 'pw')}, mm AS (SELECT n.a AS measure, person, thread, time, CAST(EXISTS (SELECT 1 FROM aspect_rows x WHERE x.post_id = r.post_id AND x.aspect = n.a) AS BIGINT) AS num FROM records r, (VALUES " + ", ".join(f"('{a}')" for a, *_ in v.ASPECTS) + f") AS n(a)), {_COMPARE}",
    "period_unit": f"WITH {v.R}, s AS (SELECT CAST(floor((epoch(max(time)) - epoch(min(time))) / 86400) AS BIGINT) AS span_days FROM records) SELECT span_days, CASE WHEN span_days > 60 THEN 'month' WHEN span_days > 14 THEN 'week' END AS unit FROM s",
    "period_direction": _period_sql("strftime(time, '%G-W%V')"),
    "period_months": _period_sql("strftime(time, '%Y-%m')"),
    "by_source": f"WITH {v.R}, mm AS (SELECT source AS measure, person, CAST(overall < 0 AS BIGINT) AS num, 1 AS den, TRUE AS rests FROM records), sh AS ({_SHARES}), t AS (SELECT count(*) AS n_all FROM records) SELECT measure AS source, k, n, n_people, n_items, status, pct, n_all, 100.0::DOUBLE * n / n_all AS share_of_sample, count(*) OVER () > 1 AND round(100.0::DOUBLE * n / n_all, 1) > 50 AS dominant FROM sh, t",
    "leave_one_out": f"WITH {v.R}, {_LOO} SELECT kind, removed, k, n, n_people, {v.STATUS} AS status, {_PCT} AS pct FROM o",
    "cap_weights": _W + """, e AS (SELECT person, count(*) AS e FROM pool GROUP BY person), a AS (SELECT thread, count(*) AS a FROM capped GROUP BY thread), d AS (SELECT thread, count(*) AS d FROM drawn GROUP BY thread)
SELECT post_id, round((e::DOUBLE / least(e, 5)) * (a::DOUBLE / d), 9) AS weight FROM drawn JOIN e USING (person) JOIN a USING (thread) JOIN d USING (thread)""",
    "uncapped_estimate": f"WITH {v.P}, {v.R}, {_FRAME}" + f""", e AS (SELECT person, count(*) AS e FROM pool GROUP BY person), a AS (SELECT thread, count(*) AS a FROM capped GROUP BY thread), d AS (SELECT thread, count(*) AS d FROM drawn GROUP BY thread),
w AS (SELECT drawn.person, r.overall, (e::DOUBLE / least(e, 5)) * (a::DOUBLE / d) AS w FROM drawn JOIN e USING (person) JOIN a USING (thread) JOIN d USING (thread) JOIN records r USING (post_id)),
o AS (SELECT count(DISTINCT person) AS n_people, count(*) AS n_items, sum(w) AS t, sum(CASE WHEN overall < 0 THEN w ELSE 0 END) AS neg FROM w)
SELECT n_people, n_items, {v.STATUS} AS status, CASE WHEN n_people >= 20 THEN round(100 * neg / t, 6) END AS pct FROM o""",
    "saturation_curve": f"""WITH tags AS (SELECT 'E' || CAST(event_id AS VARCHAR(20)) AS post_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 't' || CAST(event_id % 17 AS VARCHAR(20)) END AS topic FROM events),
pl AS (SELECT post_id, run, row_number() OVER (PARTITION BY run ORDER BY sha256('{SEED}:' || run || ':' || post_id), post_id) AS place FROM (SELECT DISTINCT post_id FROM tags), range(40) AS r(run)),
f AS (SELECT run, topic, min(place) AS place FROM tags JOIN pl USING (post_id) WHERE topic IS NOT NULL GROUP BY ALL),
nw AS (SELECT place, count(*) / 40.0::DOUBLE AS new FROM f GROUP BY place)
SELECT p.place, round(sum(coalesce(new, 0)) OVER (ORDER BY p.place), 6) AS mean FROM (SELECT unnest(range(1, (SELECT count(DISTINCT post_id) FROM tags) + 1)) AS place) p LEFT JOIN nw USING (place)""",
}
