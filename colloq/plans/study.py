"""Queries of a study's way from sample to sections, of labels, audits, selection, synthesis and themes, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import thresholds as t
from ..functions import text as x
from ..operators import audit, coding, privacy, records, sampling, signals, stats, synthesis, themes
from ..workspace import written
from . import views as v
from .language import _SIGNALS
from .measures import _ASPECT_TABLE, _FRAME, _LOO, _PCT, _SHARES, _boot, _pool

SEED, DRAWS = 11, 200
_W = f"WITH {v.P}, {_FRAME} "

# --- From the sample to its sections ------------------------------------------------------------------------------------


def _posts(spark, sf):
    return v.posts(spark, sf).withColumn("search_term", F.lit(None).cast("string"))


def _labels(spark, sf):
    """The records' codes as JSON labels."""
    r = v.records(spark, sf)
    return r.select("post_id", F.to_json(F.struct("overall", F.col("aspects").alias("scores"), "stance")).alias("values"))


def sample_records(spark, sf):
    sample = sampling.measurement_sample(_pool(spark, sf), SEED)
    return records.assemble(sample, _posts(spark, sf), _labels(spark, sf), "scores")


def _drivers(spark, sf):
    return stats.driver_ranking(sample_records(spark, sf))


def _sampled(f):
    return lambda spark, sf: f(sample_records(spark, sf))


_R = f"{v.P}, all_{v.R}, {v.A.replace('aspect_rows', 'all_aspects')}, {_FRAME}, records AS (SELECT r.* FROM all_records r JOIN drawn d USING (post_id)), aspect_rows AS (SELECT a.* FROM all_aspects a JOIN drawn d USING (post_id))"
_SHIFT = "TIMESTAMP '2024-01-16'"


def _of(f):
    return lambda spark, sf: f(v.records(spark, sf))


def _loo(r):
    found = stats.loo_summary(stats.leave_one_out(r), r)
    return found.withColumns({c: F.round(c, 6) for c in ("min_pct", "max_pct", "change_pts")})


def _event(r):
    found = stats.event(r, "2024-01-16", DRAWS, SEED)
    return found.withColumns({c: F.round(c, 6) for c in ("lo", "hi", "diff_pts")})


def _direction(r):
    return stats.direction(r, DRAWS, SEED).withColumns({c: F.round(c, 6) for c in ("lo", "hi", "diff_pts")})


def _intervals(r):
    by = r.groupBy("source").agg(F.count_if(F.col("overall") < 0).alias("k"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("overall") > 0).alias("k2"))
    lo, hi = stats.wilson(F.col("k"), F.col("n"))
    dlo, dhi = stats.newcombe(F.col("k"), F.col("n"), F.col("k2"), F.col("n"))
    return by.select("source", *[F.round(c, 6).alias(k) for k, c in (("lo", lo), ("hi", hi), ("diff_lo", dlo), ("diff_hi", dhi))])


def _captured(spark, sf):
    return v.posts(spark, sf).withColumns({"capture_method": F.expr("CASE WHEN ord % 3 = 0 THEN 'paste' ELSE 'export' END"), "search_term": F.expr("CASE WHEN ord % 7 = 0 THEN NULL ELSE concat('q', ord % 4) END")})


def _log(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(F.expr("concat('s', event_id % 4)").alias("source"), F.expr("event_id % 2 = 0").alias("neutral"), F.expr("CAST(CASE WHEN event_id % 5 > 0 THEN event_id % 20 END AS INT)").alias("results_seen"), F.expr("CAST(event_id % 3 AS INT)").alias("kept"))


def _codes(spark, sf):
    n = v.notes(spark, sf).withColumn("role", F.expr("CASE WHEN ord % 5 = 0 THEN 'interviewer' ELSE 'participant' END"))
    turns = n.filter("source_type = 'interview'").select("post_id", "role")
    long = n.select("post_id", F.explode(F.create_map(F.lit("force"), F.col("force"), F.lit("evidence"), F.col("evidence"), F.lit("severity"), F.col("severity").cast("string"))).alias("variable", "value"))
    return records.interview_codes(turns, long)


def _rounds(spark, sf):
    """The negative share of each week as if it were a round's."""
    weekly = stats.by_period(v.records(spark, sf), "week").withColumn("round", F.dense_rank().over(stats.Window.orderBy("period")))
    return records.round_changes(weekly.select("round", F.round("pct", 1).alias("pct")))


def _verdict(spark, sf):
    r = sample_records(spark, sf)
    return records.verdict(stats.shares(stats.headline(r)).withColumn("pct", F.round("pct", 1)), stats.driver_ranking(r))


# --- Names, numbers, labels ----------------------------------------------------------------------------------------------


def _redacted(spark, sf):
    p = v.posts(spark, sf).withColumn("text", F.concat_ws(" ", "text", F.lit("Thanks"), "person", F.expr("concat('and u', ord % 50, '.')"), F.lit("not xu12 u1-a")))
    return privacy.redact_names(p, p.select(F.col("person").alias("name"))).select("post_id", "text", "n_names")


def _outputs(spark, sf):
    """Lines of an output, some with numbers that nothing accounts for."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    text = F.expr("concat('In ', 1990 + event_id % 50, ' we had ', event_id % 9, ' of ', event_id % 120, '.5 and 1,', lpad(event_id % 1000, 3, '0'), CASE WHEN event_id % 4 = 0 THEN concat(', see T01-p', lpad(event_id % 99, 2, '0')) ELSE '' END)")
    return e.select(F.lit("report.md").alias("file"), F.col("event_id").alias("line"), text.alias("text"), F.lit(None).cast("string").alias("post"))


def _cited(spark, sf):
    """Posts T01-p00 to T01-p98: each holds the number that its id and 20 make, and a score."""
    n = spark.range(99).withColumn("id", F.col("id").cast("int"))
    return n.select(F.expr("concat('T01-p', lpad(id, 2, '0'))").alias("post_id"), F.lit("T01").alias("thread"), F.lit("A thread of 7 days").alias("title"), F.expr("concat('It took ', id + 20, '.5 hours')").alias("text"), (F.col("id") % 9).alias("score"))


def _untraced(spark, sf):
    values = spark.range(0, 60).select((F.col("id") * 2).cast("double").alias("value"))
    allowed = audit.allowed_numbers(spark.createDataFrame([("up to 1,002 of 3.5",)], "text string"), values)
    return audit.untraced(_outputs(spark, sf), allowed, audit.post_numbers(_cited(spark, sf)))


def _typed(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    text = F.expr("concat('After ', event_id % 30 + 20, '.5 hours and {{ share 12 }} in 2024', CASE WHEN event_id % 3 = 0 THEN ' twice' ELSE ' 2 times' END)")
    prose = e.select(F.col("event_id").alias("place"), text.alias("text"), F.expr("CASE WHEN event_id % 5 <> 0 THEN concat('T01-p', lpad(event_id % 30, 2, '0')) END").alias("post"))
    return audit.typed_digits(prose, audit.post_numbers(_cited(spark, sf)))


_VARIABLES = [("overall", "single", False, None, "measurement"), ("scores", "per_aspect", False, None, "measurement"), ("friction", "single", False, None, "detail"), ("severity", "single", True, "friction", "detail"), ("stance", "single", True, None, "measurement")]
_VALUES = [*[("overall", str(k)) for k in range(-2, 3)], *[("scores", str(k)) for k in range(-2, 3)], ("friction", "true"), ("friction", "false"), *[("severity", str(k)) for k in (1, 2, 3)], *[("stance", str(k)) for k in range(-2, 3)]]


def _book(spark):
    variables = spark.createDataFrame([(n, k, nu, rw, s) for n, k, nu, rw, s in _VARIABLES], "variable string, kind string, nullable boolean, required_when string, sample string")
    order: dict[str, int] = {}
    rows = []
    for n, value in _VALUES:
        order[n] = order.get(n, -1) + 1
        rows.append((n, order[n], value))
    return variables, spark.createDataFrame(rows, "variable string, ord int, value string")


_LABEL = """CASE event_id % 12 WHEN 0 THEN '{"overall":1.0,"scores":{},"friction":true,"severity":2}' WHEN 1 THEN '{"overall":"1","scores":{"speed":2},"friction":false,"severity":null}'
WHEN 2 THEN '{"overall":true,"scores":[1],"friction":true,"severity":null}' WHEN 3 THEN '{"overall":-2,"scores":{"speed":1,"price":2},"friction":false,"severity":1}'
WHEN 4 THEN '{"overall":null,"scores":{"colour":1},"friction":true,"severity":9}' WHEN 5 THEN '{"overall":2,"scores":{"speed":7},"friction":true,"severity":3,"mood":1}'
WHEN 6 THEN '{"scores":{},"friction":false,"severity":null}' ELSE '{"overall":0,"scores":{"speed":-1},"friction":true,"severity":1}' END"""
_ITEM = "CASE WHEN event_id % 50 = 7 THEN 'x' || CAST(event_id AS VARCHAR(20)) WHEN event_id % 50 = 9 THEN 'i' || CAST(event_id - 1 AS VARCHAR(20)) ELSE 'i' || CAST(event_id AS VARCHAR(20)) END"


def _labelled(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(F.expr(_ITEM).alias("item_id"), F.expr(_LABEL).alias("values")), e.select(F.expr("'i' || CAST(event_id AS VARCHAR(20))").alias("item_id"))


def _checked(spark, sf):
    labels, items = _labelled(spark, sf)
    variables, allowed = _book(spark)
    used = variables.filter("variable <> 'stance'")
    return coding.check_labels(labels, items, used, allowed.select("variable", "value").filter("variable <> 'stance'"), ["speed", "price"])


def _sheet_items(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(F.expr("'i' || CAST(event_id AS VARCHAR(20))").alias("item_id"), F.expr("CASE WHEN event_id % 3 = 0 THEN 'detail' ELSE 'measurement' END").alias("sample"), F.expr(v.POSTS["text"]).alias("text"), F.lit(None).cast("string").alias("parent_text"), F.lit(True).alias("fresh"))


_SHEET = [(n, k, s) for n, k, _, _, s in _VARIABLES]


def _sheet(spark, sf):
    return coding.agreement_sheet(_sheet_items(spark, sf), _SHEET, ["speed", "price"], SEED)


def _filled(spark, sf):
    """The sheet of all items as two people might hand it in, with faults."""
    items = _sheet_items(spark, sf).withColumn("n", F.expr("CAST(substr(item_id, 2) AS BIGINT)"))
    m, d = F.col("sample") == "measurement", F.col("sample") == "detail"
    own = items.select(
        F.expr("CASE WHEN n % 40 = 3 THEN concat('y', n) ELSE item_id END").alias("item_id"), F.expr("CASE WHEN n % 41 = 0 THEN 'AI' WHEN n % 43 = 0 THEN '' ELSE 'Ann' END").alias("coder"), "text", F.lit("").alias("parent_text"),
        F.when(m, F.expr("CASE n % 5 WHEN 0 THEN '+1' WHEN 1 THEN '-2' WHEN 2 THEN '' WHEN 3 THEN 'good' ELSE ' 0 ' END")).otherwise("n/a").alias("overall"),
        F.when(m, F.expr("CASE WHEN n % 4 = 0 THEN '2' ELSE '' END")).otherwise("n/a").alias("scores[speed]"), F.when(m, F.expr("CASE WHEN n % 7 = 0 THEN '5' ELSE '' END")).otherwise("").alias("scores[price]"),
        F.when(d, F.expr("CASE WHEN n % 2 = 0 THEN 'TRUE' ELSE 'false' END")).when(F.expr("n % 11 = 0"), "true").otherwise("n/a").alias("friction"), F.when(d, F.expr("CASE WHEN n % 5 = 0 THEN '' ELSE '2' END")).otherwise("n/a").alias("severity"),
        F.when(m, F.expr("CASE WHEN n % 3 = 1 THEN '' ELSE '1' END")).otherwise("n/a").alias("stance"),
    )
    return own, items.select("item_id", "sample")


def _sheet_problems(spark, sf):
    sheet, items = _filled(spark, sf)
    variables, allowed = _book(spark)
    parsed = coding.parse_cells(coding.sheet_cells(sheet, _SHEET, ["speed", "price"]), allowed.select("variable", "value"))
    return coding.sheet_problems(parsed, items, variables).groupBy("variable", "rule").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("first"))


def _units(spark, sf):
    sheet, items = _filled(spark, sf)
    variables, allowed = _book(spark)
    parsed = coding.parse_cells(coding.sheet_cells(sheet, _SHEET, ["speed", "price"]), allowed.select("variable", "value")).filter("ok AND cell <> 'n/a'")
    held = parsed.join(items, "item_id").join(variables.select("variable", F.col("sample").alias("of")), "variable").filter("sample = of")
    return coding.units(held.select("item_id", "coder", "variable", "aspect", "value"), variables, allowed).groupBy("metric", "idx").agg(F.count(F.lit(1)).alias("n"))


# --- Selection ------------------------------------------------------------------------------------------------------------


def _flagged(spark, sf):
    found = signals.signals(v.posts(spark, sf)).select("post_id", "flags")
    return _pool(spark, sf).join(found, "post_id").select("ord", "post_id", "person", "kind", "score", "flags")


def _selected(spark, sf):
    pool = written(_flagged(spark, sf).withColumn("kind", F.expr("CASE WHEN ord < 40 THEN kind ELSE 'comment' END")), "flagged")
    clusters = pool.select("post_id", (F.col("ord") % 3).cast("int").alias("cluster"), F.row_number().over(stats.Window.partitionBy(F.col("ord") % 3).orderBy("ord")).alias("place"))
    return sampling.detail_selection(pool, clusters=clusters)


def _interviewed(spark, sf):
    p = v.posts(spark, sf)
    selected = p.filter("source_type = 'forum' AND ord % 100 = 1").select("post_id", "person", F.array(F.lit("all")).alias("reasons"))
    asked = p.filter("source_type = 'forum' AND ord % 50 = 1").select("post_id", "person", F.lit("why").alias("reason"))
    return sampling.with_interviews(selected, p, asked).select("post_id", F.array_join("reasons", ";").alias("reasons"))


# --- Synthesis ------------------------------------------------------------------------------------------------------------

_OBS = {
    "ord": "event_id",
    "post_id": "'E' || CAST(CASE WHEN event_id % 60 = 5 THEN event_id - 1 ELSE event_id END AS VARCHAR(20))",
    "observation": "CASE WHEN event_id % 11 = 9 AND event_id % 2 = 0 THEN 'the search is FAST' ELSE 'People say how it is' END",
    "quote": "CASE WHEN event_id % 11 = 9 THEN 'The search is fast' WHEN event_id % 11 = 6 THEN 'I ended up ... every single week' WHEN event_id % 11 = 3 THEN 'Agreed' WHEN event_id % 11 = 8 THEN 'wholly unlike any of it, and longer' ELSE NULL END",
}


def _nuggets(spark, sf):
    obs = v.select(spark, sf, _OBS, "events").filter("quote IS NOT NULL")
    posts = v.posts(spark, sf).filter("headline = FALSE").select("post_id", "person", "source_type", "text")
    codes = v.notes(spark, sf).filter("ord % 9 <> 0").select("post_id", "evidence")
    return synthesis.nuggets(obs, posts, codes)[1]


def _insights(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    ids = e.select(F.expr("concat('N', event_id % 300)").alias("id"), F.expr("CASE WHEN event_id % 7 = 0 THEN 'against' ELSE 'for' END").alias("side"), F.expr(v.NOTES["post_id"]).alias("post_id"))
    insights = spark.range(310).select(F.expr("concat('N', id)").alias("id"), F.expr("CASE WHEN id % 2 = 0 THEN 'high' ELSE 'medium' END").alias("confidence"))
    notes = v.notes(spark, sf).withColumn("thread", F.expr("concat('T', ord % 40)"))
    return synthesis.insight_checks(insights, ids, notes.select("post_id", "person", "source_type", "thread", "strong"), 30)


def _jobs(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    cites = e.select(F.expr("concat('J', event_id % 2000)").alias("id"), F.expr(v.NOTES["post_id"]).alias("post_id"))
    jobs = spark.range(2000).select(F.expr("concat('J', id)").alias("id"), F.expr("CASE WHEN id % 3 = 0 THEN 'Export more' ELSE 'When it is late, I want to export, so I can sleep' END").alias("job"))
    return synthesis.job_checks(jobs, cites, v.notes(spark, sf))


def _cites(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    cites = e.select(F.expr("CASE event_id % 3 WHEN 0 THEN 'insight' WHEN 1 THEN 'job' ELSE 'opportunity' END").alias("kind"), F.expr("concat('c', event_id % 90)").alias("id"), F.expr("'E' || CAST(CASE WHEN event_id % 77 = 0 THEN -event_id - 1 ELSE event_id END AS VARCHAR(20))").alias("post_id"))
    return synthesis.cite_problems(cites, v.notes(spark, sf))


def _hypotheses(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    signals_ = e.select(F.expr("concat('H', event_id % 500)").alias("id"), F.expr("CASE event_id % 3 WHEN 0 THEN 'for' WHEN 1 THEN 'unclear' ELSE CASE WHEN event_id % 4 = 0 THEN 'against' ELSE 'for' END END").alias("lean"), (F.col("event_id") % 23).alias("voices"), (F.col("event_id") % 31 == 0).alias("measured"))
    known = spark.range(520).select(F.expr("concat('H', id)").alias("id"), F.expr("CASE WHEN id % 2 = 0 THEN 'formed' ELSE 'stated' END").alias("origin"), F.expr("CASE WHEN id % 5 = 0 THEN 'low' ELSE 'high' END").alias("importance"))
    return synthesis.judged(signals_, known, 150, 90)


def _evidence(spark, sf):
    return synthesis.driver_evidence(stats.driver_ranking(v.records(spark, sf)).unionByName(spark.createDataFrame([("nothing", 0, 0.0, 9)], "aspect string, mentions bigint, share double, rank int")), v.notes(spark, sf))


def _unexamined(spark, sf):
    detail = signals.signals(v.posts(spark, sf)).select("post_id", "flags", "score", "ord")
    notes = v.notes(spark, sf).filter("ord % 4 <> 0")
    return synthesis.unexamined(detail, notes).select("post_id", "score")


# --- Themes ---------------------------------------------------------------------------------------------------------------


def _theme_items(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select(F.col("doc_id").alias("id"), F.col("source").alias("person"), "text")


def _by_modulo(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    own = d.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 7).cast("int").alias("cluster"))
    return own.withColumn("place", F.row_number().over(stats.Window.partitionBy("cluster").orderBy("id")))


def _weights(spark, sf):
    rows = themes.weights(themes.terms(_theme_items(spark, sf)).select("id", "terms"), "id", 2)
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("terms"), F.round(F.sum("w"), 6).alias("w"), F.round(F.max("w"), 6).alias("top"))


def _described(spark, sf):
    return themes.describe(_by_modulo(spark, sf), _theme_items(spark, sf).select("id", "person")).withColumn("representative", F.concat_ws(",", "representative"))


def _theme_gaps(spark, sf):
    clusters = _by_modulo(spark, sf)
    cites = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id % 7 < 5 AND doc_id % 14 < 4").select(F.expr("concat('N', doc_id % 3)").alias("insight"), F.col("doc_id").alias("id"))
    out = themes.summary(themes.describe(clusters, _theme_items(spark, sf).select("id", "person")), clusters.select("cluster", "id"), cites)
    return out.select("cluster", F.concat_ws(",", "linked").alias("linked"), "gap")


def _themes(spark, sf):
    found, _, _ = themes.themes(_theme_items(spark, sf), k=5)
    return found.select("cluster", "size", "coverage", "dominated_by", F.concat_ws(",", F.transform("representative", lambda i: i.cast("string"))).alias("representative"), F.concat_ws(",", "terms").alias("terms"))


# --- Functions ------------------------------------------------------------------------------------------------------------

_S = {
    "n": "event_id",
    "age": "CAST(event_id % 30 AS VARCHAR(20)) || CASE event_id % 5 WHEN 0 THEN 'd' WHEN 1 THEN 'w' WHEN 2 THEN 'mo' WHEN 3 THEN 'y' ELSE 'min' END || ' ago'",
    "votes": "CASE event_id % 4 WHEN 0 THEN '1.5k' WHEN 1 THEN CAST(event_id AS VARCHAR(20)) WHEN 2 THEN '-3' ELSE 'Vote' END",
    "score": "CASE event_id % 4 WHEN 0 THEN '12.7' WHEN 1 THEN '-4' WHEN 2 THEN 'x' ELSE CAST(event_id AS VARCHAR(20)) END",
    "ident": "CASE event_id % 3 WHEN 0 THEN 't3_' WHEN 1 THEN 't1_' ELSE '' END || 'a_' || CAST(event_id AS VARCHAR(20))",
    "at": "CASE event_id % 4 WHEN 0 THEN CAST(1700000000 + event_id * 61 AS VARCHAR(20)) WHEN 1 THEN '2024-02-03 04:05:06' WHEN 2 THEN '2024-02-03' ELSE 'soon' END",
    "stamp": "CASE event_id % 3 WHEN 0 THEN '01:02:' || CAST(10 + event_id % 50 AS VARCHAR(20)) || ',5' WHEN 1 THEN '12:34' ELSE '0:07' END",
    "title": "CASE event_id % 3 WHEN 0 THEN 'Is it -- Good? No. ' || CAST(event_id AS VARCHAR(20)) WHEN 1 THEN '!!!' ELSE 'A very long title that goes on and on until it is cut somewhere' END",
    "body": "CASE event_id % 3 WHEN 0 THEN 'See [this](http://a.b/c) by /u/some-one **now**' WHEN 1 THEN 'a &amp; b' || chr(10) || '> quoted' || chr(10) || 'c' ELSE '`x`  y' END",
    "said": "CASE event_id % 3 WHEN 0 THEN 'It’s “so” Ｆine, 20% or 1,234.5' WHEN 1 THEN 'P-12345678 on 2024-03-04 had 7' ELSE 'ﬁve — of 9' END",
}


def _functions(spark, sf):
    r = v.select(spark, sf, _S, "events")
    c = F.col
    return r.select(
        "n", x.age_to_date(c("age"), F.lit("2024-03-01").cast("date")).alias("age"), x.votes(c("votes")).alias("votes"), F.coalesce(x.parse_score(c("score")), F.lit(0)).alias("score"), x.strip_prefix(c("ident")).alias("ident"),
        x.parse_time(c("at")).alias("at"), x.ts_to_sec(c("stamp")).alias("seconds"), x.clock(x.ts_to_sec(c("stamp"))).alias("clock"), x.slug(c("title")).alias("slug"), x.clean_body(c("body")).alias("body"),
        x.loose(c("said")).alias("loose"), x.tidy(c("said")).alias("tidy"), F.array_join(x.numbers_in(c("said")), ";").alias("numbers"),
        x.word_diff(F.lit("the quick brown fox"), F.concat(F.lit("the slow brown fox "), (c("n") % 2).cast("string"))).alias("diff"),
    )


QUERIES = {
    "sample_records": lambda s, d: sample_records(s, d).select("post_id", "person", "overall", "stance", F.size("aspects").alias("n_aspects")),
    "sample_headline": _sampled(lambda r: stats.shares(stats.headline(r))),
    "sample_driver_rank": _drivers,
    "sample_summary": _sampled(records.sample_summary),
    "sample_verdict": _verdict,
    "headline_mean": _of(stats.headline_mean),
    "most_common_aspects": _of(lambda r: stats.most_common(r, 3)),
    "event_section": _of(_event),
    "direction_section": _of(_direction),
    "period_aspects": _of(lambda r: stats.period_aspects(r, "week", 2)),
    "leave_one_out_summary": _of(_loo),
    "older_intervals": _of(_intervals),
    "interview_counts": lambda s, d: records.interview_counts(v.posts(s, d).filter("source_type = 'interview'")),
    "interview_codes": _codes,
    "collection_sources": lambda s, d: records.collection_sources(_captured(s, d), _log(s, d)).withColumns({c: F.concat_ws(",", c) for c in ("capture", "search_terms")}),
    "collection_totals": lambda s, d: records.collection_totals(v.posts(s, d)),
    "search_totals": lambda s, d: records.search_totals(_log(s, d)),
    "round_changes": _rounds,
    "redacted_names": _redacted,
    "code_collisions": lambda s, d: privacy.collisions(v.posts(s, d).withColumns({"person_code": F.expr("concat('P-', ord % 700)"), "_key": F.col("person")})),
    "untraced_numbers": _untraced,
    "typed_digits": _typed,
    "visible_html": lambda s, d: audit.visible(s.read.parquet(f"{d}/pages.parquet")),
    "page_text": lambda s, d: s.read.parquet(f"{d}/pages.parquet").select("page_id", x.html_text(F.col("html")).alias("text")),
    "forum_context": lambda s, d: coding.with_parent(v.posts(s, d)).select("post_id", "parent_text"),
    "item_keys": lambda s, d: coding.with_parent(v.posts(s, d)).select("post_id", coding.item_key("m", "abc").alias("item_key")),
    "label_checks": _checked,
    "label_opposites": lambda s, d: coding.opposite_signs(_labelled(s, d)[0], "scores"),
    "agreement_sheet": _sheet,
    "sheet_problems": _sheet_problems,
    "agreement_units": _units,
    "agreement_quotas": lambda s, d: coding.quotas(s.read.parquet(f"{d}/events.parquet").select((F.col("event_id") % 130).alias("n_a"), (F.col("event_id") % 70).alias("n_b")).distinct()),
    "detail_selection": lambda s, d: _selected(s, d).select("post_id", F.array_join("reasons", ";").alias("reasons")),
    "selection_summary": lambda s, d: sampling.selection_summary(v.posts(s, d).select("post_id", "person", F.array(F.expr("CASE ord % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'flag:a,b' ELSE 'cluster:C01' END")).alias("reasons"))),
    "small_pool": lambda s, d: sampling.detail_selection(_flagged(s, d), budget=10**9).select("post_id", F.array_join("reasons", ";").alias("reasons")),
    "interview_inclusion": _interviewed,
    "topups": lambda s, d: sampling.topup(v.posts(s, d), v.posts(s, d).filter("ord % 4 = 0"), v.posts(s, d).filter("ord % 3 = 0")).select("post_id"),
    "nugget_problems": _nuggets,
    "insight_checks": _insights,
    "job_checks": _jobs,
    "cite_problems": _cites,
    "questions_rank": lambda s, d: synthesis.questions(v.notes(s, d).withColumn("tags", F.expr("CASE WHEN ord % 6 = 0 THEN array(topic, 'question') ELSE tags END"))),
    "frames": lambda s, d: synthesis.frames(v.notes(s, d).withColumn("frame", F.col("force")), ["push", "pull", "none", "absent"]).withColumn("aspects", F.concat_ws(",", "aspects")),
    "hypotheses_judged": _hypotheses,
    "hypothesis_share": lambda s, d: synthesis.greater(v.records(s, d), "share_of_negative", "speed", "price", "person", DRAWS, SEED),
    "hypothesis_proportion": lambda s, d: synthesis.proportion_lean(synthesis.proportion_range(v.notes(s, d).groupBy("person").agg((F.count_if("success") * 9 > F.count(F.lit(1))).alias("hit")), DRAWS, SEED)),
    "driver_evidence": _evidence,
    "unexamined_posts": _unexamined,
    "theme_weights": _weights,
    "theme_describe": _described,
    "theme_gaps": _theme_gaps,
    "theme_clusters": _themes,
    "text_functions": _functions,
}

_LOGGED = "log AS (SELECT 's' || CAST(event_id % 4 AS VARCHAR) AS source, event_id % 2 = 0 AS neutral, CASE WHEN event_id % 5 > 0 THEN CAST(event_id % 20 AS INTEGER) END AS results_seen, CAST(event_id % 3 AS INTEGER) AS kept FROM events)"
_IV = "s[CAST(floor(0.025 * (len(s) - 1)) AS INT) + 1] AS lo, s[CAST(floor(0.975 * (len(s) - 1)) AS INT) + 1] AS hi"


def _compare_sql(source: str, side: str, words: tuple[str, str] = ("rose", "fell")) -> str:
    """``compare`` of ``source`` (measure, person, time, num) as CTEs that end in ``compared``."""
    return f"""both_ AS (SELECT measure, {side} AS side, person, num FROM {source}), used AS (SELECT * FROM both_ WHERE side IS NOT NULL),
c AS (SELECT cluster, row_number() OVER (PARTITION BY measure_set ORDER BY cluster) - 1 AS pos, measure_set, count(*) OVER (PARTITION BY measure_set) AS n FROM (SELECT DISTINCT measure_set, person AS cluster FROM (SELECT CASE WHEN measure = 'in_favour' THEN 'v' ELSE 'a' END AS measure_set, person FROM used))),
w AS (SELECT measure_set, draw, cluster, count(*) AS w FROM (SELECT s.measure_set, d.draw, CAST('0x' || substr(sha256('{SEED}:' || d.draw || ':' || s.pos), 1, 8) AS BIGINT) % s.n AS pos FROM range({DRAWS}) AS d(draw), c s) x JOIN c USING (measure_set, pos) GROUP BY ALL),
sums AS (SELECT measure, CASE WHEN measure = 'in_favour' THEN 'v' ELSE 'a' END AS measure_set, side, person AS cluster, sum(num) AS num, count(*) AS den FROM used GROUP BY ALL),
reps AS (SELECT measure, draw, side, CASE WHEN sum(w * den) > 0 THEN 100.0::DOUBLE * sum(w * num) / sum(w * den) END AS rate FROM sums JOIN w USING (measure_set, cluster) GROUP BY ALL),
dd AS (SELECT measure, draw, max(rate) FILTER (side = 'after') - max(rate) FILTER (side = 'before') AS d FROM reps GROUP BY ALL),
iv AS (SELECT measure, {_IV} FROM (SELECT measure, list_sort(list(d) FILTER (d IS NOT NULL)) AS s FROM dd GROUP BY measure)),
base AS (SELECT measure, CAST(coalesce(sum(num) FILTER (side = 'before'), 0) AS BIGINT) AS k_before, CAST(coalesce(sum(num) FILTER (side = 'after'), 0) AS BIGINT) AS k_after, count(*) FILTER (side = 'before') AS n_before, count(*) FILTER (side = 'after') AS n_after, count(DISTINCT person) AS n_people FROM used GROUP BY measure),
compared AS (SELECT *, CASE WHEN n_people >= 20 THEN 100.0::DOUBLE * k_after / n_after - 100.0::DOUBLE * k_before / n_before END AS diff_pts,
  CASE WHEN n_people < 20 OR n_before < 15 OR n_after < 15 OR lo IS NULL THEN 'insufficient data' WHEN lo > 0 THEN '{words[0]}' WHEN hi < 0 THEN '{words[1]}' ELSE 'no clear change' END AS verdict FROM base LEFT JOIN iv USING (measure))"""


_SIDE = f"CASE WHEN time < {_SHIFT} THEN 'before' ELSE 'after' END"

ORACLE = {
    "sample_records": f"WITH {_R} SELECT post_id, person, overall, stance, CAST((SELECT count(*) FROM aspect_rows a WHERE a.post_id = records.post_id) AS INTEGER) AS n_aspects FROM records",
    "sample_headline": f"""WITH {_R}, mm AS (SELECT 'negative' AS measure, person, CAST(overall < 0 AS BIGINT) AS num, 1 AS den, TRUE AS rests FROM records UNION ALL SELECT 'neutral', person, CAST(overall = 0 AS BIGINT), 1, TRUE FROM records
UNION ALL SELECT 'positive', person, CAST(overall > 0 AS BIGINT), 1, TRUE FROM records) {_SHARES}""",
    "sample_driver_rank": f"WITH {_R}, {_ASPECT_TABLE}, s AS (SELECT *, round(100.0::DOUBLE * negative / all_negative, 1) AS share FROM tbl WHERE mentions >= 3) SELECT aspect, mentions, share, CAST(row_number() OVER (ORDER BY share DESC, round(mean, 2), first_seen) AS INTEGER) AS rank FROM s WHERE share > 0",
    "sample_summary": f"WITH {_R}, o AS (SELECT count(*) AS n_items, count(DISTINCT person) AS n_people, count(DISTINCT thread) AS n_threads FROM records) SELECT *, {v.STATUS} AS status, {v.STATUS} = 'full' AS show_words FROM o",
    "sample_verdict": f"""WITH {_R}, {_ASPECT_TABLE}, s AS (SELECT *, round(100.0::DOUBLE * negative / all_negative, 1) AS share FROM tbl WHERE mentions >= 3),
r AS (SELECT aspect, row_number() OVER (ORDER BY share DESC, round(mean, 2), first_seen) AS rank FROM s WHERE share > 0),
o AS (SELECT count(*) AS n_items, count(DISTINCT person) AS n_people, count(*) FILTER (overall < 0) AS k, round(100.0 * count(*) FILTER (overall < 0) / count(*), 1) AS neg, round(100.0 * count(*) FILTER (overall > 0) / count(*), 1) AS pos FROM records),
p AS (SELECT *, {v.STATUS} AS status, (SELECT list(aspect ORDER BY rank) FROM r) AS names FROM o), q AS (SELECT *, CASE WHEN status = 'early-signal' THEN names[1:2] ELSE names[1:3] END AS top FROM p)
SELECT CASE WHEN status = 'counts-only' THEN 'Too few people to measure: ' || k || ' of ' || n_items || ' sampled comments were negative' ELSE
  CASE WHEN neg - pos > 15 THEN CASE status WHEN 'early-signal' THEN 'Leaning ' ELSE 'Mostly ' END || 'negative' WHEN neg - pos < -15 THEN CASE status WHEN 'early-signal' THEN 'Leaning ' ELSE 'Mostly ' END || 'positive' ELSE 'Mixed' END
  || CASE WHEN len(top) > 0 THEN CASE status WHEN 'early-signal' THEN ', mostly about ' ELSE ', driven by ' END || CASE WHEN len(top) > 1 THEN array_to_string(top[1:len(top) - 1], ', ') || ' and ' || top[len(top)] ELSE top[1] END ELSE '' END
  || CASE status WHEN 'early-signal' THEN ', in a small sample' ELSE '' END END AS verdict FROM q""",
    "headline_mean": f"WITH {v.R}, o AS (SELECT count(*) AS n_items, count(DISTINCT person) AS n_people, avg(overall) AS m FROM records) SELECT n_items, n_people, {v.STATUS} AS status, CASE WHEN n_people >= 20 THEN round(m, 2) END AS mean FROM o",
    "most_common_aspects": f"WITH {v.A}, g AS (SELECT aspect, count(*) AS n, min(ord) AS f FROM aspect_rows GROUP BY aspect) SELECT aspect, n, CAST(row_number() OVER (ORDER BY n DESC, f, aspect) AS INTEGER) AS rank FROM g QUALIFY rank <= 3",
    "event_section": f"""WITH {v.R}, {v.A}, names AS (SELECT DISTINCT aspect FROM aspect_rows), mm AS (SELECT 'negative' AS measure, person, time, CAST(overall < 0 AS BIGINT) AS num FROM records UNION ALL SELECT 'in_favour', person, time, CAST(stance > 0 AS BIGINT) FROM records WHERE stance IS NOT NULL
UNION ALL SELECT n.aspect, person, time, CAST(EXISTS (SELECT 1 FROM aspect_rows x WHERE x.post_id = r.post_id AND x.aspect = n.aspect) AS BIGINT) FROM records r, names n), {_compare_sql('mm', _SIDE)},
a AS (SELECT *, CAST(row_number() OVER (ORDER BY abs(diff_pts) DESC, measure) AS INTEGER) AS rank FROM compared WHERE measure NOT IN ('negative', 'in_favour') AND verdict IN ('rose', 'fell')),
u AS (SELECT *, NULL AS rank, 'measure' AS kind FROM compared WHERE measure IN ('negative', 'in_favour') UNION ALL BY NAME SELECT *, 'aspect' AS kind FROM a WHERE rank <= 8)
SELECT measure, k_before, k_after, n_before, n_after, n_people, round(lo, 6) AS lo, round(hi, 6) AS hi, round(diff_pts, 6) AS diff_pts, verdict, kind, rank FROM u""",
    "direction_section": f"""WITH {v.R}, sp AS (SELECT CAST(floor((epoch(max(time)) - epoch(min(time))) / 86400) AS BIGINT) AS span_days FROM records), u AS (SELECT *, CASE WHEN span_days > 60 THEN 'month' WHEN span_days > 14 THEN 'week' END AS unit FROM sp),
k AS (SELECT *, CASE unit WHEN 'month' THEN strftime(time, '%Y-%m') ELSE strftime(time, '%G-W%V') END AS period FROM records, u), g AS (SELECT period, count(*) AS n FROM k GROUP BY period HAVING count(*) >= 15),
e AS (SELECT min(period) AS first, max(period) AS last, CAST(count(*) AS INTEGER) AS usable FROM g),
mm AS (SELECT 'negative' AS measure, person, CASE WHEN period = first THEN 'before' WHEN period = last THEN 'after' END AS sd, CAST(overall < 0 AS BIGINT) AS num FROM k, e), {_compare_sql('mm', 'sd', ('worsening', 'improving'))}
SELECT 'ok' AS status, span_days, unit, first, last, usable, k_before, k_after, n_before, n_after, round(lo, 6) AS lo, round(hi, 6) AS hi, round(diff_pts, 6) AS diff_pts, verdict FROM compared, u, e""",
    "period_aspects": f"""WITH {v.R}, {v.A}, j AS (SELECT strftime(r.time, '%G-W%V') AS period, a.aspect, a.ord FROM aspect_rows a JOIN records r USING (post_id) WHERE r.time IS NOT NULL), g AS (SELECT period, aspect, count(*) AS n, min(ord) AS f FROM j GROUP BY ALL)
SELECT period, aspect, n, CAST(row_number() OVER (PARTITION BY period ORDER BY n DESC, f, aspect) AS INTEGER) AS rank FROM g QUALIFY rank <= 2""",
    "leave_one_out_summary": f"""WITH {v.R}, {_LOO}, b AS (SELECT round(100.0::DOUBLE * count(*) FILTER (overall < 0) / count(*), 1) AS base FROM records), m AS (SELECT *, 100.0::DOUBLE * k / n AS pct FROM o WHERE n_people >= 20),
z AS (SELECT *, round(round(pct, 1) - base, 1) AS by_ FROM m, b), f AS (SELECT kind, removed, by_ FROM z ORDER BY abs(by_) DESC, CASE kind WHEN 'source' THEN 0 WHEN 'search_term' THEN 1 ELSE 2 END, removed LIMIT 1)
SELECT (SELECT count(*) FROM z) AS removals_with_pct, round((SELECT min(pct) FROM z), 6) AS min_pct, round((SELECT max(pct) FROM z), 6) AS max_pct, kind, removed, round(by_, 6) AS change_pts FROM f""",
    "older_intervals": f"""WITH {v.R}, g AS (SELECT source, count(*) FILTER (overall < 0)::DOUBLE AS k, count(*)::DOUBLE AS n, count(*) FILTER (overall > 0)::DOUBLE AS k2 FROM records GROUP BY source),
w AS (SELECT *, k / n AS p, k2 / n AS q, 1.96 * 1.96 AS zz FROM g),
i AS (SELECT *, 100 * greatest(0, (p + zz / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)) AS lo, 100 * least(1, (p + zz / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)) AS hi,
  100 * greatest(0, (q + zz / (2 * n) - 1.96 * sqrt(q * (1 - q) / n + zz / (4 * n * n))) / (1 + zz / n)) AS lo2, 100 * least(1, (q + zz / (2 * n) + 1.96 * sqrt(q * (1 - q) / n + zz / (4 * n * n))) / (1 + zz / n)) AS hi2 FROM w)
SELECT source, round(lo, 6) AS lo, round(hi, 6) AS hi, round(100 * (q - p) - sqrt(pow(100 * q - lo2, 2) + pow(hi - 100 * p, 2)), 6) AS diff_lo, round(100 * (q - p) + sqrt(pow(hi2 - 100 * q, 2) + pow(100 * p - lo, 2)), 6) AS diff_hi FROM i""",
    "interview_counts": f"WITH {v.P} SELECT count(DISTINCT thread) AS transcripts, count(DISTINCT person) FILTER (role = 'participant') AS participants, count(*) FILTER (role = 'participant') AS turns FROM posts WHERE source_type = 'interview'",
    "interview_codes": f"""WITH {v.N}, i AS (SELECT * FROM notes WHERE source_type = 'interview' AND ord % 5 <> 0), l AS (SELECT 'force' AS variable, force AS value FROM i UNION ALL SELECT 'evidence', evidence FROM i UNION ALL SELECT 'severity', CAST(severity AS VARCHAR) FROM i WHERE severity IS NOT NULL)
SELECT variable, value, count(*) AS n FROM l GROUP BY ALL""",
    "collection_sources": f"""WITH {v.P}, {_LOGGED}, c AS (SELECT *, CASE WHEN ord % 3 = 0 THEN 'paste' ELSE 'export' END AS capture_method, CASE WHEN ord % 7 <> 0 THEN 'q' || CAST(ord % 4 AS VARCHAR) END AS search_term FROM posts WHERE source_type = 'forum'),
l AS (SELECT source, count(*) AS m FROM log GROUP BY source)
SELECT source, count(DISTINCT thread) AS threads, count(*) AS posts, array_to_string(list_sort(list(DISTINCT capture_method)), ',') AS capture, array_to_string(list_sort(list(DISTINCT search_term) FILTER (search_term IS NOT NULL)), ',') AS search_terms, coalesce(max(m), 0) AS searches_logged FROM c LEFT JOIN l USING (source) GROUP BY source""",
    "collection_totals": f"""WITH {v.P} SELECT count(*) FILTER (source_type = 'forum') AS forum_posts, count(DISTINCT person) FILTER (source_type = 'forum' AND role = 'participant') AS forum_people, count(DISTINCT thread) FILTER (source_type = 'forum') AS forum_threads,
  count(*) FILTER (source_type = 'interview') AS interview_turns, min(CAST(time AS DATE)) FILTER (source_type = 'forum') AS first_day, max(CAST(time AS DATE)) FILTER (source_type = 'forum') AS last_day FROM posts""",
    "search_totals": f"WITH {_LOGGED} SELECT count(*) AS logged, count(*) FILTER (neutral) AS neutral, CAST(sum(results_seen) AS BIGINT) AS results_seen, CAST(sum(kept) AS BIGINT) AS kept, count(*) FILTER (kept = 0) AS kept_nothing FROM log",
    "round_changes": f"""WITH {v.R}, w AS (SELECT strftime(time, '%G-W%V') AS period, count(*) FILTER (overall < 0) AS k, count(*) AS n, count(DISTINCT person) AS p FROM records WHERE time IS NOT NULL GROUP BY 1),
r AS (SELECT CAST(row_number() OVER (ORDER BY period) AS INTEGER) AS round, CASE WHEN p >= 20 THEN round(100.0::DOUBLE * k / n, 1) END AS pct FROM w) SELECT round, pct, round(pct - lag(pct) OVER (ORDER BY round), 1) AS change_pts FROM r""",
    "redacted_names": f"""WITH {v.P}, known AS (SELECT list(DISTINCT person) AS names FROM posts), l AS (SELECT post_id, text, person, 'u' || CAST(ord % 50 AS VARCHAR) AS other, names FROM posts, known),
f AS (SELECT *, length(person) >= 3 AS a, length(other) >= 3 AND list_contains(names, other) AS b FROM l)
SELECT post_id, text || ' Thanks ' || CASE WHEN a THEN '[user]' ELSE person END || ' and ' || CASE WHEN b THEN '[user]' ELSE other END || '. not xu12 u1-a' AS text, a::INTEGER + b::INTEGER AS n_names FROM f""",
    "code_collisions": f"WITH {v.P} SELECT 'P-' || CAST(ord % 700 AS VARCHAR) AS person_code, count(DISTINCT person) AS names FROM posts GROUP BY 1 HAVING count(DISTINCT person) > 1",
    "untraced_numbers": """WITH l AS (SELECT event_id AS line, CAST(1990 + event_id % 50 AS VARCHAR) AS a, CAST(event_id % 9 AS VARCHAR) AS b, CAST(event_id % 120 AS VARCHAR) || '.5' AS c, '1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') AS d, CASE WHEN event_id % 4 = 0 THEN event_id % 99 END AS p FROM events),
n AS (SELECT line, p, unnest([b, c, d]) AS token FROM l), x AS (SELECT *, CAST(replace(token, ',', '') AS DOUBLE) AS value FROM n)
SELECT 'report.md' AS file, line, token FROM x WHERE NOT (value = floor(value) AND value BETWEEN 1990 AND 2100) AND NOT (value = floor(value) AND value < 120 AND value % 2 = 0) AND value NOT IN (1002, 3.5)
  AND NOT coalesce(value = p + 20.5 OR value = p % 9, FALSE)""",
    "typed_digits": """WITH l AS (SELECT event_id AS place, event_id % 30 + 20.5 AS h, event_id % 3 <> 0 AS two, CASE WHEN event_id % 5 <> 0 THEN event_id % 30 END AS p FROM events)
SELECT place, CAST(CAST(h AS DECIMAL(9, 1)) AS VARCHAR) AS token FROM l WHERE p IS NULL OR p + 20.5 <> h UNION ALL SELECT place, '2' FROM l WHERE two AND (p IS NULL OR p % 9 <> 2)""",
    "forum_context": f"WITH {v.P} SELECT a.post_id, b.text AS parent_text FROM posts a LEFT JOIN posts b ON b.post_id = a.parent_id",
    "item_keys": f"""WITH {v.P} SELECT a.post_id, sha256('["m","abc","' || a.text || '",' || coalesce('"' || b.text || '"', 'null') || ']') AS item_key FROM posts a LEFT JOIN posts b ON b.post_id = a.parent_id""",
    "label_checks": f"""WITH l AS (SELECT {_ITEM} AS item_id, event_id % 12 AS k FROM events), i AS (SELECT 'i' || CAST(event_id AS VARCHAR) AS item_id FROM events), ok AS (SELECT l.* FROM l JOIN i USING (item_id)), t AS (SELECT item_id, count(*) AS n, min_by(k, {_LABEL.replace('event_id % 12', 'k')}) AS k FROM ok GROUP BY item_id)
SELECT DISTINCT item_id, NULL AS variable, 'not an item' AS rule FROM l WHERE item_id NOT IN (SELECT item_id FROM i) UNION ALL SELECT item_id, NULL, 'labelled more than once' FROM t WHERE n > 1 UNION ALL SELECT item_id, NULL, 'not labelled' FROM i WHERE item_id NOT IN (SELECT item_id FROM l)
UNION ALL SELECT item_id, f.variable, f.rule FROM t JOIN (VALUES (0, 'overall', 'not allowed'), (1, 'overall', 'not allowed'), (2, 'overall', 'not allowed'), (2, 'scores', 'not an object of aspects'), (2, 'severity', 'required'), (3, 'severity', 'must be null'),
  (4, 'overall', 'null'), (4, 'scores', 'no such aspect'), (4, 'severity', 'not allowed'), (5, 'scores', 'score not allowed'), (5, 'mood', 'no such variable'), (6, 'overall', 'missing')) AS f(k, variable, rule) USING (k)""",
    "label_opposites": f"SELECT {_ITEM} AS item_id FROM events WHERE event_id % 12 = 3",
    "agreement_sheet": f"""WITH i AS (SELECT 'i' || CAST(event_id AS VARCHAR) AS item_id, CASE WHEN event_id % 3 = 0 THEN 'detail' ELSE 'measurement' END AS sample, {v.POSTS['text']} AS text FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY sha256('{SEED}:' || item_id), item_id) AS rn FROM i), p AS (SELECT *, sample = 'measurement' AS m FROM r WHERE rn <= CASE WHEN sample = 'measurement' THEN 60 ELSE 40 END)
SELECT item_id, '' AS coder, text, '' AS parent_text, CASE WHEN m THEN '' ELSE 'n/a' END AS overall, CASE WHEN m THEN '' ELSE 'n/a' END AS "scores[speed]", CASE WHEN m THEN '' ELSE 'n/a' END AS "scores[price]",
  CASE WHEN m THEN 'n/a' ELSE '' END AS friction, CASE WHEN m THEN 'n/a' ELSE '' END AS severity, CASE WHEN m THEN '' ELSE 'n/a' END AS stance FROM p""",
    "sheet_problems": """WITH e AS (SELECT event_id AS n, CASE WHEN event_id % 40 = 3 THEN 'y' || CAST(event_id AS VARCHAR) ELSE 'i' || CAST(event_id AS VARCHAR) END AS item_id, event_id % 3 <> 0 AS m, event_id % 40 = 3 AS lost FROM events),
f AS (SELECT item_id, NULL AS variable, 'not a coded item' AS rule FROM e WHERE lost UNION ALL SELECT item_id, NULL, 'reserved coder' FROM e WHERE n % 41 = 0 UNION ALL SELECT item_id, NULL, 'no coder' FROM e WHERE n % 43 = 0 AND n % 41 <> 0
UNION ALL SELECT item_id, 'overall', 'not allowed' FROM e WHERE m AND NOT lost AND n % 5 = 3 UNION ALL SELECT item_id, 'overall', 'null' FROM e WHERE m AND NOT lost AND n % 5 = 2 UNION ALL SELECT item_id, 'scores', 'not allowed' FROM e WHERE m AND NOT lost AND n % 7 = 0
UNION ALL SELECT item_id, 'friction', 'does not apply' FROM e WHERE m AND NOT lost AND n % 11 = 0 UNION ALL SELECT item_id, 'severity', 'required' FROM e WHERE NOT m AND NOT lost AND n % 2 = 0 AND n % 5 = 0 UNION ALL SELECT item_id, 'severity', 'must be null' FROM e WHERE NOT m AND NOT lost AND n % 2 = 1 AND n % 5 <> 0)
SELECT variable, rule, count(*) AS n, min(item_id) AS first FROM f GROUP BY ALL""",
    "agreement_units": """WITH e AS (SELECT event_id AS n, event_id % 3 <> 0 AS m FROM events WHERE event_id % 40 <> 3),
u AS (SELECT 'overall' AS metric, CASE n % 5 WHEN 0 THEN 3 WHEN 1 THEN 0 ELSE 2 END AS idx FROM e WHERE m AND n % 5 IN (0, 1, 4) UNION ALL SELECT 'scores (mentioned)', (n % 4 = 0)::INT FROM e WHERE m UNION ALL SELECT 'scores (mentioned)', 0 FROM e WHERE m AND n % 7 <> 0 UNION ALL SELECT 'scores', 4 FROM e WHERE m AND n % 4 = 0
UNION ALL SELECT 'friction', (n % 2 = 1)::INT FROM e WHERE NOT m UNION ALL SELECT 'severity (expressed)', (n % 5 <> 0)::INT FROM e WHERE NOT m UNION ALL SELECT 'severity', 1 FROM e WHERE NOT m AND n % 5 <> 0
UNION ALL SELECT 'stance (expressed)', (n % 3 <> 1)::INT FROM e WHERE m UNION ALL SELECT 'stance', 3 FROM e WHERE m AND n % 3 <> 1) SELECT metric, CAST(idx AS INTEGER) AS idx, count(*) AS n FROM u GROUP BY ALL""",
    "agreement_quotas": "WITH s AS (SELECT DISTINCT event_id % 130 AS n_a, event_id % 70 AS n_b FROM events), d AS (SELECT *, least(100 - least(60, n_a), n_b) AS b FROM s) SELECT least(100 - b, n_a) AS a, b FROM d",
    "selection_summary": f"""WITH {v.P}, f AS (SELECT person, CASE ord % 3 WHEN 0 THEN 'first:post' WHEN 1 THEN 'first:flag' ELSE 'first:cluster' END AS what FROM posts), p AS (SELECT person FROM posts GROUP BY person HAVING count(*) >= {t.DETAIL_PER_PERSON})
SELECT what, count(*) AS n FROM f GROUP BY what UNION ALL SELECT 'people_at_cap', count(*) FROM p""",
    "small_pool": _W + "SELECT post_id, 'all' AS reasons FROM pool",
    "interview_inclusion": f"""WITH {v.P} SELECT post_id, 'all' AS reasons FROM posts WHERE source_type = 'forum' AND ord % 100 = 1 UNION ALL SELECT post_id, 'interview' FROM posts WHERE source_type = 'interview' AND role = 'participant'
UNION ALL SELECT post_id, 'topup: why' FROM posts WHERE source_type = 'forum' AND ord % 50 = 1 AND ord % 100 <> 1""",
    "topups": f"WITH {v.P} SELECT post_id FROM posts WHERE source_type = 'forum' AND NOT headline AND ord % 3 = 0 AND ord % 4 <> 0",
    "nugget_problems": f"""WITH {v.P}, o AS (SELECT event_id AS ord, CASE WHEN event_id % 60 = 5 THEN event_id - 1 ELSE event_id END AS of, event_id % 11 AS q, event_id % 11 = 9 AND event_id % 2 = 0 AS rep FROM events WHERE event_id % 11 IN (3, 6, 8, 9)),
k AS (SELECT o.*, p.post_id, p.text, p.source_type, 'E' || CAST(o.of AS VARCHAR) AS pid, row_number() OVER (PARTITION BY o.of ORDER BY o.ord) AS nth FROM o LEFT JOIN posts p ON p.ord = o.of AND NOT p.headline), g AS (SELECT * FROM k WHERE post_id IS NOT NULL AND nth = 1)
SELECT pid AS post_id, 'error' AS level, 'not in the detail selection' AS problem FROM k WHERE post_id IS NULL UNION ALL SELECT pid, 'error', 'a post gets one observation' FROM k WHERE post_id IS NOT NULL AND nth > 1
UNION ALL SELECT pid, 'error', 'the quote is not verbatim' FROM g WHERE q = 8 OR of % 11 <> q UNION ALL SELECT pid, 'warning', 'very short quote' FROM g WHERE q = 3 UNION ALL SELECT pid, 'warning', 'the observation repeats the quote' FROM g WHERE rep
UNION ALL SELECT pid, 'warning', 'not coded yet' FROM g WHERE of % 9 = 0 UNION ALL SELECT pid, 'warning', 'coded as observed, from a forum' FROM g WHERE of % 9 <> 0 AND of % 4 = 3 AND source_type = 'forum'""",
    "insight_checks": f"""WITH {v.N}, c AS (SELECT 'N' || CAST(ord % 300 AS VARCHAR) AS id, ord % 7 = 0 AS against, person, source_type = 'interview' AS inside, ord % 40 AS thread, strong FROM notes),
b AS (SELECT id, count(DISTINCT person) FILTER (NOT against) AS voices, count(DISTINCT person) FILTER (NOT against AND NOT inside) AS forum, count(DISTINCT thread) FILTER (NOT against AND inside) AS talks, count(*) FILTER (NOT against AND strong) AS strong, bool_or(against) AS counter FROM c GROUP BY id),
i AS (SELECT 'N' || CAST(r AS VARCHAR) AS id, r % 2 = 0 AS high FROM range(310) AS x(r)), j AS (SELECT i.*, coalesce(voices, 0) AS voices, coalesce(forum, 0) AS forum, coalesce(talks, 0) AS talks, coalesce(strong, 0) AS strong, coalesce(counter, FALSE) AS counter FROM i LEFT JOIN b USING (id))
SELECT id, 'one voice' AS warning FROM j WHERE voices = 1 UNION ALL SELECT id, 'high without enough behind it' FROM j WHERE high AND (NOT (forum >= 5 OR talks >= 10) OR strong = 0) UNION ALL SELECT id, 'no counter-evidence' FROM j WHERE NOT counter""",
    "job_checks": f"""WITH {v.N}, c AS (SELECT ord % 2000 AS j, count(DISTINCT force) FILTER (force <> 'none') AS f FROM notes GROUP BY 1)
SELECT 'J' || CAST(r AS VARCHAR) AS id, 'no job story' AS warning FROM range(2000) AS x(r) WHERE r % 3 = 0 UNION ALL SELECT 'J' || CAST(r AS VARCHAR), 'fewer than two forces' FROM range(2000) AS x(r) LEFT JOIN c ON j = r WHERE coalesce(f, 0) < 2""",
    "cite_problems": "SELECT CASE event_id % 3 WHEN 0 THEN 'insight' WHEN 1 THEN 'job' ELSE 'opportunity' END AS kind, 'c' || CAST(event_id % 90 AS VARCHAR) AS id, 'E' || CAST(-event_id - 1 AS VARCHAR) AS post_id FROM events WHERE event_id % 77 = 0",
    "questions_rank": f"""WITH {v.N}, g AS (SELECT aspect, count(*) AS n, count(DISTINCT person) AS voices, count(DISTINCT person) FILTER (source_type <> 'interview') AS forum, count(DISTINCT person) FILTER (source_type = 'interview') AS interview, max(coalesce(severity, 0)) AS max_sev,
  round(avg(coalesce(severity, 0)), 1) AS mean_sev, count(*) FILTER (strong) AS strong FROM notes WHERE ord % 6 = 0 GROUP BY aspect) SELECT *, CAST(row_number() OVER (ORDER BY n DESC, aspect) AS INTEGER) AS rank FROM g""",
    "frames": f"""WITH {v.N} SELECT force AS frame, count(*) AS n, count(DISTINCT person) AS voices, count(DISTINCT person) FILTER (source_type <> 'interview') AS forum, count(DISTINCT person) FILTER (source_type = 'interview') AS interview,
  array_to_string(list_sort(list(DISTINCT aspect)), ',') AS aspects FROM notes WHERE force IN ('push', 'pull') GROUP BY force""",
    "hypotheses_judged": """WITH s AS (SELECT event_id % 500 AS h, CASE event_id % 3 WHEN 0 THEN 'for' WHEN 1 THEN 'unclear' ELSE CASE WHEN event_id % 4 = 0 THEN 'against' ELSE 'for' END END AS lean, event_id % 23 AS voices, event_id % 31 = 0 AS measured FROM events),
g AS (SELECT h, bool_or(lean = 'for') AS f, bool_or(lean = 'against') AS a, max(CASE WHEN measured AND lean <> 'unclear' THEN greatest(voices, 90) ELSE voices END) AS voices FROM s GROUP BY h),
k AS (SELECT 'H' || CAST(r AS VARCHAR) AS id, CASE WHEN r % 2 = 0 THEN 'formed' ELSE 'stated' END AS origin, CASE WHEN r % 5 = 0 THEN 'low' ELSE 'high' END AS importance, coalesce(f, FALSE) AS f, coalesce(a, FALSE) AS a, coalesce(voices, 0) AS voices FROM range(520) AS x(r) LEFT JOIN g ON h = r),
l AS (SELECT *, CASE WHEN f AND a THEN 'mixed' WHEN f THEN 'leans for' WHEN a THEN 'leans against' ELSE 'can''t tell from this data' END AS lean, CASE WHEN voices < 5 THEN 'weak' WHEN voices < 15 THEN 'moderate' ELSE 'strong' END AS strength FROM k)
SELECT id, origin, importance, lean, strength, voices, CASE WHEN importance = 'low' THEN 'park for now' WHEN origin = 'formed' THEN 'test first' WHEN strength <> 'weak' AND lean IN ('leans for', 'leans against') THEN 'build on it, keep checking' ELSE 'test first' END AS priority,
  CASE WHEN origin = 'formed' AND lean = 'leans against' THEN 'formed from this data, which leans against it' END AS warning FROM l""",
    "hypothesis_share": f"""WITH {v.R}, {v.A}, cl AS (SELECT person AS cluster, count(*) FILTER (aspect = 'speed') AS sp, count(*) FILTER (aspect = 'price') AS pr, count(*) AS al FROM aspect_rows WHERE score < 0 GROUP BY person),
used AS (SELECT DISTINCT cluster FROM (SELECT person AS cluster FROM aspect_rows)), {_boot('person', 'pw').replace('FROM (SELECT DISTINCT person AS cluster FROM records)', 'FROM used')},
r AS (SELECT draw, coalesce(CASE WHEN sum(w * al) > 0 THEN 100.0::DOUBLE * sum(w * sp) / sum(w * al) END, 0) AS ra, coalesce(CASE WHEN sum(w * al) > 0 THEN 100.0::DOUBLE * sum(w * pr) / sum(w * al) END, 0) AS rb FROM cl JOIN pw_w USING (cluster) GROUP BY draw),
p AS (SELECT 100.0::DOUBLE * count(*) FILTER (ra > rb) / count(*) AS probability FROM r) SELECT probability, CASE WHEN probability >= 80 THEN 'for' WHEN probability <= 20 THEN 'against' ELSE 'unclear' END AS lean FROM p""",
    "hypothesis_proportion": f"""WITH {v.N}, records AS (SELECT person, count(*) FILTER (success) * 9 > count(*) AS hit FROM notes GROUP BY person), {_boot('person', 'pw')},
r AS (SELECT draw, 100.0::DOUBLE * sum(w * hit::INT) / sum(w) AS rate FROM records JOIN pw_w ON cluster = person GROUP BY draw), l AS (SELECT list_sort(list(rate)) AS s FROM r), i AS (SELECT {_IV} FROM l),
o AS (SELECT CAST(count(*) FILTER (hit) AS BIGINT) AS k, count(*) AS n, count(*) AS n_people, count(*) AS n_items FROM records)
SELECT k, n, n_people, n_items, {v.STATUS} AS status, {_PCT} AS pct, lo, hi, CASE WHEN n_people >= 20 AND lo > 50 THEN 'for' WHEN n_people >= 20 AND hi < 50 THEN 'against' ELSE 'unclear' END AS lean FROM o, i""",
    "driver_evidence": f"""WITH {v.R}, {v.A}, {v.N}, {_ASPECT_TABLE}, dr AS (SELECT aspect FROM tbl WHERE mentions >= 3 AND round(100.0::DOUBLE * negative / all_negative, 1) > 0 UNION ALL SELECT 'nothing'),
o AS (SELECT *, row_number() OVER (PARTITION BY aspect, person ORDER BY strong DESC, coalesce(severity, 0) DESC, coalesce(score, 0) DESC, ord) AS own FROM notes WHERE aspect IN (SELECT aspect FROM dr)),
k AS (SELECT aspect, post_id, CAST(row_number() OVER (PARTITION BY aspect ORDER BY own > 1, strong DESC, coalesce(severity, 0) DESC, coalesce(score, 0) DESC, ord) AS INTEGER) AS rank FROM o QUALIFY rank <= 3) SELECT d.aspect, k.post_id, k.rank FROM dr d LEFT JOIN k USING (aspect)""",
    "unexamined_posts": f"WITH {v.P}, {_SIGNALS} SELECT post_id, score FROM sig WHERE len(flags) > 0 AND ord % 4 = 0 ORDER BY coalesce(score, 0) DESC, ord LIMIT 12",
    "theme_describe": """WITH d AS (SELECT doc_id AS id, CAST(doc_id % 7 AS INTEGER) AS cluster, source AS person FROM documents), b AS (SELECT cluster, person, count(*) AS m FROM d GROUP BY ALL),
t AS (SELECT cluster, CAST(sum(m) AS BIGINT) AS size, count(*) AS coverage, max(m) AS top FROM b GROUP BY cluster), p AS (SELECT cluster, max(person) AS person FROM b JOIN t USING (cluster) WHERE m = top GROUP BY cluster),
r AS (SELECT cluster, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS representative FROM (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY id) <= 3) GROUP BY cluster)
SELECT cluster, size, coverage, CASE WHEN size >= 4 AND top * 2 > size THEN person END AS dominated_by, representative FROM t JOIN p USING (cluster) JOIN r USING (cluster)""",
    "theme_gaps": """WITH d AS (SELECT doc_id AS id, CAST(doc_id % 7 AS INTEGER) AS cluster, source FROM documents), l AS (SELECT cluster, string_agg(DISTINCT 'N' || CAST(id % 3 AS VARCHAR), ',' ORDER BY 'N' || CAST(id % 3 AS VARCHAR)) AS linked FROM d WHERE id % 7 < 5 AND id % 14 < 4 GROUP BY cluster),
c AS (SELECT cluster, count(DISTINCT source) AS coverage FROM d GROUP BY cluster) SELECT cluster, coalesce(linked, '') AS linked, linked IS NULL AND coverage >= 5 AS gap FROM c LEFT JOIN l USING (cluster)""",
    "text_functions": f"""WITH {v.cte('f', _S, 'events')}, g AS (SELECT * FROM f)
SELECT n, DATE '2024-03-01' - CAST(n % 30 * CASE n % 5 WHEN 0 THEN 1 WHEN 1 THEN 7 WHEN 2 THEN 30 WHEN 3 THEN 365 ELSE 0 END AS INTEGER) AS age, CAST(CASE n % 4 WHEN 0 THEN 1500 WHEN 1 THEN n WHEN 2 THEN -3 END AS INTEGER) AS votes,
  CAST(CASE n % 4 WHEN 0 THEN 12 WHEN 1 THEN -4 WHEN 2 THEN 0 ELSE n END AS INTEGER) AS score, 'a_' || CAST(n AS VARCHAR) AS ident,
  CASE n % 4 WHEN 0 THEN date_trunc('minute', make_timestamp((1700000000 + n * 61) * 1000000)) WHEN 1 THEN TIMESTAMP '2024-02-03 04:05:06' WHEN 2 THEN TIMESTAMP '2024-02-03' END AS at,
  CASE n % 3 WHEN 0 THEN 3720 + 10 + n % 50 + 0.5 WHEN 1 THEN 754 ELSE 7 END::DOUBLE AS seconds, CASE n % 3 WHEN 0 THEN '62:' || CAST(10 + n % 50 AS VARCHAR) WHEN 1 THEN '12:34' ELSE '00:07' END AS clock,
  CASE n % 3 WHEN 0 THEN 'is-it-good-no-' || CAST(n AS VARCHAR) WHEN 1 THEN 'thread' ELSE 'a-very-long-title-that-goes-on-and-on-un' END AS slug, CASE n % 3 WHEN 0 THEN 'See this by /u/[user] now' WHEN 1 THEN 'a & b c' ELSE 'x y' END AS body,
  CASE n % 3 WHEN 0 THEN 'its so fine 20 or 1 234 5' WHEN 1 THEN 'p 12345678 on 2024 03 04 had 7' ELSE 'five of 9' END AS loose, CASE n % 3 WHEN 0 THEN 'It''s "so" Fine, 20% or 1,234.5' WHEN 1 THEN 'P-12345678 on 2024-03-04 had 7' ELSE 'five — of 9' END AS tidy,
  CASE n % 3 WHEN 0 THEN '20;1,234.5' WHEN 1 THEN '7' ELSE '9' END AS numbers, 'the [-slow-] {{+quick+}} brown fox [-' || CAST(n % 2 AS VARCHAR) || '-]' AS diff FROM g""",
}
