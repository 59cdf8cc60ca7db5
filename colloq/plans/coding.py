"""Queries of coding, agreement, notes, hypotheses and conversations on the driver tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import coding, conversation, synthesis
from . import views as v
from .measures import _boot

SEED, DRAWS = 11, 200

_CODES = """codes AS (SELECT 'quality' AS metric, doc_id AS unit, 'a' AS coder, quality AS idx FROM labels UNION ALL SELECT 'quality', doc_id, 'b', CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END FROM labels
  UNION ALL SELECT 'quality', doc_id, 'c', CASE WHEN doc_id % 5 = 0 THEN toxic ELSE quality END FROM labels WHERE doc_id % 2 = 0)"""


def codes(spark, sf):
    """Labels as one coder's, and two more derived from them."""
    rows = spark.read.parquet(f"{sf}/labels.parquet")
    parts = [
        rows.select(F.lit("quality").alias("metric"), F.col("doc_id").alias("unit"), F.lit(c).alias("coder"), F.expr(e).alias("idx"))
        for c, e in (("a", "quality"), ("b", "CASE WHEN doc_id % 7 = 0 THEN 1 - quality ELSE quality END"))
    ]
    third = rows.filter("doc_id % 2 = 0").select(F.lit("quality").alias("metric"), F.col("doc_id").alias("unit"), F.lit("c").alias("coder"), F.expr("CASE WHEN doc_id % 5 = 0 THEN toxic ELSE quality END").alias("idx"))
    return parts[0].unionByName(parts[1]).unionByName(third)


def _alpha(spark, sf, level):
    return coding.alpha(codes(spark, sf), level).withColumn("alpha", F.round("alpha", 9))


_ALPHA = """per AS (SELECT metric, unit, idx, count(*) AS m FROM codes GROUP BY ALL), used AS (SELECT *, sum(m) OVER (PARTITION BY metric, unit) AS sz FROM per QUALIFY sz > 1),
o AS (SELECT a.metric, a.idx AS c, b.idx AS k, sum(a.m * (b.m - (a.idx = b.idx)::INT)::DOUBLE / (a.sz - 1)) AS o FROM used a JOIN used b USING (metric, unit) GROUP BY ALL),
n AS (SELECT metric, idx AS c, sum(m)::DOUBLE AS n FROM used GROUP BY ALL)"""


def _alpha_sql(distance: str) -> str:
    return f"""WITH {_CODES}, {_ALPHA}, p AS (SELECT a.metric, a.c, b.c AS k, a.n, b.n AS n2, {distance} AS d FROM n a JOIN n b USING (metric))
SELECT p.metric, (SELECT count(DISTINCT unit) FROM codes) AS units, (SELECT count(DISTINCT unit) FROM used) AS pairable,
  round(1 - ((SELECT sum(n) FROM n) - 1) * sum(coalesce(o.o, 0) * d) / sum(n * n2 * d), 9) AS alpha FROM p LEFT JOIN o USING (metric, c, k) GROUP BY p.metric"""


_VOICES = "count(DISTINCT person) AS voices, count(DISTINCT person) FILTER (source_type <> 'interview') AS forum, count(DISTINCT person) FILTER (source_type = 'interview') AS interview"
_GROUP = f"count(*) AS n, {_VOICES}, max(coalesce(severity, 0)) AS max_sev, round(avg(coalesce(severity, 0)), 1) AS mean_sev, count(*) FILTER (strong) AS strong"
_FORCES = ", ".join(f"count(*) FILTER (force = '{f}') AS {f}" for f in synthesis.FORCES)


def _turns(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    who = F.expr("CASE WHEN turn % 4 = 3 THEN NULL WHEN turn % 4 = 0 THEN 'A' ELSE role END")
    return rows.select(F.col("conv_id").alias("thread"), F.col("turn").alias("ord"), who.alias("speaker"), "text", F.when(F.col("turn") % 2 == 0, F.col("turn") * 1.0).alias("end_s"))


_SPOKEN = "t AS (SELECT conv_id AS thread, turn AS ord, CASE WHEN turn % 4 = 3 THEN NULL WHEN turn % 4 = 0 THEN 'A' ELSE role END AS speaker, text, CASE WHEN turn % 2 = 0 THEN turn * 1.0::DOUBLE END AS end_s FROM conversations)"


def _tree(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    return conversation.reply_tree(rows.select(F.col("conv_id").alias("thread"), F.col("turn").alias("id"), F.expr("CASE WHEN turn > 0 THEN turn DIV 2 END").alias("parent"), (F.length("text") % 5).alias("score"), F.col("turn").alias("ord")).withColumn("parent", F.when(F.col("parent") != F.col("id"), F.col("parent"))))


def _exports(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    return conversation.export_dedupe(rows.select(F.col("doc_id").alias("ord"), F.expr("CASE WHEN doc_id % 50 = 0 THEN 'RepostBot' ELSE source END").alias("author"), F.col("lang").alias("link"), F.expr("CASE WHEN doc_id % 4 = 0 THEN 'post' ELSE 'comment' END").alias("kind"), F.expr("CAST(doc_id % 170 AS STRING)").alias("rid")))


def _ids(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("ord"), F.col("lang").alias("thread"), F.col("source").alias("author"), "text")
    none = spark.createDataFrame([], "thread string, key string, n int")
    return conversation.stable_ids(rows, none).drop("key")


def _context(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    role = F.expr("CASE role WHEN 'user' THEN 'participant' WHEN 'assistant' THEN 'interviewer' ELSE 'unknown' END")
    return coding.with_context(rows.select(F.col("conv_id").alias("thread"), F.col("turn").alias("ord"), role.alias("role"), "text")).filter("role = 'participant'")


def _notes(f):
    return lambda spark, sf: f(v.notes(spark, sf))


def _reuse(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.sha2(F.to_json(F.array(F.lit("m"), "text")), 256).alias("item_key"))
    return coding.reusable(rows, rows.filter("doc_id % 2 = 0").select("item_key")).select("doc_id", "reused")


def _labels(spark, sf):
    """Labels of which every third is of an item that there is not; all documents are items."""
    rows = spark.read.parquet(f"{sf}/labels.parquet")
    item = F.expr("CASE WHEN doc_id % 3 = 0 THEN -1 - doc_id ELSE doc_id END").alias("item_id")
    rows = rows.select(item, F.expr("CASE WHEN doc_id % 11 = 0 THEN 'true' WHEN doc_id % 13 = 0 THEN 'null' ELSE CAST(quality AS STRING) END").alias("value"), F.lit("quality").alias("variable"))
    items = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("item_id"))
    allowed = spark.createDataFrame([("quality", "0"), ("quality", "1")], "variable string, value string")
    return coding.label_errors(rows, items, allowed, spark.createDataFrame([("quality", False)], "variable string, nullable boolean"))


QUERIES = {
    "alpha_nominal": lambda s, d: _alpha(s, d, "nominal"),
    "alpha_ordinal": lambda s, d: _alpha(s, d, "ordinal"),
    "confusion": lambda s, d: coding.confusion(codes(s, d), "a", "b"),
    "section_status": lambda s, d: coding.section_status(coding.alpha(codes(s, d), "nominal"), ["quality"]),
    "batch_assign": lambda s, d: coding.batches(s.read.parquet(f"{d}/labels.parquet").select(F.col("doc_id").alias("id")), SEED),
    "label_reuse": _reuse,
    "label_errors": _labels,
    "context_prev_turn": _context,
    "nugget_groups": _notes(synthesis.group),
    "pains_rank": _notes(synthesis.pains),
    "successes_rank": _notes(synthesis.successes),
    "force_balance": _notes(lambda n: synthesis.force_balance(n, "aspect")),
    "forces_reach": _notes(synthesis.forces_reach),
    "opportunity_rank": _notes(synthesis.opportunity_rank),
    "products": _notes(synthesis.products),
    "tag_pairs": _notes(synthesis.tag_pairs),
    "evidence_mix": _notes(synthesis.evidence_mix),
    "diverse_pick": _notes(synthesis.diverse_pick),
    "hypothesis_greater": lambda s, d: synthesis.greater(v.records(s, d), "negative_rate", "speed", "price", "person", DRAWS, SEED),
    "hypothesis_above": lambda s, d: synthesis.above(v.records(s, d), "mention_rate", 25.0, "person", DRAWS, SEED),
    "hypothesis_voices": _notes(lambda n: synthesis.voices_lean(n, F.when(F.col("sentiment") > 1, "for").when(F.col("sentiment") < -1, "against"))),
    "proportion_range": _notes(lambda n: synthesis.proportion_range(n.groupBy("person").agg((F.count_if("friction") * 2 > F.count(F.lit(1))).alias("hit")), DRAWS, SEED)),
    "merge_speakers": lambda s, d: conversation.merge_speakers(_turns(s, d)),
    "role_guess": lambda s, d: conversation.role_guess(_turns(s, d).filter("speaker IS NOT NULL")),
    "reply_tree": _tree,
    "export_dedupe": _exports,
    "stable_ids": _ids,
}

ORACLE = {
    "alpha_nominal": _alpha_sql("(a.c <> b.c)::INT"),
    "alpha_ordinal": _alpha_sql("CASE WHEN a.c = b.c THEN 0 ELSE pow((SELECT sum(g.n) FROM n g WHERE g.c BETWEEN least(a.c, b.c) AND greatest(a.c, b.c)) - (a.n + b.n) / 2, 2) END"),
    "confusion": f"WITH {_CODES} SELECT a.idx AS row, b.idx AS col, count(*) AS n FROM codes a JOIN codes b USING (unit) WHERE a.coder = 'a' AND b.coder = 'b' GROUP BY ALL",
    "batch_assign": f"WITH n AS (SELECT doc_id AS id, row_number() OVER (ORDER BY sha256('{SEED}:' || doc_id), doc_id) AS n FROM labels) SELECT id, 'm' || lpad(CAST(n AS VARCHAR), 4, '0') AS item_id, CAST((n - 1) // 40 + 1 AS INTEGER) AS batch FROM n",
    "label_reuse": "SELECT doc_id, text IN (SELECT text FROM documents WHERE doc_id % 2 = 0) AS reused FROM documents",
    "label_errors": """WITH l AS (SELECT CASE WHEN doc_id % 3 = 0 THEN -1 - doc_id ELSE doc_id END AS item_id, 'quality' AS variable, CASE WHEN doc_id % 11 = 0 THEN 'true' WHEN doc_id % 13 = 0 THEN 'null' ELSE CAST(quality AS VARCHAR) END AS value FROM labels),
i AS (SELECT doc_id AS item_id FROM documents)
SELECT DISTINCT item_id, NULL AS variable, 'unknown item' AS rule FROM l WHERE item_id NOT IN (SELECT item_id FROM i) UNION ALL SELECT item_id, 'quality', 'missing' FROM i WHERE item_id NOT IN (SELECT item_id FROM l)
UNION ALL SELECT item_id, variable, 'null' FROM l WHERE value = 'null' UNION ALL SELECT item_id, variable, 'not allowed' FROM l WHERE value NOT IN ('0', '1', 'null')""",
    "context_prev_turn": "WITH t AS (SELECT conv_id AS thread, turn AS ord, role, text, CASE WHEN lag(role) OVER w = 'assistant' THEN lag(text) OVER w END AS parent_text FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT thread, ord, 'participant' AS role, text, parent_text FROM t WHERE role = 'user'",
    "nugget_groups": f"WITH {v.N} SELECT aspect, {_GROUP} FROM notes GROUP BY aspect",
    "pains_rank": f"WITH {v.N}, g AS (SELECT aspect, {_GROUP} FROM notes WHERE friction GROUP BY aspect) SELECT *, CAST(row_number() OVER (ORDER BY voices * max_sev DESC, n DESC, aspect) AS INTEGER) AS rank FROM g",
    "successes_rank": f"WITH {v.N}, g AS (SELECT aspect, {_GROUP} FROM notes WHERE success GROUP BY aspect) SELECT *, CAST(row_number() OVER (ORDER BY voices DESC, n DESC, aspect) AS INTEGER) AS rank FROM g",
    "force_balance": f"WITH {v.N} SELECT aspect, {_FORCES}, count(*) AS n, {_VOICES} FROM notes GROUP BY aspect",
    "forces_reach": f"WITH {v.N} SELECT force, count(*) AS n, {_VOICES} FROM notes WHERE force <> 'none' GROUP BY force",
    "opportunity_rank": f"WITH {v.N}, g AS (SELECT aspect, count(*) AS n, {_VOICES}, round(coalesce(avg(coalesce(severity, 0)) FILTER (friction), 0), 1) AS mean_sev FROM notes GROUP BY aspect) SELECT *, round(voices * (1 + mean_sev), 2) AS rank_score FROM g",
    "products": f"WITH {v.N} SELECT split_part(second, ':', 2) AS name, {_FORCES}, count(*) AS n, count(DISTINCT person) AS voices, round(avg(sentiment), 2) + 0.0 AS mean_sentiment FROM notes WHERE second LIKE 'product:%' GROUP BY 1",
    "tag_pairs": f"WITH {v.N} SELECT least(topic, second) AS a, greatest(topic, second) AS b, count(*) AS n FROM notes WHERE second NOT LIKE 'product:%' GROUP BY ALL HAVING count(*) >= 2 ORDER BY n DESC, a, b LIMIT 15",
    "evidence_mix": f"WITH {v.N} SELECT evidence, count(*) AS n FROM notes GROUP BY evidence",
    "diverse_pick": f"""WITH {v.N}, o AS (SELECT *, row_number() OVER (PARTITION BY aspect, person ORDER BY strong DESC, coalesce(severity, 0) DESC, coalesce(score, 0) DESC, ord) AS own FROM notes)
SELECT aspect, post_id, CAST(row_number() OVER (PARTITION BY aspect ORDER BY own > 1, strong DESC, coalesce(severity, 0) DESC, coalesce(score, 0) DESC, ord) AS INTEGER) AS rank FROM o QUALIFY rank <= 3""",
    "hypothesis_greater": f"""WITH {v.R}, {v.A}, {_boot('person', 'pw')}, s AS (SELECT aspect, person AS cluster, count(*) FILTER (score < 0) AS num, count(*) AS den FROM aspect_rows GROUP BY ALL),
r AS (SELECT draw, aspect, 100.0::DOUBLE * sum(w * num) / sum(w * den) AS rate FROM s JOIN pw_w USING (cluster) GROUP BY ALL), k AS (SELECT draw, max(rate) FILTER (aspect = 'speed') AS ra, max(rate) FILTER (aspect = 'price') AS rb FROM r GROUP BY draw),
p AS (SELECT 100.0::DOUBLE * count(*) FILTER (ra > rb) / count(*) AS probability FROM k WHERE ra IS NOT NULL AND rb IS NOT NULL) SELECT probability, CASE WHEN probability >= 80 THEN 'for' WHEN probability <= 20 THEN 'against' ELSE 'unclear' END AS lean FROM p""",
    "hypothesis_above": f"""WITH {v.R}, {v.A}, {_boot('person', 'pw')}, c AS (SELECT person AS cluster, count(*) AS den FROM records GROUP BY ALL), a AS (SELECT DISTINCT aspect FROM aspect_rows),
s AS (SELECT a.aspect, c.cluster, c.den, (SELECT count(*) FROM aspect_rows x WHERE x.aspect = a.aspect AND x.person = c.cluster) AS num FROM a, c),
r AS (SELECT draw, aspect, 100.0::DOUBLE * sum(w * num) / sum(w * den) AS rate FROM s JOIN pw_w USING (cluster) GROUP BY ALL),
p AS (SELECT aspect AS measure, 100.0::DOUBLE * count(*) FILTER (rate > 25) / count(*) AS probability FROM r GROUP BY aspect) SELECT *, CASE WHEN probability >= 80 THEN 'for' WHEN probability <= 20 THEN 'against' ELSE 'unclear' END AS lean FROM p""",
    "hypothesis_voices": f"WITH {v.N}, c AS (SELECT count(DISTINCT person) FILTER (sentiment > 1) AS voices_for, count(DISTINCT person) FILTER (sentiment < -1) AS voices_against FROM notes) SELECT *, CASE WHEN voices_for >= 2 AND voices_for >= 2 * voices_against THEN 'for' WHEN voices_against >= 2 AND voices_against >= 2 * voices_for THEN 'against' ELSE 'unclear' END AS lean FROM c",
    "merge_speakers": f"""WITH {_SPOKEN}, f AS (SELECT *, coalesce(last_value(speaker IGNORE NULLS) OVER (PARTITION BY thread ORDER BY ord), 'UNKNOWN') AS who FROM t),
g AS (SELECT *, CASE WHEN who = lag(who) OVER (PARTITION BY thread ORDER BY ord) THEN 0 ELSE 1 END AS new FROM f), h AS (SELECT *, CAST(sum(new) OVER (PARTITION BY thread ORDER BY ord) AS BIGINT) AS seg FROM g)
SELECT thread, seg, min(who) AS speaker, string_agg(text, ' ' ORDER BY ord) AS text, max_by(end_s, CASE WHEN end_s IS NOT NULL THEN ord END) AS end_s FROM h GROUP BY thread, seg""",
    "export_dedupe": "WITH e AS (SELECT doc_id AS ord, CASE WHEN doc_id % 50 = 0 THEN 'RepostBot' ELSE source END AS author, lang AS link, CASE WHEN doc_id % 4 = 0 THEN 'post' ELSE 'comment' END AS kind, CAST(doc_id % 170 AS VARCHAR) AS rid FROM documents) SELECT * FROM e WHERE NOT lower(author) LIKE '%bot' QUALIFY row_number() OVER (PARTITION BY link, kind, rid ORDER BY ord) = 1",
    "stable_ids": "SELECT doc_id AS ord, lang AS thread, CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS INTEGER) AS n FROM documents",
    "section_status": f"WITH a AS ({_alpha_sql('(a.c <> b.c)::INT')}) SELECT CASE WHEN alpha IS NULL THEN 'unverified' WHEN alpha >= 0.8 THEN 'verified' WHEN alpha >= 0.667 THEN 'tentative' ELSE 'unreliable' END AS status FROM a",
    "proportion_range": f"""WITH {v.N}, records AS (SELECT person, count(*) FILTER (friction) * 2 > count(*) AS hit FROM notes GROUP BY person), {_boot('person', 'pw')},
r AS (SELECT draw, 100.0::DOUBLE * sum(w * hit::INT) / sum(w) AS rate FROM records JOIN pw_w ON cluster = person GROUP BY draw), l AS (SELECT list_sort(list(rate)) AS s FROM r),
o AS (SELECT CAST(count(*) FILTER (hit) AS BIGINT) AS k, count(*) AS n, count(*) AS n_people, count(*) AS n_items FROM records)
SELECT k, n, n_people, n_items, {v.STATUS} AS status, CASE WHEN n_people >= 20 THEN 100.0::DOUBLE * k / n END AS pct, s[CAST(floor(0.025 * (len(s) - 1)) AS INT) + 1] AS lo, s[CAST(floor(0.975 * (len(s) - 1)) AS INT) + 1] AS hi FROM o, l""",
    "role_guess": f"""WITH {_SPOKEN}, s AS (SELECT thread, speaker, avg(contains(text, '?')::INT) AS q, avg(length(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))) AS words, count(*) AS n, min(ord) AS first FROM t WHERE speaker IS NOT NULL GROUP BY ALL),
l AS (SELECT *, CASE WHEN regexp_matches(lower(speaker), 'interviewer|moderator|researcher|facilitator|host') OR regexp_full_match(lower(speaker), '(int|mod|r)\\d*') THEN 'interviewer' WHEN regexp_matches(lower(speaker), 'participant|respondent|interviewee|user|customer') OR regexp_full_match(lower(speaker), 'p\\d+') THEN 'participant' END AS label FROM s),
w AS (SELECT *, bool_or(coalesce(label = 'interviewer', FALSE)) OVER p AS labelled, count(*) OVER p AS speakers, bool_or(n >= 2) OVER p AS several FROM l WINDOW p AS (PARTITION BY thread)),
r AS (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY (n >= 2 OR NOT several) DESC, q DESC, words, first) AS rank FROM w)
SELECT thread, speaker, CASE WHEN labelled THEN coalesce(label, 'participant') WHEN speakers = 1 THEN 'participant' WHEN rank = 1 THEN 'interviewer' ELSE 'participant' END AS role,
  CASE WHEN labelled THEN 'labels' WHEN speakers = 1 THEN 'single' ELSE 'questions' END AS method FROM r""",
    "reply_tree": """WITH RECURSIVE p AS (SELECT conv_id AS thread, turn AS id, CASE WHEN turn > 0 AND turn // 2 <> turn THEN turn // 2 END AS parent, CAST(length(text) % 5 AS BIGINT) AS score, turn AS ord FROM conversations),
n AS (SELECT x.*, y.id AS up, -coalesce(x.score, 0) * 1000000 + x.ord AS k FROM p x LEFT JOIN p y ON y.thread = x.thread AND y.id = x.parent),
tree AS (SELECT thread, id, [k] AS path FROM n WHERE up IS NULL UNION ALL SELECT n.thread, n.id, list_append(t.path, n.k) FROM n JOIN tree t ON n.thread = t.thread AND n.up = t.id)
SELECT thread, id, CAST(len(path) - 1 AS INTEGER) AS depth, row_number() OVER (PARTITION BY thread ORDER BY path) AS place FROM tree""",
}
