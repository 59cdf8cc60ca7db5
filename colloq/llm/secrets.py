"""Secret scans behind a trigram inverted index.

Postings (trigram, document) are kept in a written table sorted by trigram. From each rule's regular expression
a Boolean trigram query is derived: an OR of branches, each an AND of all trigrams of the text that a match
of the branch must contain. Intersected postings give the candidates of a rule, which alone are read again and
verified. A rule without mandatory trigrams (here: hex) scans every text. Only trigrams that some rule asks for
are posted; the index folds ASCII case, so it never misses a match. All of it is DataFrame operations.

Base rules count only if the counted group is long enough; spans are leftmost, non-overlapping per kind, in
code points, end exclusive. The index adds no spans of its own.

Defined results: a null text is empty; rows with a null doc_id and rows that repeat are scanned like others
(a row is known by doc_id and a hash of its text); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, written

#: Candidates up to this many rows are sent to all tasks (some 60 bytes each); more of them are shuffled.
BROADCAST_ROWS = 50_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a Java regular expression; what it matches counts if its group ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int


ASSIGN = Rule(
    "assign",
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    2,
    8,
)
ACCESS = Rule("access", r"AKIA[A-Z0-9]+", 0, 16)
# A run of 32 is what [0-9a-f]+ with 32 characters matches; shorter runs need not be taken out of the text.
HEX = Rule("hex", r"[0-9a-f]{32,}", 0, 32)
RULES = (ASSIGN, ACCESS, HEX)


# --- Boolean trigram queries -------------------------------------------------------------------------------------


def _alternatives(parsed, limit: int = 64) -> list[list[str]]:
    """Branches of a parsed expression, each a list of literal runs that any match of the branch contains."""
    import re._constants as c

    branches: list[list[str]] = [[""]]

    def literal(x: str) -> None:
        for b in branches:
            b[-1] += x

    def gap() -> None:
        for b in branches:
            b.append("")

    for op, arg in parsed:
        if op is c.LITERAL:
            literal(chr(arg))
        elif op is c.SUBPATTERN:
            inner = _alternatives(arg[3], limit)
            branches[:] = _joined(branches, inner, limit)
        elif op is c.BRANCH:
            inner = [alt for part in arg[1] for alt in _alternatives(part, limit)]
            branches[:] = _joined(branches, inner, limit)
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[:2] == (0, 1):
            inner = [[""], *_alternatives(arg[2], limit)]
            branches[:] = _joined(branches, inner, limit)
        else:  # a class, a repeat or an assertion: nothing certain, and neighbours are no longer adjacent
            gap()
    return branches


def _joined(branches: list[list[str]], inner: list[list[str]], limit: int) -> list[list[str]]:
    if len(branches) * len(inner) > limit:
        return [[*b, ""] for b in branches]
    return [[*b[:-1], b[-1] + x[0], *x[1:]] for b in branches for x in inner]


def trigram_query(pattern: str) -> list[list[str]]:
    """OR of ANDs of case-folded trigrams; empty if some branch has no mandatory trigram."""
    import re._parser as parser

    found: list[list[str]] = []
    for runs in _alternatives(parser.parse(pattern)):
        grams = sorted({run[k : k + 3].lower() for run in runs for k in range(len(run) - 2)})
        if not grams:
            return []
        if grams not in found:
            found.append(grams)
    return found


# --- Index -----------------------------------------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id, row) of the given trigrams, written and sorted by trigram within each file."""
    folded = F.lower("text")
    present = F.filter(F.array(*[F.when(F.contains(folded, F.lit(t)), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    rows = _keyed(docs).select("doc_id", "row", F.explode(present).alias("trigram"))
    return written(rows.sortWithinPartitions("trigram", "doc_id"), "trigram-index")


def candidates(index: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """(doc_id, row, kinds): documents whose postings satisfy the query of a rule."""
    spark = index.sparkSession
    asked = [(kind, k, t, len(grams)) for kind, branches in queries.items() for k, grams in enumerate(branches) for t in grams]
    values = ", ".join(f"('{kind}', {k}, '{t}', {n})" for kind, k, t, n in asked)
    terms = spark.sql(f"SELECT * FROM VALUES {values} AS q(kind, branch, trigram, needed)")
    met = (
        index.join(F.broadcast(terms), "trigram")  # as many rows as the rules have trigrams
        .groupBy("doc_id", "row", "kind", "branch", "needed")
        .agg(F.count_distinct("trigram").alias("n"))
        .filter("n = needed")
    )
    return met.groupBy("doc_id", "row").agg(F.collect_set("kind").alias("kinds"))


# --- Verification ------------------------------------------------------------------------------------------------


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Matches of a rule as an array of (start, order, kind, end), in code points.

    Splitting at the matches gives the text between them; running sums of both lengths give the places.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = whole if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(whole, lambda x: F.length(x)).alias("own"),
        F.transform(counted, lambda x: F.length(x)).alias("n"),
    )
    kind = "STRUCT<start: BIGINT, ord: INT, kind: STRING, end: BIGINT>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr(f"CAST(array() AS ARRAY<{kind}>)").alias("out"))

    def step(acc, x):
        at = acc["at"] + x["gap"]
        end = at + F.coalesce(x["own"], F.lit(0))
        span = F.struct(at.alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        none = F.expr(f"CAST(array() AS ARRAY<{kind}>)")
        return F.struct(end.alias("at"), F.concat(acc["out"], F.when(x["n"] >= rule.least, F.array(span)).otherwise(none)).alias("out"))

    return F.when(F.regexp_like(text, pattern), F.aggregate(parts, start, step, lambda acc: acc["out"])).otherwise(
        F.expr(f"CAST(array() AS ARRAY<{kind}>)")
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, index: DataFrame | None = None) -> DataFrame:
    """One row a document: doc_id, found (array of start, ord, kind, end, in order of start and rule)."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [r for r in rules if queries[r.kind]]
    order = {r.kind: k for k, r in enumerate(rules)}
    rows = _keyed(docs)
    full = [spans_of(F.col("text"), r, order[r.kind]) for r in rules if not queries[r.kind]]
    empty = F.expr("CAST(array() AS ARRAY<STRUCT<start: BIGINT, ord: INT, kind: STRING, end: BIGINT>>)")
    base = rows.select("doc_id", "row", F.concat(empty, *full).alias("scanned"))
    if not indexed:
        return base.select("doc_id", F.array_sort("scanned").alias("found"))
    if index is None:
        index = build_index(docs, sorted({t for r in indexed for grams in queries[r.kind] for t in grams}))
    picked = written(candidates(index, {r.kind: queries[r.kind] for r in indexed}), "secret-candidates")
    few = picked.count() <= BROADCAST_ROWS
    keys = picked.select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "kinds")
    same = rows["doc_id"].eqNullSafe(keys["_id"]) & (rows["row"] == keys["_row"])
    read = rows.join(F.broadcast(keys) if few else keys, same)
    checked = [
        F.when(F.array_contains("kinds", r.kind), spans_of(F.col("text"), r, order[r.kind])).otherwise(empty) for r in indexed
    ]
    verified = read.select("_id", "_row", F.concat(*checked).alias("verified")).dropDuplicates(["_id", "_row"])
    verified = written(verified.filter(F.size("verified") > 0), "secrets-verified")
    few = verified.count() <= BROADCAST_ROWS
    same = base["doc_id"].eqNullSafe(verified["_id"]) & (base["row"] == verified["_row"])
    joined = base.join(F.broadcast(verified) if few else verified, same, "left")
    return joined.select("doc_id", F.array_sort(F.concat("scanned", F.coalesce("verified", empty))).alias("found"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(load(spark, sf_dir, "documents"))
    n = [F.expr(f"CAST(size(filter(found, x -> x.kind = '{r.kind}')) AS BIGINT)").alias(f"n_{r.kind}") for r in RULES]
    text = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select("doc_id", *n, F.sha2(text.cast("binary"), 256).alias("base_sha256"), text.alias("spans"))


def _sql_kind(kind: str, pattern: str, group: int, least: int, order: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, k AS kth, '{kind}' AS kind, {order} AS ord, end_ - length(m[k]) AS start_, end_, length(g[k]) >= {least} AS ok
  FROM (SELECT doc_id, m, g, k,
          list_sum(list_transform(gaps[1:k], lambda x: length(x))) + list_sum(list_transform(m[1:k], lambda x: length(x))) AS end_
        FROM (SELECT doc_id, m, g, gaps, unnest(range(1, len(m) + 1)) AS k
              FROM (SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', {group}) AS g,
                           string_split_regex(text, '{p}') AS gaps FROM texts)))"""


SQL = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS (SELECT * FROM ({_sql_kind('assign', ASSIGN.pattern, 2, 8, 0)}
  UNION ALL {_sql_kind('access', ACCESS.pattern, 0, 16, 1)}
  UNION ALL {_sql_kind('hex', HEX.pattern, 0, 32, 2)}) WHERE ok),
lists AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || CAST(start_ AS BIGINT) || ':' || CAST(end_ AS BIGINT), ',' ORDER BY start_, ord) AS spans
  FROM spans GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN lists USING (doc_id)
"""
