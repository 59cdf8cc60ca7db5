"""Names out of posts: codes for people, mentions masked, bare names redacted, and the gate ahead of it."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as x
from ..sources.rows import InputProblem

MIN_NAME = 3


def fingerprint(salt: bytes) -> str:
    """Tells salts apart without giving them away."""
    return hashlib.sha256(b"salt fingerprint\0" + salt).hexdigest()[:12]


def redact_names(posts: DataFrame, names: DataFrame) -> DataFrame:
    """``text`` without the bare names (name) of authors, and ``n_names``, how many there were: whole words, exact case, longest first.

    No list of names is sent anywhere: a post's words meet the first words of names in a join, and the few names that it may hold become
    a pattern of its own.
    """
    word = r"[\p{L}\p{N}_]+"
    usable = names.select("name").distinct().filter(F.length("name") >= MIN_NAME)
    heads = usable.select("name", F.coalesce(F.try_element_at(F.regexp_extract_all("name", F.lit(word), F.lit(0)), F.lit(1)), F.lit("")).alias("w"))
    asked = posts.select("post_id", F.explode(F.array_distinct(F.concat(F.regexp_extract_all("text", F.lit(word), F.lit(0)), F.array(F.lit(""))))).alias("w"))
    quoted = F.concat(F.lit(r"\Q"), F.regexp_replace("name", r"\\E", r"\\E\\\\E\\Q"), F.lit(r"\E"))
    held = asked.join(heads, "w").groupBy("post_id").agg(F.array_sort(F.collect_set(F.struct((-F.length("name")).alias("n"), quoted.alias("q")))).alias("qs"))
    pattern = F.concat(F.lit(r"(?U)(?<![\w/@-])(?:"), F.array_join(F.transform("qs", lambda q: q["q"]), "|"), F.lit(r")(?![\w-])"))
    rows = posts.join(held.select("post_id", pattern.alias("_p")), "post_id", "left")
    known = F.col("_p").isNotNull()
    n = F.when(known, F.regexp_count("text", F.col("_p"))).otherwise(0)
    return rows.withColumn("n_names", n).withColumn("text", F.when(F.col("n_names") > 0, F.regexp_replace("text", F.col("_p"), F.lit("[user]"))).otherwise(F.col("text"))).drop("_p")


def person_codes(posts: DataFrame, salt: bytes) -> DataFrame:
    """``person_code`` in place of ``author``; a post without an author is a person of its own."""
    key = F.coalesce("author", F.concat(F.lit("\0unnamed\0"), "post_id"))
    return posts.withColumn("_key", key).withColumn("person_code", x.person_code(salt, F.col("_key")))


def collisions(coded: DataFrame) -> DataFrame:
    """Codes that two names share."""
    return coded.groupBy("person_code").agg(F.count_distinct("_key").alias("names")).filter("names > 1")


def verified(report: dict | None, current: str) -> None:
    """Raise unless the texts were checked in their present state and none is tidied or failed."""
    if report is None:
        raise InputProblem("verify first: transcriptions must be checked before names go")
    if report.get("sha256") != current:
        raise InputProblem("the posts have changed since they were verified")
    if not report.get("ok"):
        raise InputProblem(f"{report.get('failed', 0)} failed and {report.get('tidied', 0)} tidied transcriptions")


def anonymise(posts: DataFrame, salt: bytes) -> DataFrame:
    """Posts with codes for people, mentions masked and bare names redacted; an error if two names share a code."""
    coded = person_codes(posts, salt)
    if collisions(coded).limit(1).count():
        raise InputProblem("two people got one code; use another salt")
    masked = coded.drop("author", "_key").withColumn("text", x.mask_mentions(F.col("text")))
    return redact_names(masked, posts.select(F.col("author").alias("name")).dropna())
