"""Batches of items to code, label checks, and agreement between coders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import thresholds as t
from ..sources.rows import union


def batches(items: DataFrame, seed: int, size: int = 40, prefix: str = "m") -> DataFrame:
    """(item_id, batch, id): items in hash order, opaque ids, batches of ``size``. Items are a sample, bounded by its caps."""
    place = F.row_number().over(Window.orderBy(F.sha2(F.concat_ws(":", F.lit(seed), "id"), 256), "id"))
    out = items.select("id", place.alias("n"))
    batch = (F.floor((F.col("n") - 1) / size) + 1).cast("int").alias("batch")
    return out.select("id", F.concat(F.lit(prefix), F.lpad(F.col("n").cast("string"), 4, "0")).alias("item_id"), batch)


def with_context(turns: DataFrame) -> DataFrame:
    """The turn before as context, where an interviewer speaks it; ``turns``: thread, ord, role, text."""
    w = Window.partitionBy("thread").orderBy("ord")
    said = F.when(F.lag("role").over(w) == "interviewer", F.lag("text").over(w))
    return turns.withColumn("parent_text", said)


def reusable(items: DataFrame, coded: DataFrame) -> DataFrame:
    """``reused`` for items whose key (of sample, codebook, text and parent) was coded in the last round."""
    keys = coded.select("item_key").distinct().withColumn("reused", F.lit(True))
    return items.join(keys, "item_key", "left").withColumn("reused", F.coalesce("reused", F.lit(False)))


def label_errors(labels: DataFrame, items: DataFrame, allowed: DataFrame, variables: DataFrame) -> DataFrame:
    """(item_id, variable, rule): what is wrong with labels (item_id, variable, value as JSON text).

    Values are compared as JSON texts, so 1, true and "1" are three values. ``variables``: variable, nullable.
    """
    unknown = labels.join(items, "item_id", "left_anti").select("item_id", F.lit(None).cast("string").alias("variable"), F.lit("unknown item").alias("rule")).distinct()
    twice = labels.groupBy("item_id", "variable").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("item_id", "variable", F.lit("duplicate").alias("rule"))
    wanted = items.join(F.broadcast(variables.select("variable")))  # a codebook's few variables
    missing = wanted.join(labels, ["item_id", "variable"], "left_anti").select("item_id", "variable", F.lit("missing").alias("rule"))
    extra = labels.join(variables, "variable", "left_anti").select("item_id", "variable", F.lit("extra variable").alias("rule"))
    known = labels.join(variables, "variable")
    null = known.filter("value = 'null' AND NOT nullable").select("item_id", "variable", F.lit("null").alias("rule"))
    wrong = known.filter("value <> 'null'").join(allowed, ["variable", "value"], "left_anti").select("item_id", "variable", F.lit("not allowed").alias("rule"))
    return unknown.unionByName(twice).unionByName(missing).unionByName(extra).unionByName(null).unionByName(wrong)


def quotas(sizes: DataFrame, first: int = 60, second: int = 40) -> DataFrame:
    """(a, b): items of two samples on the agreement sheet; what one lacks the other makes up for. ``sizes``: n_a, n_b."""
    a, b, total = F.col("n_a"), F.col("n_b"), first + second
    return sizes.select(
        F.least(a, F.greatest(F.lit(first), total - b)).alias("a"), F.least(b, F.greatest(F.lit(second), total - a)).alias("b")
    )


def alpha(codes: DataFrame, level: str) -> DataFrame:
    """(metric, units, pairable, alpha): Krippendorff's agreement of codes (metric, unit, coder, idx).

    Coincidences come from counts of each value in a unit, not from pairs of coders, so a unit with many coders costs its
    distinct values. Ordinal distances come from running sums of the values' totals. Null without pairs or variation.
    """
    per = codes.groupBy("metric", "unit", "idx").agg(F.count(F.lit(1)).alias("m"))
    size = F.sum("m").over(Window.partitionBy("metric", "unit"))
    used = per.withColumn("size", size).filter("size > 1")
    other = used.select("metric", "unit", F.col("idx").alias("idx2"), F.col("m").alias("m2"))
    both = used.join(other, ["metric", "unit"])
    same = F.when(F.col("idx") == F.col("idx2"), 1).otherwise(0)
    o = both.groupBy("metric", F.col("idx").alias("c"), F.col("idx2").alias("k")).agg(F.sum(F.col("m") * (F.col("m2") - same) / (F.col("size") - 1)).alias("o"))
    n = used.groupBy("metric", F.col("idx").alias("c")).agg(F.sum("m").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("metric").orderBy("c"))
    n = n.withColumn("upto", upto)
    pairs = n.join(n.select("metric", F.col("c").alias("k"), F.col("n").alias("n2"), F.col("upto").alias("upto2")), "metric")
    if level == "nominal":
        distance = F.when(F.col("c") != F.col("k"), 1.0).otherwise(0.0)
    else:
        low = F.when(F.col("c") <= F.col("k"), F.col("upto") - F.col("n")).otherwise(F.col("upto2") - F.col("n2"))
        between = F.greatest("upto", "upto2") - low - (F.col("n") + F.col("n2")) / 2.0
        distance = F.when(F.col("c") != F.col("k"), between * between).otherwise(0.0)
    sums = pairs.withColumn("d", distance).join(o, ["metric", "c", "k"], "left").groupBy("metric").agg(
        F.sum(F.coalesce("o", F.lit(0.0)) * F.col("d")).alias("seen"), F.sum(F.col("n") * F.col("n2") * F.col("d")).alias("due")
    )
    total = n.groupBy("metric").agg(F.sum("n").alias("total"))
    units = codes.groupBy("metric").agg(F.count_distinct("unit").alias("units"))
    pairable = used.groupBy("metric").agg(F.count_distinct("unit").alias("pairable"))
    out = units.join(pairable, "metric", "left").join(sums, "metric", "left").join(total, "metric", "left")
    value = F.when(F.col("due") > 0, 1 - (F.col("total") - 1) * F.col("seen") / F.col("due"))
    return out.select("metric", "units", F.coalesce("pairable", F.lit(0)).alias("pairable"), value.alias("alpha"))


def section_status(found: DataFrame, variables: list[str]) -> DataFrame:
    """The lowest status of the variables that a section rests on; unverified if one was not checked."""
    ranks = {"unverified": 0, "unreliable": 1, "tentative": 2, "verified": 3}
    status = found.select(F.split("metric", r" \(")[0].alias("variable"), t.agreement_status(F.col("alpha")).alias("status"))
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col("status")], F.lit(0))
    wanted = found.sparkSession.createDataFrame([(v,) for v in variables], "variable string")
    lowest = wanted.join(status, "variable", "left").agg(F.min(rank).alias("r"))
    names = F.array(*[F.lit(k) for k in ranks])
    return lowest.select(names[F.col("r")].alias("status"))


def confusion(codes: DataFrame, first: str, second: str) -> DataFrame:
    """(row, col, n) of two coders' values for the same units."""
    a = codes.filter(F.col("coder") == first).select("unit", F.col("idx").alias("row"))
    b = codes.filter(F.col("coder") == second).select("unit", F.col("idx").alias("col"))
    return a.join(b, "unit").groupBy("row", "col").agg(F.count(F.lit(1)).alias("n"))


# --- What the coder sees, and what comes back ----------------------------------------------------------------------------


def with_parent(posts: DataFrame) -> DataFrame:
    """``parent_text`` of forum posts (post_id, parent_id, text): what they answer."""
    above = posts.select(F.col("post_id").alias("parent_id"), F.col("text").alias("parent_text"))
    return posts.join(above, "parent_id", "left")


def item_key(sample: str, codebook_sha: str):
    """Key of what a coder sees: a hash of the JSON list of sample, codebook, text and parent text (null if none)."""
    said = F.to_json(F.array(F.lit(sample), F.lit(codebook_sha), F.col("text"), F.col("parent_text")))
    return F.sha2(said, 256)


def blinded(items: DataFrame) -> DataFrame:
    """The only columns of an item that a coder gets."""
    return items.select("item_id", "text", "parent_text")


def exploded(labels: DataFrame) -> DataFrame:
    """Labels (item_id, values: a JSON object) as rows (item_id, variable, kind, text): the JSON type and text of each value."""
    labels.select("item_id", F.try_parse_json("values").alias("v")).filter("v IS NOT NULL").createOrReplaceTempView("_colloq_labels")
    sql = "SELECT item_id, key AS variable, schema_of_variant(value) AS kind, to_json(value) AS text, value FROM _colloq_labels, LATERAL variant_explode(v)"
    return labels.sparkSession.sql(sql)


def of_aspects(rows: DataFrame) -> DataFrame:
    """(item_id, variable, aspect, kind, text) of values that are objects."""
    rows.filter("startswith(kind, 'OBJECT')").select("item_id", "variable", "value").createOrReplaceTempView("_colloq_objects")
    sql = "SELECT item_id, variable, o.key AS aspect, schema_of_variant(o.value) AS kind, to_json(o.value) AS text FROM _colloq_objects, LATERAL variant_explode(value) AS o"
    return rows.sparkSession.sql(sql)


#: JSON types that a codebook's values have; 2.0 and true are not 2.
PLAIN = ("BIGINT", "BOOLEAN", "STRING")


def check_labels(labels: DataFrame, items: DataFrame, variables: DataFrame, allowed: DataFrame, aspects: list[str]) -> DataFrame:
    """(item_id, variable, rule) of all that is wrong with the labels of one sample's batches.

    ``items``: item_id; ``variables``: variable, kind, nullable, required_when; ``allowed``: variable, value (JSON text).
    """
    at = lambda df, rule, v="variable": df.select("item_id", (F.col(v) if v else F.lit(None)).cast("string").alias("variable"), F.lit(rule).alias("rule"))
    known = labels.join(items, "item_id", "left_semi")
    times = known.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.min("values").alias("values"))
    once = times.select("item_id", "values")
    rows = exploded(once)
    told = rows.select("item_id", "variable", "kind", "text")
    wanted = once.select("item_id").join(F.broadcast(variables))  # a codebook's few variables
    gate = told.select("item_id", F.col("variable").alias("required_when"), F.col("text").alias("gate"))
    values = told.select("item_id", "variable", F.col("kind").alias("type"), "text")
    every = wanted.join(values, ["item_id", "variable"], "left").join(gate, ["item_id", "required_when"], "left")
    null = F.col("type") == "VOID"
    single = every.filter("kind <> 'per_aspect' AND type IS NOT NULL")
    gated = F.col("required_when").isNotNull()
    plain = single.filter(~null).join(allowed.withColumnRenamed("value", "text"), ["variable", "text"], "left_anti")
    odd = single.filter(~null & ~F.col("type").isin(*PLAIN)).join(plain.select("item_id", "variable"), ["item_id", "variable"], "left_anti")
    blocked = single.filter(gated & (F.col("gate") == "false") & ~null)
    objects = every.filter("kind = 'per_aspect' AND type IS NOT NULL")
    scores = of_aspects(rows).join(variables.filter("kind = 'per_aspect'").select("variable"), "variable", "left_semi")
    of_list = F.col("aspect").isin(aspects) if aspects else F.lit(False)
    wrong_score = scores.filter(of_list).join(allowed.withColumnRenamed("value", "text"), ["variable", "text"], "left_anti")
    return union(
        [
            at(labels.join(items, "item_id", "left_anti"), "not an item", None).distinct(),
            at(times.filter("n > 1"), "labelled more than once", None),
            at(items.join(labels, "item_id", "left_anti"), "not labelled", None),
            at(told.join(variables, "variable", "left_anti"), "no such variable"),
            at(every.filter("type IS NULL"), "missing"),
            at(objects.filter("NOT startswith(type, 'OBJECT')"), "not an object of aspects"),
            at(scores.filter(~of_list), "no such aspect"),
            at(wrong_score, "score not allowed"),
            at(single.filter(gated & (F.col("gate") == "true") & null), "required"),
            at(blocked, "must be null"),
            at(single.filter(~gated & null & ~F.col("nullable")), "null"),
            at(plain, "not allowed"),
            at(odd, "not allowed"),
        ]
    )


def opposite_signs(labels: DataFrame, variable: str) -> DataFrame:
    """(item_id) whose overall score and all aspect scores point opposite ways."""
    rows = exploded(labels)
    overall = rows.filter("variable = 'overall' AND kind = 'BIGINT'").select("item_id", F.col("text").cast("int").alias("overall"))
    scores = of_aspects(rows).filter((F.col("variable") == variable) & (F.col("kind") == "BIGINT")).groupBy("item_id")
    scores = scores.agg(F.min(F.col("text").cast("int")).alias("lo"), F.max(F.col("text").cast("int")).alias("hi"))
    return overall.join(scores, "item_id").filter("(overall < 0 AND lo > 0) OR (overall > 0 AND hi < 0)").select("item_id")


def labelled(labels: DataFrame, index: DataFrame) -> DataFrame:
    """(sample, post_id, values) from labels (item_id, values) and the batches' index (sample, item_id, post_id)."""
    return labels.join(index, "item_id").select("sample", "post_id", "values")


# --- Agreement sheet -------------------------------------------------------------------------------------------------------

MISSING = "n/a"


def sheet_columns(variables: list[tuple[str, str]], aspects: list[str]) -> list[str]:
    """Columns of the sheet; ``variables``: (name, kind)."""
    return ["item_id", "coder", "text", "parent_text", *[c for v, kind in variables for c in ([f"{v}[{a}]" for a in aspects] if kind == "per_aspect" else [v])]]


def agreement_sheet(items: DataFrame, variables: list[tuple[str, str, str]], aspects: list[str], seed: int, first: int = 60, second: int = 40, carried: DataFrame | None = None) -> DataFrame:
    """Rows to be coded by people: items of both samples in hash order, up to their quotas, with cells that do not apply marked.

    ``items``: item_id, sample, text, parent_text, fresh; ``variables``: (name, kind, sample). ``carried`` (item_id, coder, cells) has a later
    round's codes from before: those items are given with their codes, and new ones are drawn from what is fresh, in proportion to it.
    """
    pool, total = items, first + second
    if carried is not None:
        pool = items.filter("fresh").join(carried.select("item_id").distinct(), "item_id", "left_anti")
        have, fresh = items.count(), pool.count()
        total = max(1, round(total * fresh / have)) if fresh else 0
        first = round(total * first / (first + second))
    sizes = pool.agg(F.count_if(F.col("sample") == "measurement").alias("n_a"), F.count_if(F.col("sample") == "detail").alias("n_b"))
    a, b = quotas(sizes, first, total - first).first()
    order = [F.sha2(F.concat_ws(":", F.lit(seed), "item_id"), 256), "item_id"]
    drawn = [pool.filter(F.col("sample") == s).orderBy(*order).limit(n) for s, n in (("measurement", a), ("detail", b))]
    cells = []
    for v, kind, sample in variables:
        cell = F.when(F.col("sample") == sample, F.lit("")).otherwise(MISSING)
        cells += [cell.alias(f"{v}[{k}]") for k in aspects] if kind == "per_aspect" else [cell.alias(v)]
    sheet = drawn[0].unionByName(drawn[1]).select("item_id", F.lit("").alias("coder"), "text", F.coalesce("parent_text", F.lit("")).alias("parent_text"), *cells)
    if carried is not None:
        sheet = carried.join(items.select("item_id", "text", F.coalesce("parent_text", F.lit("")).alias("parent_text")), "item_id").select(*sheet.columns).unionByName(sheet)
    return sheet


def sheet_cells(sheet: DataFrame, variables: list[tuple[str, str, str]], aspects: list[str]) -> DataFrame:
    """The sheet's cells as rows (item_id, coder, variable, aspect, cell)."""
    entries = []
    for v, kind, _ in variables:
        for a in aspects if kind == "per_aspect" else [None]:
            name = f"{v}[{a}]" if a else v
            entries.append(F.struct(F.lit(v).alias("variable"), F.lit(a).cast("string").alias("aspect"), F.trim(F.coalesce(F.col(f"`{name}`"), F.lit(""))).alias("cell")))
    return sheet.select("item_id", F.trim(F.coalesce("coder", F.lit(""))).alias("coder"), F.explode(F.array(*entries)).alias("e")).select("item_id", "coder", "e.*")


def parse_cells(cells: DataFrame, allowed: DataFrame) -> DataFrame:
    """``value`` (JSON text, null if blank) and ``ok`` of each cell: codebook values in any case, numbers also with signs and zeros ahead."""
    plain = F.lower(F.regexp_replace("value", '^"|"$', ""))
    own = allowed.select("variable", "value", F.when(F.regexp_like("value", F.lit(r"^-?\d+$")), F.col("value").cast("int").cast("string")).otherwise(plain).alias("_as"))
    blank = F.lower("cell").isin("", "null")
    as_int = F.col("cell").try_cast("int").cast("string")
    rows = cells.withColumn("_as", F.when(~blank, F.coalesce(as_int, F.lower("cell"))))
    return rows.join(F.broadcast(own), ["variable", "_as"], "left").withColumn("ok", blank | F.col("value").isNotNull()).drop("_as")


def sheet_problems(parsed: DataFrame, items: DataFrame, variables: DataFrame) -> DataFrame:
    """(item_id, coder, variable, rule); ``items``: item_id, sample; ``variables``: variable, sample, kind, nullable, required_when."""
    held = parsed.join(items, "item_id").join(F.broadcast(variables.withColumnRenamed("sample", "of")), "variable")
    key = ["item_id", "coder"]
    at = lambda df, rule: df.select(*key, "variable", F.lit(rule).alias("rule"))
    whole = lambda df, rule: df.select(*key, F.lit(None).cast("string").alias("variable"), F.lit(rule).alias("rule")).distinct()
    own = held.filter("sample = of")
    twice = parsed.groupBy(*key, "variable", F.coalesce("aspect", F.lit(""))).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    gate = own.select(*key, F.col("variable").alias("required_when"), F.col("value").alias("gate"))
    single = own.filter("kind <> 'per_aspect' AND ok").join(gate, [*key, "required_when"], "left")
    return union(
        [
            whole(parsed.join(items, "item_id", "left_anti"), "not a coded item"),
            whole(parsed.filter("coder = ''"), "no coder"),
            whole(parsed.filter(F.lower("coder") == "ai"), "reserved coder"),
            whole(twice, "coded twice"),
            at(held.filter((F.col("sample") != F.col("of")) & ~F.col("cell").isin("", MISSING)), "does not apply").distinct(),
            at(own.filter("NOT ok"), "not allowed").distinct(),
            at(single.filter("value IS NULL AND required_when IS NULL AND NOT nullable"), "null"),
            at(single.filter("required_when IS NOT NULL AND gate = 'true' AND value IS NULL"), "required"),
            at(single.filter("required_when IS NOT NULL AND gate = 'false' AND value IS NOT NULL"), "must be null"),
        ]
    )


def units(values: DataFrame, variables: DataFrame, allowed: DataFrame) -> DataFrame:
    """(metric, unit, coder, idx) for ``alpha``, from (item_id, coder, variable, aspect, value), a row for each cell that applies.

    What may be left out is scored twice: whether it was mentioned (aspects) or expressed (nullable ones), and then the value where given.
    """
    v = variables.select("variable", "kind", "nullable")
    rows = values.join(F.broadcast(v), "variable").withColumn("unit", F.concat_ws(":", "item_id", "aspect"))
    said = rows.filter("kind = 'per_aspect' OR nullable")
    how = F.concat("variable", F.when(F.col("kind") == "per_aspect", " (mentioned)").otherwise(" (expressed)"))
    given = said.select(how.alias("metric"), "unit", "coder", F.col("value").isNotNull().cast("int").alias("idx"))
    scored = rows.filter("value IS NOT NULL").join(F.broadcast(allowed), ["variable", "value"]).select(F.col("variable").alias("metric"), "unit", "coder", F.col("ord").alias("idx"))
    return given.unionByName(scored)
