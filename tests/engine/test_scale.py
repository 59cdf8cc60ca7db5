"""Right results where a table has several splits, equal rows or many posts a file."""

import re

import numpy as np

from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloq.operators import matching, stats, synthesis, themes
from colloq.sources import captures, rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_problems_of_a_capture_hold_no_list_of_ids_a_post(spark):
    post = "struct<id: string, author: string, date: string, date_approx: boolean, parent: string, score: int, text: string, headline: boolean>"
    told = [(f"p{k}", "a", "2024-01-02", False, f"p{k - 1}" if k else None, 1, "said", False) for k in range(4000)]
    told[7] = ("p6", "a", "soon", False, "px", 1, " ", False)
    whole = spark.createDataFrame([("c.json", "page.txt", None, told), ("d.json", "lost.txt", None, told)], f"file string, source_file string, _bad string, posts array<{post}>")
    found = captures.problems(whole, spark.createDataFrame([("page.txt",)], "source_file string"))
    assert "array_contains" not in plan(found)
    assert sorted((r.file, r.id or "", r.problem) for r in found.collect()) == [
        ("c.json", "", "duplicate post ids"), ("c.json", "p6", "date is not YYYY-MM-DD"), ("c.json", "p6", "empty text"), ("c.json", "p6", "parent not in this capture"),
        ("c.json", "p8", "parent not in this capture"), ("d.json", "", "source file not found"),
    ]


def test_lines_are_numbered_over_the_splits_of_a_file(spark, tmp_path):
    for name, end in (("a.jsonl", "\n"), ("b.jsonl", "\r\n")):
        (tmp_path / name).write_bytes(end.join(["" if k % 5 == 0 else f'{{"id": {k}}}' if k % 5 < 4 else "{no" for k in range(1, 501)]).encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        good, bad = rows.json_lines(spark, str(tmp_path), T.StructType.fromDDL("id bigint"), ("id",))
        assert good.filter("line <> id").count() == 0 and good.count() == 600
        assert bad.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.sum("line").alias("s")).collect() == [("not a JSON object", 200, 2 * sum(range(4, 501, 5)))]
        assert "Format: Text" not in plan(good)  # numbered lines are read, not whole files
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_equal_posts_keep_their_numbers(spark, tmp_path):
    from colloq.plans import sources

    spark.createDataFrame([(k, "en", "s", "same") for k in range(1, 10)], "doc_id bigint, lang string, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.ord: r.n for r in sources._known_ids(spark, str(tmp_path)).collect()}
    assert got == {3: 1, 6: 2, 9: 3, 1: 4, 2: 5, 4: 6, 5: 7, 7: 8, 8: 9}


def test_problems_of_nuggets_do_not_hang_on_the_order_of_rows(spark):
    n = 300
    shuffled = lambda df, parts: df.repartition(parts, F.rand())
    obs = spark.range(n).select(F.col("id").alias("ord"), F.concat(F.lit("E"), "id").alias("post_id"), F.expr("IF(id % 2 = 0, 'IT IS FAST', 'other')").alias("observation"), F.lit("it is fast").alias("quote"))
    posts = spark.range(n).select(F.concat(F.lit("E"), "id").alias("post_id"), F.lit("u").alias("person"), F.lit("forum").alias("source_type"), F.expr("IF(id % 3 = 0, 'now it is fast', 'wholly unlike')").alias("text"))
    codes = posts.select("post_id", F.lit("opinion").alias("evidence"))
    found = synthesis.nuggets(shuffled(obs, 3), shuffled(posts, 4), codes)[1].groupBy("problem").count().collect()
    assert {r[0]: r[1] for r in found} == {"the quote is not verbatim": 200, "the observation repeats the quote": 150}
    quotes = matching.elided_check(shuffled(posts.withColumnRenamed("text", "source").withColumn("said", F.lit("it is fast")), 5))
    assert len(re.findall("monotonically_increasing_id", plan(quotes))) == 0


def test_first_posts_of_topics_are_found_without_sorting_every_order(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(stats, "written", lambda df, what: seen.append((what, plan(df))) or df)
    tags = spark.range(60).select(F.concat(F.lit("E"), "id").alias("post_id"), F.expr("IF(id % 5 = 0, NULL, concat('t', id % 3))").alias("topic"))
    stats.heard_range(tags, 5, 7)
    assert len(seen) == 3 and not any("SortAggregate" in p for _, p in seen)


def test_net_negative_range_deals_out_no_row_a_draw(spark):
    told = spark.range(400).select(F.concat(F.lit("u"), F.col("id") % 37).alias("person"), F.concat(F.lit("T"), F.col("id") % 7).alias("thread"), (F.col("id") % 5 - 2).alias("overall"))
    out = stats.net_negative_range(told, "thread", 20, 3)
    assert not re.search(r"hashpartitioning\(thread#\d+L?, person", plan(out))  # records are dealt out by person, and draws are added up there
    alone = stats.net_negative_range(told.withColumn("own", F.col("person")), "own", 20, 3).collect()
    assert stats.net_negative_range(told, "person", 20, 3).collect() == alone


def test_axes_are_the_decompositions_first_ones(spark):
    rng = np.random.default_rng(3)
    full = rng.random((60, 40)) * (rng.random((60, 40)) < 0.3)
    rows = spark.createDataFrame([(k, [int(c) for c in np.flatnonzero(r)], [float(v) for v in r[r != 0]]) for k, r in enumerate(full)], "id bigint, at array<int>, w array<double>")
    found = themes._axes(rows, 40, 4)
    assert np.allclose(np.linalg.norm(full @ found, axis=0), np.linalg.svd(full)[1][:4], rtol=1e-6)


def test_sets_are_made_for_the_texts_of_pairs_only(spark):
    text = F.concat(F.lit("one two three four five six seven eight nine ten eleven "), F.col("id") % 2, F.lit(" "), F.expr("IF(id < 4, '', array_join(transform(sequence(1, 30), i -> concat('w', i * id)), ' '))"))
    found = matching.near_pairs(spark.range(9).select("id", text.alias("text")), None)
    assert "LeftSemi" in plan(found)
    assert [(r.a, r.b) for r in found.collect()] == []
