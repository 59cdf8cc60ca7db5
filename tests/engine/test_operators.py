"""Known answers of the engine's operators on inline rows."""

import datetime as dt
import hashlib
import hmac

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from colloq.functions import text as x
from colloq.operators import coding, conversation, language, matching, sampling, stats


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def records(spark, rows):
    return spark.createDataFrame(rows, "ord bigint, person string, thread string, source string, search_term string, overall int, stance int, aspects map<string,int>")


def test_entry_points_agree():
    queries, oracle = __spark_entry__.queries(), __spark_entry__.oracle_sql
    assert callable(oracle) and len(queries) > 60


def test_headline_of_thirty_people(spark):
    rows = [(2 * p + k, f"p{p}", f"t{p % 10}", "s", None, -2 if p < 12 and k == 0 else -1 if p < 18 and k == 1 else 0 if p < 24 else 1, None, {}) for p in range(30) for k in (0, 1)]
    got = {r.measure: r for r in stats.shares(stats.headline(records(spark, rows))).collect()}
    assert sum(r.k for r in got.values()) == 60 and got["negative"].n_people == 30 and got["negative"].status == "full"
    assert got["negative"].k == sum(r[5] < 0 for r in rows) and got["negative"].pct == pytest.approx(100 * got["negative"].k / 60)


def test_few_people_show_counts_only(spark):
    rows = [(k, f"p{k % 5}", "t", "s", None, -1, None, {}) for k in range(80)]
    r = stats.share_table(stats.headline(records(spark, rows)).filter("measure = 'negative'"), draws=20, seed=1).first()
    assert r.status == "counts-only" and r.k == 80 and r.pct is None and r.lo is None


def test_interval_index_rule(spark):
    lo, hi = stats.interval(F.col("id").cast("double"))
    assert tuple(spark.range(1, 101).agg(lo, hi).first()) == (3.0, 97.0)


def test_leave_one_out_of_three_sources(spark):
    neg = {"a": 10, "b": 20, "c": 0}
    rows = [(k, f"{s}{k}", f"t{s}", s, None, -1 if k < neg[s] else 1, None, {}) for s in "abc" for k in range(20)]
    got = {r.removed: r.pct for r in stats.leave_one_out(records(spark, rows)).filter("kind = 'source'").collect()}
    assert got == {"a": 50.0, "b": 25.0, "c": 75.0}


@pytest.mark.parametrize("sizes, expected", [([100] * 20, (150, 15)), ([1] * 5, (0, 0)), ([3] * 10, (30, 3))])
def test_thread_cap_size(spark, sizes, expected):
    rows = [(f"t{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    assert tuple(sampling.thread_cap_size(spark.createDataFrame(rows, "thread string, i int")).first()) == expected


def test_draw_equals_the_greedy_loop(spark):
    posts = [(f"e{k}", f"p{k % 37}", f"t{k % 13}", f"text {k}") for k in range(400)]
    pool = spark.createDataFrame(posts, "post_id string, person string, thread string, text string")
    got = {r.post_id for r in sampling.measurement_sample(pool, seed=5, size=60).collect()}
    key = lambda p: (hashlib.sha256(f"5\0{p[1]}\0{p[3]}".encode()).hexdigest(), p[0])
    capped, per = [], {}
    for p in sorted(posts, key=key):
        per[p[1]] = per.get(p[1], 0) + 1
        if per[p[1]] <= 5:
            capped.append(p)
    size = {}
    for p in capped:
        size[p[2]] = size.get(p[2], 0) + 1
    n = next((n for n in range(60, 0, -1) if sum(min(s, n // 10) for s in size.values()) >= n), 0)
    taken, held = [], {}
    for p in capped:
        if len(taken) < n and held.get(p[2], 0) < n // 10:
            taken.append(p[0])
            held[p[2]] = held.get(p[2], 0) + 1
    assert got == set(taken)


def test_log_likelihood_and_adjustment(spark):
    parts = [F.lit(v) for v in (10, 2, 1000, 1000)]
    assert one(spark, x.g2(*parts)) == pytest.approx(5.822063, abs=1e-5)
    assert one(spark, x.log_ratio(*parts)) == pytest.approx(2.321928, abs=1e-6)
    tested = spark.createDataFrame([("n", "a", 9.0), ("n", "b", 4.0), ("p", "c", 1.0)], "side string, term string, g2 double")
    q = {r.term: r.q for r in language.adjusted(tested).collect()}
    assert q["a"] == pytest.approx(0.0081, abs=1e-3) and q["b"] == pytest.approx(0.0683, abs=1e-3) and q["c"] == pytest.approx(0.3173, abs=1e-3)


def test_agreement_of_four_coders(spark):
    table = {
        "A": [1, 2, 3, 3, 2, 1, 4, 1, 2, None, None, None], "B": [1, 2, 3, 3, 2, 2, 4, 1, 2, 5, None, 3],
        "C": [None, 3, 3, 3, 2, 3, 4, 2, 2, 5, 1, None], "D": [1, 2, 3, 3, 2, 4, 4, 1, 2, 5, 1, None],
    }
    rows = [("m", u, c, v) for c, vs in table.items() for u, v in enumerate(vs) if v is not None]
    codes = spark.createDataFrame(rows, "metric string, unit int, coder string, idx int")
    assert coding.alpha(codes, "nominal").first().alpha == pytest.approx(0.743, abs=1e-3)
    assert coding.alpha(codes, "ordinal").first().alpha == pytest.approx(0.815, abs=1e-3)


def test_text_functions(spark):
    cases = [
        (x.slug(F.lit("Hello, World! ")), "hello-world"),
        (x.votes(F.lit("1.2k")), 1200),
        (x.ts_to_sec(F.lit("1:02:03,5")), 3723.5),
        (x.age_to_date(F.lit("3w ago"), F.lit(dt.date(2024, 3, 31))), dt.date(2024, 3, 10)),
        (x.period_key(F.lit(dt.date(2027, 1, 1)), "week"), "2026-W53"),
        (x.mask_mentions(F.lit("ask @bob or /u/al_x, mail a@b.c")), "ask @[user] or u/[user], mail a@b.c"),
        (x.numbers_in(F.lit("1,200 of 30% on 2024-05-01 by P-12345678")), ["1,200", "30"]),
        (x.person_code(b"salt", F.lit("ann")), "P-" + hmac.new(b"salt", b"ann", hashlib.sha256).hexdigest()[:8]),
        (x.is_echo(F.lit("Same here!")), True),
        (x.strip_prefix(F.lit("t3_abc")), "abc"),
        (x.loose(F.lit("It’s  “FINE”—ok")), "its fine ok"),
        (x.lexicon_count(F.lit("I think the the fix is, maybe, done"), "hedge"), 2),
        (x.lexicon_count(F.lit("I think the the fix is, maybe, done"), "repair"), 1),
        (x.word_diff(F.lit("a b d"), F.lit("a c d")), "a [-c-] {+b+} d"),
        (x.py_round(F.lit(12.25), F.lit(1)), 12.2),
        (x.clean_body(F.lit("see [this](http://x) **now** &amp; u/bob")), "see this now & u/[user]"),
        (x.html_text(F.lit("<p>a<b>b</b></p>")), "a b"),
    ]
    got = spark.range(1).select(*[c.alias(f"c{k}") for k, (c, _) in enumerate(cases)]).first()
    assert list(got) == [v for _, v in cases]


def test_duplicates_are_first_kept(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()
    chain = [" ".join(base[:20] + [f"w{j}" for j in range(k)]) for k in range(3)]
    rows = [(1, chain[0]), (2, chain[1]), (3, chain[2]), (4, chain[0]), (5, "short text"), (6, "short text")]
    items = spark.createDataFrame(rows, "id bigint, text string")
    assert {r.id: r.kept for r in matching.near_kept(items).collect()} == {1: True, 2: False, 3: False, 4: False, 5: True, 6: True}


def test_quotes(spark):
    rows = [("the price is", "I said the price is fair"), ("the  price “is”", 'so the price "is" fair'), ("price ... fair", "the price is fair"), ("fair ... price", "the price is fair"), ("nothing alike", "zzz")]
    pairs = spark.createDataFrame(rows, "said string, source string")
    assert [r.status for r in matching.elided_check(pairs).orderBy("said").collect()] == [s for _, s in sorted(zip([r[0] for r in rows], ["exact", "normalised", "exact", "failed", "failed"]))]


def test_reply_tree_and_speakers(spark):
    posts = [("t", "a", None, 0, 0), ("t", "b", "a", 1, 1), ("t", "c", "a", 5, 2), ("t", "d", "b", 9, 3), ("t", "e", "gone", 2, 4)]
    tree = conversation.reply_tree(spark.createDataFrame(posts, "thread string, id string, parent string, score int, ord int"))
    assert [r.id for r in tree.orderBy("place").collect()] == ["e", "a", "c", "b", "d"]
    turns = [("t", 0, "A", "x", None), ("t", 1, None, "y", 2.0), ("t", 2, "B", "z", None)]
    merged = conversation.merge_speakers(spark.createDataFrame(turns, "thread string, ord int, speaker string, text string, end_s double"))
    assert [(r.speaker, r.text, r.end_s) for r in merged.orderBy("seg").collect()] == [("A", "x y", 2.0), ("B", "z", None)]


def test_heard_range_equals_reading_the_posts_in_each_order(spark):
    tags = [(f"E{i}", f"t{i * i % 13}" if i % 5 else None) for i in range(57)] + [("E3", "t50"), ("E8", "t51")]
    posts, topics = sorted({p for p, _ in tags}), {t for _, t in tags if t}
    found = []
    for run in range(12):
        order = sorted(posts, key=lambda p: (hashlib.sha256(f"7:{run}:{p}".encode()).hexdigest(), p))
        firsts = [min(order.index(p) for p, x in tags if x == t) for t in topics]
        found.append(np.bincount(firsts, minlength=len(posts)).cumsum())
    got = stats.heard_range(spark.createDataFrame(tags, "post_id string, topic string"), 12, 7).orderBy("place").collect()
    mean = np.mean(found, axis=0)
    assert [r.place for r in got] == list(range(1, len(posts) + 1))
    for name, want in (("mean", mean), ("low", np.percentile(found, 2.5, axis=0)), ("high", np.percentile(found, 97.5, axis=0))):
        assert np.allclose([r[name] for r in got], want)
    assert {r.last_posts for r in got} == {5} and np.allclose([r.last_new for r in got], mean[-1] - mean[-6])


def test_saturation_range_reads_all_events(spark):
    found = __spark_entry__.queries()["saturation_range"](spark, __spark_entry__.SMOKE_DIR)
    events = spark.read.parquet(f"{__spark_entry__.SMOKE_DIR}/events.parquet").select("event_id").distinct().count()
    assert found.count() == events > 120
