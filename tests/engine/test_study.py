"""The study's folder, readers, trees, selection, audits and themes against hand-worked answers and plain loops."""

import io
import random
import zipfile

import pytest

from colloq import report
from colloq.operators import audit, coding, conversation, matching, privacy, sampling, stats, themes
from colloq.sources import rows, transcripts
from colloq.sources.rows import InputProblem
from colloq.study import Codebook, Study, design_problems


def book(**more):
    overall = {"name": "overall", "level": "ordinal", "values": [-2, -1, 0, 1, 2]}
    return {"version": "1", "study_type": "product", "variables": [overall], "aspects": ["speed"], "instructions": ["read", {"text": "deep", "applies_to": "detail"}], **more}


def test_a_study_goes_through_its_locks_and_rounds(spark, tmp_path):
    study = Study(spark, str(tmp_path))
    study.create("Tools", "product")
    with pytest.raises(InputProblem):
        study.create("Tools", "product")
    with pytest.raises(InputProblem):
        study.frozen()
    study.files.write_json("codebook.json", book())
    lock = study.freeze()
    assert study.freeze() == lock and study.frozen()[0].version == "1"
    study.files.write_json("codebook.json", book(aspects=["price"]))
    for new in (False, True):  # changed without a version of its own
        with pytest.raises(InputProblem):
            study.freeze(new)
    study.files.write_json("codebook.json", book())
    study.files.write("batches/b1.jsonl", "{}\n")
    study.files.write("labels/b1.jsonl", "{}\n")
    with pytest.raises(InputProblem):
        study.open_for_sampling()
    with pytest.raises(InputProblem):
        study.lock_labels("one", 3, 1)
    with pytest.raises(InputProblem):
        study.lock_labels("one", 0, 1, {"1": "two"})
    held = study.lock_labels("one", 0, 1)
    assert study.lock_labels("one", 0, 1)["locked_at"] == held["locked_at"] and study.locked()["coder"] == "one"
    study.files.write("sealed/prior.md", "I expect")
    assert study.unseal()["late"] is False and study.files.read("results/prior.md") == b"I expect"
    study.files.write_json("results/agreement.json", {"labels_locked_at": "then", "codebook": held["codebook"]})
    assert study.agreement()[0] == {} and "other labels" in study.agreement()[1]
    study.files.write_json("samples/summary.json", {"seed": 11})
    assert study.resolve_seed(5) == (5, "given") and study.resolve_seed() == (11, "reused")
    assert study.next_round("more threads")["round"] == 2
    assert not study.files.exists("labels.lock") and study.closed_rounds()[0]["coder"] == "one" and study.resolve_seed() == (11, "reused")
    study.files.write("labels/b1.jsonl", "{}\n")
    with pytest.raises(InputProblem):
        study.locked()
    state = study.status()
    assert state["freeze"] == "done" and state["ingest"] == "to do" and state["verify"] == "waiting"
    study.files.write_json("codebook.json", book(version="2"))
    assert study.status()["freeze"] == "stale"
    study.freeze(new_version=True)
    assert study.files.exists("superseded/1-1/labels") and not study.files.exists("labels")
    with pytest.raises(ZeroDivisionError), study.stage("ingest"):
        1 / 0  # noqa: B018
    assert study.status()["ingest"] == "failed"
    with pytest.raises(InputProblem):
        study.require("ingest")
    assert study.files.exists(study.reset()) and study.files.exists("results/run_manifest.json")


def test_codebook_design_and_what_the_coder_sees():
    good = Codebook.of(book())
    assert design_problems(good, "product") == [] and len(design_problems(good, "news")) == 2
    assert good.for_coder("measurement")["instructions"] == ["read"] and "aspects" not in good.for_coder("measurement")
    assert "applies_to" not in str(good.for_coder("measurement")["variables"][0].keys())


def test_trees_of_any_depth_and_cycles(spark):
    chain = [("t", k, k - 1 if k else None, 0, k) for k in range(70)]
    loop = [("u", 1, 2, 0, 1), ("u", 2, 1, 0, 2), ("u", 3, 2, 0, 3), ("u", 4, None, 0, 4), ("u", 5, 4, 9, 5), ("u", 6, 4, 10, 6), ("u", 7, 99, 0, 7)]
    df = spark.createDataFrame(chain + loop, "thread string, id bigint, parent bigint, score int, ord bigint")
    found = {(r.thread, r.id): (r.depth, r.place) for r in conversation.reply_tree(df).collect()}
    assert all(found["t", k] == (k, k + 1) for k in range(70))
    assert [found["u", k] for k in (1, 2, 3, 4, 6, 5, 7)] == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 5), (1, 6), (0, 7)]


def test_numbers_are_kept_and_new_ones_follow(spark):
    posts = spark.createDataFrame([(1, "t", "a", "x"), (2, "t", "a", "x"), (3, "t", "b", "y")], "ord bigint, thread string, author string, text string")
    first = conversation.stable_ids(posts.filter("ord > 1"), spark.createDataFrame([], "thread string, key string, n int"))
    again = conversation.stable_ids(posts, first.select("thread", "key", "n"))
    assert {r.ord: r.n for r in again.collect()} == {1: 1, 2: 3, 3: 2}


def plain_detail(pool, budget, per_person, clusters):
    """The selection as a loop."""
    reasons, held = {}, {}

    def take(p, why):
        if p["post_id"] in reasons:
            reasons[p["post_id"]].append(why)
            return 0
        if p["kind"] != "post" and held.get(p["person"], 0) >= per_person:
            return 0
        reasons[p["post_id"]] = [why]
        held[p["person"]] = held.get(p["person"], 0) + 1
        return 1

    for p in pool:
        if p["kind"] == "post":
            take(p, "post")
    steps = [
        (sorted(pool, key=lambda p: (-(p["score"] or 0), p["ord"])), int(budget * 0.2), lambda p: "top_score"),
        (sorted([p for p in pool if p["flags"]], key=lambda p: (-len(p["flags"]), -(p["score"] or 0), p["ord"])), int(budget * 0.4), lambda p: "flag:" + ",".join(sorted(p["flags"]))),
    ]
    for order, quota, why in steps:
        for p in order:
            if quota <= 0 or len(reasons) >= budget:
                break
            quota -= take(p, why(p))
    left = budget - len(reasons)
    for c in sorted(set(clusters.values()), key=lambda c: (-list(clusters.values()).count(c), c)):
        own = [p for p in pool if clusters[p["post_id"]] == c]
        share, got = max(1, round(left * len(own) / len(pool))), 0
        for p in own:
            if got >= share or len(reasons) >= budget:
                break
            got += take(p, f"cluster:C{c + 1:02d}")
    return reasons


@pytest.mark.parametrize("seed", [1, 2])
def test_detail_selection_is_the_greedy_loop(spark, seed):
    rng = random.Random(seed)
    pool = [
        {"ord": k, "post_id": f"p{k:03d}", "person": f"u{rng.randrange(25)}", "kind": "post" if rng.random() < 0.05 else "comment", "score": rng.choice([None, *range(40)]), "flags": rng.sample(["a", "b", "c"], rng.choice([0, 0, 0, 1, 2]))}
        for k in range(160)
    ]
    clusters = {p["post_id"]: rng.randrange(3) for p in pool}
    df = spark.createDataFrame([tuple(p.values()) for p in pool], "ord bigint, post_id string, person string, kind string, score int, flags array<string>")
    near = spark.createDataFrame([(p["post_id"], clusters[p["post_id"]], p["ord"]) for p in pool], "post_id string, cluster int, place bigint")
    found = {r.post_id: r.reasons for r in sampling.detail_selection(df, budget=50, per_person=4, clusters=near).collect()}
    assert found == plain_detail(pool, 50, 4, clusters)


def test_content_hash_is_of_rows_and_not_of_their_order(spark):
    a = spark.range(50).selectExpr("id", "concat('x', id) AS t")
    same, other = a.orderBy("id", ascending=False).repartition(3), a.filter("id > 0")
    assert sampling.content_hash(a).first() == sampling.content_hash(same).first() != sampling.content_hash(other).first()
    assert sampling.ids_hash(a, "t") == sampling.ids_hash(same, "t")


def test_strict_csv(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text('﻿a,b\n1,"two\nlines"\n, x \n1,2,3\n')
    good, problems = rows.csv_rows(spark, str(path), ["a", "b"])
    assert [(r.a, r.b) for r in good.orderBy("line").collect()] == [("1", "two\nlines"), (None, "x")]
    assert [r.problem for r in problems.collect()] == ["more values than columns"]
    with pytest.raises(InputProblem):
        rows.check(rows.csv_rows(spark, str(path), ["a", "c"])[1])


def test_documents_are_read_by_paragraph(spark, tmp_path):
    data = io.BytesIO()
    space = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("word/document.xml", f"<w:document {space}><w:body><w:p><w:r><w:t>Ann: hel</w:t></w:r><w:r><w:t>lo</w:t></w:r></w:p><w:p><w:r><w:t>Bob: hi?</w:t></w:r></w:p></w:body></w:document>")
    (tmp_path / "one.docx").write_bytes(data.getvalue())
    read = transcripts.read_documents(spark, str(tmp_path / "one.docx"))
    assert read.first().text == "Ann: hello\nBob: hi?"
    said = transcripts.with_roles(transcripts.turns(transcripts.line_segments(read))).orderBy("place").collect()
    assert [(r.speaker, r.text, r.method) for r in said] == [("Ann", "hello", "questions"), ("Bob", "hi?", "questions")]


def test_prose_with_colons_is_no_speaker(spark):
    lines = ["Ann: one", "Note this: two", "Bob: three", "Also: four", "Ann: five", "Bob: six", "Then: seven"]
    df = spark.createDataFrame([("f", "\n".join(lines))], "file string, text string")
    found = transcripts.line_segments(df).orderBy("ord").collect()
    assert [(r.speaker, r.text) for r in found] == [("Ann", "one Note this: two"), ("Bob", "three Also: four"), ("Ann", "five"), ("Bob", "six Then: seven")]


def test_visible_text_knows_its_post(spark):
    html = '<p>a<script>no</script></p>\n<div data-post="T01-p02"><b>5 of</b><br>9<img aria-label="chart 7"/></div><i aria-label="x">z</i>'
    found = audit.visible(spark.createDataFrame([(1, html), (2, None)], "page_id bigint, html string")).orderBy("nth").collect()
    assert [(r.text, r.post, r.line) for r in found] == [("a", None, 1), ("5 of", "T01-p02", 2), ("9", "T01-p02", 2), ("chart 7", "T01-p02", 2), ("x", None, 2), ("z", None, 2)]


def test_names_go_as_whole_words(spark):
    posts = spark.createDataFrame([("1", "Bob-1", "Ask Bob or Bobby, not bob; @Bob and Bob-1."), ("2", "Bobby", "a.b said so"), ("3", "a.b", "Al"), ("4", None, "Bob")], "post_id string, author string, text string")
    names = spark.createDataFrame([("Bob",), ("Bobby",), ("Bob-1",), ("a.b",), ("Al",)], "name string")
    found = {r.post_id: (r.text, r.n_names) for r in privacy.redact_names(posts, names).collect()}
    assert found == {"1": ("Ask [user] or [user], not bob; @Bob and [user].", 3), "2": ("[user] said so", 1), "3": ("Al", 0), "4": ("[user]", 1)}
    codes = privacy.anonymise(posts, b"salt").collect()
    assert len({r.person_code for r in codes}) == 4 and "author" not in codes[0].asDict()
    for bad in (None, {"sha256": "b", "ok": True}, {"sha256": "a", "ok": False}):
        with pytest.raises(InputProblem):
            privacy.verified(bad, "a")
    privacy.verified({"sha256": "a", "ok": True}, "a")


def test_quotes_by_tier(spark):
    pairs = spark.createDataFrame([("it is “so” fine", 'well, it is "so" fine'), ("the search is really fast here", "I say the search is realy fast here and"), ("gone entirely from it all", "nothing like that"), ("one ... three", "one two three"), ("three ... one", "one two three")], "said string, source string")
    assert [r.status for r in matching.quote_check(pairs).collect()][:3] == ["normalised", "tidied", "failed"]
    assert {r.said: r.status for r in matching.elided_check(pairs).collect()}["one ... three"] == "exact"
    assert {r.said: r.status for r in matching.elided_check(pairs).collect()}["three ... one"] == "failed"


def test_sheet_carries_earlier_codes(spark):
    items = spark.createDataFrame([(f"i{k}", "measurement", f"t{k}", None, k >= 6) for k in range(10)], "item_id string, sample string, text string, parent_text string, fresh boolean")
    carried = spark.createDataFrame([("i1", "Ann", "2")], "item_id string, coder string, overall string")
    sheet = coding.agreement_sheet(items, [("overall", "single", "measurement")], [], 3, 6, 4, carried).collect()
    assert len(sheet) == 1 + 4 and [(r.coder, r.overall) for r in sheet if r.item_id == "i1"] == [("Ann", "2")]
    assert {r.item_id for r in sheet} - {"i1"} <= {"i6", "i7", "i8", "i9"}


def test_themes_find_what_belongs_together(spark):
    rng = random.Random(4)
    kinds = ["engine wheel brake gearbox tyre clutch".split(), "flour butter sugar oven dough yeast".split(), "violin trumpet drum chord melody rhythm".split()]
    items = [(k, f"u{k % 9}", " ".join(rng.choices(kinds[k % 3], k=14))) for k in range(45)]
    found, members, facts = themes.themes(spark.createDataFrame(items, "id bigint, person string, text string"), k=3)
    by = {}
    for r in members.collect():
        by.setdefault(r.cluster, set()).add(r.id % 3)
    assert sorted(map(len, by.values())) == [1, 1, 1] and facts["method"].startswith("TF-IDF + LSA") and facts["silhouette"] > 0.5
    shown = found.collect()
    assert {r.size for r in shown} == {15} and all(len(r.representative) == 3 and len(r.terms) == 6 for r in shown)
    with pytest.raises(ValueError):
        themes.themes(spark.createDataFrame(items[:5], "id bigint, person string, text string"))


def test_older_intervals(spark):
    r = spark.range(1).select(*stats.wilson(stats.F.lit(20.0), stats.F.lit(50.0))).first()
    assert round(r[0], 1) == 27.6 and round(r[1], 1) == 53.8


def test_sentences_banners_and_curves():
    negative = {"k": 6, "n": 10, "n_people": 9, "status": "counts-only"}
    assert report.safe_sentence(negative, "posting in s1", "sync") == "In a random sample of 10 comments from 9 people posting in s1, 6 of the 10 comments were negative, most often about sync. This is a count, not a measured share."
    assert "60.0% of the comments were negative (likely 40.0–70.0% within" in report.safe_sentence(negative | {"status": "full", "pct": 60.0, "lo": 40.0, "hi": 70.0}, "", None)
    variables = [("overall", "single"), ("scores", "per_aspect")]
    assert report.banner("drivers", variables, {"overall": "verified", "scores": "tentative", "scores (mentioned)": "verified"})[0] == "tentative"
    assert report.banner("drivers", variables, {"overall": "verified"})[0] == "unverified" and report.banner("trust", variables, {}) is None and report.banner("questions", variables, {})[0] == "none"
    assert report.midsteps([0, 0, 4, 4, 4]) == pytest.approx([0, 4 / 3, 2.4, 3.2, 4])
    assert report.midsteps([3, 3]) == [3, 3] and report.curve([1.0], [1], [1], 3) is None
    shape = report.curve([0, 1, 2], [0, 0, 1], [1, 2, 2], 2)
    assert shape["line"].startswith("M44.0,200.0 L") and shape["band"].endswith(" Z")
    page = report.markdown("Tools", "product", {"verdict": "Mixed", "pains": [{"aspect": "a|b", "n": 2}], "stance": "no"}, variables, {})
    assert "## Verdict" in page and "a\\|b" in page and "Stance" not in page


def test_posts_that_keep_coming(spark, tmp_path):
    from colloq import streaming

    lines = [f'{{"ord":{k},"post_id":"p{k % 30}","source_type":"forum","source":"s","thread":"T{k % 12}","role":"participant","kind":"comment","headline":false,"promotional":false,"person":"u{k % 25}","time":"2024-01-0{1 + k % 9} 10:00:00","text":"a post with more than eight words in it number {k}"}}' for k in range(40)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    folder = lambda n: str(tmp_path / n)
    query = streaming.redraw(streaming.read(spark, folder("in")), folder("kept"), folder("out"), 5, folder("state"))
    assert query.awaitTermination(120)
    assert spark.read.parquet(folder("kept")).count() == 30
    drawn = spark.read.parquet(folder("out"))
    assert 0 < drawn.count() <= 30 and drawn.select("post_id").distinct().count() == drawn.count()
    assert "window" not in streaming.weekly(streaming.read(spark, folder("in"))).columns
