"""The pipeline on a small folder of tables: its stages keep what they should and pass the columns on."""

import random
from collections import Counter

import corpus_pipeline
from colloq.llm import exact_dedup, quality, shingle_join


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["ba", "de", "fi", "go", "lu"]) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    clean = [prose(rng.randint(40, 200)) for _ in range(120)]
    junk = [" | ".join(word().upper() + "!!" for _ in range(60)) for _ in range(60)]
    passage = prose(30)
    near = clean[0].split(" ")
    near[10] = "edited"
    texts = clean + junk + [clean[3], clean[3], " ".join(near), f"{prose(50)} {passage} {prose(50)}"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 120), 0) for i in range(180)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        ids.append({r.doc_id for r in docs.collect()})
    quality_ids, exact_ids, near_ids, clean_ids = ids
    assert quality_ids == set(range(120)) | {180, 181, 182, 183}
    assert exact_ids == quality_ids - {3, 180}
    assert near_ids == exact_ids - {182}
    assert clean_ids == near_ids - {183}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(clean_ids)
    assert quality.THRESHOLD == 0.7 and exact_dedup.SQL


def plain_components(texts):
    """Brute force: (components with the least number as root, Jaccard of each pair in an order)."""
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.lower().split() for t in texts)]
    root, share = list(range(len(sets))), {}
    def find(x):  # noqa: E306
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            share[j, i] = both / (len(a) + len(sets[j]) - both)
            if share[j, i] >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))], share


def kept_near(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id for r in corpus_pipeline.near_stage(spark, docs, "").collect()}


def test_star_of_near_copies_is_one_group(spark):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(300):
        copy = list(base)
        for at in rng.sample(range(5, 195, 6), 4):  # 4 edits cost 20 of 196 shingles: 0.81 to the base, less to other copies
            copy[at] = f"z{rng.random()}"
        texts.append(" ".join(copy))
    texts.insert(150, " ".join(base))
    roots, share = plain_components(texts)
    assert set(roots) == {0} and sum(s < 0.8 for s in share.values()) > 0.9 * len(share)
    assert kept_near(spark, texts) == {0}


def test_all_pairs_at_the_threshold_are_found(spark):
    rng = random.Random(6)
    texts = []
    for g in range(150):  # pairs at a Jaccard of 0.75 to 0.9, by one run of words left out
        base = [f"g{g}w{k}" for k in range(204)]
        copy = list(base)
        copy[100 : 100 + rng.randint(12, 42)] = []
        texts += [" ".join(base), " ".join(copy)]
    roots, share = plain_components(texts)
    bands = Counter(int(share[2 * g, 2 * g + 1] * 50) for g in range(150))
    assert all(bands[b] >= 5 for b in range(40, 45))
    kept = kept_near(spark, texts)
    assert kept == {i for i, r in enumerate(roots) if r == i}


def test_documents_below_the_threshold_stay(spark):
    rng = random.Random(7)
    texts = []
    for g in range(150):
        base = [f"g{g}w{k}" for k in range(204)]
        copy = list(base)
        for at in rng.sample(range(5, 195, 6), 5):  # 175 of 225 shingles shared: 0.78
            copy[at] = f"g{g}z{at}"
        texts += [" ".join(base), " ".join(copy)]
    assert kept_near(spark, texts) == set(range(300))


def test_group_with_texts_below_the_threshold_costs_no_pairs_of_them(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(150)]
    def edited(n):  # noqa: E306
        copy = list(base)
        for at in rng.sample(range(5, 145, 6), n):
            copy[at] = f"z{rng.random()}"
        return copy
    near = [edited(rng.randint(1, 3)) for _ in range(120)]  # 146 shingles: 3 edits leave 131, and 130 are enough
    far = [edited(rng.randint(4, 5)) for _ in range(120)]
    short = [edited(2)[: rng.randint(100, 149)] for _ in range(20)]
    texts = [" ".join(t) for t in [base, *near, *far, *short]]
    rng.shuffle(texts)
    counted, verified = [], shingle_join._verified
    monkeypatch.setattr(shingle_join, "_verified", lambda pairs, docs: counted.append(pairs.count()) or verified(pairs, docs))
    roots, _ = plain_components(texts)
    assert max(Counter(roots).values()) > 120 and len(set(roots)) > 100
    assert kept_near(spark, texts) == {i for i, r in enumerate(roots) if r == i}
    assert sum(counted) < 20 * len(texts)
