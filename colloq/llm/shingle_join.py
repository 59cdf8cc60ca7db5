"""Near copies by the true similarity of their shingles: every pair with a Jaccard of ``SHARE`` or more is found.

A text is the set of its five-word shingles (64-bit hashes). All sets are put in one order, rare shingles first; two sets that
share enough have a common shingle among the first ones of both (prefix filter). Shingles that are frequent in a sample come last, by
their count there; all others are counted exactly, in one shuffle in which no shingle is hot. A text of which more than a
fifth occurs nowhere else has no partner and is done then, which leaves little but copies. The order decides how fast the
search is and never what it finds; a pair becomes a link only after its two sets have been counted against each other.

Documents with equal sets are one node. Pairs come in rounds, so that large groups of copies do not cost all their pairs: first
those whose fingerprints are close; then in each shared shingle one member of each component against the member with
the fewest shingles ahead of it, which is the one that the others were made from, if it is there. After a round shingles whose
documents are all in one component are done. What is left is compared pair by pair without any cap, except pairs of one
component, which cannot change it, and pairs whose places forbid it: two sets have nothing in common ahead of their first common
shingle, so they share at most what either has from there on, and a pair that shares enough passes at that shingle. Sets are
made again from the texts of the documents that a round asks for; no table of all sets is kept.

Defined results: texts without words have equal (empty) sets; rows that repeat a doc_id and a set are one document; a doc_id with several
different sets is compared with none, so its rows stay; rows with a null doc_id stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import attach, dropped, fits, trim, written
from .components import components
from .shingles import majority, shingle_hashes

SHARE = (4, 5)  # 0.8 as a fraction, so that the bounds are whole numbers
SHINGLE = 5
SAMPLE = 20_000  # documents that tell which shingles are frequent
FREQUENT = 50_000  # shingles that are put last
ID_BYTES = 32  # of a doc_id in a hash table
ROWS = 1 << 16  # shingles that a task passes on at once
BATCH = 512  # documents or pairs that a task gets at once, with texts or sets
ROUNDS = 2  # rounds against the best-linked member, before all pairs are compared


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(shingle_hashes(text, SHINGLE))


def _bytes(column: pa.Array) -> Iterator[bytes]:
    return (t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column)


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = np.concatenate([np.zeros(0, "<u8"), *map(shingle_set, _bytes(batch.column(1)))])
        for k in range(0, len(h), 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(h[k : k + (1 << 20)].view("<i8"))], ["h"])


def _counts(h: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sample's count of each shingle, 0 if it is not frequent."""
    if not len(frequent) or not len(h):
        return np.zeros(len(h), "int64")
    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
    return np.where(frequent[at] == h, counts[at], 0)


def prefix_size(n: int) -> tuple[int, int]:
    """How many of the first shingles of a set of n a partner can need, and how many where the partner is no smaller."""
    p, q = SHARE
    return n - -(-p * n // q) + 1, n - -(-2 * p * n // (p + q)) + 1


def _sketches(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each text: a digest and the size of its set, its fingerprint, and its frequent shingles (how many, and the first in order)."""
    for batch in batches:
        marks, sizes, prints, many, late = [], [], [], [], []
        for text in _bytes(batch.column(1)):
            h = shingle_set(text)
            count = _counts(h, frequent, counts)
            common = h[count > 0][np.lexsort((h[count > 0], count[count > 0]))]
            marks.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
            sizes.append(len(h))
            prints.append(majority(h))
            many.append(len(common))
            late.append(common[: prefix_size(len(h))[0]].view("<i8"))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, late)]).astype("int32")), pa.array(np.concatenate([np.zeros(0, "<i8"), *late])))
        columns = [batch.column(0), pa.array(marks, pa.binary()), pa.array(sizes, pa.int32()), pa.array(prints, pa.binary()), pa.array(many, pa.int32()), lists]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "size", "fp", "many", "late"])


SKETCH = "doc_id bigint, mark binary, size int, fp binary, many int, late array<bigint>"


def _rare(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, rep): the shingles that are not frequent, in batches of about ``ROWS``."""
    keys, reps, held = [], [], 0
    for batch in batches:
        for rep, text in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), strict=True):
            h = shingle_set(text)
            h = h[_counts(h, frequent, counts) == 0].view("<i8")
            keys.append(h)
            reps.append(np.full(len(h), rep, "int64"))
            held += len(h)
            if held >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(reps))], ["key", "rep"])
                keys, reps, held = [], [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(reps))], ["key", "rep"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = pa.array([shingle_set(t).tobytes() for t in _bytes(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["rep", "hashes"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    p, q = SHARE
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * (p + q) >= p * (len(a) + len(b))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, ha, hb) the pairs whose sets share enough."""
    for batch in batches:
        pairs = zip(_bytes(batch.column(2)), _bytes(batch.column(3)), strict=True)
        ok = pa.array([similar(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")) for x, y in pairs], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b), written: the pairs whose sets share enough. Only texts that a pair asks for are read and dealt out."""
    pairs = written(pairs, "near-pairs")
    ids = written(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "near-ids")
    asked = F.broadcast(ids) if fits(ids.count(), ID_BYTES) else ids
    sets = docs.join(asked, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_sets, "rep bigint, hashes binary")
    ha = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("ha"))
    hb = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("hb"))
    full = pairs.join(ha, "a").join(hb, "b").select("a", "b", "ha", "hb")
    out = written(full.mapInArrow(_verify, "a bigint, b bigint").distinct(), "near-links")
    dropped(pairs, ids)
    return out


def _close(small: str, large: str) -> Column:
    p, q = SHARE
    return F.col(small) * q >= F.col(large) * p


def _enough(na: str, at: str, nb: str, bt: str) -> Column:
    """Whether sets of ``na`` and ``nb`` shingles can share enough if the first common one is at these places."""
    p, q = SHARE
    return F.least(F.col(na) - F.col(at), F.col(nb) - F.col(bt)) * (p + q) >= (F.col(na) + F.col(nb)) * p


def _bridges(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of shingles whose documents are in several components."""
    told = members.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = told.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    return told.join(open_, "key")


def _same_prints(nodes: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): pairs to be counted first, those whose fingerprints are equal (a star for each fingerprint) or found close."""
    classes = written(nodes.groupBy("fp").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")), "near-prints")
    star = attach(nodes.select("rep", "fp"), classes.filter("n > 1").select("fp", "least"), "fp", ["rep"]).filter("rep <> least")
    near = search(classes.select(F.col("least").alias("rep"), "fp"))
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return written(near.unionByName(star.select(F.col("least").alias("a"), F.col("rep").alias("b"))), "near-prints")


def _members(nodes: DataFrame, rare: DataFrame) -> DataFrame:
    """(key, rep, size, pos), written: the prefixes of the nodes that can have a partner, without shingles that only one of them has
    and without those that come too late in a node for the smallest partner there.

    ``nodes``: rep, size, many, late; ``rare``: (key, rep) of their shingles that are not frequent.
    """
    p, q = SHARE
    counted = rare.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("df > 1")
    again = written(counted, "shared-shingles")
    held = again.groupBy("rep").agg(F.count(F.lit(1)).cast("int").alias("again"))
    can = nodes.join(held, "rep", "left").withColumn("again", F.coalesce("again", F.lit(0)))
    can = can.filter((F.col("again") + F.col("many")) * q >= F.col("size") * p).filter("size > 0")
    can = written(can.withColumn("alone", F.col("size") - F.col("again") - F.col("many")).select("rep", "size", "again", "alone", "late"), "near-candidates")
    slim = can.select("rep", "size", "alone")
    rank = F.row_number().over(Window.partitionBy("rep").orderBy("df", "key"))
    place = F.col("alone") + rank - 1
    early = again.join(F.broadcast(slim) if fits(slim.count(), 2 * ID_BYTES) else slim, "rep").select("key", "rep", "size", place.alias("pos"))
    late = can.select("rep", "size", (F.col("alone") + F.col("again")).alias("_from"), F.posexplode("late").alias("at", "key"))
    both = early.unionByName(late.select("key", "rep", "size", (F.col("_from") + F.col("at")).alias("pos")))
    n = F.col("size")
    posted = written(both.filter((n - F.col("pos")) * q >= n * p).select("key", "rep", "size", "pos"), "near-prefixes")
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("least")).filter("n > 1").select("key", "least")
    smallest = F.greatest(F.col("least"), F.ceil(n * p / q))
    out = written(posted.join(shared, "key").filter((n - F.col("pos")) * (p + q) >= (n + smallest) * p).drop("least"), "shared-keys")
    dropped(again, can, posted)
    return out


def _same_prints(nodes: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b): pairs to be counted first, those whose fingerprints are equal (a star for each fingerprint) or found close."""
    classes = written(nodes.groupBy("fp").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")), "near-prints")
    star = attach(nodes.select("rep", "fp"), classes.filter("n > 1").select("fp", "least"), "fp", ["rep"]).filter("rep <> least")
    near = search(classes.select(F.col("least").alias("rep"), "fp"))
    near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return written(near.unionByName(star.select(F.col("least").alias("a"), F.col("rep").alias("b"))), "near-prints")


def links(nodes: DataFrame, members: DataFrame, docs: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) from ``members``, the fingerprints of ``nodes`` (rep, fp) and the ``docs`` (doc_id, text) that they stand for."""
    used = written(nodes.select("rep", "fp").join(members.select("rep").distinct(), "rep", "left_semi"), "near-nodes")
    edges = _verified(_same_prints(used, search).distinct(), docs)
    labels = written(components(edges), "near-components")
    open_ = written(_bridges(members, labels), "open-shingles")
    for _ in range(ROUNDS):
        if not open_.limit(1).count():
            return labels
        one = open_.groupBy("key", "component").agg(F.min(F.struct("pos", "rep", "size")).alias("x")).select("key", "component", "x.pos", "x.rep", "x.size")
        lead = one.groupBy("key").agg(F.min(F.struct("pos", "rep", "size", "component")).alias("x"))
        lead = lead.select("key", F.col("x.rep").alias("a"), *[F.col(f"x.{c}").alias(f"{c}_a") for c in ("pos", "size", "component")])
        held = one.join(lead, "key").filter("component <> component_a").filter(_close("size", "size_a") & _close("size_a", "size"))
        held = held.filter(_enough("size_a", "pos_a", "size", "pos"))
        more = _verified(held.select(F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).distinct(), docs)
        if not more.limit(1).count():
            break
        edges = edges.unionByName(more)
        dropped(labels, open_)
        labels = written(components(edges), "near-components")
        open_ = written(_bridges(members, labels), "open-shingles")
    side = lambda s: open_.select("key", F.col("rep").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("pos", "size", "component")])
    short = _enough("size_a", "pos_a", "size_a", "pos_a")  # the smaller set has its first common shingle that early
    ahead = F.struct("size_a", "a") < F.struct("size_b", "b")
    can = ahead & (F.col("component_a") != F.col("component_b")) & _enough("size_a", "pos_a", "size_b", "pos_b") & _close("size_a", "size_b")
    pairs = side("a").filter(short).join(side("b"), "key").filter(can).select("a", "b").distinct()
    last = _verified(pairs, docs)
    dropped(open_)
    return components(edges.unionByName(last)) if last.limit(1).count() else labels


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Texts and sets reach Python few at a time, so a task's memory is bounded by ``BATCH`` of them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def near_components(docs: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(doc_id, component_id) of the documents that another one with a smaller doc_id stands for; null doc_ids are left out.

    ``search`` gives the links (a, b) between fingerprints (rep, fp) that are close.
    """
    trim(docs.sparkSession)
    with _small_batches(docs.sparkSession):
        return _near_components(docs, search)


def _near_components(docs: DataFrame, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text")).filter("doc_id IS NOT NULL")
    share = max(1, -(-slim.count() // SAMPLE))
    sample = slim.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    counted = sample.mapInArrow(_all_shingles, "h bigint").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 2")
    top = counted.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    frequent, counts = top.column("h").to_numpy().view("<u8"), top.column("n").to_numpy()
    order = np.argsort(frequent)
    known = {"frequent": frequent[order], "counts": counts[order]}
    sketches = written(slim.mapInArrow(partial(_sketches, **known), SKETCH), "shingle-sketches")
    several = sketches.groupBy("doc_id").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).filter("lo <> hi").select("doc_id")
    if several.limit(1).count():
        several = written(several, "ids-of-several-texts")
        slim, sketches = slim.join(several, "doc_id", "left_anti"), sketches.join(several, "doc_id", "left_anti")
    same = sketches.groupBy("mark").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    equal = written(sketches.select("doc_id", "mark").join(same, "mark").filter("rep <> doc_id").select("doc_id", "mark", "rep").distinct(), "equal-sets")
    nodes = sketches.join(equal, ["doc_id", "mark"], "left_anti").select(F.col("doc_id").alias("rep"), "size", "many", "late", "fp")
    gone = equal.select("doc_id")
    texts = slim.join(F.broadcast(gone) if fits(equal.count(), ID_BYTES) else gone, "doc_id", "left_anti")
    members = _members(nodes, texts.mapInArrow(partial(_rare, **known), "key bigint, rep bigint"))
    linked = links(nodes, members, slim, search)
    labels = components(linked.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(equal.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    out = written(labels.filter("node <> component").select(F.col("node").alias("doc_id"), F.col("component").alias("component_id")).distinct(), "near-labels")
    dropped(members, equal)
    return out
