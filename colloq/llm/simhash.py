"""SimHash near-duplicates with pigeonring filtering.

A fingerprint of 64 bits is a ring of m segments. If two fingerprints differ in at most t bits, then from some
segment on every chain of l consecutive segments has at most l * t / m differences. The chain's part that must be equal
is the index key: fingerprints are joined only if they share it, then the chain's longer prefixes are held to their
proportional budgets, and only what passes gets the full Hamming check. With t = 2 and m = 16 the equal part is seven
segments, and the search finds every link.

Classes of equal fingerprints are one node each. A key with at most ``LIGHT`` nodes is checked pair by pair. The nodes of
larger keys go through their 65 one-bit neighbours, where nodes that meet are within two bits; that is exact, and at most
65 nodes meet in one place. Links become components by star contraction.

Defined results: a null or empty text has fingerprint zero and links like any other; rows with a null doc_id take the
component of their fingerprint's smallest doc_id (null if there is none); rows that repeat get equal results;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, load, written
from .components import components
from .shingle_join import near_components
from .shingles import majority, shingle_hashes

BITS, MOST, SEGMENT = 64, 2, 4
SEGMENTS = BITS // SEGMENT
EQUAL = (SEGMENTS - 1) // MOST  # segments that a chain's budget of no difference covers
LIGHT = 32
SHINGLE = 3


# --- Fingerprints ----------------------------------------------------------------------------------------------


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [majority(shingle_hashes(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary())], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the bits as little-endian bytes; shingles count as often as they occur."""
    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return slim.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id bigint, fp binary")


# --- Search --------------------------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), "u1").reshape(-1, BITS // 8)
    return np.unpackbits(flat, axis=1, bitorder="little")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rep) for each segment that a chain can begin with; a key holds the place in its upper bits."""
    width = EQUAL * SEGMENT
    weights = np.int64(1) << np.arange(width, dtype="int64")
    for batch in batches:
        if not batch.num_rows:
            continue
        bits = _matrix(batch.column(1))
        bits = np.concatenate([bits, bits[:, :width]], axis=1)
        keys = [(bits[:, start : start + width] @ weights) | np.int64(start << 44) for start in range(0, BITS, SEGMENT)]
        reps = np.tile(batch.column(0).to_numpy(zero_copy_only=False), len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(reps)], ["key", "rep"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, key, fa, fb) what keeps the chain's budgets and then the full threshold."""
    budgets = np.arange(1, SEGMENTS + 1) * MOST // SEGMENTS
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, key = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        diff = (_matrix(batch.column(3)) ^ _matrix(batch.column(4))).reshape(len(a), SEGMENTS, SEGMENT).sum(axis=2)
        turn = ((key >> 44) // SEGMENT)[:, None] + np.arange(SEGMENTS)
        chain = np.cumsum(np.take_along_axis(diff, turn % SEGMENTS, axis=1), axis=1)
        ok = (chain <= budgets).all(axis=1)  # the last budget is the threshold itself
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])


def _flips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype="u8")]).astype("<u8")
    for batch in batches:
        if batch.num_rows:
            fp = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8")
            near = (fp[:, None] ^ flips).ravel().view("<i8")
            reps = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), 65)
            yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(reps)], ["near", "rep"])


def links(classes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect whatever differs in at most two bits; ``classes`` (rep, fp) is a written table of distinct fingerprints."""
    keyed = classes.mapInArrow(_keys, "key bigint, rep bigint")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(keyed.join(shared, "key"), "shared-keys")
    light = members.filter(F.col("n") <= LIGHT).select("key", "rep")
    pairs = light.select("key", F.col("rep").alias("a")).join(light.select("key", F.col("rep").alias("b")), "key").filter("a < b")
    fa = classes.select(F.col("rep").alias("a"), F.col("fp").alias("fa"))
    fb = classes.select(F.col("rep").alias("b"), F.col("fp").alias("fb"))
    full = pairs.join(fa, "a").join(fb, "b").select("a", "b", "key", "fa", "fb")
    near = full.mapInArrow(_verify, "a bigint, b bigint").distinct()
    heavy = members.filter(F.col("n") > LIGHT).select("rep").distinct()
    nodes = classes.join(heavy, "rep", "left_semi").select("rep", "fp")
    balls = nodes.mapInArrow(_flips, "near bigint, rep bigint").groupBy("near").agg(F.collect_list("rep").alias("reps"))
    star = balls.filter(F.size("reps") > 1).select(F.array_min("reps").alias("b"), F.explode("reps").alias("a"))
    return near.unionByName(star.filter("a <> b").select("a", "b").distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, fp, component_id (the smallest doc_id that links lead to, itself included)."""
    prints = written(fingerprints(docs), "fingerprints")
    grouped = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = written(grouped, "classes")
    known = classes.filter("rep IS NOT NULL").select("rep", "fp")
    labels = components(links(known))
    facts = classes.join(labels, classes["rep"] == labels["node"], "left").select(
        "fp", "n", F.coalesce("component", "rep").alias("component_id"), "component"
    )
    facts = facts.filter("n > 1 OR component IS NOT NULL").select("fp", "component_id")
    found = attach(prints, facts, "fp", ["doc_id"])
    return found.select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller doc_id; rows with a null doc_id stay.

    Links are the pairs whose five-word shingle sets have a Jaccard of 0.8 or more, all of them and no others. Fingerprints of
    these sets and the pigeonring search above give the closest pairs; bits neither prove a similarity nor find all pairs down
    to 0.8, so each pair is counted, and ``shingle_join`` finds what lies beyond two bits.
    """
    drop = near_components(docs, links).select(F.col("doc_id").alias("_cq_drop"))
    return docs.join(drop, docs["doc_id"].cast("bigint") == drop["_cq_drop"], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(load(spark, sf_dir, "documents"))
    digits = F.lower(F.hex("fp"))  # little-endian bytes; the number is written from its highest byte on
    number = F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(8))])
    return found.select("doc_id", number.alias("fingerprint"), "component_id")
