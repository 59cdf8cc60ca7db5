"""Benchmark decontamination over a positional inverted index of the training tokens.

The index is split by documents: each segment holds the postings of about ``SEGMENT`` tokens (terms, and for
each term the sorted positions of all its occurrences), and is one row of a written table. No posting is
shuffled. The test items are the stated query set: they are read in blocks of at most ``BLOCK`` bytes, and
each block visits every segment. There a window (a phrase of consecutive item words) starts from the postings
of its rarest term; the lists of its other terms, shifted by their offsets, are intersected from rare to
frequent. What is left are exact phrase matches. ``near_matches`` reports windows whose terms all lie
close together in any order.

Defined results: a null text has no words; items with a null id or text are ignored; rows that repeat an
item id count as one item; documents with a null doc_id or that repeat are judged like any other; an empty
table of items leaves all documents clean; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, own, written

WINDOW = 10
SEGMENT = 1 << 19  # tokens
BLOCK = 16 << 20  # bytes of item texts a visit
GAP = 64  # positions between documents: no phrase, and no near match of a smaller span, crosses it

LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
INDEX = "ids binary, known binary, starts binary, counts binary, terms binary, heads binary, postings binary"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(LOWER).split()


def _segment(ids: list, counts: list[int], tokens: list[bytes]) -> dict:
    counts_ = np.array(counts, "int64")
    starts = np.concatenate([[0], np.cumsum(counts_ + GAP)[:-1]])
    places = np.arange(len(tokens)) + np.repeat(np.arange(len(counts)) * GAP, counts_)
    number: dict[bytes, int] = {}
    terms = np.fromiter((number.setdefault(t, len(number)) for t in tokens), "int32", len(tokens))
    order = np.argsort(terms, kind="stable")
    heads = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=len(number)))])
    return {
        "ids": np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
        "known": np.array([i is not None for i in ids], "u1").tobytes(),
        "starts": starts.astype("<i8").tobytes(),
        "counts": counts_.astype("<i8").tobytes(),
        "terms": b"\n".join(number),
        "heads": heads.astype("<i4").tobytes(),
        "postings": places[order].astype("<i8" if len(counts) * GAP > 2**30 else "<i4").tobytes(),
    }


def _index(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    ids: list = []
    counts: list[int] = []
    tokens: list[bytes] = []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = words_of(text.as_buffer().to_pybytes()) if text.is_valid else []
            ids.append(doc_id)
            counts.append(len(words))
            tokens += words
            if len(tokens) >= segment or len(ids) >= segment:
                yield pa.RecordBatch.from_pylist([_segment(ids, counts, tokens)])
                ids, counts, tokens = [], [], []
    if ids:
        yield pa.RecordBatch.from_pylist([_segment(ids, counts, tokens)])


def build_index(docs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The index of ``docs`` (doc_id, text) as a written table, a row for each segment."""
    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return written(slim.mapInArrow(partial(_index, segment=segment), INDEX), "positional-index")


class Windows:
    """Windows of a block of items, their terms numbered."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        number: dict[bytes, int] = {}
        by_length: dict[int, list] = {}
        for item, text in items:
            words = [number.setdefault(w, len(number)) for w in words_of(text.encode())]
            n = min(window, len(words))
            for k in range(len(words) - n + 1 if n else 0):
                by_length.setdefault(n, []).append((item, words[k : k + n]))
        self.terms = list(number)
        self.sets = [(n, [x[0] for x in v], np.array([x[1] for x in v], "int64")) for n, v in by_length.items()]


class Segment:
    def __init__(self, row: dict, terms: list[bytes]):
        self.ids, self.known = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["known"], "u1")
        self.starts, self.counts = np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["counts"], "<i8")
        self.heads = np.frombuffer(row["heads"], "<i4")
        own = row["terms"].split(b"\n") if row["terms"] else []
        self.postings = np.frombuffer(row["postings"], "<i8" if len(self.ids) * GAP > 2**30 else "<i4")
        number = dict(zip(own, range(len(own)), strict=True))
        self.at = np.array([number.get(t, -1) for t in terms], "int64")
        self.size = np.where(self.at >= 0, self.heads[self.at + 1] - self.heads[self.at], 0) if own else self.at * 0

    def list_of(self, term: int) -> np.ndarray:
        return self.postings[self.heads[self.at[term]] : self.heads[self.at[term] + 1]]

    def present(self, matrix: np.ndarray) -> np.ndarray:
        """Rows of ``matrix`` all of whose terms have postings here."""
        return np.flatnonzero((self.size[matrix] > 0).all(axis=1))

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """Starts of the phrase: offset-adjusted lists intersected, from the rarest term on."""
        found = None
        for k in np.argsort(self.size[terms], kind="stable"):
            places = self.list_of(terms[k])
            if found is None:
                found = places - k
                continue
            at = np.searchsorted(places, found + k)
            at[at == len(places)] = 0
            found = found[places[at] == found + k]
            if not len(found):
                break
        return found

    def close(self, terms: np.ndarray, span: int) -> np.ndarray:
        """Places of the rarest term that lie, with a place of every other term, in some ``span`` words of one document."""
        order = terms[np.argsort(self.size[terms], kind="stable")]
        anchor = self.list_of(order[0]).astype("int64")
        others = [self.list_of(k) for k in dict.fromkeys(order.tolist()) if k != order[0]]
        for places in others:  # without a place less than the span away there is nothing to sweep
            anchor = anchor[np.searchsorted(places, anchor - span + 1) < np.searchsorted(places, anchor + span)]
        of = self.document(anchor)
        low, end = self.starts[of], self.starts[of] + self.counts[of]
        found = []
        some = max(1, 2**20 // span)
        for k in range(0, len(anchor), some):  # every start of a window around these places
            a, floor, stop = (x[k : k + some] for x in (anchor, low, end))
            start = a[:, None] - np.arange(span)
            ok = start >= floor[:, None]
            limit = np.minimum(start + span, stop[:, None])
            for places in others:
                at = np.searchsorted(places, start)
                ok &= (at < len(places)) & (places[np.minimum(at, len(places) - 1)] < limit)
            found.append(a[ok.any(axis=1)])
        return np.concatenate(found) if found else anchor

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1


def _search(batches: Iterator[pa.RecordBatch], blocks) -> Iterator[pa.RecordBatch]:
    windows: Windows = blocks.value
    for batch in batches:
        for row in batch.to_pylist():
            s = Segment(row, windows.terms)
            n = len(s.ids)
            edge = np.zeros(int(s.starts[-1] + s.counts[-1]) + GAP + 1, "int32")
            items: dict[int, set] = {}
            for length, names, matrix in windows.sets:
                for w in s.present(matrix):
                    found = s.phrase(matrix[w])
                    np.add.at(edge, found, 1)
                    np.add.at(edge, found + length, -1)
                    for d in np.unique(s.document(found)):
                        items.setdefault(int(d), set()).add(names[w])
            hit = np.flatnonzero(np.cumsum(edge) > 0)
            of = s.document(hit)
            cut = np.searchsorted(of, np.arange(n + 1))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(s.ids, pa.int64(), mask=s.known == 0),
                    "n_words": pa.array(s.counts, pa.int64()),
                    "hits": [(hit[cut[d] : cut[d + 1]] - s.starts[d]).tolist() for d in range(n)],
                    "items": [sorted(items.get(d, ())) for d in range(n)],
                },
                pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))]),
            )


def _near(batches: Iterator[pa.RecordBatch], blocks, slop: int) -> Iterator[pa.RecordBatch]:
    windows: Windows = blocks.value
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            s = Segment(row, windows.terms)
            for length, names, matrix in windows.sets:
                for w in s.present(matrix):
                    for place in s.close(matrix[w], length + slop):
                        d = int(s.document(np.array([place]))[0])
                        rows.append((int(s.ids[d]) if s.known[d] else None, names[w], int(place - s.starts[d])))
        cols = list(zip(*rows, strict=True)) or [[]] * 3
        kinds = (pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "position"])


def _blocks(items: DataFrame, window: int) -> Iterator[Windows]:
    """Items in blocks of bounded size; only one is on the driver at a time."""
    block, size = [], 0
    rows = items.select(F.col("item_id").cast("string"), "text").dropna().toLocalIterator()
    for item, text in rows:
        block.append((item, text))
        size += len(text)
        if size >= BLOCK:
            yield Windows(block, window)
            block, size = [], 0
    yield Windows(block, window)


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, index: DataFrame | None = None) -> DataFrame:
    """One row a document: doc_id, n_words, hits (positions of hit words), items (item ids as strings, sorted)."""
    spark = docs.sparkSession
    index = build_index(docs) if index is None else index
    schema = "doc_id bigint, n_words bigint, hits array<bigint>, items array<string>"
    parts = [
        index.mapInArrow(partial(_search, blocks=spark.sparkContext.broadcast(w)), schema) for w in _blocks(items, window)
    ]
    if len(parts) == 1:
        return parts[0]
    # Several blocks: segments and their documents come in the same order for each, so rows have a common number.
    numbered = [written(p.withColumn("_row", F.monotonically_increasing_id()), "matches") for p in parts]
    whole = numbered[0]
    for more in numbered[1:]:
        more = more.filter(F.size("items") > 0).select("_row", F.col("hits").alias("_hits"), F.col("items").alias("_items"))
        whole = whole.join(more, "_row", "left").withColumns(
            {c: F.array_sort(F.array_union(c, F.coalesce(f"_{c}", F.expr("array()")))) for c in ("hits", "items")}
        ).drop("_hits", "_items")
    return whole.drop("_row")


def near_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 10, index: DataFrame | None = None) -> DataFrame:
    """Windows whose terms all lie within ``window + slop`` words of a document: doc_id, item_id, position of the rarest."""
    spark = docs.sparkSession
    index = build_index(docs) if index is None else index
    parts = [
        index.mapInArrow(partial(_near, blocks=spark.sparkContext.broadcast(w), slop=slop), "doc_id bigint, item_id string, position bigint")
        for w in _blocks(items, window)
    ]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole.distinct()


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a hit; rows that share a doc_id with a hit row go with it, a null doc_id has its own texts looked up."""
    keyed = docs.withColumn("_cq_key", F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))))
    found = find_matches(keyed.select(F.col("_cq_key").alias("doc_id"), "text"), items, window)
    hit = found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("_cq_key")).distinct()
    return keyed.join(hit, "_cq_key", "left_anti").select(own(docs))


def report(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(find_matches(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")))


SQL = r"""
WITH read AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
asked AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
sized AS (SELECT item, ws, least(10, len(ws)) AS n FROM asked WHERE len(ws) > 0),
items AS (SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS words FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM sized)),
windows AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS words FROM (SELECT *, unnest(range(1, greatest(len(ws) - n + 2, 1))) AS i FROM read, (SELECT DISTINCT n FROM items))),
hits AS (SELECT DISTINCT doc_id, n, i, item FROM windows JOIN items USING (n, words)),
places AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM read LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
"""
