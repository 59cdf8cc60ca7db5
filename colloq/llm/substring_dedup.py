"""Substring deduplication over a log-structured fingerprint index.

A window is ``WINDOW`` consecutive words. Its gram is the least hash of the runs of ``GRAM`` words inside it;
consecutive windows with the same gram form a stretch. Documents that share a window share its gram, so the
index holds one fingerprint a stretch (gram, digest of the words of the stretch, doc_id) instead of one a window,
about a fifth, and misses nothing.

Each batch becomes a sorted immutable run, bucketed by gram; that is its only shuffle of fingerprints. The run is
merge-joined with the older runs, bucket by bucket. A stretch that also lies in an earlier document is removed as a
whole. Where one gram has different stretches (at the ends of passages and around edits), the windows of the first
document of each stretch are compared one by one. When there are more than ``MOST_RUNS`` runs they are merged into one.

Verification: grams only bring stretches together. Words go because BLAKE2b digests of the words themselves are equal, 64 bits for a
stretch (besides its gram) and 128 for a window, whatever the rolling hashes of the grams do.

Hot grams: what repeats inside a task's batch of documents is decided there, and only its first document goes on; that holds for
stretches and for single windows. A gram with ``HOT`` or more stretches in one batch is dealt over ``SALTS`` buckets and
its stretches always compared window by window; a mark in the gram's plain bucket makes batches where it is rare do the same.

Batches come in ascending doc_id, so what a run holds is smaller than what comes later.

Defined results: a null text has no words; a row with a null doc_id loses nothing and is no source; rows that repeat a
doc_id are judged alike and are no source for one another; an empty table gives no rows; other columns
are not read. A text of fewer words than a window loses nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_folder, dropped, files_of, load, new_path, tidy, written

WINDOW = 13
GRAM = 6
MOST_RUNS = 1
BATCHES = 3
HOT = 64
SALTS = 32
M = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
MASK48 = np.uint64(2**48 - 1)
BLOCK = 1 << 20  # bytes hashed at a time

SPACE = np.array([c in (9, 10, 11, 12, 13, 32) for c in range(256)])


# --- Hashes of runs of words ---------------------------------------------------------------------------------

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of M and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        out = []
        for base in (M, pow(M, -1, 2**64)):
            x = np.full(max(BLOCK, 2 * n), base, "<u8")
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _running(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of M, from nothing on."""
    out = np.zeros(len(values) + 1, "<u8")
    np.cumsum(values * _powers(len(values))[0][: len(values)], out=out[1:])
    return out


def _spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of what lies from start to end (exclusive), the same wherever it lies."""
    return (sums[end] - sums[start]) * _powers(len(sums))[1][start]


class Chunk:
    """Some texts, their words numbered through: hashes are computed for all of them at once."""

    def __init__(self, texts: list[bytes]):
        texts = [b" ".join(t.split()) for t in texts]
        self.line = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.line, "u1")
        edge = np.diff((~SPACE[raw]).astype("i1"), prepend=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.starts, self.ends = starts, ends
        at = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.base = np.searchsorted(starts, at)  # first word of each text, and the end
        self.n = len(starts)
        hashes = np.zeros(self.n, "<u8")
        k = 0
        while k < self.n:  # whole words, about a block of bytes
            stop = max(k + 1, int(np.searchsorted(ends, starts[k] + BLOCK)))
            a, s, e = starts[k], starts[k:stop], ends[k:stop]
            sums = _running(raw[a : e[-1]].astype("<u8"))
            hashes[k:stop] = _mix(_spans(sums, s - a, e - a) + (e - s).astype("<u8"))
            k = stop
        self.hashes = hashes
        self.sums = _running(hashes)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.base))

    def stretches(self) -> tuple[np.ndarray, ...]:
        """Text, first and last window (as numbers of their first words), gram (48 bits) and digest (64 bits) of each stretch."""
        if self.n < WINDOW:
            none = np.zeros(0, "int64")
            return none, none, none, none.astype("<u8"), none.astype("<u8")
        at = np.arange(self.n - GRAM + 1)
        least = _mix(_spans(self.sums, at, at + GRAM))
        width = WINDOW - GRAM + 1  # grams of a window
        reach = 1
        while 2 * reach <= width:
            least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        whole = np.flatnonzero(self.text_of[: self.n - WINDOW + 1] == self.text_of[WINDOW - 1 :])
        least, text = least[whole], self.text_of[whole]
        if not len(whole):
            return text, whole, whole, least, least
        first = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (text[1:] != text[:-1])]))
        last = np.concatenate([first[1:], [len(whole)]]) - 1
        a, b = whole[first], whole[last]
        check = np.frombuffer(self._digests(a, b + WINDOW - 1, 8), "<u8")
        return text[first], a, b, least[first] & MASK48, check

    def _digests(self, first: np.ndarray, last: np.ndarray, size: int) -> bytes:
        """Digests of the words from ``first`` to ``last``, joined by single spaces."""
        line = self.line
        return b"".join([blake2b(line[s:e], digest_size=size).digest() for s, e in zip(self.starts[first].tolist(), self.ends[last].tolist(), strict=True)])

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits for each window."""
        both = np.frombuffer(self._digests(starts, starts + WINDOW - 1, 16), "<u8").reshape(-1, 2)
        return both[:, 0], both[:, 1]


@contextmanager
def co_partitioned(spark: SparkSession) -> Iterator[None]:
    """Joins on (gram, salt, chk) use the buckets by (gram, salt) as they are, without a shuffle of either side."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).astype("<u8").view("<i8"))


def _texts(column: pa.Array) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column]


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a block of bytes."""
    a = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK:
            yield a, k + 1
            a, size = k + 1, 0
    if a < len(texts):
        yield a, len(texts)


# --- Tasks over texts --------------------------------------------------------------------------------------------

ROW = "gram bigint, salt int, chk bigint, doc_id bigint, nth int"
LOCAL, MARK = -1, -1  # salt of what a batch of documents has decided; check of a mark


def _stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each stretch: ``nth`` of its document."""
    for batch in batches:
        ids, texts = batch.column(0).to_numpy(zero_copy_only=False), _texts(batch.column(1))
        parts = []
        for a, b in _chunks(texts):
            text, _, _, g, c = Chunk(texts[a:b]).stretches()
            nth = np.arange(len(text)) - np.searchsorted(text, text)
            parts.append((g, c, ids[a:b][text], nth))
        if not parts:
            continue
        g, c, d, k = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((d, c, g))
        g, c, d, k = g[order], c[order], d[order], k[order]
        if not len(g):
            continue
        new_gram = np.concatenate([[True], g[1:] != g[:-1]])
        new = new_gram | np.concatenate([[True], c[1:] != c[:-1]])
        group = np.cumsum(new) - 1
        decided = d > d[np.flatnonzero(new)][group]
        gram = np.cumsum(new_gram) - 1
        hot = (np.bincount(gram[new]) >= HOT)[gram]
        salt = np.where(hot, 1 + (c % np.uint64(SALTS)).astype("int64"), 0)
        salt[decided] = LOCAL
        out = g.astype("<u8").view("<i8").copy()
        out[decided] = (_mix(d[decided].astype("<i8").view("<u8")) & MASK48).view("<i8")  # dealt by document
        marks = g[hot & new_gram].view("<i8")
        none = np.full(len(marks), -1)
        arrays = (
            np.concatenate([out, marks]),
            np.concatenate([salt, 0 * none]).astype("int32"),
            np.concatenate([c.view("<i8"), none]),
            np.concatenate([d, none]),
            np.concatenate([k, none]).astype("int32"),
        )
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["gram", "salt", "chk", "doc_id", "nth"])


def _digest(words: list[bytes], removed: np.ndarray) -> tuple[int, bytes, str]:
    kept = [w for w, gone in zip(words, removed.tolist(), strict=True) if not gone] if removed.any() else words
    line = b" ".join(kept)
    return int(removed.sum()), line, hashlib.sha256(line).hexdigest()


RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
STATE = f"{RESULT}, row bigint, text binary, gone binary, starts array<int>, w1 array<bigint>, w2 array<bigint>, kept binary"


def _apply(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Remove whole stretches; documents with open ones keep their text and list their windows.

    ``met`` names a stretch by its number and digest, as rows may share a doc_id and not the text. A window that a smaller doc_id
    of the batch has, too, goes at once; only its first document lists it.
    """
    for batch in batches:
        rows, open_, all_texts = [], [], _texts(batch.column(1))
        ids, hashes, met = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        for a, b in _chunks(all_texts):
            told = [k for k in range(a, b) if met[k]]
            if told:
                chunk = Chunk([all_texts[k] for k in told])
                text, first, last, _, check = chunk.stretches()
                check, begin = check.view("<i8"), np.searchsorted(text, np.arange(len(told) + 1))
                place = dict(zip(told, range(len(told)), strict=True))
            for k in range(a, b):
                words = all_texts[k].split()
                edge = np.zeros(len(words) + 1, "int32")
                row = dict.fromkeys(("text", "gone", "starts", "w1", "w2", "kept"))
                whole, still = [], []
                if met[k]:
                    base, own, end = chunk.base[place[k]], begin[place[k]], begin[place[k] + 1]
                    for x in met[k]:
                        of = own + x["nth"]
                        if of < end and check[of] == x["chk"]:
                            (whole if x["whole"] else still).append(of)
                    np.add.at(edge, first[whole] - base, 1)
                    np.add.at(edge, last[whole] - base + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
                n = sha = None
                if still:
                    starts = np.concatenate([np.arange(first[x], last[x] + 1) for x in still])
                    open_.append((len(rows), ids[k], gone, starts - base, *chunk.windows(starts)))
                    row |= {"row": hashes[k], "text": all_texts[k]}
                else:
                    n, line, sha = _digest(words, gone)
                    row["kept"] = line if texts else None
                rows.append(row | {"doc_id": ids[k], "n_words": len(words), "n_removed": n, "kept_sha256": sha})
        for (at, _, gone, starts, w1, w2), here in zip(open_, _decided(open_), strict=True):
            edge = np.zeros(len(gone) + 1, "int32")
            np.add.at(edge, starts[here], 1)
            np.add.at(edge, starts[here] + WINDOW, -1)
            gone = gone | (np.cumsum(edge[:-1]) > 0)
            rows[at] |= {"gone": np.packbits(gone).tobytes(), "starts": starts[~here].astype("int32"), "w1": w1[~here].view("<i8"), "w2": w2[~here].view("<i8")}
        yield pa.RecordBatch.from_pylist(rows, _STATE)


def _decided(open_: list[tuple]) -> list[np.ndarray]:
    """For each document of a batch, which of its windows a smaller doc_id of the batch has."""
    if not open_:
        return []
    sizes = [len(x[3]) for x in open_]
    w1, w2 = (np.concatenate([x[k] for x in open_]) for k in (4, 5))
    doc = np.repeat(np.array([x[1] for x in open_], "int64"), sizes)
    order = np.lexsort((doc, w2, w1))
    new = np.concatenate([[True], (w1[order][1:] != w1[order][:-1]) | (w2[order][1:] != w2[order][:-1])])
    out = np.empty(len(doc), bool)
    out[order] = doc[order] > doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return np.split(out, np.cumsum(sizes)[:-1])


_STATE = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("row", pa.int64()), ("text", pa.binary()), ("gone", pa.binary()),
     ("starts", pa.list_(pa.int32())), ("w1", pa.list_(pa.int64())), ("w2", pa.list_(pa.int64())), ("kept", pa.binary())]
)


def _finish(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, gone, more): remove the windows that start at ``more``, too."""
    for batch in batches:
        rows = []
        for doc_id, text, gone, more in zip(
            batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True
        ):
            words = text.split()
            removed = np.unpackbits(np.frombuffer(gone, "u1"), count=len(words)).astype(bool)
            edge = np.zeros(len(words) + 1, "int32")
            if more:
                starts = np.unique(more)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + WINDOW, -1)
            removed |= np.cumsum(edge[:-1]) > 0
            n, line, sha = _digest(words, removed)
            rows.append({"doc_id": doc_id, "n_words": len(words), "n_removed": n, "kept_sha256": sha, "kept": line if texts else None})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([*[_STATE.field(k) for k in range(4)], _STATE.field("kept")]))


def _source_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, asked: numbers of its stretches) of earlier documents -> their windows."""
    for batch in batches:
        ids, texts, asked = batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2).to_pylist()
        for a, b in _chunks(texts):
            chunk = Chunk(texts[a:b])
            text, first, last, _, _ = chunk.stretches()
            begin = np.searchsorted(text, np.arange(b - a + 1))
            starts, of = [], []
            for k in range(a, b):
                for x in asked[k]:
                    if x < begin[k - a + 1] - begin[k - a]:  # of rows that repeat a doc_id, only those that have it
                        starts.append(np.arange(first[begin[k - a] + x], last[begin[k - a] + x] + 1))
                        of.append(np.full(len(starts[-1]), ids[k], "int64"))
            if starts:
                w1, w2 = chunk.windows(np.concatenate(starts))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(of)), _signed(w1), _signed(w2)], ["doc_id", "w1", "w2"])


# --- Index -----------------------------------------------------------------------------------------------------------


class FingerprintIndex:
    """Sorted immutable runs of stretches (``ROW``), each a table bucketed by (gram, salt), and the texts that were delivered.

    ``path`` names the index; opening an existing path continues it, with its own buckets. A new index has as many buckets as shuffle
    partitions, 64 at least: one file a bucket, and buckets grow with the cluster. A run counts once it is wholly written, so a
    job that is lost leaves an index that can be opened again; to deliver the same documents again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark, self.path = spark, path or new_path(spark, "fingerprint-index")
        self.runs, self.paths = [], {}
        self.delivered: list[DataFrame] = []  # (doc_id, text) of the calls before
        self.buckets = buckets or max(64, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
        for folder in files_of(spark, f"{self.path}/*/_SUCCESS"):
            at = folder.rsplit("/", 1)[0]
            if "/texts-" in at:
                self.delivered.append(spark.read.schema("doc_id bigint, text binary").parquet(at))
            else:
                self.buckets = int(at.rsplit("-", 1)[1])
                self.runs.append(self._table(at))

    def _table(self, path: str) -> str:
        name = "fingerprint_run_" + uuid.uuid4().hex[:12]
        self.spark.sql(
            f"CREATE TABLE {name} ({ROW}) USING parquet CLUSTERED BY (gram, salt) SORTED BY (gram, salt, chk, doc_id) "
            f"INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        self.paths[name] = path
        return name

    def _write(self, df: DataFrame, dealt: bool = False) -> str:
        """A run of ``df``; ``dealt`` if its partitions are the buckets already."""
        path = f"{self.path}/run-{uuid.uuid4().hex[:12]}-{self.buckets}"
        name = self._table(path)
        sorted_ = (df if dealt else df.repartition(self.buckets, "gram", "salt")).sortWithinPartitions("gram", "salt", "chk", "doc_id")
        writer = sorted_.write.mode("append").format("parquet").bucketBy(self.buckets, "gram", "salt")
        with tidy(self.spark):
            writer.sortBy("gram", "salt", "chk", "doc_id").option("path", path).saveAsTable(name)
        return name

    def deliver(self, texts: DataFrame) -> None:
        path = f"{self.path}/texts-{uuid.uuid4().hex[:12]}"
        texts.write.parquet(path)
        self.delivered.append(self.spark.read.schema(texts.schema).parquet(path))

    def close(self, delete: bool = False) -> None:
        """Forget the tables' names in this session; with ``delete`` the files go, too."""
        for run in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        if delete:
            drop_folder(self.spark, self.path)

    def ingest(self, stretches: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Append a batch's stretches as a run.

        Returns (doc_id, nth, gram, chk, whole) of the stretches that need a closer look: ``whole`` if an earlier document has
        it, otherwise this document is the first and the gram has other stretches, in the batch or in a run; and what
        the older runs hold.
        """
        run = self._write(stretches)
        rows = self.spark.table(run)
        same, gram = Window.partitionBy("gram", "salt", "chk"), Window.partitionBy("gram", "salt")
        found = rows.filter("salt >= 0").withColumns({"first": F.min("doc_id").over(same), "lo": F.min("chk").over(gram), "hi": F.max("chk").over(gram)})
        found = found.filter("nth >= 0").withColumn("many", (F.col("lo") != F.col("hi")) | (F.col("salt") > 0))
        old = self.history()
        for k, table in enumerate(self.runs):  # run by run, so that each join uses the buckets as they are
            held = self.spark.table(table).filter("salt >= 0")
            seen = held.groupBy("gram", "salt", "chk").agg(F.min("doc_id").alias(f"seen{k}"))
            known = held.groupBy("gram", "salt").agg(F.lit(True).alias(f"known{k}"))
            found = found.join(seen.hint("merge"), ["gram", "salt", "chk"], "left").join(known.hint("merge"), ["gram", "salt"], "left")
            found = found.withColumns({"first": F.least("first", f"seen{k}"), "many": F.col("many") | F.coalesce(f"known{k}", F.lit(False))})
        found = found.select("doc_id", "nth", "gram", "chk", (F.col("first") < F.col("doc_id")).alias("whole"), "many").filter("whole OR many").drop("many")
        local = rows.filter(F.col("salt") == LOCAL).select("doc_id", "nth", "gram", "chk", F.lit(True).alias("whole"))
        self.runs.append(run)
        return found.unionByName(local), old

    def history(self) -> DataFrame | None:
        out = None
        for run in self.runs:
            out = self.spark.table(run) if out is None else out.unionByName(self.spark.table(run))
        return out

    def compact(self) -> None:
        """Merge the runs into one; of a stretch that several hold, the first document stays."""
        if len(self.runs) > 1:
            dealt = self.history().filter("salt >= 0").repartition(self.buckets, "gram", "salt")
            first = dealt.groupBy("gram", "salt", "chk").agg(F.min(F.struct("doc_id", "nth")).alias("x"))
            merged = self._write(first.select("gram", "salt", "chk", "x.doc_id", "x.nth"), dealt=True)
            for run in self.runs:
                self.spark.sql(f"DROP TABLE {run}")
                drop_folder(self.spark, self.paths.pop(run))
            self.runs = [merged]


def _ingest(batch: DataFrame, earlier: DataFrame | None, index: FingerprintIndex, texts: bool) -> DataFrame:
    met, old = index.ingest(batch.filter("doc_id IS NOT NULL").mapInArrow(_stretch_rows, ROW))
    with co_partitioned(batch.sparkSession):
        met = written(met, "stretches-met")
    replies = met.groupBy("doc_id").agg(F.collect_set(F.struct("nth", "chk", "whole")).alias("met"))
    told = batch.join(replies, "doc_id", "left").select("doc_id", "text", F.xxhash64("text").alias("row"), "met")
    state = written(told.mapInArrow(partial(_apply, texts=texts), STATE), "substring-state")
    open_ = state.filter("text IS NOT NULL")
    windows = open_.select("doc_id", "row", F.explode(F.arrays_zip("starts", "w1", "w2")).alias("x")).select("doc_id", "row", "x.*")
    sources, read_again = windows.select("doc_id", "w1", "w2"), None
    if old is not None and earlier is not None:
        grams = met.filter("NOT whole").select("gram").distinct()
        first = old.filter("salt >= 0 AND nth >= 0").join(grams, "gram", "left_semi").groupBy("gram", "salt", "chk").agg(F.min(F.struct("doc_id", "nth")).alias("x"))
        asked = first.groupBy("x.doc_id").agg(F.collect_set("x.nth").alias("asked"))
        read = earlier.filter("doc_id IS NOT NULL").join(asked, "doc_id").select("doc_id", "text", "asked")
        read_again = written(read.mapInArrow(_source_windows, "doc_id bigint, w1 bigint, w2 bigint"), "source-windows")
        sources = sources.unionByName(read_again)
    dropped(met)
    least = sources.groupBy("w1", "w2").agg(F.min("doc_id").alias("_least"), F.max("doc_id").alias("_last")).filter("_last > _least")
    more = windows.join(least, ["w1", "w2"]).filter("_least < doc_id").groupBy("doc_id", "row").agg(F.collect_set("starts").alias("more"))
    rest = open_.select("doc_id", "row", "text", "gone").join(more, ["doc_id", "row"], "left").select("doc_id", "text", "gone", "more")
    done = state.filter("text IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256", "kept")
    out = written(done.unionByName(rest.mapInArrow(partial(_finish, texts=texts), f"{RESULT}, kept binary")), "substring-result")
    dropped(state, read_again)
    return out


def substring_dedup(docs: DataFrame, batches: int = BATCHES, texts: bool = False, index: FingerprintIndex | None = None) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256, and with ``texts`` the kept words.

    The documents are ingested in ``batches`` ascending ranges of doc_id, cut at quantiles, each against the runs of those before it.
    An ``index`` that is passed holds the runs and the texts of the calls it was passed to before, and this call's after it; so
    deliveries give what one call over all their documents gives, if each has larger doc_ids than those before it.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    keep = index is not None
    index = index or FingerprintIndex(spark)
    cuts = [k / batches for k in range(1, batches)]
    found = slim.agg(F.percentile_approx("doc_id", cuts)).first()[0] if cuts else None
    edges = [None, *sorted(set(found or [])), None]
    parts = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        above = F.lit(True) if lo is None else F.col("doc_id") > lo
        below = F.lit(True) if hi is None else F.col("doc_id") <= hi
        batch = slim.filter(above & below | (F.col("doc_id").isNull() if lo is None else F.lit(False)))
        earlier = None if lo is None else slim.filter(F.col("doc_id") <= lo)
        for texts_before in index.delivered:
            earlier = texts_before if earlier is None else earlier.unionByName(texts_before)
        parts.append(_ingest(batch, earlier, index, texts))
        if len(index.runs) > MOST_RUNS and (keep or hi is not None):
            index.compact()
    if keep:
        index.deliver(slim.filter("doc_id IS NOT NULL"))
    else:
        index.close(delete=True)
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole.withColumn("kept", F.col("kept").cast("string")) if texts else whole.drop("kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(load(spark, sf_dir, "documents"))


SQL = """
WITH texts AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS words FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM texts)),
least AS (SELECT words, min(doc_id) AS doc_id FROM windows GROUP BY words),
hits AS (SELECT w.doc_id, w.i FROM windows w JOIN least l USING (words) WHERE l.doc_id < w.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place FROM hits),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS line, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(line, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)
"""
