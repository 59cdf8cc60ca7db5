"""Best-fit packing of documents into sequences, improved by swap-based local search.

Documents are tokenized where they are read and leave one small row a piece. Pieces are dealt by hash into
groups of about ``group_size``; each group is packed by itself: best fit, longest first, then a local
search that moves or exchanges pieces between bins that are not full (one, one for one, two for one, one for
two), each step from an emptier to a fuller bin, so that the sum of squared fills grows and bins empty.
The number of groups grows with the data, so no task grows; a group wastes at most a fraction of its last bins.

Defined results: a null text is the empty text, whose only id is the end id; a null doc_id is carried along;
rows that repeat are packed like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, written
from .tokens import token_bytes, tokenizer_path

LENGTH = 4096
END_ID = 1
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, length: int, end_id: int) -> Iterator[pa.RecordBatch]:
    end = end_id.to_bytes(4, "little")
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids = token_bytes(text.as_buffer().to_pybytes() if text.is_valid else b"", path) + end
            for k, at in enumerate(range(0, len(ids), 4 * length)):
                part = ids[at : at + 4 * length]
                rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def tokenized_pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    return slim.mapInArrow(partial(_pieces, path=path, length=length, end_id=end_id), PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that still takes it."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    mask = 0  # bit r is set if a bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        if r > n:
            room[r - n].append(b)
            mask |= 1 << (r - n)
    return bins


def _step(low: list[int], high: list[int], lengths: list[int], spare: int) -> tuple[list[int], list[int]] | None:
    """Items to take from ``low`` and from ``high`` so that ``high`` gains most and at most ``spare``."""
    best, found = 0, None
    out_of = [(lengths[i], [i]) for i in low]
    out_of += [(lengths[a] + lengths[b], [a, b]) for k, a in enumerate(low) for b in low[k + 1 :]]
    back = [(0, [])] + [(lengths[i], [i]) for i in high]
    pairs = [(lengths[a] + lengths[b], [a, b]) for k, a in enumerate(high) for b in high[k + 1 :]]
    for n, give in out_of:
        for m, take in back + pairs if len(give) == 1 else back:
            if best < n - m <= spare:
                best, found = n - m, (give, take)
                if best == spare:
                    return found
    return found


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, tries: int = 64, wide: int = 24) -> list[list[int]]:
    """Empty bins, emptiest first, by steps that raise the sum of squared fills, until the bound or no step is left.

    ``tries``: bins in a row that may stay before it ends. Bins of more than ``wide`` pieces only join in
    with their ``wide`` longest ones.
    """
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    alive = len(bins) - bins.count([])
    order = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: fill[b])
    failed = 0
    for target in order:
        if alive <= least or failed >= tries:
            break
        moved = True
        while bins[target] and moved:
            moved = False
            others = sorted((b for b in order if b != target and fill[target] <= fill[b] < capacity), key=lambda b: -fill[b])
            for b in others:
                top = lambda x: sorted(bins[x], key=lambda i: -lengths[i])[:wide]
                step = _step(top(target), top(b), lengths, capacity - fill[b])
                if not step:
                    continue
                give, take = step
                bins[target] = [i for i in bins[target] if i not in give] + take
                bins[b] = [i for i in bins[b] if i not in take] + give
                gain = sum(lengths[i] for i in give) - sum(lengths[i] for i in take)
                fill[target] -= gain
                fill[b] += gain
                moved = True
                if not bins[target]:
                    break
        if bins[target]:
            failed += 1
        else:
            alive, failed = alive - 1, 0
    return [b for b in bins if b]


def _pack(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
    lengths = pdf["length"].astype(int).tolist()
    bins = local_search(best_fit(lengths, capacity), lengths, capacity)
    sequence, offset = np.zeros(len(pdf), "int64"), np.zeros(len(pdf), "int64")
    for k, b in enumerate(bins):
        at = 0
        for i in b:
            sequence[i], offset[i] = k, at
            at += lengths[i]
    group = int(pdf["_group"].iloc[0]) if len(pdf) else 0
    return pdf.drop(columns="_group").assign(sequence_id=sequence + (group << 32), offset=offset)


def pack(pieces: DataFrame, length: int = LENGTH, group_size: int = 32768) -> DataFrame:
    """Give every piece (``PIECES``, a written table) a sequence_id and its offset there.

    Pieces are dealt by a hash of themselves and of their place in the table, so rows that repeat do not meet in one group.
    """
    groups = max(1, -(-pieces.count() // group_size))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(partial(_pack, capacity=length), f"{PIECES}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(written(tokenized_pieces(docs, path or tokenizer_path(), length, end_id), "pieces"), length)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(load(spark, sf_dir, "documents"))
