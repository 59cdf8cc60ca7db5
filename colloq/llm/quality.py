"""Quality classifier: a sparse ensemble of rules over statistics of the text.

1. Statistics are Spark column expressions on the whole text (``STATISTICS``).
2. Small regression trees are boosted on the statistics of a bounded sample of labelled rows; each path from a root
   to a node is a candidate rule, a conjunction of thresholds.
3. Logistic weights with a lasso penalty are fitted to the rules; most become zero.
4. What is left is compiled into one Spark column expression, so scoring is a projection of the scan.

The sample: at most ``SAMPLE`` labelled documents, those with the least hash of their doc_id; labels come only from
rows whose crc32(doc_id as text) mod 4 is not 2. Scores see nothing but the text.

Defined results: a null text is the empty text, which is scored like any other; rows that repeat and rows with a null
doc_id are scored alike (a null doc_id is not held out); null labels are ignored, and a document with several
labels has the largest. Without any label every document scores 1, so nothing is rejected; with labels of
one kind every document has that kind's smoothed rate. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, own, trim

SAMPLE = 20_000
THRESHOLD = 0.7

_WORD = r"\S+"


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text by name."""
    words = F.split(F.trim(text), r"\s+")
    lines = F.split(text, "\n")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    count = lambda p: F.regexp_count(text, F.lit(p)).cast("double")
    return {
        "chars": F.length(text).cast("double"),
        "words": F.size(words).cast("double"),
        "word_length": chars / n,
        "upper": count("[A-Z]") / chars,
        "digits": count("[0-9]") / chars,
        "marks": count(r"[.,;:?]") / n,
        "symbols": count(r"[#$%&*|^~<>{}=_@!\[\]\\+/-]") / chars,
        "glued": count(r"[\w.,][^\s\w.,;:?'\")-]{2,}") / n,
        "lines": F.size(lines) / n,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        "distinct_words": F.size(F.array_distinct(words)) / n,
        "long_words": count(r"\S{16,}") / n,
        "sentences": count(r"[.!?](\s|$)") / n,
        "capitals": count(r"(^|\s)[A-ZÀ-ÖØ-Þ]") / n,
        "short_words": count(r"(^|\s)\S{1,3}(?=\s|$)") / n,
    }


# --- Rules -----------------------------------------------------------------------------------------------------


@dataclass
class Rules:
    """Score = sigmoid(bias + sum of weights of the rules that hold). A rule is ((name, above, threshold), ...)."""

    bias: float
    weights: list[float] = field(default_factory=list)
    rules: list[tuple] = field(default_factory=list)

    def expression(self) -> str:
        terms = [repr(float(self.bias))]
        for w, rule in zip(self.weights, self.rules, strict=True):
            holds = " AND ".join(f"{name} {'>' if above else '<='} {t!r}D" for name, above, t in rule)
            terms.append(f"IF({holds}, {float(w)!r}D, 0D)")
        while len(terms) > 1:  # a balanced sum: generated code may not nest deeply
            terms = [f"({' + '.join(terms[k : k + 2])})" for k in range(0, len(terms), 2)]
        return f"1D / (1D + exp(-{terms[0]}))"


def _tree(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, rows: np.ndarray, columns: np.ndarray, depth: int, path: tuple, out: list, least: int):
    """Paths of a tree that splits squared error; ``x`` holds bin numbers."""
    if depth == 0 or len(rows) < 2 * least:
        return
    best = (1e-9, None)
    total, n = g[rows].sum(), len(rows)
    for c in columns:
        bins = len(cuts[c]) + 1
        if bins < 2:
            continue
        s = np.bincount(x[rows, c], g[rows], bins).cumsum()[:-1]
        k = np.bincount(x[rows, c], minlength=bins).cumsum()[:-1]
        ok = (k >= least) & (n - k >= least)
        if ok.any():
            gain = np.where(ok, s**2 / np.maximum(k, 1) + (total - s) ** 2 / np.maximum(n - k, 1) - total**2 / n, 0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], (c, at))
    if best[1] is None:
        return
    c, at = best[1]
    for above in (False, True):
        part = rows[(x[rows, c] > at) == above]
        rule = (*path, (c, above, float(cuts[c][at])))
        out.append((rule, part))
        _tree(x, cuts, g, part, columns, depth - 1, rule, out, least)


def _candidates(values: np.ndarray, y: np.ndarray, trees: int, depth: int, seed: int) -> list[tuple]:
    rng = np.random.RandomState(seed)
    n, d = values.shape
    cuts = [np.unique(np.quantile(values[:, c], np.linspace(0, 1, 66)[1:-1])) for c in range(d)]
    x = np.stack([np.searchsorted(cuts[c], values[:, c], side="left") for c in range(d)], axis=1)
    raw = np.zeros(n)
    found: dict[tuple, None] = {}
    for _ in range(trees):
        g = y - 1 / (1 + np.exp(-raw))
        rows = np.flatnonzero(rng.rand(n) < 0.7)
        columns = rng.permutation(d)[: max(3, d // 2)]
        out: list = []
        _tree(x, cuts, g, rows, columns, depth, (), out, max(5, n // 500))
        ends = {rule for rule, _ in out} - {rule[:-1] for rule, _ in out}
        for rule, part in out:
            found[rule] = None
            if rule in ends and len(part):
                hold = np.ones(n, bool)
                for c, above, t in rule:
                    hold &= (values[:, c] > t) == above
                raw[hold] += 0.5 * 4 * g[part].mean()
    return list(found)


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty on all but the bias, by accelerated proximal gradients."""
    n, k = r.shape
    rate = r.mean(axis=0)
    scale = np.concatenate([[1.0], np.sqrt(np.maximum(rate * (1 - rate), 1e-3))])
    blocks = [slice(a, a + 2048) for a in range(0, n, 2048)]

    def times(w: np.ndarray) -> np.ndarray:
        u = (w / scale).astype("float32")
        return np.concatenate([u[0] + r[b].astype("float32") @ u[1:] for b in blocks])

    def back(x: np.ndarray) -> np.ndarray:
        x = x.astype("float32")
        return np.concatenate([[x.sum()], sum(x[b] @ r[b].astype("float32") for b in blocks)]) / scale

    v = np.ones(k + 1)
    for _ in range(20):
        v = back(times(v))
        v /= np.linalg.norm(v)
    step = 4 * n / float(np.linalg.norm(times(v)) ** 2) * 0.95
    w, m, t = np.zeros(k + 1), np.zeros(k + 1), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-times(m).astype("float64")))
        new = m - step * back(p - y) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, m, t = new, new + (t - 1) / t2 * (new - w), t2
    return float(w[0]), w[1:] / scale[1:]


def fit(values: np.ndarray, y: np.ndarray, names: list[str], trees: int = 60, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> Rules:
    if not len(y):
        return Rules(40.0)
    if y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Rules(float(np.log(rate / (1 - rate))))
    found = _candidates(values, y, trees, depth, seed)
    held: dict[bytes, tuple] = {}  # rules that hold for the same rows are one
    for rule in found:
        hold = np.ones(len(y), bool)
        for c, above, t in rule:
            hold &= (values[:, c] > t) == above
        held.setdefault(np.packbits(hold).tobytes(), rule)
    found = list(held.values())
    holds = np.empty((len(y), len(held)), "u1")
    for k, b in enumerate(held):
        holds[:, k] = np.unpackbits(np.frombuffer(b, "u1"), count=len(y))
    bias, w = _lasso(holds, y, penalty)
    keep = np.flatnonzero(np.abs(w) > 1e-3)
    return Rules(bias, [float(w[k]) for k in keep], [tuple((names[c], a, t) for c, a, t in found[k]) for k in keep])


# --- Training and scoring ----------------------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _fit_rows(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The rules of the sample, as one row of JSON."""
    table = pa.Table.from_batches(list(batches))
    if table.num_rows:
        table = table.sort_by("_id")
        values = np.column_stack([table[k].to_numpy() for k in names])
        rules = fit(values, table["_y"].to_numpy().astype("float64"), names)
        yield pa.RecordBatch.from_pydict({"rules": [json.dumps([rules.bias, rules.weights, rules.rules])]})


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> Rules:
    """Fit to a sample of at most ``sample`` labelled documents, in one task; the driver gets the rules alone."""
    trim(docs.sparkSession)
    doc_id = F.col("doc_id").cast("bigint")
    known = labels.select(doc_id.alias("_id"), F.col(target).cast("int").alias("_y")).dropna()
    known = known.filter(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("_y").alias("_y"))
    # At most `sample` rows of two numbers: small enough to be sent to every task.
    drawn = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    stats = statistics(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(doc_id.alias("_id"), "text").join(F.broadcast(drawn), "_id")
    rows = rows.select("_id", "_y", *[c.alias(k) for k, c in stats.items()])
    # A doc_id that repeats counts once; the bound holds for documents whatever the tables hold.
    table = rows.groupBy("_id", "_y").agg(*[F.max(k).alias(k) for k in stats])
    found = table.repartition(1).mapInArrow(partial(_fit_rows, names=list(stats)), "rules string").first()
    if found is None:  # no label at all
        return Rules(40.0)
    bias, weights, rules = json.loads(found[0])
    return Rules(bias, weights, [tuple(tuple(x) for x in rule) for rule in rules])


def scored(docs: DataFrame, rules: Rules) -> DataFrame:
    """(row: all columns of ``docs``, score): rows are packed, so no column can clash."""
    packed = docs.select(F.struct(*own(docs)).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    stats = statistics(F.col("text"))
    used = {name for rule in rules.rules for name, _, _ in rule}
    measured = packed.select("row", *[c.alias(k) for k, c in stats.items() if k in used])
    return measured.select("row", F.expr(rules.expression()).alias("score"))


def keep_good(docs: DataFrame, rules: Rules, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold.

    The condition on a row number, always true, keeps the optimizer from pushing the filter below the statistics: there
    it would write each of them out again wherever a rule names it.
    """
    good = F.when(F.monotonically_increasing_id() >= 0, F.col("score")).alias("score")
    return scored(docs, rules).select("row", good).filter(F.col("score") >= threshold).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    found = scored(docs.select("doc_id", "text"), train(docs, labels))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
