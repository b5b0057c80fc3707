"""Quality rules: gradient-boosted trees over document statistics.

The base rules (too few words, too many repeated ones) fail a document. The
verdict on the others is a boosted tree ensemble over ratios of the
statistics, fitted to the quality labels. It may only fall as symbols, repeated words, repeated lines, upper case
or exclamation marks rise (``MONOTONE``): splits that break this are refused,
and children are bounded by the middle of their parent's two values. The trees are flattened
into numpy node arrays; all rows of a batch walk them together.

Fitted on at most about ``SAMPLE`` labelled documents, chosen by a hash of
their id; every document is scored.

Defined results: null text has no words and fails; a labelled id that has no
document, or null labels, teach nothing; without labels of both kinds the base
rules alone decide (score null); repeated rows are scored alike; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import arrow_schema, quoted
from jobsift.llm.textstats import Counts, repeat_words

SAMPLE = 8000
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeat_words", "upper", "exclamations", "distinct")
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeat_words": -1, "upper": -1, "exclamations": -1}
STATS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


@dataclass
class Trees:
    """All trees' nodes in flat arrays; a leaf's children are itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[at]] <= self.threshold[at]
                at = np.where(low, self.left[at], self.right[at])
            total += self.value[at]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], rounds: int = 40, depth: int = 3,
              rate: float = 0.3, bins: int = 32, l2: float = 1.0, least: float = 1.0) -> Trees:
    """Histogram gradient boosting of the logistic loss under monotonic constraints."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    margin = np.full(len(y), base := float(np.log(share / (1 - share))))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        k = len(value)
        for column, what in ((feature, 0), (threshold, np.inf), (left, k), (right, k), (value, v)):
            column.append(what)
        return k

    def split(rows, g, h):
        """Best (gain, feature, bin, left value, right value) that keeps the constraints."""
        best = None
        for f, e in enumerate(edges):
            if not len(e):
                continue
            gl = np.cumsum(np.bincount(binned[f][rows], g[rows], len(e) + 1))[:-1]
            hl = np.cumsum(np.bincount(binned[f][rows], h[rows], len(e) + 1))[:-1]
            gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
            yield_l, yield_r = np.clip(-gl / (hl + l2), low, high), np.clip(-gr / (hr + l2), low, high)
            gain = -(gl * yield_l + (hl + l2) * yield_l ** 2 / 2) - (gr * yield_r + (hr + l2) * yield_r ** 2 / 2)
            bad = (hl < least) | (hr < least) | (monotone.get(f, 0) * (yield_r - yield_l) < 0)
            gain[bad] = -np.inf
            k = int(gain.argmax())
            if gain[k] > -np.inf and (best is None or gain[k] > best[0]):
                best = gain[k], f, k, yield_l[k], yield_r[k]
        return best

    def grow(rows, g, h, to, lo, hi) -> int:
        nonlocal low, high
        low, high = lo, hi
        gs, hs = g[rows].sum(), h[rows].sum()
        own = float(np.clip(-gs / (hs + l2), lo, hi))
        best = split(rows, g, h) if to else None
        if best is None or best[0] <= -(gs * own + (hs + l2) * own ** 2 / 2) + 1e-6:
            margin[rows] += rate * own
            return leaf(rate * own)
        _, f, k, vl, vr = best
        node, mid, sign = leaf(0.0), (vl + vr) / 2, monotone.get(f, 0)
        first, second = ((lo, mid), (mid, hi)) if sign > 0 else ((mid, hi), (lo, mid)) if sign < 0 else ((lo, hi),) * 2
        feature[node], threshold[node] = f, edges[f][k]
        under = binned[f][rows] <= k
        left[node] = grow(rows[under], g, h, to - 1, *first)
        right[node] = grow(rows[~under], g, h, to - 1, *second)
        return node

    low, high = -np.inf, np.inf
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-9), depth, -np.inf, np.inf))
    return Trees(*(np.array(c) for c in (roots, feature, threshold, left, right, value)), depth, base)


def stats_of(raw: bytes | None) -> tuple[tuple[int, ...], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the features of the trees."""
    c = Counts(raw)
    again = repeat_words(c.words)
    n = max(c.n, 1)
    return ((c.n, c.word_chars, c.symbols, c.dup_lines, again),
            [float(np.log1p(c.n)), c.word_chars / n, c.symbols / n, c.dup_lines / max(len(c.lines), 1), again / n,
             c.upper_share(), c.per_word(ord("!")), c.distinct_share()])


def labelled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most about ``sample`` labelled documents."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("y"))
    n = known.count()
    part = min(1.0, sample / max(n, 1))
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    rows = docs.join(F.broadcast(some), "doc_id")  # bounded by the sample

    def run(batches):
        for batch in batches:
            x = [stats_of(t)[1] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    got = rows.select("body", F.col("y").cast("double").alias("y")).mapInArrow(run, "x array<double>, y double").toArrow()
    x = np.array(got.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = got.column("y").to_numpy()
    order = np.lexsort([*x.T, y])  # the same fit whatever order the tasks end in
    return x[order], y[order]


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the statistics, base_failed, kept and the trees' score."""
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"),
                       quoted(text_col).cast("string").cast("binary").alias("body"))
    x, y = labelled(rows, labels, sample)
    monotone = {FEATURES.index(k): v for k, v in MONOTONE.items()}
    trees = fit_trees(x, y, monotone) if 0 < y.sum() < len(y) else None
    columns = STATS + ", score double"
    schema = arrow_schema(columns)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            counts, features = zip(*(stats_of(t) for t in batch.column(1).to_pylist()))
            score = [None] * len(counts) if trees is None else 1 / (1 + np.exp(-trees.score(np.array(features))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*counts)), pa.array(score, pa.float64())],
                schema=schema)

    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (rows.mapInArrow(run, columns).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(1.0)) >= 0.5))
            .select(*[c.split()[0] for c in STATS.split(", ")], "base_failed", "kept", "score"))


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
