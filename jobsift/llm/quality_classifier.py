"""Quality classifier: a weak-label model whose posteriors train a hashed linear scorer.

1. Overlapping heuristic labellers (``votes``) look at every whole document.
   Each knows one kind of defect, or one mark of prose, and votes bad or good
   when it sees it, else nothing.
2. Vote patterns are counted over all documents (at most 2^10 counters reach
   the driver). Expectation-maximisation of a two-class model, in which
   labellers vote independently given the class, estimates how accurate each
   one is (its chance to vote on good and on bad documents) and the
   share of good documents, and so the posterior of every pattern.
3. Posteriors are the soft labels of a logistic scorer over hashed byte
   trigrams and hashed levels of the statistics, fitted on about ``SAMPLE``
   documents, chosen by a hash of the row, half of them from either class
   as far as there are enough.

A document is kept if its score reaches the cut that best splits the weak
labels of all documents (at most 0.5): every document is scored once for it, and
good and bad ones are counted in ``BINS`` bins of the score's logit.

Defined results: null and wordless texts score 0; repeated rows score
alike; if all documents get one label, the score is their posterior; an empty
table gives an empty result; other columns are not read (the pipeline's stage
passes them on).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import arrow_rows, arrow_schema, quoted
from jobsift.llm.textstats import Counts, hashed_grams

SAMPLE = 4000
DIM, LEVELS, BLOCK = 2048, 256, 256
BINS, EDGE = 4096, 16.0  # bins of the logit from -EDGE to EDGE; what lies beyond is in the outer ones
DEFECTS = 7  # the first labellers vote bad, the others good
CLEAN = re.compile(rb"[\"'(]?[A-Za-z\x80-\xff'-]+[\")']?[.,;:?!]?$")


def measures(c: Counts) -> np.ndarray:
    clean = sum(m is not None for m in map(CLEAN.match, c.words))
    return np.array([c.symbols / max(c.n, 1), c.upper_share(), c.per_word(ord("!")), c.adjacent_share(),
                     c.distinct_share(), clean / max(c.n, 1), c.word_chars / max(c.n, 1),
                     c.per_word(ord("|")), c.per_word(np.frombuffer(b".,;:?!", np.uint8))])


def votes(c: Counts, m: np.ndarray) -> list[int]:
    """One vote per labeller: first those that know a defect, then those that know a mark of prose
    (which a text of under 20 words, too short to show it, is credited with)."""
    symbols, upper, shouts, adjacent, distinct, clean, _, pipes, points = m
    long = c.n >= 20
    return [int(x) for x in (
        symbols > 0.25, pipes > 0.15, upper > 0.5 and long, shouts > 0.3, clean < 0.6 and long,
        adjacent > 0.3 and long, distinct < min(0.25, 25 / c.n ** 0.5) and long if c.n else False,
        distinct > 0.4 and adjacent < 0.1 or not long, 0.002 < upper < 0.2 or not long, 0.01 < points < 0.6 or not long)]


LABELLERS = len(votes(Counts(b""), measures(Counts(b""))))
PROMISE = np.array([[0.01] * DEFECTS + [0.9] * (LABELLERS - DEFECTS), [0.35] * DEFECTS + [0.5] * (LABELLERS - DEFECTS)])
TRUST = 20.0


def pattern_of(raw: bytes | None) -> tuple[int, Counts, np.ndarray]:
    c = Counts(raw)
    m = measures(c)
    code = 0
    for v in votes(c, m):
        code = 2 * code + v
    return (code if c.n else -1), c, m


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """EM: (posterior of good for each of the 2^k patterns, [class, labeller] chance of a vote; class 0 is good).

    The chances start from, and in ``TRUST`` votes stay bound to, what a
    heuristic promises (``PROMISE``): defects are seldom seen on good
    documents, marks of prose often; the votes of the corpus outweigh it.
    """
    fires = lambda p: (p[:, None] >> np.arange(LABELLERS)[::-1] & 1).astype(float)
    d, chance, share = fires(patterns), PROMISE.copy(), np.array([0.85, 0.15])

    def posterior(d):
        log = np.log(share) + d @ np.log(chance).T + (1 - d) @ np.log(1 - chance).T
        p = np.exp(log - log.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    for _ in range(rounds):
        weight = posterior(d) * counts[:, None]
        share = (weight.sum(axis=0) + TRUST * share) / (weight.sum() + TRUST)
        chance = (weight.T @ d + TRUST * PROMISE) / (weight.sum(axis=0)[:, None] + TRUST)
    return posterior(fires(np.arange(2 ** LABELLERS)))[:, 0], chance


def features(raw: bytes, m: np.ndarray) -> np.ndarray:
    """Hashed trigram frequencies (square roots, so of unit length), levels of the measures, a constant."""
    grams = np.sqrt(hashed_grams(raw, DIM))
    grams /= max(np.linalg.norm(grams), 1e-9)
    levels = np.zeros(LEVELS)
    for j, x in enumerate(m):
        step = int(min(15, np.floor(np.log2(1 + 64 * x) * 1.6)))
        levels[(j * 2654435761 + step * 40503) % LEVELS] += 0.5
    return np.concatenate([grams, levels, [1.0]]).astype(np.float32)


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 300, l2: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels, classes weighted alike, accelerated gradient descent."""
    weight = np.where(y > 0.5, 0.5 / max((y > 0.5).sum(), 1), 0.5 / max((y <= 0.5).sum(), 1))
    weight, y, l2 = weight.astype(np.float32), y.astype(np.float32), np.float32(l2)  # so that x is never copied
    w = at = np.zeros(x.shape[1], np.float32)
    step = np.float32(1 / (0.25 * float(np.einsum("ij,ij->i", x, x).max()) + l2))
    for k in range(rounds):
        p = 1 / (1 + np.exp(-(x @ at)))
        nxt = at - step * (x.T @ (weight * (p - y)) + l2 * at)
        w, at = nxt, nxt + np.float32(k / (k + 3)) * (nxt - w)
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w, -60, 60)


def bins_of(logit: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((logit + EDGE) * (BINS / (2 * EDGE))), 0, BINS - 1).astype(np.int64)


def cut_of(good: np.ndarray, bad: np.ndarray) -> float:
    """The score that splits the documents, counted per bin, with the least share of good ones below plus bad ones
    above: the middle of the best gap between bins, at most 0.5."""
    missed = np.concatenate([[0], np.cumsum(good)]) / good.sum() + 1 - np.concatenate([[0], np.cumsum(bad)]) / bad.sum()
    low = high = int(missed.argmin())
    while high < BINS and not good[high] and not bad[high]:
        high += 1
    edges = [1 / (1 + np.exp(EDGE - k * (2 * EDGE / BINS))) for k in (low, high)]
    return float(min(0.5, sum(edges) / 2)) if high else 0.5 / (1 + np.exp(60.0))  # below every score


def fit(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text"):
    """(posterior of each pattern, scorer weights or None, cut) learnt from all documents."""
    body = docs.select(quoted(text_col).cast("string").cast("binary").alias("body"))
    body = body.withColumn("draw", F.pmod(F.xxhash64("body"), F.lit(1 << 40)))

    def patterns(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                code = pattern_of(raw)[0]
                seen[code] = seen.get(code, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                                         names=["pattern", "n"])

    got = body.select("body").mapInArrow(patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n")).orderBy("pattern").collect()
    code = np.array([p for p, _ in got if p >= 0], np.int64)
    count = np.array([n for p, n in got if p >= 0], float)
    if not len(code):
        return np.full(2 ** LABELLERS, 0.5), None, 0.5
    good, _ = estimate(code, count)
    n_good, n_bad = count[good[code] > 0.5].sum(), count[good[code] <= 0.5].sum()
    if not n_good or not n_bad:
        return good, None, 0.5
    # chosen by the text's hash, each text once: reruns agree, no other column counts, copies do not fill the sample
    part = {True: min(1.0, sample / 2 / n_good), False: min(1.0, sample / 2 / n_bad)}

    def chosen(batches):
        def rows():
            for batch in batches:
                for raw, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    p, _, m = pattern_of(raw)
                    if p >= 0 and u < part[bool(good[p] > 0.5)]:
                        yield features(raw, m).tobytes(), float(good[p])
        yield from arrow_rows(rows(), schema, BLOCK)

    schema = arrow_schema("x binary, y double")
    # only rows that either half could take are looked at again
    most = int(max(part.values()) * (1 << 40))
    rows = body.where(F.col("draw") < most).groupBy("draw").agg(F.min("body").alias("body"))
    rows = rows.select("body", (F.col("draw") / float(1 << 40)).alias("u"))
    table = rows.mapInArrow(chosen, "x binary, y double").toArrow()
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(-1, DIM + LEVELS + 1)
    y = table.column("y").to_numpy()
    order = np.lexsort([x[:, 0], x[:, 1], x[:, 2], y])
    x, y = x[order], y[order]
    if not (y > 0.5).any() or (y > 0.5).all():
        return good, None, 0.5
    w = fit_scorer(x, y)
    bad_at, good_at = np.zeros(BINS), np.zeros(BINS)
    for at, is_good, n in body.select("body").mapInArrow(binned(good, w), "bin long, good boolean, n long").groupBy(
            "bin", "good").agg(F.sum("n")).collect():
        (good_at if is_good else bad_at)[at] = n
    return good, w, cut_of(good_at, bad_at)


def binned(good: np.ndarray, w: np.ndarray):
    """mapInArrow: how many good and bad documents (by their votes) have their logit in each bin."""
    def run(batches):
        seen = np.zeros((2, BINS), np.int64)
        for batch in batches:
            texts = batch.column(0)
            for at in range(0, len(texts), BLOCK):
                rows = [(raw, *pattern_of(raw)) for raw in texts.slice(at, BLOCK).to_pylist()]
                rows = [r for r in rows if r[1] >= 0]
                if rows:
                    bins = bins_of(logits(np.stack([features(raw, m) for raw, _, _, m in rows]), w))
                    np.add.at(seen, ((good[[r[1] for r in rows]] > 0.5).astype(int), bins), 1)
        kind, at = seen.nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(kind == 1, pa.bool_()),
                                          pa.array(seen[kind, at], pa.int64())], names=["bin", "good", "n"])

    return run


def judge(model, text: Column) -> Column:
    """struct(weak: the posterior of the votes, score: the scorer's probability of a good document, kept)."""
    good, w, cut = model
    w = None if w is None else w.astype(np.float32)

    @F.pandas_udf("weak double, score double, kept boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(texts), 2))
        for at in range(0, len(texts), BLOCK):
            seen = [(k, raw, *pattern_of(raw)) for k, raw in enumerate(texts[at:at + BLOCK], at)]
            seen = [s for s in seen if s[2] >= 0]
            if not seen:
                continue
            rows = [s[0] for s in seen]
            out[rows] = good[[s[2] for s in seen]][:, None]
            if w is not None:
                x = np.stack([features(raw, m) for _, raw, _, _, m in seen])
                out[rows, 1] = 1 / (1 + np.exp(-logits(x, w)))
        return pd.DataFrame({"weak": out[:, 0], "score": out[:, 1], "kept": out[:, 1] >= cut})

    return run(text.cast("string").cast("binary"))


def classify(docs: DataFrame, model=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, weak_good, score, kept."""
    model = model or fit(docs, text_col=text_col)
    got = docs.select(quoted(id_col).cast("long").alias("doc_id"), judge(model, quoted(text_col)).alias("j"))
    return got.select("doc_id", F.col("j.weak").alias("weak_good"), F.col("j.score").alias("score"),
                      F.col("j.kept").alias("kept"))


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
