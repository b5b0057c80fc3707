import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.llm import quality_classifier as qc
from jobsift.llm.quality_rules import FEATURES, MONOTONE, fit_trees, quality_rules
from jobsift.llm.textstats import Counts, repeat_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_stats(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside)


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "É", "|", "a b c d e ", " ", "\n", "\x0b", "\x85", "#x"]), max_size=60).map("".join))
def test_counts(text):
    c = Counts(text.encode())
    assert (c.n, c.word_chars, c.symbols, c.dup_lines, repeat_words(c.words)) == slow_stats(text)


def test_repeats_with_a_large_vocabulary():
    w = [str(i).encode() for i in range(20_000)] * 2 + [b"z"]
    assert repeat_words(w) == 40_000


def test_rules_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (99, None, 1)], "doc_id long, quality int, toxic int")
    got = quality_rules(odd, labels).collect()
    want = Counter((r.doc_id, *slow_stats(r.text)) for r in odd.collect())
    assert Counter((g.doc_id, *(g[s] for s in STATS)) for g in got) == want
    for g in got:
        assert g.base_failed == (g.n_words < 10 or 100 * g.n_repeat_words > 20 * g.n_words)
        assert g.kept == (not g.base_failed) and g.score is None  # one kind of label: the base rules decide
    assert quality_rules(none, labels).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return docs, labels, {r.doc_id: r.quality for r in labels.collect()}


def test_rules_agree_with_labels_held_out(labelled):
    docs, labels, quality = labelled
    got = quality_rules(docs, labels.where("doc_id % 2 = 0")).collect()
    rest = [(g.kept, quality[g.doc_id], g.base_failed) for g in got if quality.get(g.doc_id) is not None and g.doc_id % 2]
    good, bad = [k for k, q, b in rest if q and not b], [k for k, q, _ in rest if not q]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)
    assert not any(g.kept for g in got if g.base_failed)


def test_trees_keep_their_constraints():
    rng = np.random.default_rng(5)
    x = rng.random((800, 3))
    y = ((x[:, 0] + 0.3 * np.sin(12 * x[:, 0]) + x[:, 2] + 0.3 * rng.random(800)) < 1).astype(float)
    trees = fit_trees(x, y, {0: -1, 2: -1}, rounds=30)
    assert ((trees.score(x) > 0) == (y > 0.5)).mean() > 0.85
    for f in (0, 2):
        line = np.repeat(rng.random((50, 3)), 40, axis=0)
        line[:, f] = np.tile(np.linspace(-0.5, 1.5, 40), 50)
        steps = np.diff(trees.score(line).reshape(50, 40), axis=1)
        assert (steps <= 1e-12).all() and (steps < 0).any()
    # the flat arrays give what walking each tree by hand gives
    def walk(row):
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = (trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right)[node]
            total += trees.value[node]
        return total
    assert np.allclose(trees.score(x[:60]), [walk(r) for r in x[:60]])
    assert set(MONOTONE) <= set(FEATURES)


def test_em_recovers_accuracies():
    """Votes drawn from the model: the labellers' chances and the classes come back."""
    rng = np.random.default_rng(1)
    n, k = 60_000, qc.LABELLERS
    bad = rng.random(n) < 0.2
    defect = np.arange(k) < qc.DEFECTS
    chance = np.array([np.where(defect, rng.uniform(0.005, 0.03, k), rng.uniform(0.8, 0.95, k)),
                       np.where(defect, rng.uniform(0.3, 0.6, k), rng.uniform(0.3, 0.6, k))])
    code = np.zeros(n, np.int64)
    for j in range(k):
        code = 2 * code + (rng.random(n) < np.where(bad, chance[1, j], chance[0, j]))
    patterns, counts = np.unique(code, return_counts=True)
    good, got = qc.estimate(patterns, counts.astype(float))
    assert ((good[code] > 0.5) == ~bad).mean() > 0.97
    assert abs(got - chance).max() < 0.03


def test_classifier_on_labels(labelled):
    docs, _, quality = labelled
    got = {r.doc_id: r for r in qc.classify(docs).collect()}
    assert len(got) == docs.count()
    good = [got[i].kept for i, q in quality.items() if q]
    bad = [got[i].kept for i, q in quality.items() if not q]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_classifier_on_odd_rows(odd, none):
    got = qc.classify(odd).collect()
    assert len(got) == odd.count()
    assert all(g.score == 0 and not g.kept for g in got if g.doc_id in (3, 4, 5))
    assert qc.classify(none).count() == 0


def test_cut_is_taken_over_all_documents(spark, monkeypatch):
    """With a scorer of few documents that scores all low, no other cut splits the weak labels of all better."""
    fit_scorer = qc.fit_scorer

    def low(x, y):
        w = fit_scorer(x, y)
        w[-1] -= 4
        return w

    monkeypatch.setattr(qc, "fit_scorer", low)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = qc.fit(docs, sample=60)
    got = qc.classify(docs, model).toPandas()
    got = got[got.weak_good > 0]
    good = got[got.weak_good > 0.5].score.to_numpy()
    bad = got[got.weak_good <= 0.5].score.to_numpy()
    missed = lambda cut: (good < cut).mean() + (bad >= cut).mean()
    best = min(map(missed, {0.5, *(s for s in got.score if s <= 0.5)}))
    assert 0 < model[2] <= 0.5 and missed(model[2]) <= best + 0.002
    assert (got.kept == (got.score >= model[2])).all()


def test_other_columns_and_copies_change_no_verdict(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = sorted((r.doc_id, r.kept, r.score) for r in qc.classify(docs).collect())
    wide = docs.withColumn("extra", F.lit(7)).withColumn("lang", F.lit("xx"))
    assert sorted((r.doc_id, r.kept, r.score) for r in qc.classify(wide).collect()) == plain
