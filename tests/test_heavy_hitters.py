"""Top terms by per-task summaries: bounds of the summaries, and equality with the full count."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from jobsift.operators import heavy_hitters as H
from jobsift.operators import terms


def _summary(lists, slots):
    batches = [pa.RecordBatch.from_arrays([pa.array(b, pa.list_(pa.string()))], names=["items"]) for b in lists]
    out = [r for batch in H.summarise(slots)(iter(batches)) for r in batch.to_pylist()]
    return {r["item"]: r["low"] for r in out if r["item"] is not None}, sum(r["error"] for r in out)


@pytest.mark.parametrize("slots", [1, 3, 10, 1000])
def test_counters_bound_the_true_counts(slots):
    rnd = random.Random(slots)
    words = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(3000)]
    lists = [[words[i:i + 7] for i in range(a, a + 500, 7)] for a in range(0, 3000, 500)]
    true = Counter(w for batch in lists for words in batch for w in words)
    low, error = _summary(lists, slots)
    assert len(low) <= slots and error <= sum(true.values()) / (slots + 1)
    assert all(low.get(w, 0) <= n <= low.get(w, 0) + error for w, n in true.items())


def test_empty_and_null_lists():
    assert _summary([], 5) == ({}, 0)
    assert _summary([[[], None, [None]]], 5) == ({}, 0)
    assert _summary([[["a"], [], ["a", None]]], 5) == ({"a": 2}, 0)


def _texts(spark):
    rnd = random.Random(3)
    hot = ["Apis api apis spark's Spark SPARK"] * 400  # a third of the texts are alike
    tail = [" ".join(f"{rnd.choice('abcxyz')}{int(rnd.paretovariate(0.6))}q" for _ in range(12)) for _ in range(800)]
    rest = [None, "", "12 34", "the of and", "資料 工程師 資料"]
    return spark.createDataFrame([(t,) for t in hot + tail + rest], "text string").repartition(7)


@pytest.mark.parametrize("k, slots, limit", [
    (5, 200, 1000),    # proven by the summaries, most words in none of them at the end
    (5, 1 << 16, 1000),  # summaries without error
    (50, 4, 1000),     # no proof: the full count
    (5, 200, 1),       # too many candidates to broadcast: the full count
    (100_000, 1 << 16, 100_000),  # fewer terms than asked for
])
def test_equals_the_full_count(spark, k, slots, limit):
    texts = _texts(spark)
    want = [tuple(r) for r in terms.top_terms(texts, k=k).collect()]
    assert [tuple(r) for r in H.top_terms(texts, k=k, slots=slots, broadcast_rows=limit).collect()] == want


def test_proof_is_found_or_refused(spark):
    lists = spark.createDataFrame([(["a"] * 60 + [f"x{i}"],) for i in range(50)], "items array<string>").repartition(3)
    assert "a" in {r.item for r in H.candidates(lists, 1, 8).collect()}
    assert H.candidates(lists, 30, 8) is None


def test_ties_at_the_last_rank_are_all_candidates(spark):
    lists = spark.createDataFrame([([w] * 20,) for w in "abcdef"] + [([f"r{i}"],) for i in range(40)], "items array<string>").repartition(4)
    found = H.candidates(lists, 3, 30)
    assert found is not None and {r.item for r in found.collect()} >= set("abcdef")


def test_no_texts(spark):
    none = spark.createDataFrame([], "text string")
    assert H.top_terms(none).collect() == []
    assert H.top_terms(spark.createDataFrame([(None,), ("",)], "text string")).collect() == []


def test_no_shuffle_of_the_vocabulary(spark):
    plan = H.top_terms(_texts(spark), k=5, slots=200)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
