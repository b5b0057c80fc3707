import hashlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobsift.llm.exact_dedup import RadixTrie, exact_dedup, merger

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, largest):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(ASCII)].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        seen = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            kept, seen = i == keep and not seen, seen or i == keep
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))


def result(df):
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_odd_rows_equal_brute_force(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert result(exact_dedup(odd, keep="largest")) == expected(rows, True)
    assert result(exact_dedup(odd)) == expected(rows, False)


def test_empty_table(none):
    assert exact_dedup(none).count() == 0


def test_colliding_hashes_and_spilled_subtrees(spark, odd):
    rows = [(i, f"{'x' * (i % 7)}{i % 50} text") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup(df, keep="largest", budget=3000, content_hash=lambda b: len(b) % 2)
    assert result(got) == expected(rows, True)


def test_a_third_of_all_rows_alike(spark):
    alike = [(7, "the same Row"), (None, None), (9, "THE SAME ROW")]
    rows = [(7, "the same Row")] * 3000 + [(None, None)] * 500 + [(9, "THE SAME ROW")] * 63 + [(i, f"t{i % 900}") for i in range(3000)]
    rows = [r for i in range(16) for r in rows[i::16]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    held = spark.createDataFrame(alike * 100, "doc_id long, text string").coalesce(1)
    assert result(exact_dedup(df, keep="largest")) == expected(rows, True)
    assert result(exact_dedup(df)) == expected(rows, False)
    assert result(exact_dedup(held)) == expected(alike * 100, False)


def test_rows_alike_are_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 64_000, 1, 32).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
        per_task = exact_dedup(df).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept"))
        got = per_task.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in got) == 64_000 and sum(r.kept for r in got) == 1
    assert max(r.n for r in got) < 32_000


def test_only_ascii_letters_are_folded(spark):
    rows = [(1, "ÉTÉ"), (2, "été"), (3, "Été"), (4, "ÉTé"), (5, "ÉtÉ")]
    got = {r.doc_id: r.keep_id for r in exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3, 5: 1}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6)), st.integers(0, 2000))
def test_trie_equals_a_dict(keys, budget):
    trie, merge, got = RadixTrie(), merger("smallest"), {}
    for i, k in enumerate(keys):
        trie.add(k, [i, 0, 1, 1 << i % 64, None], merge)
        if sum(trie.held.values()) > budget:
            for key, v in trie.spill(budget // 2):
                got[key] = merge(got[key], v) if key in got else v
    for key, v in trie.spill():
        got[key] = merge(got[key], v) if key in got else v
    assert {k: (v[0], v[2]) for k, v in got.items()} == {k: (keys.index(k), keys.count(k)) for k in keys}
    assert not trie.held
