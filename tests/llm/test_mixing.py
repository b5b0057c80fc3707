import re
from collections import defaultdict

from tests.conftest import rows as sorted_rows

from jobsift.llm.mixing import mix, numbered

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes):
    """Water filling, straight from the rule."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in order}
        capped |= set(over)


def check(df, got, near=0.02):
    size_of, per = [], defaultdict(int)
    for r in df.collect():
        n = len(WORD.findall(r.text or ""))
        size_of.append((r.doc_id, n))
        per[r.source] += n
    want = targets(per)
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((g.doc_id, g.size) for g in got), key=key) == sorted(size_of, key=key)
    taken, largest = defaultdict(int), defaultdict(int)
    for g in got:
        assert g.source_size == per[g.source] and abs(g.target - want[g.source]) < 1e-6 * max(1, want[g.source])
        assert g.taken == g.copies * g.size and 0 <= g.taken <= 3 * g.size
        ratio = want[g.source] / per[g.source] if per[g.source] else 0
        assert int(ratio + 1e-9) <= g.copies <= -int(-ratio // 1) if per[g.source] else g.copies == 0
        taken[g.source] += g.taken
        largest[g.source] = max(largest[g.source], g.size)
    for s in per:
        assert abs(taken[s] - want[s]) <= max(largest[s] if near is None else 0, (near or 0) * want[s])


def test_odd_rows(odd, none):
    check(odd, mix(odd).collect(), near=None)
    assert mix(none).count() == 0


def test_documents_and_reruns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(docs, mix(docs).collect(), near=None)
    assert sorted_rows(mix(docs)) == sorted_rows(mix(docs.repartition(7)))


def test_three_levels_hot_source_and_copies(spark):
    """9,000 documents in one source (levels of 64), many identical rows, and a source whose target is capped."""
    rows = [(i, "w " * (1 + i * i % 97), "en", "a") for i in range(9000)] + [(1, "x y z", "en", "a")] * 700
    rows += [(i, "v " * (i % 50), "en", "b") for i in range(1200)] + [(20_000, "one two", "en", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    got = mix(df).collect()
    check(df, [g for g in got], near=0.01)


def test_native(odd):
    plan = mix(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert plan.count("SinglePartition") == 0


def test_copies_are_fair(spark):
    """Over many seeds (ids), a document is taken as often as its ratio says."""
    rows = [(i, "w " * (1 + i % 9), "en", s) for i in range(6000) for s in ("a", "b")]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    for s, ratio in (("a", 2 / 3), ("b", 4 / 3)):
        for n in range(1, 10):
            copies = [g.copies for g in got if g.source == s and g.size == n]
            assert abs(sum(copies) / len(copies) - ratio) < 0.06


def test_sources_of_mostly_wordless_rows(spark):
    """Documents with words are few among many without: each of them is in the result, with its copies."""
    rows = [(k * 2000 + i, None if i % 2 else " ", "en", f"s{k}") for k in range(6) for i in range(1000)]
    rows += [(k * 2000 + 1000 + i, "w " * (3 + 4 * i), "en", f"s{k}") for k in range(6) for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    check(df, mix(df).collect(), near=None)


def test_a_third_of_all_rows_alike(spark, monkeypatch):
    rows = [(1, "one row of five words", "a")] * 700 + [(2, None, "a")] * 100 + [(i, "some words " * (i % 9), "abc"[i % 3]) for i in range(1300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    whole = sorted_rows(mix(df), "doc_id", "copies", "taken", "size")
    monkeypatch.setattr("jobsift.llm.mixing.COPIES", 64)  # runs of copies dealt to tasks: the same names, so the same mix
    assert sorted_rows(mix(df), "doc_id", "copies", "taken", "size") == whole
    check(df, mix(df).collect())


def test_numbers_of_copies(spark, monkeypatch):
    monkeypatch.setattr("jobsift.llm.mixing.COPIES", 4)
    df = spark.createDataFrame([(i, i, n) for i, n in enumerate([1, 3, 4, 5, 8, 9, 30])], "row_hash long, doc_id long, n long")
    got = numbered(df)
    assert sorted_rows(got, "doc_id", "no") == [(i, k) for i, n in enumerate([1, 3, 4, 5, 8, 9, 30]) for k in range(1, n + 1)]
    assert numbered(df.limit(0)).count() == 0
