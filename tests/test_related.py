"""Similar postings against brute force; bookmarks (FIXTURES §3: 13, 16)."""

import datetime as dt

from jobsift import bindings as B
from jobsift import schema as S
from jobsift.operators import bookmarks, related
from tests.conftest import SMOKE, rows

TS = dt.datetime(2024, 5, 1)


def brute_similar(job_codes, pairs, k=2):
    by_cat = {}
    for code, cat in pairs:
        by_cat.setdefault(cat, set()).add(code)
    out = {}
    for code in job_codes:
        peers = set()
        for cat, members in by_cat.items():
            if code in members:
                peers |= members
        peers.discard(code)
        out[code] = sorted(peers)[:k]
    return out


def test_similar_jobs_equals_brute_force(spark):
    t = B.Tables(spark, SMOKE)
    job, jc = t.job, t.job_category
    codes = [r.job_code for r in job.select("job_code").collect()]
    pairs = [(r.job_code, r.job_category) for r in jc.collect()]
    expected = {c: v for c, v in brute_similar(codes, pairs).items() if v}
    got = {}
    for r in related.similar_jobs(job, jc).collect():
        got.setdefault(r.job_code, []).append((r.rank, r.similar_code))
    got = {c: [s for _, s in sorted(v)] for c, v in got.items()}
    assert got == expected


def test_similar_edge_cases(spark):
    job = spark.createDataFrame(
        [(c, f"title {c}", "co", "台北市", None, None, None, None, None, None, None, None, None, "s", TS)
         for c in ["alone", "a", "peer", "z"]], S.JOB)
    jc = spark.createDataFrame([("alone", "solo"), ("a", "x"), ("a", "y"), ("peer", "x"), ("peer", "y")],
                               S.JOB_CATEGORY)
    out = related.similar_jobs(job, jc)
    assert rows(out, "job_code", "similar_code") == [("a", "peer"), ("peer", "a")]


def test_toggle_parity(spark):
    t = spark.createDataFrame(
        [(i, dt.datetime(2024, 5, 1, 0, i), 1, code) for i, code in
         enumerate(["once", "twice", "twice", "thrice", "thrice", "thrice"])],
        "event_id long, ts timestamp_ntz, user_id long, job_code string")
    state = {r.job_code: r.bookmarked for r in bookmarks.bookmark_state(t).collect()}
    assert state == {"once": True, "twice": False, "thrice": True}
    acts = [(r.job_code, r.action) for r in bookmarks.bookmark_actions(t).orderBy("event_id").collect()]
    assert acts == [("once", "add"), ("twice", "add"), ("twice", "remove"),
                    ("thrice", "add"), ("thrice", "remove"), ("thrice", "add")]


def test_actions_across_buckets(spark):
    # the same key over several days: ordinals continue from day to day
    t = spark.createDataFrame(
        [(i, dt.datetime(2024, 5, 1 + i // 3, i % 3), 7, "k") for i in range(8)],
        "event_id long, ts timestamp_ntz, user_id long, job_code string")
    got = [(r.ordinal, r.action) for r in bookmarks.bookmark_actions(t).orderBy("event_id").collect()]
    assert got == [(i + 1, "add" if i % 2 == 0 else "remove") for i in range(8)]


def test_actions_of_a_hot_key_split_over_tasks(spark):
    # one key holds most events; the global sort spreads its run over
    # several partitions, and ordinals still equal a per-key row_number
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    ev = [(i, dt.datetime(2024, 5, 1) + dt.timedelta(seconds=i % 97), 1, "hot") for i in range(3000)]
    ev += [(3000 + i, dt.datetime(2024, 5, 2), 2 + i % 5, f"c{i % 7}") for i in range(300)]
    t = spark.createDataFrame(ev, "event_id long, ts timestamp_ntz, user_id long, job_code string")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # keep the 8 sort partitions of this small input
    try:
        parts = (t.orderBy("user_id", "job_code", "ts", "event_id").where(F.col("job_code") == "hot")
                 .select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts > 1
        w = Window.partitionBy("user_id", "job_code").orderBy("ts", "event_id")
        expect = t.select("event_id", F.row_number().over(w).cast("bigint").alias("ordinal"))
        got = bookmarks.bookmark_actions(t).select("event_id", "ordinal")
        assert rows(got) == rows(expect)
    finally:
        spark.conf.unset(key)


def test_apply_toggles_twice_is_identity(spark):
    marks = spark.createDataFrame([(1, "a"), (1, "b")], S.USER_BOOKMARK)
    tog = spark.createDataFrame([(1, "b"), (1, "c")], "user_id long, job_code string")
    once = bookmarks.apply_toggles(marks, tog)
    assert rows(once) == [(1, "a"), (1, "c")]
    assert rows(bookmarks.apply_toggles(once, tog)) == rows(marks)


def test_user_without_bookmarks_gets_one_row(spark):
    users = spark.createDataFrame([(1, "ann", "a@x.com", "p"), (2, "bob", "b@x.com", "p")], S.USER)
    marks = spark.createDataFrame([(1, f"j{i}") for i in range(7)], S.USER_BOOKMARK)
    job = spark.createDataFrame(
        [(f"j{i}", "t", "co", "l", None, None, None, None, None, None, None, None, None, "s", TS) for i in range(7)],
        S.JOB)
    out = related.user_bookmarks(users, marks, job)
    per_user = {}
    for r in out.collect():
        per_user.setdefault(r.user_id, []).append(r.job_code)
    assert sorted(per_user[1]) == [f"j{i}" for i in range(5)]
    assert per_user[2] == [None]


def test_bookmark_lists_are_whole_and_bounded(spark):
    marks = spark.createDataFrame([(1, f"j{i:04d}") for i in range(950)] + [(2, "a"), (2, "b")], S.USER_BOOKMARK)
    got = related.user_bookmark_list(marks, chunk=100).collect()
    lists = {}
    for r in got:
        assert r.bookmark_list == sorted(r.bookmark_list) and len(r.bookmark_list) < 200
        lists.setdefault(r.user_id, []).extend(r.bookmark_list)
    assert sorted(lists[1]) == [f"j{i:04d}" for i in range(950)] and lists[2] == ["a", "b"]
    assert [r.chunk_no for r in got if r.user_id == 2] == [0]


def test_similar_jobs_salted_equals_broadcast(spark):
    t = B.Tables(spark, SMOKE)
    assert rows(related.similar_jobs(t.job, t.job_category, broadcast_rows=0)) == rows(
        related.similar_jobs(t.job, t.job_category))


def test_view_flags_are_per_user(spark):
    marks = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "user_id long, job_code string")
    views = spark.createDataFrame([(10, 1, "a"), (11, 2, "a"), (12, 1, "b"), (13, 2, "b")],
                                  "event_id long, user_id long, job_code string")
    got = rows(related.view_flags(views, marks), "event_id", "bookmarked")
    assert got == [(10, True), (11, False), (12, False), (13, True)]
