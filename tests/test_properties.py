"""Property checks on generated inputs."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobsift import schema as S
from jobsift.functions.numeric import rounded_ratio
from jobsift.operators import bookmarks, market, sync
from tests.conftest import rows

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
TS = dt.datetime(2024, 5, 1)


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**6)), min_size=1, max_size=30))
def test_rounded_ratio_is_exact_half_away(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(rounded_ratio(df.n, df.d)).collect()]
    want = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP)) for n, d in pairs]
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from(S.EDU_PREFIXES + ["其他", None]), min_size=1, max_size=40))
def test_edu_shares_sum_to_one(spark, edus):
    data = [(str(i), "t", "c", "台北市", "月薪", 1, 1, e, None, None, None, None, None, "s", TS)
            for i, e in enumerate(edus)]
    out = market.edu_distribution(spark.createDataFrame(data, S.JOB)).collect()
    if out:
        assert abs(sum(r.share for r in out) - 1.0) < 1e-9
        assert sum(r["count"] for r in out) == sum(1 for e in edus if e in S.EDU_PREFIXES)


codes = st.sampled_from([f"c{i}" for i in range(12)])
sources = st.sampled_from(["https://www.board-a.example/job/", "https://www.board-b.example/job-"])


@SETTINGS
@given(st.lists(st.tuples(codes, sources), max_size=12, unique_by=lambda x: x[0]),
       st.lists(codes, max_size=8, unique=True))
def test_sync_idempotent_and_scoped(spark, stored_rows, batch_codes):
    def job(code, src, ts):
        return (code, "t", "co", "l", None, None, None, None, None, None, None, None, None, src + code, ts)

    stored = spark.createDataFrame([job(c, s, TS) for c, s in stored_rows], S.JOB)
    batch = spark.createDataFrame([job(c, "https://www.board-a.example/job/", TS + dt.timedelta(days=1))
                                   for c in batch_codes], S.JOB)
    once = sync.sync_jobs(stored, batch, "www.board-a")
    assert rows(sync.sync_jobs(once, batch, "www.board-a")) == rows(once)
    codes_after = {r.job_code for r in once.collect()}
    # every batch code is present; a board-b row survives unless the batch took its code
    assert set(batch_codes) <= codes_after
    for c, s in stored_rows:
        if "board-b" in s and c not in batch_codes:
            assert c in codes_after
        if "board-a" in s and c not in batch_codes:
            assert c not in codes_after


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), codes), max_size=25))
def test_toggling_twice_is_identity(spark, toggles):
    marks = spark.createDataFrame([(1, "c0"), (2, "c1")], S.USER_BOOKMARK)
    tog = spark.createDataFrame(toggles, "user_id long, job_code string") if toggles else \
        spark.createDataFrame([], "user_id long, job_code string")
    twice = bookmarks.apply_toggles(bookmarks.apply_toggles(marks, tog), tog)
    assert rows(twice) == rows(marks)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 3), codes, st.integers(0, 10_000)), min_size=1, max_size=30,
                unique_by=lambda x: x[2]))
def test_action_parity_matches_state(spark, events):
    df = spark.createDataFrame(
        [(i, TS + dt.timedelta(minutes=m), u, c) for i, (u, c, m) in enumerate(events)],
        "event_id long, ts timestamp_ntz, user_id long, job_code string")
    last = (bookmarks.bookmark_actions(df)
            .groupBy("user_id", "job_code").agg(F.max_by("action", "ordinal").alias("last")))
    state = bookmarks.bookmark_state(df)
    joined = last.join(state, ["user_id", "job_code"]).collect()
    assert all((r["last"] == "add") == r.bookmarked for r in joined)


CODES = [f"c{i:02d}" for i in range(25)]


@SETTINGS
@given(st.sets(st.sampled_from(CODES[:20]), min_size=1),
       st.lists(st.tuples(st.sampled_from(CODES), st.sampled_from(["hot", "hot", "hot", "a", "b", "c"])),
                max_size=60))
def test_similar_jobs_equal_brute_force(spark, present, pairs):
    from jobsift.operators import related
    # a hot category, duplicate pairs, and bridge codes with no posting
    job = spark.createDataFrame(
        [(c, "t", "co", "l", None, None, None, None, None, None, None, None, None, "s", TS) for c in sorted(present)],
        S.JOB)
    jc = spark.createDataFrame(pairs, S.JOB_CATEGORY) if pairs else spark.createDataFrame([], S.JOB_CATEGORY)
    members = {}
    for code, cat in pairs:
        if code in present:
            members.setdefault(cat, set()).add(code)
    want = []
    for code in sorted(present):
        peers = set().union(*[m for m in members.values() if code in m]) - {code}
        want += [(code, i + 1, p) for i, p in enumerate(sorted(peers)[:2])]
    assert rows(related.similar_jobs(job, jc, salts=4), "job_code", "rank", "similar_code") == want


PIECES = ["API", "api", "APIs", "apis", "Java's", "JAVA", "class", "classes", "ss", "s", "'s", "x's",
          "123", "1990's", "the", "The", "bus", "bu", "SQL", "sqls", "資料", "資料s", "'quoted'", "don't"]


@SETTINGS
@given(st.lists(st.lists(st.tuples(st.sampled_from(PIECES), st.sampled_from([" ", ",", ". ", "'", "\n"])),
                         max_size=12), min_size=1, max_size=6))
def test_term_counts_equal_word_cloud_rules(spark, docs):
    from jobsift.functions.text import STOP_WORDS
    from jobsift.operators import terms
    from tests.test_text import _wordcloud_counts
    texts = ["".join(w + sep for w, sep in doc) for doc in docs]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert rows(terms.term_counts(df), "term", "n") == _wordcloud_counts(texts, STOP_WORDS)
