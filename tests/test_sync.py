"""Snapshot sync, categories, batch policies (FIXTURES §3: 3, 10-12)."""

import datetime as dt

import pytest

from jobsift import schema as S
from jobsift.operators import history, sync
from jobsift.operators.quality import job_rules
from tests.conftest import rows

OLD = dt.datetime(2024, 5, 1)
NEW = dt.datetime(2024, 5, 2)


def job(code, source, ts=OLD, title="t"):
    return (code, title, "co", "台北市", "月薪", 1, 2, None, None, None, None, None, None, source, ts)


def frame(spark, data):
    return spark.createDataFrame(data, S.JOB)


@pytest.fixture
def stored(spark):
    return frame(spark, [
        job("keep", "https://www.board-a.example/job/keep"),
        job("change", "https://www.board-a.example/job/change"),
        job("gone", "https://www.board-a.example/job/gone"),
        job("other", "https://www.board-b.example/job-other.html"),
        job("moves", "https://www.board-b.example/job-moves.html"),
    ])


def test_sync_update_delete_insert(spark, stored):
    batch = frame(spark, [job("keep", "https://www.board-a.example/job/keep", NEW),
                          job("change", "https://www.board-a.example/job/change", NEW, title="new title"),
                          job("new", "https://www.board-a.example/job/new", NEW),
                          job("moves", "https://www.board-a.example/job/moves", NEW)])
    out = sync.sync_jobs(stored, batch, "www.board-a")
    got = {r.job_code: (r.job_title, r.job_source, r.create_date) for r in out.collect()}
    assert set(got) == {"keep", "change", "new", "other", "moves"}
    assert got["change"][0] == "new title"
    assert got["keep"][2] == NEW
    assert got["other"][2] == OLD                                  # other source untouched
    assert got["moves"][1] == "https://www.board-a.example/job/moves"   # one row, now source B


def test_sync_is_idempotent(spark, stored):
    batch = frame(spark, [job("keep", "https://www.board-a.example/job/keep", NEW)])
    once = sync.sync_jobs(stored, batch, "www.board-a")
    twice = sync.sync_jobs(once, batch, "www.board-a")
    assert rows(once) == rows(twice)


def test_sync_never_touches_other_sources(spark, stored):
    batch = frame(spark, [job("x", "https://www.board-a.example/job/x", NEW)])
    out = sync.sync_jobs(stored, batch, "www.board-a")
    others = lambda df: rows(df.where(~df.job_source.contains("www.board-a")))
    assert others(out) == others(stored)


def test_empty_batch_changes_nothing(spark, stored):
    empty = frame(spark, [])
    out = sync.guard_empty(stored, empty, lambda t, b: sync.sync_jobs(t, b, "www.board-a"))
    assert rows(out) == rows(stored)


def test_stale_and_cascade(spark, stored):
    batch = frame(spark, [job("keep", "https://www.board-a.example/job/keep", NEW)])
    assert rows(sync.stale_jobs(stored, batch, "www.board-a"), "job_code") == [("change",), ("gone",)]
    after = sync.sync_jobs(stored, batch, "www.board-a")
    cats = spark.createDataFrame([("keep", "a"), ("gone", "a"), ("other", "b")], S.JOB_CATEGORY)
    assert rows(sync.cascade(cats, after)) == [("keep", "a"), ("other", "b")]
    assert rows(sync.orphans(cats, after)) == [("gone", "a")]


def test_category_append_versus_set(spark):
    old = spark.createDataFrame([("a", "x"), ("b", "y")], S.JOB_CATEGORY)
    new = spark.createDataFrame([("a", "x"), ("c", "x"), ("c", "z")], S.JOB_CATEGORY)
    assert sync.append_categories(old, new).count() == 5
    assert sync.set_categories(old, new).count() == 4


def test_batch_policy_all_or_nothing(spark):
    dup = frame(spark, [job("a", "s"), job("a", "s")])
    with pytest.raises(ValueError):
        sync.batch_policy(dup)
    schema_nullable = S.JOB.__class__([f.__class__(f.name, f.dataType, True) for f in S.JOB.fields])
    null_title = spark.createDataFrame([("b", None, "co", "l", None, 1, 1, None, None, None, None, None, None,
                                         "s", OLD)], schema_nullable)
    with pytest.raises(ValueError):
        sync.batch_policy(null_title)
    ok = frame(spark, [job("a", "s")])
    assert sync.batch_policy(ok).count() == 1


def test_row_policy_first_wins(spark):
    df = spark.createDataFrame([("a", 2, "second"), ("a", 1, "first"), ("b", 5, "only")],
                               "job_code string, pos int, note string")
    out = sync.first_wins(df, "job_code", ["pos"])
    assert rows(out, "job_code", "note") == [("a", "first"), ("b", "only")]


def test_insert_unique_email(spark):
    existing = spark.createDataFrame([("a@x.com",)], "email string")
    new = spark.createDataFrame([("a@x.com", 1), ("b@x.com", 3), ("b@x.com", 2)], "email string, ts int")
    out = sync.insert_unique(existing, new, "email", ["ts"])
    assert rows(out) == [("b@x.com", 2)]


def test_commit_switches_a_pointer(spark, tmp_path):
    root = str(tmp_path / "t")
    first = spark.createDataFrame([("a", "x")], S.JOB_CATEGORY)
    with pytest.raises(FileNotFoundError):
        sync.current_table(spark, root)
    one = sync.commit_table(first, root)
    open_before = sync.current_table(spark, root)
    # the new state is derived from the old one; readers of the old one go on
    two = sync.commit_table(open_before.unionByName(spark.createDataFrame([("b", "y")], S.JOB_CATEGORY)), root)
    assert rows(sync.current_table(spark, root)) == [("a", "x"), ("b", "y")] and rows(open_before) == [("a", "x")]
    # a version that was written but not committed is not seen
    spark.createDataFrame([("z", "z")], S.JOB_CATEGORY).write.parquet(f"{root}/v-left-over")
    assert sync.current_table(spark, root).count() == 2
    sync.commit_table(first, root)
    left = {p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")}
    assert one.split("/")[-1] not in left and two.split("/")[-1] in left and len(left) == 2


def test_a_code_repeated_in_the_batch_enters_once(spark, stored):
    batch = frame(spark, [job("keep", "https://www.board-a.example/job/keep", NEW, title="b"),
                          job("keep", "https://www.board-a.example/job/keep", NEW, title="a"),
                          job("KEEP", "https://www.board-a.example/job/keep", NEW, title="c")])
    got = [r.job_code for r in sync.sync_jobs(stored, batch, "www.board-a").collect()]
    assert sorted(got) == ["KEEP", "keep", "moves", "other"]
    folded = sync.sync_jobs(stored, batch, "www.board-a", key_collation="UNICODE_CI_AI").collect()
    assert sorted(r.job_code.lower() for r in folded) == ["keep", "moves", "other"]


def test_row_policy_rejects_with_reasons(spark):
    nullable = S.JOB.__class__([f.__class__(f.name, f.dataType, True) for f in S.JOB.fields])
    data = [job("a", "s", NEW, "second"), job("a", "s", OLD, "first"), job("a", "s", OLD, "first"),
            job("b", "s", OLD), job("b", "s", OLD, None), job("c", None, OLD)] + [job("d", "s", OLD)] * 40
    df = spark.createDataFrame(data, nullable)
    loaded, rejected = sync.row_policy(df, job_rules(), ["create_date"])
    assert rows(loaded, "job_code", "job_title") == [("a", "first"), ("b", "t"), ("d", "t")]
    assert rows(rejected, "job_code", "reasons") == sorted(
        [("a", "duplicate_job_code")] * 2 + [("b", "null_job_title"), ("c", "null_job_source")]
        + [("d", "duplicate_job_code")] * 39)


def test_history_day_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "h")
    vocab = S.Vocabulary(tracked={"X": "x"})
    row = lambda d, n, x: spark.createDataFrame([(d, n, x)], "date date, total_post long, x long")
    history.upsert_history(path, row(OLD.date(), 5, 1).union(row(NEW.date(), 6, 2)))
    for _ in range(2):
        history.upsert_history(path, row(NEW.date(), 7, 3))
    assert rows(history.read_history(spark, path, vocab)) == [(OLD.date(), 5, 1), (NEW.date(), 7, 3)]


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from jobsift import session

    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://head:7077")
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(fake)
    sc.master = "local-cluster[3,2,1024]"
    with pytest.raises(ValueError):
        session.checkpoint_root(fake)


def test_scratch_is_cleared(spark):
    from jobsift.session import clear_scratch, scratch_path

    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_assign_ids_dense_in_key_order_over_many_slices(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # keep several sort slices for this small input
    try:
        df = spark.createDataFrame([(f"k{i:05d}", i) for i in range(2000)], "code string, v long")
        got = sync.assign_ids(df, "code", start=100)
        ids = sorted((r.code, r.id) for r in got.collect())
        assert ids == [(f"k{i:05d}", 101 + i) for i in range(2000)]
    finally:
        spark.conf.unset(key)


def test_insert_with_ids_continues_after_max(spark):
    table = spark.createDataFrame([("a", 1), ("c", 7)], "job_code string, id long")
    new = spark.createDataFrame([("d",), ("b",), ("c",)], "job_code string")
    got = rows(sync.insert_with_ids(table, new, "job_code"), "job_code", "id")
    assert got == [("b", 8), ("d", 9)]


def test_case_and_accent_insensitive_keys(spark):
    # the original's unique index treats yEO595 and yeo595 as one key
    stored = frame(spark, [job("yeo595", "https://www.board-b.example/job-yeo595.html")])
    batch = frame(spark, [job("yEO595", "https://www.board-a.example/job/yEO595", NEW)])
    binary = sync.sync_jobs(stored, batch, "board-a")
    folded = sync.sync_jobs(stored, batch, "board-a", key_collation="UNICODE_CI_AI")
    assert sorted(r.job_code for r in binary.collect()) == ["yEO595", "yeo595"]
    assert [r.job_code for r in folded.collect()] == ["yEO595"]
    both = stored.unionByName(batch)
    assert sync.duplicate_keys(both, ["job_code"]).count() == 0
    dup = sync.duplicate_keys(both, ["job_code"], key_collation="UNICODE_CI_AI").collect()
    assert [(r.job_code, r.n) for r in dup] == [("yEO595", 2)]
