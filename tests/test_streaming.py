"""Streaming jobs equal their batch counterparts, also over several micro-batches."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from jobsift import bindings as B
from jobsift.operators import bookmarks, history, sync
from jobsift.schema import JOB
from jobsift.streaming import jobs as streams
from tests.conftest import SMOKE, rows


def test_toggle_state_stream_equals_batch(spark):
    stream = streams.toggle_state(spark, streams.event_stream(spark, SMOKE))
    batch = bookmarks.bookmark_state(B.toggles(spark, SMOKE))
    assert rows(stream, *batch.columns) == rows(batch)


def test_toggle_state_over_many_microbatches(spark, tmp_path):
    # split the events into several files and read one file per micro-batch
    events = spark.read.parquet(f"{SMOKE}/events.parquet").orderBy("event_id")
    events.repartition(4, "user_id").write.parquet(str(tmp_path / "ev"))
    stream = streams.toggle_state(
        spark, streams.event_stream(spark, str(tmp_path / "ev"), file_glob="*.parquet", max_files=1))
    batch = bookmarks.bookmark_state(B.toggles(spark, SMOKE))
    assert rows(stream, *batch.columns) == rows(batch)


def test_upsert_stream_equals_batch_sync(spark):
    import __spark_entry__ as E
    q = E.queries()
    assert rows(q["stream_upsert"](spark, SMOKE)) == rows(q["sync_upsert"](spark, SMOKE))


def test_category_counts_repeats_across_microbatches(spark, tmp_path):
    # the same (day, category, job) lands in two files read in two
    # micro-batches; it is counted once
    import datetime as dt
    d1, d2 = dt.datetime(2024, 5, 1, 9), dt.datetime(2024, 5, 2, 9)
    first = [("a", "X", d1), ("b", "X", d1), ("a", "Y", d1)]
    second = [("a", "X", d1), ("c", "X", d2), ("c", "X", d2)]
    for i, part in enumerate([first, second]):
        spark.createDataFrame(part, streams.POSTING_CATEGORY).coalesce(1).write.json(str(tmp_path / f"p{i}"))
    src = (spark.readStream.schema(streams.POSTING_CATEGORY).option("maxFilesPerTrigger", 1)
           .json(str(tmp_path / "p*")))
    got = rows(streams.daily_category_counts(spark, src, ["X", "Y"]), "day", "job_category", "n_jobs")
    assert got == [(d1.date(), "X", 2), (d1.date(), "Y", 1), (d2.date(), "X", 1)]


def land_postings(spark, tmp_path, files):
    for i, part in enumerate(files):
        frame = spark.createDataFrame([(c, f"{t}", "co", "l", None, 1, 2, None, None, None, None, None, None,
                                        f"https://www.board-a.example/job/{c}", ts) for c, t, ts in part], JOB)
        frame.coalesce(1).write.mode("append").json(str(tmp_path / "land"))
        time.sleep(1.1)  # file streams take files in the order of their modification times


D1, D2, D3 = (dt.datetime(2024, 5, d, 9) for d in (1, 2, 3))


def stored_postings(spark):
    return spark.createDataFrame([("b", "old", "co", "l", None, 1, 2, None, None, None, None, None, None,
                                   "https://www.board-a.example/job/b", D1)], JOB)


def synced(df):
    return rows(df, "job_code", "job_title")


def test_two_days_in_one_batch_are_taken_in_order(spark, tmp_path):
    land_postings(spark, tmp_path, [[("a", "new", D3)], [("a", "old", D2), ("b", "gone", D2)]])
    got = streams.upsert_stream(spark, stored_postings(spark), str(tmp_path / "land"), "www.board-a")
    assert synced(got) == [("a", "new")]


def test_a_snapshot_in_several_batches_and_a_late_day(spark, tmp_path):
    land_postings(spark, tmp_path, [[("a", "d2", D2)], [("c", "d2", D2)], [("x", "late", D1)], [("a", "d3", D3)]])
    got = streams.upsert_stream(spark, stored_postings(spark), str(tmp_path / "land"), "www.board-a", max_files=1)
    assert synced(got) == [("a", "d3")]


def test_upsert_stream_stops_and_restarts(spark, tmp_path):
    path, checkpoint = str(tmp_path / "jobs"), str(tmp_path / "ckpt")
    run = lambda: synced(streams.upsert_stream(spark, stored_postings(spark), str(tmp_path / "land"),
                                               "www.board-a", path, checkpoint, max_files=1))
    land_postings(spark, tmp_path, [[("a", "d2", D2)]])
    assert run() == [("a", "d2")]
    assert run() == [("a", "d2")]  # nothing new: nothing changes
    land_postings(spark, tmp_path, [[("c", "d2", D2)]])
    assert run() == [("a", "d2"), ("c", "d2")]
    land_postings(spark, tmp_path, [[("c", "d3", D3)]])
    assert run() == [("c", "d3")]


def test_late_rows_count_in_their_day(spark, tmp_path):
    days = [dt.datetime(2024, 5, 9), dt.datetime(2024, 4, 1), dt.datetime(2024, 5, 8)]
    for i, d in enumerate(days):
        spark.createDataFrame([(f"j{i}", "X", d), ("again", "X", d)], streams.POSTING_CATEGORY).coalesce(1).write.mode(
            "append").json(str(tmp_path / "land"))
        time.sleep(1.1)
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    src = lambda: (spark.readStream.schema(streams.POSTING_CATEGORY).option("maxFilesPerTrigger", 1)
                   .json(str(tmp_path / "land")))
    got = streams.daily_category_counts(spark, src(), ["X"], path, checkpoint)
    assert rows(got, "day", "n_jobs") == sorted((d.date(), 2) for d in days)
    # stopped, more lands for an old day, started again
    spark.createDataFrame([("late", "X", days[1]), ("again", "X", days[1])], streams.POSTING_CATEGORY).coalesce(1).write.mode(
        "append").json(str(tmp_path / "land"))
    got = streams.daily_category_counts(spark, src(), ["X"], path, checkpoint)
    assert rows(got, "day", "n_jobs") == sorted((d.date(), 3 if d == days[1] else 2) for d in days)


def replay_last(checkpoint):
    """As after a crash between a micro-batch's writes and its commit: the next run does it again."""
    last = max(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    for p in (checkpoint / "commits").glob(f"*{last}*"):
        p.unlink()
    return last


def land_events(folder, parts, spark):
    """One file per part, in this order of modification times."""
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(str(folder / f"p{i}"))
        for f in (folder / f"p{i}").glob("part-*"):
            os.utime(f, (1_700_000_000 + 10 * i,) * 2)


def events_of(spark, folder, max_files=1):
    return streams.event_stream(spark, str(folder / "p*"), file_glob="*.parquet", max_files=max_files)


def test_toggles_after_restart_and_replay(spark, tmp_path):
    events = spark.read.parquet(f"{SMOKE}/events.parquet")
    parts = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i) for i in range(4)]
    path, ckpt = tmp_path / "t", tmp_path / "c"
    run = lambda: streams.toggle_state(spark, events_of(spark, tmp_path / "e"), str(path), str(ckpt))
    land_events(tmp_path / "e", parts[:2], spark)
    run()
    last = replay_last(ckpt)
    before = rows(streams.batches(spark, str(path), streams.TOGGLES).where(f"batch = {last}"))
    run()  # the replayed micro-batch writes what it wrote
    assert rows(streams.batches(spark, str(path), streams.TOGGLES).where(f"batch = {last}")) == before
    for i, part in enumerate(parts[2:], 2):
        part.coalesce(1).write.parquet(str(tmp_path / "e" / f"p{i}"))
    got, batch = run(), bookmarks.bookmark_state(B.toggles(spark, SMOKE))
    assert rows(got, *batch.columns) == rows(batch)
    each = streams.batches(spark, str(path), streams.TOGGLES).groupBy("batch").count().collect()
    clicks = [p.where("event_type = 'click'").count() for p in parts]
    assert all(r["count"] <= max(clicks) for r in each)  # a micro-batch writes the keys that it changed


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4, 5), (5, 4, 3, 2, 1, 0), (3, 0, 5, 1, 4, 2)])
def test_daily_codes_in_any_order_of_files(spark, tmp_path, order):
    events = spark.read.parquet(f"{SMOKE}/events.parquet")
    slices = [events.where(F.pmod(F.dayofmonth("ts"), F.lit(30)).between(5 * i, 5 * i + 4)) for i in range(6)]
    assert sum(s.count() for s in slices) == events.count()
    repeated = [slices[i].unionByName(slices[(i + 1) % 6].limit(20)) for i in order]
    path, ckpt = tmp_path / "t", tmp_path / "c"
    land_events(tmp_path / "e", repeated, spark)
    streams.distinct_daily_codes(spark, events_of(spark, tmp_path / "e"), str(path), str(ckpt))
    replay_last(ckpt)
    got = streams.distinct_daily_codes(spark, events_of(spark, tmp_path / "e"), str(path), str(ckpt))
    want = B.toggles(spark, SMOKE).select(F.to_date("ts").alias("day"), "job_code").distinct()
    assert rows(got, "day", "job_code") == rows(want)
    kinds = {r.kind: r["count"] for r in streams.batches(spark, str(path), streams.DAY_KEYS).groupBy("kind").count().collect()}
    assert kinds["first"] > 0 and (kinds.get("late", 0) > 0)  # the operator alone would have lost these


def test_upsert_appends_what_landed(spark, tmp_path):
    files = [[("a", "d2", D2), ("c", "d2", D2)], [("a", "d3", D3)], [("x", "late", D1), ("b", "late", D1)]]
    path, ckpt = tmp_path / "jobs", tmp_path / "ckpt"
    run = lambda: synced(streams.upsert_stream(spark, stored_postings(spark), str(tmp_path / "land"),
                                               "www.board-a", str(path), str(ckpt), max_files=1))
    for part in files:
        land_postings(spark, tmp_path, [part])
        assert run()[0][0] == "a"
    assert [len(spark.read.parquet(str(path / "batches" / f"batch={i}")).collect()) for i in range(3)] == [2, 1, 2]
    assert run() == [("a", "d3")]
    replay_last(ckpt)
    assert run() == [("a", "d3")]
    streams.fold_jobs(spark, str(path), "www.board-a")
    assert synced(streams.settled_jobs(spark, str(path), "www.board-a")) == [("a", "d3")]
    land_postings(spark, tmp_path, [[("c", "late", D2)]])
    assert run() == [("a", "d3")]
    land_postings(spark, tmp_path, [[("c", "d3", D3)]])
    assert run() == [("a", "d3"), ("c", "d3")]


def test_other_sources_stay_and_late_days_settle_in_order(spark, tmp_path):
    """Any order of landing gives what taking the days in order gives."""
    def post(code, title, site, ts):
        return (code, title, "co", "l", None, 1, 2, *[None] * 6, f"https://{site}/job/{code}", ts)

    mine, other = "www.board-a.example", "www.board-b.example"
    stored = spark.createDataFrame([post("k", "s", other, D1), post("a", "s", other, D1), post("z", "s", mine, D1)], JOB)
    days = {D1: [post("a", "1", mine, D1), post("o", "1", other, D1)], D2: [post("b", "2", mine, D2), post("k", "2", other, D2)],
            D3: [post("c", "3", mine, D3), post("c", "0", mine, D3)]}
    want = stored
    for d in sorted(days):
        want = sync.sync_jobs(want, spark.createDataFrame(days[d], JOB), "www.board-a")
    for k, order in enumerate([(D1, D2, D3), (D3, D1, D2)]):
        for i, d in enumerate(order):
            spark.createDataFrame(days[d], JOB).coalesce(1).write.mode("append").json(str(tmp_path / f"l{k}"))
        got = streams.upsert_stream(spark, stored, str(tmp_path / f"l{k}"), "www.board-a", max_files=1)
        assert rows(got, "job_code", "job_title") == rows(want, "job_code", "job_title")


def test_sketches_merge_late_rows_and_days(spark, tmp_path):
    days = [dt.datetime(2024, 5, d) for d in (9, 1, 8)]
    path, ckpt = str(tmp_path / "t"), str(tmp_path / "c")
    src = lambda: spark.readStream.schema(streams.POSTING_CATEGORY).option("maxFilesPerTrigger", 1).json(
        str(tmp_path / "land"))
    for i, d in enumerate(days):
        frame = spark.range(3000 * i, 3000 * i + 6000).select(F.concat(F.lit("j"), "id").alias("job_code"),
                                                              F.lit("X").alias("job_category"),
                                                              F.lit(d).cast("timestamp_ntz").alias("create_date"))
        frame.unionByName(frame.limit(100)).coalesce(1).write.mode("append").json(str(tmp_path / "land"))
        got = streams.daily_category_sketches(spark, src(), ["X"], path, ckpt)
    replay_last(tmp_path / "c")
    got = streams.daily_category_sketches(spark, src(), ["X"], path, ckpt)
    assert rows(got, "day", "n") == sorted((d.date(), 6000) for d in days)
    (row,) = history.merged_distinct(got, ["job_category"]).collect()
    assert row.n == 18000 and abs(row.n_distinct - 12000) <= streams.SKETCH_BOUND * 12000


def test_results_without_their_checkpoint_raise(spark, tmp_path):
    land_postings(spark, tmp_path, [[("a", "d2", D2)]])
    run = lambda c: streams.upsert_stream(spark, stored_postings(spark), str(tmp_path / "land"), "www.board-a",
                                          str(tmp_path / "jobs"), str(tmp_path / c))
    run("c1")
    with pytest.raises(ValueError, match="another checkpoint"):
        run("c2")
