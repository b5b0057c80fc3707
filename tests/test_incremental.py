"""History from a sync's own changes, search over a request table, batches checked as they land."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from jobsift.operators import history, search, search_index, sync
from jobsift.operators.search import SearchSpec
from jobsift.schema import JOB, Vocabulary
from tests.conftest import rows

VOCAB = Vocabulary(tracked={"X": "x", "Y": "y", "Z": "z"}, regions=[], region_chars=3, edu_prefixes=[], edu_chars=2,
                   category_vocabulary=["X", "Y", "Z", "other"])
DAY = dt.datetime(2024, 5, 1)


def post(code, site="a", title="t", company="co", place="l", pay="月薪", low=1, skills=None):
    return (code, title, company, place, pay, low, 2, None, None, skills, None, None, None, f"https://www.{site}.example/{code}", DAY)


def test_history_from_changes_equals_the_snapshot_after_every_sync(spark, tmp_path):
    """Inserts, changes that gain categories, removals, codes that come back or change source, repeated batch rows, an empty batch."""
    draw = random.Random(3)
    path, counts = str(tmp_path / "h"), str(tmp_path / "c")
    jobs = spark.createDataFrame([post(f"j{i}", "ab"[i % 2]) for i in range(12)], JOB)
    bridge = spark.createDataFrame([(f"j{i}", draw.choice(["X", "Y", "other"])) for i in range(14) for _ in range(2)],
                                   "job_code string, job_category string")
    bridge = sync.cascade(bridge, jobs)
    history.upsert_history(path, history.posting_snapshot(jobs, bridge, "2024-05-01", VOCAB))
    for n, (site, date) in enumerate([("a", "2024-05-02"), ("b", "2024-05-02"), ("a", "2024-05-03"), ("a", "2024-05-05")]):
        codes = [f"j{i}" for i in range(16) if draw.random() < 0.5] if n != 2 else []
        batch = spark.createDataFrame([post(c, site) for c in codes for _ in range(draw.randint(1, 2))], JOB)
        added = spark.createDataFrame([(c, draw.choice(["X", "Y", "Z", "other"])) for c in codes],
                                      "job_code string, job_category string")
        if codes:
            signed = history.signed_counts(sync.sync_changes(jobs, batch, f"www.{site}"), bridge, added, VOCAB)
            for _ in range(2):
                history.put_counts(signed, counts, date, f"{site}-{n}")
            jobs = sync.land(sync.sync_jobs(jobs, batch, f"www.{site}"), str(tmp_path / f"jobs{n}"))
            bridge = sync.land(sync.cascade(sync.append_categories(bridge, added), jobs), str(tmp_path / f"bridge{n}"))
        history.upsert_history(path, history.day_from_counts(spark, path, counts, date, VOCAB))
        want = history.posting_snapshot(jobs, bridge, date, VOCAB)
        got = history.read_history(spark, path, VOCAB).where(F.col("date") == F.lit(date).cast("date"))
        assert rows(got, *want.columns) == rows(want)


def test_changes_of_a_sync(spark):
    target = spark.createDataFrame([post("k"), post("gone"), post("other", "b")], JOB)
    batch = spark.createDataFrame([post("k"), post("k"), post("new")], JOB)
    assert rows(sync.sync_changes(target, batch, "www.a")) == [("gone", "removed"), ("k", "changed"), ("new", "inserted")]


POSTS = [post("p1", title="Data Engineer", company="Über 100% Co", place="台北市信義區", skills="Python,SQL"),
         post("p2", title="data_engineer", company="aaa", place="台北市", low=50000, skills=None),
         post("p3", title="Go", company="", place="台", pay=None, skills="go_lang"),
         post("p4", title="Data Scientist", company="Data Co", place="新竹", pay="年薪", skills="R"),
         post("p5", title="Backend Engineer", company="bbb", place="台北市", low=40001, skills="Data\\Lake")]
REQUESTS = [(1, "Data", None, None, None), (2, "Engineer", "Data", "台北市", None), (3, "go", "", "", " "), (4, None, None, None, "40000元"),
            (5, "a%r", None, None, None), (6, "data_eng", None, None, None), (7, "100%", None, None, None), (8, None, "Eng", None, "abc"),
            (9, "%", None, None, None), (10, "no such word", None, None, None), (11, None, None, None, None), (12, "", "", "信義區", "1"),
            (13, "Data", "Go", None, None), (14, None, None, "台", "4e4"), (15, "aaa", None, None, "-1")]


@pytest.mark.parametrize("match", ["contains", "like"])
def test_request_table_equals_one_search_per_request(spark, match):
    job = spark.createDataFrame(POSTS, JOB)
    asked = spark.createDataFrame(REQUESTS, "request_id long, keyword string, job_title string, location string, salary string")
    got = rows(search_index.search_requests(job, asked, match, block=3), "request_id", "job_code")
    want = []
    for r in REQUESTS:
        spec = SearchSpec(keyword=r[1], job_title=r[2], location=r[3], salary=r[4], match=match)
        want += [(r[0], x.job_code) for x in search.search(job, spec).collect()]
    assert got == sorted(want) and len(want) > 10


def test_index_kept_for_later_requests_and_empty_tables(spark, tmp_path):
    job = spark.createDataFrame(POSTS, JOB)
    index = search_index.build_index(job, str(tmp_path / "index"))
    asked = spark.createDataFrame(REQUESTS, "request_id long, keyword string, job_title string, location string, salary string")
    got = search_index.search_requests(job, asked.where("request_id = 1"), index=index)
    assert rows(got, "job_code") == [("p1",), ("p5",)]
    assert search_index.search_requests(job, asked.limit(0), index=index).count() == 0
    assert search_index.search_requests(job.limit(0), asked).count() == 0
    with pytest.raises(ValueError):
        search_index.search_requests(job, asked, "regex")


def test_a_hot_text_is_looked_up_in_parts(spark):
    """A third of the postings share one company; no join puts them under one key."""
    job = spark.range(3000).select(F.concat(F.lit("j"), "id").alias("job_code"), F.lit("t").alias("job_title"),
                                   F.when(F.col("id") % 3 == 0, F.lit("Hot Company")).otherwise(F.concat(F.lit("c"), "id")).alias("company_name"),
                                   F.lit("l").alias("job_location"), F.lit("月薪").alias("salary_period"), F.lit("s").alias("skills"),
                                   F.lit(5).cast("bigint").alias("min_salary"), F.lit("u").alias("job_source"))
    asked = spark.createDataFrame([(1, "Hot", None, None, None), (2, "ompany", None, None, None), (3, "c299", None, None, None)],
                                  "request_id long, keyword string, job_title string, location string, salary string")
    got = search_index.search_requests(job, asked).groupBy("request_id").count()
    n = sum(1 for i in range(3000) if i % 3 and f"c{i}".find("c299") == 0)
    assert rows(got) == [(1, 1000), (2, 1000), (3, n)]


def test_observed_batches(spark, tmp_path):
    target = spark.createDataFrame([post("k"), post("gone"), post("other", "b")], JOB)
    step = lambda t, b: sync.sync_jobs(t, b, "www.a")
    good = spark.createDataFrame([post("k", title="new"), post("n")], JOB)
    got = sync.commit_observed(target, good, str(tmp_path / "1"), step)
    assert rows(got, "job_code", "job_title") == [("k", "new"), ("n", "t"), ("other", "t")]
    assert rows(sync.commit_observed(target, good.limit(0), str(tmp_path / "2"), step), "job_code") == rows(target, "job_code")
    with pytest.raises(ValueError, match="duplicate"):
        sync.commit_observed(target, good.unionByName(good.limit(1)), str(tmp_path / "3"), step)
    with pytest.raises(ValueError, match="NULL"):
        sync.commit_observed(target, good.withColumn("company_name", F.lit(None).cast("string")), str(tmp_path / "4"), step)
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    counted = good.repartition(1).withColumn("job_title", F.udf(count)("job_title"))
    landed, totals = sync.land_observed(counted, str(tmp_path / "5"))
    assert totals == {"rows": 2, "most": 1, "nulls": 0} and landed.count() == 2 and seen.value == 2  # one scan


def test_requests_meet_postings_by_term_numbers_in_parts(spark, monkeypatch):
    """Pairs are made by equal keys in parts of few pairs, without a text comparison, a distinct or a nested loop on pairs;
    short terms, requests without terms and repeated requests are whole."""
    monkeypatch.setattr(search_index, "PAIRS", 4, raising=False)
    job = spark.createDataFrame([*POSTS, *[post(f"q{i}", title="Data", low=i) for i in range(20)]], JOB)
    more = [(None, "Data", None, None, None), (20, "Data", None, None, "5"), (20, "Data", None, None, "5"), (21, "D", "ta", "l", None)]
    asked = spark.createDataFrame([*REQUESTS, *more], "request_id long, keyword string, job_title string, location string, salary string")
    out = search_index.search_requests(job, asked, "like", block=2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LIKE" not in plan and "Aggregate" not in plan and "pmod" in plan
    joins = out._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in joins and "Cartesian" not in joins
    want = []
    for r in [*REQUESTS, *more]:
        spec = SearchSpec(keyword=r[1], job_title=r[2], location=r[3], salary=r[4], match="like")
        want += [(r[0], x.job_code) for x in search.search(job, spec).collect()]
    assert sorted(map(str, ((r.request_id, r.job_code) for r in out.collect()))) == sorted(map(str, want))


def joined_rows(out):
    """Rows that each join of the last stage of a run query made."""
    plan, found = out._jdf.queryExecution().executedPlan().executedPlan(), []

    def walk(node):
        if node.nodeName() == "ResultQueryStage":
            node = node.plan()
        if "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found


@pytest.mark.parametrize("ids, span", [(1 << 10, 1 << 14), (4, 10)])
def test_requests_for_the_same_terms_meet_a_posting_as_one(spark, monkeypatch, ids, span):
    """A posting meets blocks of requests, whatever their bounds; a term of many requests is dealt into spans of them; ids that are null
    or come twice, and requests without a bound, are whole."""
    monkeypatch.setattr(search_index, "IDS", ids, raising=False)
    monkeypatch.setattr(search_index, "SPAN", span, raising=False)
    job = spark.createDataFrame([post(f"q{i}", title="Data", low=None if i == 9 else 10 * i) for i in range(20)], JOB)
    many = [(i, "Data", None, None, None if i % 3 == 0 else f"{i - 50}.5 a") for i in range(200)]
    many += [(None, "Data", None, None, "15"), (None, "Data", None, None, None), (7, "Data", None, None, "15"), (7, "Data", None, None, "15")]
    many += [(300 + i, None, "Data", "l", str(i)) for i in range(40)] + [(400, None, None, None, None), (401, None, None, None, "-0.0")]
    asked = spark.createDataFrame(many, "request_id long, keyword string, job_title string, location string, salary string")
    out = search_index.search_requests(job, asked, "like")
    got = sorted(str((r.request_id, r.job_code)) for r in out.collect())
    low = {f"q{i}": None if i == 9 else 10 * i for i in range(20)}
    bound = [(r[0], r[4] and float(r[4].split()[0])) for r in many]
    want = sorted(str((k, c)) for k, b in bound for c, x in low.items() if b is None or (x is not None and x > b))
    assert got == want and len(got) > 2000
    if ids > 4:
        made = joined_rows(out)
        assert made and sum(made) < len(got) / 5


def test_signed_counts_of_the_query_read_landed_tables(spark, monkeypatch):
    """What the counts read several times is derived once per sync: every input of ``signed_counts`` is a scan of files."""
    from jobsift.plans import catalog
    from tests.conftest import SMOKE

    plans, plain = [], history.signed_counts

    def watched(changes, categories, new_categories, vocab):
        plans.extend(df._jdf.queryExecution().optimizedPlan().toString() for df in (changes, categories, new_categories))
        return plain(changes, categories, new_categories, vocab)

    monkeypatch.setattr(catalog.history, "signed_counts", watched)
    assert catalog.QUERIES["history_incremental"](spark, SMOKE).count() == 3
    assert len(plans) == 12 and not any("Join" in p or "Aggregate" in p for p in plans)
