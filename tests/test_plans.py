"""Physical-plan properties that matter at scale."""

import io
from contextlib import redirect_stdout

from jobsift import bindings as B
from jobsift.bindings import TEST_VOCAB as V
from jobsift.operators import bookmarks, market, related, terms
from jobsift.sources.tables import save_posting_tables
from tests.conftest import SMOKE


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bucketed_tables_join_without_shuffle(spark):
    t = B.Tables(spark, SMOKE)
    job, jc = save_posting_tables(spark, t.job, t.job_category, buckets=8, prefix="plantest_")
    p = plan(market.region_salary(job, jc, vocab=V))
    assert "SortMergeJoin" in p or "BroadcastHashJoin" in p
    assert "Exchange hashpartitioning(job_code" not in p


def test_ranked_selection_limits_before_shuffle(spark):
    t = B.Tables(spark, SMOKE)
    p = plan(related.similar_jobs(t.job, t.job_category))
    # per-job category and peer sets: partial aggregates below the exchange on job_code
    assert p.count("ObjectHashAggregate") >= 2
    # ranking: partial and final limit around the exchange
    ranked = related.top_k_per_group(t.job_category, ["job_category"], ["job_code"], 3)
    assert plan(ranked).count("WindowGroupLimit") >= 2


def test_term_counts_aggregate_map_side(spark):
    docs = B.read(spark, SMOKE, "documents").select("text")
    p = plan(terms.top_terms(docs))
    # partial HashAggregate below the exchange on the spelling counts
    assert p.index("Exchange hashpartitioning(word") < p.rindex("HashAggregate")


def test_scan_prunes_columns(spark):
    t = B.Tables(spark, SMOKE)
    p = plan(market.edu_distribution(t.job, vocab=V))
    orders_scan = [line for line in p.splitlines() if "orders.parquet" in line][0]
    assert "o_totalprice" not in orders_scan and "o_orderpriority" in orders_scan


def test_history_has_no_distinct_aggregation(spark):
    from jobsift.operators import history
    t = B.Tables(spark, SMOKE)
    p = plan(history.posting_history(t.job, t.job_category, vocab=V))
    assert "count(distinct" not in p.lower() and "Expand" not in p


def test_texts_are_dealt_only_when_asked(spark, monkeypatch):
    t = B.Tables(spark, SMOKE)
    assert "REPARTITION" not in plan(t.texts("documents"))
    monkeypatch.setattr(B.Tables, "text_partitions", 6)
    assert "REPARTITION_BY_NUM" in plan(t.texts("documents"))


def test_similar_jobs_joins_no_hot_code(spark):
    t = B.Tables(spark, SMOKE)
    p = plan(related.similar_jobs(t.job, t.job_category))
    assert "similar_code" not in "".join(line for line in p.splitlines() if "Join" in line or "Exchange" in line)
    assert p.count("Exchange hashpartitioning(job_category") == 0  # candidates are broadcast after they are counted
    salted = plan(related.similar_jobs(t.job, t.job_category, broadcast_rows=0))
    assert "Exchange hashpartitioning(job_category" in salted and "_salt" in salted


def test_user_bookmarks_joins_no_null_key(spark):
    t = B.Tables(spark, SMOKE)
    p = plan(related.user_bookmarks(t.users, bookmarks.current_bookmarks(t.toggles), t.job))
    outer = [line for line in p.splitlines() if "LeftOuter" in line]
    assert len(outer) == 2 and "user_id" in outer[0] and "job_code" in outer[1]


def test_by_category_shuffles_the_bridge_once(spark):
    t = B.Tables(spark, SMOKE)
    for q in (market.category_salary(t.job, t.job_category, V),
              market.region_salary_by_category(t.job, t.job_category, V, B.CATEGORIES),
              market.edu_distribution_by_category(t.job, t.job_category, V, B.CATEGORIES)):
        assert plan(q).count("Exchange hashpartitioning(job_code") == 2  # the bridge and the jobs


def test_history_upsert_has_no_join(spark):
    import __spark_entry__ as E
    assert "Join" not in plan(E.queries()["history_upsert"](spark, SMOKE))


def test_html_details_have_no_join(spark):
    from jobsift.sources import html
    pages = spark.createDataFrame([("u", "h")], "url string, html string")
    p = plan(html.detail_records(pages))
    assert "Join" not in p and "Exchange" not in p


def test_headline_plans_have_no_pairs_or_python(spark):
    # no cartesian or nested-loop joins (all-pairs work) and no Python
    # evaluation in the plans of the heavy queries
    import __spark_entry__ as E
    q = E.queries()
    for name in ["region_salary", "similar_jobs", "term_frequency", "skill_terms_by_category",
                 "bookmark_actions", "sync_cascade", "view_flags", "posting_history"]:
        p = plan(q[name](spark, SMOKE))
        for bad in ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                    "MapInPandas", "FlatMapGroupsInPandas"]:
            assert bad not in p, (name, bad)
