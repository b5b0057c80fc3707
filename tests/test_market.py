"""Dashboard aggregates on hand-made rows (FIXTURES §3: 1-5, 17)."""

import datetime as dt

from jobsift import schema as S
from jobsift.functions.numeric import rounded_ratio
from jobsift.operators import history, market
from tests.conftest import rows

TS = dt.datetime(2024, 5, 1)


def job_rows(spark, specs):
    """specs: (code, location, period, min, max, edu)"""
    data = [(c, "t", "co", loc, p, mn, mx, edu, None, "Python,SQL", None, None, None, f"https://x/{c}", TS)
            for c, loc, p, mn, mx, edu in specs]
    return spark.createDataFrame(data, S.JOB)


def cats(spark, pairs):
    return spark.createDataFrame(pairs, S.JOB_CATEGORY)


def test_sentinels_and_null_pay(spark):
    job = job_rows(spark, [
        ("a", "台北市內湖區", "月薪", 0, 0, None),
        ("b", "台北市內湖區", "月薪", 0, 9999999, None),
        ("c", "台北市內湖區", "月薪", 30000, 50000, None),
        ("d", "台北市內湖區", "月薪", None, 40000, None),
        ("e", "台北市內湖區", "月薪", None, None, None),
    ])
    out = market.region_salary(job, cats(spark, [("c", "x")]))
    assert rows(out) == [("台北市", 40000)]


def test_period_prefix_versus_contains(spark):
    specs = [(str(i), "台北市", p, 10000 * (i + 1), 10000 * (i + 1), None)
             for i, p in enumerate([None, "年薪 100萬", "時薪 200", "待遇面議", "月薪 3萬", "論件 年薪"])]
    job = job_rows(spark, specs)
    jc = cats(spark, [(str(i), "後端工程師") for i in range(6)])
    # contains: only the monthly row (code 4, pay 50000)
    assert rows(market.region_salary(job, jc)) == [("台北市", 50000)]
    # prefix (one category): the '論件 年薪' row (code 5, pay 60000) stays in
    assert rows(market.region_salary(job, jc, category="後端工程師")) == [("台北市", 55000)]


def test_region_whitelist(spark):
    job = job_rows(spark, [("a", "台北市內湖區", "月薪", 100, 100, None),
                           ("b", "香港中環", "月薪", 100, 100, None),
                           ("c", "台北", "月薪", 100, 100, None)])
    assert rows(market.region_salary(job, cats(spark, []))) == [("台北市", 100)]


def test_category_rows_weight_the_average(spark):
    job = job_rows(spark, [("a", "台北市", "月薪", 100, 100, None), ("b", "台北市", "月薪", 200, 200, None),
                           ("c", "台北市", "月薪", 400, 400, None)])
    # a: no category (counts once), b: one, c: the same pair twice (counts twice)
    jc = cats(spark, [("b", "前端工程師"), ("c", "前端工程師"), ("c", "前端工程師")])
    # (100 + 200 + 400 + 400) / 4 = 275
    assert rows(market.region_salary(job, jc)) == [("台北市", 275)]
    assert rows(market.category_salary(job, jc)) == [("前端工程師", 333)]


def test_edu_prefixes_and_share(spark):
    job = job_rows(spark, [(str(i), "台北市", "月薪", 1, 1, e)
                           for i, e in enumerate(["大學以上", "高中職", "不拘", None, "other", "大學"])])
    out = rows(market.edu_distribution(job), "min_edu_level", "count", "share")
    assert out == [("不拘", 1, 0.25), ("大學", 2, 0.5), ("高中", 1, 0.25)]


def test_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (7, 2), (-7, 2), (4, 3), (0, 1)], "n long, d long")
    got = [r[0] for r in df.select(rounded_ratio(df.n, df.d)).collect()]
    assert got == [3, -3, 4, -4, 1, 0]


def test_snapshot_counts_distinct_jobs(spark):
    job = job_rows(spark, [("a", "台北市", "月薪", 1, 1, None), ("b", "台北市", "月薪", 1, 1, None)])
    jc = cats(spark, [("a", "iOS工程師"), ("a", "iOS工程師"), ("b", "iOS工程師"), ("b", "AI工程師"),
                      ("zz", "iOS工程師")])
    r = history.posting_snapshot(job, jc, "2024-05-23").collect()[0]
    assert (r.total_post, r.ios, r.ai_engineer, r.android) == (2, 2, 1, 0)
    assert str(r.date) == "2024-05-23"


def test_share_series_rejects_unknown_column(spark):
    hist = spark.createDataFrame([(dt.date(2024, 5, d), 10, 3) for d in range(1, 10)],
                                 "date date, total_post long, ios long")
    out = history.category_share_series(hist, history.resolve_category_column("iOS工程師"))
    assert [(r.others, r.chose_cat) for r in out.collect()] == [(7, 3)] * 7
    try:
        history.category_share_series(hist, "ios; DROP TABLE job")
    except ValueError:
        pass
    else:
        raise AssertionError("unknown column accepted")
