"""Validation rules (FIXTURES §3: 10, 20) and the extracted-record contract."""

import datetime as dt

import pytest

from jobsift import schema as S
from jobsift.operators import quality
from tests.conftest import rows


def test_email_and_password_rules(spark):
    users = spark.createDataFrame([
        (1, "a", "john.doe@mail.example.com", "Passw0rd@2024x"),
        (2, "b", "John@mail.example.com", "short"),
        (3, "c", "a..b@mail.example.com", "12345678 and spaces"),
        (4, "d", "nodomain@", "abcdefgh"),
    ], S.USER)
    got = rows(quality.signup_checks(users), "id", "email_ok", "password_ok")
    assert got == [(1, True, True), (2, False, False), (3, False, True), (4, False, True)]


def test_split_valid_and_rejected(spark):
    schema = S.JOB.__class__([f.__class__(f.name, f.dataType, True) for f in S.JOB.fields])
    ts = dt.datetime(2024, 5, 1)
    df = spark.createDataFrame([
        ("a", "t", "c", "l", None, 1, 2, "大學", None, None, None, None, None, "s", ts),
        ("b", None, "c", "l", None, 1, 2, "other", None, None, None, None, None, "s", ts),
        ("c", "x" * 300, "c", "l", None, 5, 2, None, None, None, None, None, None, "s", ts),
    ], schema)
    valid, rejected = quality.split_valid(df, quality.job_rules())
    assert rows(valid, "job_code") == [("a",)]
    assert rows(rejected, "job_code", "reasons") == [("b", "null_job_title"), ("c", "long_job_title")]
    warned = quality.with_reasons(df, quality.job_warnings())
    assert rows(warned, "job_code", "reasons") == [("a", ""), ("b", "edu_vocabulary"), ("c", "salary_order")]


def test_extracted_contract(spark):
    df = spark.createDataFrame([
        ("大學", "2年以上", "需出差外派", "不需負擔管理責任", "可遠端工作", ["資料工程師"]),
        ("小學", "很多", "maybe", "不需負擔管理責任", "可遠端工作", ["a", "b", "c", "d"]),
    ], "edu_level string, work_experience string, travel string, management string, remote string, "
       "category array<string>")
    tagged = quality.with_reasons(df, quality.extracted_rules())
    got = [r.reasons for r in tagged.collect()]
    assert got == ["", "edu_level,work_experience,travel,category_count,category_vocabulary"]


def test_contract_hits_every_rule(spark):
    import json
    good = dict(job_code="c1", job_title="t", company_name="c", job_location="l", salary_period="月薪", min_salary=1,
                max_salary=2, edu_level="大學", work_experience="2年以上", skills=None, travel="需出差外派",
                management="不需負擔管理責任", remote="可遠端工作", category=["資料工程師"],
                job_source="https://b/c1", create_date="2024-04-28 00:00:00")
    changes = [{}, {"edu_level": "小學"}, {"work_experience": "x"}, {"travel": "x"}, {"management": "x"}, {"remote": "x"},
               {"category": []}, {"category": ["x"]}, {"job_code": "c2"}, {"job_source": "https://evil/c1"},
               {"create_date": "1900-01-01 00:00:00"}, {"note": 1}]
    texts = [json.dumps(good | c, ensure_ascii=False) for c in changes]
    texts += [json.dumps({k: v for k, v in good.items() if k not in ("skills", "remote")}), "[]", "eval()", None]
    df = spark.createDataFrame([("c1", x) for x in texts], "job_code string, text string").coalesce(1)
    got = [r.reasons for r in quality.check_extracted(quality.parse_extracted(df), S.DOMAIN, "https://b/", "2024-04-28")
           .collect()]
    assert got == ["", "edu_level", "work_experience", "travel", "management", "remote", "category_count",
                   "category_vocabulary", "job_code", "job_source", "create_date", "keys", "keys", "malformed", "malformed",
                   "malformed"]


def test_salary_normalise(spark):
    df = spark.createDataFrame([("年薪", 600000, 900006), ("月薪", 30000, None), ("年薪", 6, None)],
                               "salary_period string, min_salary long, max_salary long")
    got = [(r.min_salary, r.max_salary) for r in quality.normalise_salary(df).collect()]
    assert got == [(50000, 75001), (30000, 30000), (1, 1)]


def test_partitioned_table_reads_need_bounds_and_a_known_table(spark):
    from jobsift.sources import jdbc

    with pytest.raises(ValueError, match="unknown table"):
        jdbc.read_table(spark, "jdbc:x:y", "job; drop", {})
    with pytest.raises(ValueError, match="bounds"):
        jdbc.read_table(spark, "jdbc:x:y", "job", {}, partition_column="id", lower=1)
