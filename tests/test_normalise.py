"""The pluggable step per board: records, faults and the contract's rules."""

from jobsift.operators import quality
from jobsift.schema import DOMAIN
from jobsift.sources import normalise as N
from tests.conftest import rows

def _odd():
    """A step made here, so that workers, which cannot import tests, get it whole."""
    base = dict.fromkeys(quality.EXTRACTED.names) | {"category": ["資料工程師"]}

    def step(code, text):
        made = base | {"job_code": code}
        return {
            "raise": lambda: 1 / 0, "none": lambda: None, "big": lambda: made | {"min_salary": 2**53 + 1},
            "huge": lambda: made | {"min_salary": 2**63}, "bool": lambda: made | {"max_salary": True},
            "number": lambda: made | {"job_title": 7}, "list": lambda: made | {"category": "資料工程師"},
            "items": lambda: made | {"category": ["資料工程師", 3]}, "more": lambda: made | {"note": "x"},
            "less": lambda: {k: v for k, v in made.items() if k != "travel"}, "code": lambda: made | {"job_code": "other"},
            "source": lambda: made | {"job_source": "s/" + code, "create_date": "2024-05-01 00:00:00"},
            "day": lambda: made | {"job_source": "s/" + code, "create_date": "2024-05-02 00:00:00"},
        }.get(text, lambda: made)()

    return step


def _run(spark, pages, **more):
    df = spark.createDataFrame(pages, "board string, code string, text string")
    return N.normalise(df, {"odd": _odd()}, DOMAIN, **more)


def test_every_fault_is_a_reason(spark):
    kinds = ["raise", "none", "big", "huge", "bool", "number", "list", "items", "more", "less", "code", "fine"]
    got = _run(spark, [("odd", f"c{i}", t) for i, t in enumerate(kinds)])
    assert [r[0] for r in got.orderBy(got.page_code.substr(2, 9).cast("int")).select("reasons").collect()] == [
        "failed:ZeroDivisionError", "failed:no_record", "", "failed:type_min_salary", "failed:type_max_salary",
        "failed:type_job_title", "failed:type_category", "failed:type_category", "keys", "keys", "job_code", ""]
    assert got.where("page_code = 'c2'").first().min_salary == 2**53 + 1
    assert got.where("reasons LIKE 'failed%' AND job_code IS NOT NULL").count() == 0


def test_source_and_day_of_the_run(spark):
    got = _run(spark, [("odd", "a", "source"), ("odd", "b", "day"), ("odd", "c", "fine")],
               source_prefix={"odd": "s/"}, run_date="2024-05-01")
    assert rows(got, "page_code", "reasons") == [("a", ""), ("b", "create_date"), ("c", "job_source,create_date")]


def test_unknown_boards_nulls_and_no_pages(spark):
    got = _run(spark, [("new", "a", "x"), (None, "b", None), ("odd", None, None), ("odd", "d", None), ("odd", "d", None)])
    assert sorted(((r.page_code, r.reasons) for r in got.collect()), key=str) == [
        ("a", "no_step"), ("b", "no_step"), ("d", ""), ("d", ""), (None, "job_code")]
    assert _run(spark, []).count() == 0


def test_two_boards_through_the_same_call(spark):
    df = spark.createDataFrame([
        ("doc", "a", '{"t":"x","pay":5,"kinds":["資料工程師"]}'), ("doc", "b", '{"t":"x"}'), ("doc", "c", "["),
        ("lines", "d", "Title: a: b\nPay: 1,200\nKinds: 資料工程師 , 資料科學家\nOther: z\nplain"), ("lines", "e", "Pay: much"),
        ("lines", "f", "")], "board string, code string, text string")
    steps = {"doc": N.json_step({"t": "job_title", "pay": "min_salary", "kinds": "category"}, remote="可遠端工作"),
             "lines": N.lines_step({"Title": "job_title", "Pay": "min_salary", "Kinds": "category"})}
    got = {r.page_code: r for r in N.normalise(df, steps).collect()}
    assert (got["a"].job_title, got["a"].min_salary, got["a"].remote, got["a"].reasons) == ("x", 5, "可遠端工作", "")
    assert got["b"].reasons == "failed:KeyError" and got["c"].reasons == "failed:JSONDecodeError"
    assert (got["d"].job_title, got["d"].min_salary, got["d"].category) == ("a: b", 1200, ["資料工程師", "資料科學家"])
    assert got["e"].reasons == "failed:ValueError" and got["f"].reasons == "category_count,category_vocabulary"
