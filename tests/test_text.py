"""Extraction from JSON, HTML and text (FIXTURES §3: 14, 15, 18, 19)."""

import datetime as dt
import json

from jobsift import bindings as B
from jobsift import schema as S
from jobsift.functions import dates as D
from jobsift.functions import text as X
from jobsift.operators import terms
from jobsift.sources import html, landing
from tests.conftest import SMOKE, rows


def test_monthly_range_parse(spark):
    df = spark.createDataFrame([("月薪 30,000 至 1,045,000",), ("月薪 30,000",), ("時薪 200",)], "t string")
    got = [(r.p.min_salary, r.p.max_salary) for r in df.select(X.parse_monthly_range("t").alias("p")).collect()]
    assert got == [(30000, 1045000), (0, 0), (0, 0)]


def test_join_nonempty(spark):
    df = spark.createDataFrame([([],), (["Python"],), (["Go", None, "SQL"],)], "a array<string>")
    assert [r[0] for r in df.select(X.join_nonempty("a")).collect()] == [None, "Python", "Go,SQL"]


def test_load_date_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 1, 15, 59, 59),), (dt.datetime(2024, 5, 1, 16, 0, 0),)],
                               "ts timestamp_ntz")
    assert [r[0] for r in df.select(D.load_date("ts")).collect()] == [dt.date(2024, 5, 1), dt.date(2024, 5, 2)]


def test_codes_from_links(spark):
    df = spark.createDataFrame([
        ("https://www.board-a.example/job/8aary?jobsource=x",), ("https://www.board-b.example/job-yEO595.html",),
        ("https://hk.board-c.example/job/75519058?type=standout",), ("https://board-d.example/job/detail/3010212845/",),
        ("https://example.com/none",)], "u string")
    got = df.select(X.extract_code("u", S.CODE_PATTERNS["json_board"]).alias("a"),
                    X.extract_code("u", S.CODE_PATTERNS["html_board"]).alias("b"),
                    X.extract_code("u", S.CODE_PATTERNS["hk_board"]).alias("c"),
                    X.first_match("u", S.CODE_PATTERNS["jp_board"]).alias("d")).collect()
    assert got[0].a == "8aary" and got[1].b == "yEO595" and got[2].c == "75519058"
    assert got[3].d == "3010212845" and got[4].a is None and got[4].d is None


def test_json_detail_to_record(spark, tmp_path):
    doc = {"data": {"switch": "on", "header": {"jobName": "後端工程師", "custName": "某公司"},
                    "jobDetail": {"addressRegion": "台北市內湖區", "salary": "月薪40,000~60,000元",
                                  "salaryMin": 40000, "salaryMax": 60000, "businessTrip": None,
                                  "manageResp": "不需負擔管理責任", "remoteWork": {"type": 1},
                                  "jobCategory": [{"description": "後端工程師"}, {"description": "軟體工程師"}]},
                    "condition": {"edu": "大學以上", "workExp": "2年以上",
                                  "specialty": [{"description": "Python"}, {"description": "Go"}]}}}
    closed = {"data": dict(doc["data"], switch="off")}
    (tmp_path / "8aary.json").write_text(json.dumps(doc, ensure_ascii=False))
    (tmp_path / "closed1.json").write_text(json.dumps(closed, ensure_ascii=False))
    details = landing.read_details(spark, str(tmp_path))
    recs = landing.detail_records(details).collect()
    assert len(recs) == 1
    r = recs[0]
    assert (r.job_code, r.skills, r.remote, r.job_category) == ("8aary", "Python,Go", "可遠端工作",
                                                                ["後端工程師", "軟體工程師"])
    assert r.job_source == "https://www.board-a.example/job/8aary"
    jobs, cats = landing.split_record(landing.detail_records(details), "2024-05-23")
    assert jobs.columns == S.JOB_COLUMNS and cats.count() == 2


def test_listing_json_codes(spark, tmp_path):
    page = {"data": {"list": [{"link": {"job": "//www.board-a.example/job/abc12?jobsource=x"}},
                              {"link": {"job": "//www.board-a.example/company/1"}},
                              {"link": {"job": "//www.board-a.example/job/zz9?x=1"}}]}}
    (tmp_path / "p1.json").write_text(json.dumps(page))
    got = rows(landing.listing_codes(spark, str(tmp_path)), "pos", "job_code")
    assert got == [(0, "abc12"), (2, "zz9")]


DETAIL_HTML = """<html><body><h1 class="job-title"> 資料工程師 </h1>
<div class="company-info-container"><span>好公司</span></div>
<div class="job-detail-box"><div class="wrapper">
<span class="jobItemName">薪資待遇</span><div>月薪 45,000 至 60,000</div>
<span class="jobItemName">上班地點</span><div> 台北市信義區 </div>
<span class="jobItemName">職務類別</span><div>資料工程師、後端工程師</div>
<span class="jobItemName">電腦專長</span><div>Python &amp; SQL</div>
</div></div></body></html>"""


def test_html_detail_record(spark):
    pages = spark.createDataFrame([("https://www.board-b.example/job-yEO595.html", DETAIL_HTML)], "url string, html string")
    r = html.detail_records(pages).collect()[0]
    assert (r.job_title, r.job_code, r.company_name, r.job_location) == ("資料工程師", "yEO595", "好公司", "台北市信義區")
    assert (r.min_salary, r.max_salary, r.skills) == (45000, 60000, "Python & SQL")
    assert r.job_category == ["資料工程師", "後端工程師"]


def test_html_detail_of_a_page_with_odd_markup(spark):
    page = """<html><h1>Board name</h1><h1 class="x job-title">資深<b>工程師</b></h1><h1>more</h1>
    <div class='company-info-container'><a>logo</a><p><span>甲&#20844;司</span><span>Ltd</span></p></div>
    <div class="jobItemName">教育程度</div><div>outside</div>
    <div class="job-detail-box"><div class="wrapper">
      <p class="jobItemName">上班地點</p><i>map</i><div>台北市<div>大安區</div>一號</div></div>
      <div class="wrapper"><span class="jobItemName">工作經驗</span>text<b>!</b><div> 3年以上 </div>
      <span class="jobItemName"> 教育程度 </span><div>大學</div></div>
      <div class="wrapper"><span class="jobItemName">教育程度</span><div>碩士&hellip;</div>
      <span class="jobItemName">是否出差</span></div></div></html>"""
    pages = spark.createDataFrame([("https://b/job-a1.html", page), ("https://b/job-a2.html", None)], "url string, html string")
    r, none = html.detail_records(pages).orderBy("job_code").collect()
    assert (r.job_title, r.company_name) == ("資深工程師", "甲公司")
    assert (r.job_location, r.work_experience, r.edu_level, r.travel) == ("台北市大安區一號", "3年以上", "碩士…", None)
    assert (none.job_code, none.job_title, none.min_salary) == ("a2", None, 0)


def test_links_in_both_quotes_decoded(spark):
    page = """<a href='/job-b.html?a=1&amp;b=2'>x</a><A class="k" HREF = "/c?q=&#x4e2d;">y</a><a data-href="/no">z</a>"""
    pages = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert rows(html.page_links(pages), "pos", "href") == [(0, "/job-b.html?a=1&b=2"), (1, "/c?q=中")]


def test_article_links_only_of_article_titles(spark):
    page = """<a href="/top">t</a><div class="new_job all_job_hover"><a href="/side">s</a>
      <h2 class='job__title__inner'><em>n</em><a href='/job-1.html?x=1&amp;y=2'>a</a><a href="/second">b</a></h2></div>
      <div class="all_job_hover"><h2 class="job__title__inner">no link</h2></div><div class="all_job"><h2
      class="job__title__inner"><a href="/job-9.html">c</a></h2></div>"""
    pages = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")
    assert rows(html.article_links(pages), "page_id", "pos", "href") == [(1, 0, "/job-1.html?x=1&y=2")]


def test_container_text_as_the_original_joins_it(spark):
    page = "<p>no</p><div class='a text-box'> one <b>two</b>\n<script>x</script><div>thr&eacute;e</div></div><div class='text-box'>4</div>"
    pages = spark.createDataFrame([(1, page), (2, "<p>x")], "page_id long, html string")
    assert rows(html.container_text(pages, "text-box")) == [(1, "onetwothrée"), (2, None)]
    assert html.container_text(pages, "text-box", sep=" ").first().text == "one two thrée"


def test_embedded_json_in_any_attribute_order(spark):
    pages = spark.createDataFrame([(1, """<input value='{"k": "a>b &amp;lt; &amp;#20013;"}' type=hidden id=jobDetailJson>"""),
                                   (2, "<input id=jobDetailJson>"), (3, None)], "page_id long, html string")
    got = html.embedded_json(pages, "jobDetailJson", "k string").orderBy("page_id").collect()
    assert [r.doc and r.doc.k for r in got] == ["a>b < 中", None, None]


def test_entities(spark):
    df = spark.createDataFrame([("&#20013;&#x4E2D;&hellip;&amp;lt;&nbsp;x &unknown; & b",), (None,)], "t string")
    assert [r[0] for r in df.select(X.unescape_html("t")).collect()] == ["中中…&lt; x &unknown; & b", None]


def test_raw_texts_roundtrip_and_rerun(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([("c1", 'a "b"\n中'), ("c2", None)], "job_code string, text string")
    for _ in range(2):
        landing.write_raw_texts(df, path, "board-c", "2024-05-23")
    landing.write_raw_texts(df.limit(1), path, "board-c", "2024-05-24")
    got = {(r.job_code, r.text) for r in landing.read_raw_texts(spark, path, "board-c", "2024-05-23").collect()}
    assert got == {("c1", 'a "b"\n中'), ("c2", None)}


def test_backup_rerun_replaces_the_day(spark, tmp_path):
    recs = spark.createDataFrame(
        [("t", "c1", "co", "l", None, 1, 2, None, None, None, None, None, None, "s", ["x"])], S.RECORD)
    path = str(tmp_path / "b")
    landing.write_backup(recs, path, "board-a", "2024-05-22")
    for _ in range(2):
        landing.write_backup(recs, path, "board-a", "2024-05-23")
    assert landing.read_backup(spark, path).count() == 2


def test_visible_text_and_embedded_json(spark):
    page = ('<html lang="ja"><head><title>T &amp; U</title><script>var t="</p>";</script>'
            '<style>p{}</style></head><body><!-- c --><p>Hello <b>world</b></p>'
            '<input id="jobDetailJson" value="{&quot;k&quot;: 7}"></body></html>')
    pages = spark.createDataFrame([(1, "https://a.example/ja/1", page)], "page_id long, url string, html string")
    assert html.page_text(pages).first().text == "T & U Hello world"
    rec = html.page_record(pages).first()
    assert (rec.lang, rec.title, rec.n_paragraphs) == ("ja", "T & U", 1)
    doc = html.embedded_json(pages, "jobDetailJson", "k int").first().doc
    assert doc.k == 7


def test_positional_whole_file(spark, tmp_path):
    # the original dump: one JSON array of 15-slot arrays per file, numbers as
    # numbers and the category slot as a nested array
    rec = ["t", "c1", "co", "台北市", "月薪", 1, 2, None, None, "Go", None, None, None, "https://x", ["a", "b"]]
    (tmp_path / "jd_board_b_2024-05-23.json").write_text(json.dumps([rec, rec], ensure_ascii=False))
    back = landing.read_positional(spark, str(tmp_path), whole_file=True).collect()
    assert len(back) == 2
    r = back[0]
    assert (r.job_code, r.min_salary, r.max_salary, r.edu_level, r.job_category) == ("c1", 1, 2, None, ["a", "b"])


def test_positional_lines_roundtrip(spark, tmp_path):
    recs = spark.createDataFrame(
        [("t", "c1", "co", "l", None, 1, None, None, None, None, None, None, None, "s", ["x"])], S.RECORD)
    landing.records_to_positional(recs).write.text(str(tmp_path / "p"))
    assert rows(landing.read_positional(spark, str(tmp_path / "p"))) == rows(recs)


def _wordcloud_counts(texts, stop_words):
    """Brute force of the word-cloud library's frequency step (no
    collocations): findall, cut 's, drop digits and stop words, fold plurals,
    fuse spellings (ties: smaller string instead of first seen)."""
    import re
    from collections import Counter, defaultdict
    found = [w for t in texts for w in re.findall(r"\w[\w']*", t)]
    found = [w[:-2] if w.lower().endswith("'s") else w for w in found]
    found = [w for w in found if not w.isdigit()]
    stop = {s.lower() for s in stop_words}
    found = [w for w in found if w.lower() not in stop]
    d = defaultdict(Counter)
    for w in found:
        d[w.lower()][w] += 1
    for key in list(d):
        if key.endswith("s") and not key.endswith("ss") and key[:-1] in d:
            for w, c in d.pop(key).items():
                d[key[:-1]][w[:-1]] += c
    return sorted((min(cd.items(), key=lambda kv: (-kv[1], kv[0]))[0], sum(cd.values()))
                  for cd in d.values())


def test_terms_keep_cjk_and_case(spark):
    df = spark.createDataFrame([("Python,資料分析 python 2024 the Go",)], "text string")
    got = rows(terms.term_counts(df), "term", "n")
    assert got == [("Go", 1), ("Python", 2), ("資料分析", 1)]


def test_terms_fold_plurals_and_possessives(spark):
    df = spark.createDataFrame([("APIs api API's class classes bus's Java's SQLs",)], "text string")
    got = rows(terms.term_counts(df), "term", "n")
    # APIs -> API (singular key exists); SQLs stays (no 'sql'); class/classes differ
    assert got == [("API", 3), ("Java", 1), ("SQLs", 1), ("bus", 1), ("class", 1), ("classes", 1)]


def test_term_counts_equal_brute_force(spark):
    docs = B.read(spark, SMOKE, "documents").select("text")
    texts = [r.text for r in docs.collect()]
    got = rows(terms.term_counts(docs), "term", "n")
    assert got == _wordcloud_counts(texts, X.STOP_WORDS)


def test_listing_offsets_extra_page_on_multiple(spark):
    totals = spark.createDataFrame([("a", 30), ("b", 31), ("c", 0)], "cat string, total long")
    got = rows(landing.listing_offsets(totals), "cat", "page_offset")
    # 30 asks for an empty second page, as the original's n//30+1 does
    assert got == [("a", 0), ("a", 30), ("b", 0), ("b", 30), ("c", 0)]


def test_backup_to_a_scheme_qualified_uri(spark, tmp_path):
    # The writers take any Hadoop URI (s3a://, abfss://, hdfs://); a
    # file:// URI stands in for object storage here. Two sources, two days:
    # reads prune to one partition.
    recs = spark.createDataFrame(
        [("t", "c1", "co", "l", None, 1, 2, None, None, None, None, None, None, "s", ["x"])], S.RECORD)
    uri = f"file://{tmp_path}/backups"
    landing.write_backup(recs, uri, "board-a", "2024-05-23")
    landing.write_backup(recs, uri, "board-a", "2024-05-24")
    landing.write_backup(recs, uri, "board-b", "2024-05-23")
    back = landing.read_backup(spark, uri, source="board-a", load_date="2024-05-24").collect()
    assert [(r.job_code, r.source, str(r.snapshot_date)) for r in back] == [("c1", "board-a", "2024-05-24")]
    assert landing.read_backup(spark, uri).count() == 3


def _pages(spark, items):
    return spark.createDataFrame(
        [(c, p, None if n is None else ([(((f"/job/c{c}p{p}i{i}?"),),) for i in range(n)],)) for c, p, n in items],
        "c int, page int, data struct<list:array<struct<link:struct<job:string>>>>")


def test_listing_ends_at_the_first_empty_or_missing_page(spark):
    pages = _pages(spark, [
        (1, 1, 2), (1, 2, 1), (1, 3, 0), (1, 4, 2),  # an empty page
        (2, 1, 1), (2, 3, 1),                        # a missing page
        (3, 2, 1),                                   # no first page
        (4, 1, None), (4, 2, 1),                     # a page without a list
        (5, 1, 1), (5, 1, 0), (5, 2, 1),             # landed twice, filled once
        (6, 0, 1), (6, 1, 1), (6, None, 1), (None, 1, 1)])
    got = landing.until_first_empty(pages, ["c"])
    assert got.columns == pages.columns
    assert rows(got.where("size(data.list) > 0"), "c", "page") == [(1, 1), (1, 2), (2, 1), (5, 1), (5, 2), (6, 1)]
    codes = landing.page_codes(got, ["c", "page"])
    assert rows(codes.where("c = 1"), "pos", "job_code") == [(0, "c1p1i0"), (0, "c1p2i0"), (1, "c1p1i1")]
    assert landing.until_first_empty(pages.limit(0), ["c"]).count() == 0


def test_listing_end_against_a_crawl_loop(spark):
    import random
    rnd = random.Random(5)
    landed = {(c, p): rnd.choice([0, 1, 1, 1, 1, 1, 1]) for c in range(20) for p in range(1, 15) if rnd.random() > 0.05}
    want = set()
    for c in range(20):
        p = 1
        while landed.get((c, p)):
            want.add((c, p))
            p += 1
    got = landing.until_first_empty(_pages(spark, [(c, p, n) for (c, p), n in landed.items()]), ["c"])
    assert set(rows(got, "c", "page")) == want


def test_variant_fields_by_path(spark):
    def page(text):
        return f"<p>&amp;</p><input id=x value='{text}'>"
    df = spark.createDataFrame([
        (1, page('{"a":{"b":[1,{"c":"t"}]},"n":"12"}')), (2, page('{"a":[],"n":"many"}')), (3, page('{"a":{"b":null},"n":null}')),
        (4, page('{"a":')), (5, "<p>none</p>"), (6, None), (7, page("[1,2]")), (8, "<input value='{}' id='&#120;'>"),
        (9, page("{&amp;quot;n&amp;quot;:3}"))], "page_id int, html string")
    docs = html.embedded_variant(df, "x")
    got = html.variant_fields(docs, {"c": ("$.a.b[1].c", "string"), "n": ("$.n", "bigint")}, ["page_id", "malformed"])
    assert rows(got, "page_id", "c", "n", "wrong") == [
        (1, "t", 12, ""), (2, None, None, "n"), (3, None, None, ""), (4, None, None, ""), (5, None, None, ""),
        (6, None, None, ""), (7, None, None, ""), (8, None, None, ""), (9, None, 3, "")]
    assert {r.page_id: r.malformed for r in got.collect() if r.malformed is not None} == {4: '{"a":'}


def test_plain_pages_give_the_standard_parsers_tree(monkeypatch):
    """Pages of plain tags are read without the standard parser; whatever is read so has the tree that it gives."""
    import random

    from jobsift.sources import dom

    def tree(e):
        return [c if isinstance(c, str) else (c.tag, c.attrs, c.classes, c.place, tree(c)) for c in e.children]

    def standard(html):
        b = dom._Builder()
        b.feed(html)
        b.close()
        return b.root

    bits = ["<div>", "</div>", "<p class='a  b'>", "</p>", '<A HREF="Q" id="x">', "</a >", "<br>", "<br/>", "text", "&amp;", "&am", "a&b",
            "<", ">", '"', "<!-- c -->", "<!---->", "<!--->", "<!DOCTYPE html>", "<?x?>", "<script>", "</script>", "<title>", "</title>",
            '<a href="x&amp;y">', '<a href="x>y">', "<a href=x>", "<a b='1' b>", "<a b='1'c='2'>", "<div/>", "</a b>", "\n", "</>"]
    draw, plain = random.Random(5), 0
    for _ in range(20000):
        page = "".join(draw.choice(bits) for _ in range(draw.randint(1, 8)))
        quick = dom._plain(page)
        plain += quick is not None
        assert tree(dom.parse(page)) == tree(standard(page)), page
    assert plain > 1000

    page = '<!doctype html><html><h1 class="t">A&amp;B</h1><script>x & y</script><p>c<br>d</html>'
    want = tree(standard(page))
    monkeypatch.setattr(dom, "_Builder", None)
    assert tree(dom.parse(page)) == want and dom.parse(page).first("h1", "t").text() == "A&B"
