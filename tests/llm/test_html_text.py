import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsift.llm.html_text import extract, visible_text

CASES = {
    "paragraphs": ("<p>One<p>Two <b>bold</b>\n text<div>Three</div>Four", "One\n\nTwo bold text\n\nThree\nFour"),
    "unclosed bold": ("<p><b>Head.<br><p>Next.</p>", "Head.\n\nNext."),
    "breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "entities": ("<p>a &amp; b &lt;c&gt; &eacute;&#233;&#xe9;&nbsp;x", "a & b <c> ééé\xa0x"),
    "hidden": ('<head><title>T</title></head><script>var t="</p>";</script><p hidden>no</p><p style="display: none">no</p>'
               '<p style="visibility:hidden">no</p><template>no</template><noscript>no</noscript>yes<input value="no">', "yes"),
    "style sheet": ("<style>.ad, #x{display:none} p.y{visibility:hidden}</style><div class='big ad'>no</div><p id=x>no</p>"
                    "<p class=y>no</p><div class=y>yes</div>", "yes"),
    "media": ("<style>@media print{.note{display:none}} @media (max-width:600px){.side,nav{display:none}} @media screen and "
              "(min-width:600px){.m{display:none}} @keyframes k{from{display:none}}</style><style media=print>b{display:none}"
              "</style><noscript><style>i{display:none}</style></noscript><p class=note>a<p class=side>b<p class=m>no"
              "<p><b>c</b><i>d</i>", "a\n\nb\n\ncd"),
    "more specific": ("<style>.tab.active{display:block} .tab{display:none} #x .y{display:none} div>.z{display:none}"
                      ".hidden{display:none} @media(min-width:768px){.md\\:block{display:block}}</style><p class=tab>no"
                      "<p class='tab active'>a<p class=y>b<p class=z>c<div id=x><i><b class=y>no</b></i></div>"
                      "<div><b class=z>no</b></div><div class='hidden md:block'>d</div>", "a\n\nb\n\nc\n\nd"),
    "siblings and states": ("<style>.p{display:none} #t:checked ~ .p{display:block} li:not(:first-child){display:none}"
                            "h1+p{display:none} a[rel=x]:hover{display:none}</style><input id=t checked><div class=p>a</div>"
                            "<ul><li>b<li>no</ul><h1>c</h1><p>no<p><a rel=x>d</a>", "a\n\n- b\n\nc\n\nd"),
    "inline over sheet": ("<style>.a{display:none} .b{display:none!important} .c{visibility:hidden}</style>"
                          "<p class=a style='display:block'>a<p class=b style='display:block'>no<p hidden style='display:block'>b"
                          "<p class=c>no <b style='visibility:visible'>c</b>", "a\n\nb\n\nc"),
    "drawings and formulas": ("x<svg><title>no</title><defs/><path d=''/>no<text>A</text><text>B<tspan>C</tspan></text></svg>"
                              "<math><semantics><mi>y</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></semantics></math>"
                              "<svg><g><p>after", "x\nA\nBC\ny=1\n\nafter"),
    "details": ("<details><summary>Sum</summary>no</details><details open><summary>S</summary>yes</details>",
                "Sum\nS\nyes"),
    "lists": ("<ul><li>one<li>two<ol start=3><li>x<li value=7>y<li>z</ol><li>three</ul>",
              "- one\n- two\n  3. x\n  7. y\n  8. z\n- three"),
    "list of paragraphs": ("<ol><li><p>a</p><p>b</p></li></ol>", "1. a\n\n   b"),
    "definitions": ("<dl><dt>A<dd>a<dt>B<dd>b</dl>", "A\n  a\nB\n  b"),
    "preformatted": ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"),
    "headings": ("<h1>T</h1>x<h2>U</h2>y", "T\n\nx\n\nU\n\ny"),
    "table": ("<table><tr><th>Name<th>Qty<tr><td>apple<td align=right>7<tr><td>fig<td align=right>120</table>",
              "Name   Qty\napple    7\nfig    120"),
    "groups": ("<table><tfoot><tr><td>f<tbody><tr><td>b<thead><tr><td>h<caption>cap</caption></table>", "cap\nh\nb\nf"),
    "spans": ("<table><tr><td rowspan=2>a<td>b<td>c<tr><td colspan=2>wide</table>", "a  b  c\n   wide"),
    "lines in cells": ("<table><tr><td>a<br>bb<td>c</table>", "a   c\nbb"),
    "nested": ("<table><tr><td>x<table><tr><td>1<td>2</table><td>y</table>", "x     y\n\n1  2"),
    "text between cells": ("<table>stray<tr><td>a</table>", "stray\n\na"),
    "blocks between rows": ("<table><tr><td>a</td></tr><div>note</div><tr><td>b</table>", "note\n\na\nb"),
    "inline in a row": ("<table><tr><b>x</b> y<td>a<td>b</table>", "x y\n\na  b"),
    "center in a table": ("<table><center>text <i>it</i></center><thead><tr><td>h</thead><tr><td>a</table>", "text it\n\nh\na"),
    "group after an open element": ("<table><div>note<tbody><tr><td>a</table>", "note\n\na"),
    "table in a row": ("<table><tr><td>a</td><table><tr><td>1<td>2</table>", "a\n\n1  2"),
    "form between rows": ("<table><form><tr><td>a<td>b</form></table>c", "a  b\n\nc"),
    "lists between cells": ("<ul><li>p<table><tr><li>q<td>a</table></ul>", "- p\n  q\n\n  a"),
    "ends between cells": ("<div>x<table><tr></div><td>a<td>b</table></div>", "x\n\na  b"),
    "cell without row": ("<table><td>a<td>b</table>", "a  b"),
    "cell without table": ("<td>a</td>b", "ab"),
    "stray ends": ("</p></div>a</b></td>", "a"),
    "empty": ("", ""), "null": (None, ""), "comment": ("a<!-- b -->c<!DOCTYPE x>", "ac"),
    "wide characters": ("<table><tr><td>日本<td>x<tr><td>a<td>y</table>", "日本  x\na     y"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    html, want = CASES[name]
    assert visible_text(html) == want


def test_deep_and_long():
    assert visible_text("<div>" * 50_000 + "x" + "</div>" * 50_000) == "x"
    assert visible_text("<ul><li>" * 5_000 + "x").endswith("x")
    assert len(visible_text("<p>word " * 100_000)) == 6 * 100_000 - 2


def test_depth_changes_nothing():
    page = ("<p>a<script>no()</script><style>.x{display:none}</style><p hidden>no<p class=x>no<b style='display:none'>no</b>"
            "<details><summary>s</summary>no</details><template>no</template><table><tr><td>1<td>2<tr><td>3<td>4</table>"
            "<ol><li>m<li>n</ol><pre>p  q\n r</pre>")
    want = visible_text(page)
    assert "no" not in want and "1. m" in want
    for tag in ("div", "span", "font", "section"):
        assert visible_text(f"<{tag}>" * 3000 + page) == want
        assert visible_text(f"<{tag}>" * 200 + page + f"</{tag}>" * 200 + "z").endswith("z")


def test_depth_of_lists_and_tables():
    """Marks, rows and cells stay past the indented levels, in a size that goes with the page's."""
    text = visible_text("".join(f"<ul><li>x{k}<li hidden>no<li>" for k in range(20_000)))
    assert [line.split("- ")[-1] for line in text.split("\n")] == [f"x{k}" for k in range(20_000)]
    assert text.count("- ") == 39_999 and len(text) < 20_000 * 250
    text = visible_text("".join(f"<table><tr><td>a{k}<td hidden>no<td>b{k}<tr><td>" for k in range(2000)))
    assert text.split() == [f"{c}{k}" for k in range(2000) for c in "ab"]
    assert visible_text("<dl><dd>" * 5000 + "x<select><option>y").split() == ["x", "y"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    "<p> </p> <div> </div> <b> </b> <table> <tr> <td> </td> </tr> </table> <ul> <li> </ul> <ol> <br> <pre> </pre> <dl> <dd> "
    "<thead> <tbody> </tbody> <h1> </h1> <caption> <select> <option> <details> <style> </style> < > & &am w1 w2 w3".split()),
    max_size=40))
def test_never_fails_and_lays_lines_out(parts):
    text = visible_text(" ".join(parts))
    assert text == "" or text.split("\n")[0].strip()


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = extract(pages)
    assert got.columns == ["page_id", "url", "text"] and got.count() == pages.count()
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in got.collect():
        assert "track(" not in r.text and "<p>" not in r.text and "margin:0" not in r.text
        if raw[r.page_id] and "<li><a" in raw[r.page_id]:
            assert r.text.startswith("- ")


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "t"), (1, None, "t"), (None, "", "u"), (2, "<p>x", None)],
                               "page_id long, html string, text string")
    got = extract(df)
    assert got.columns == ["page_id", "text", "__text"]
    assert sorted(r["__text"] for r in got.collect()) == ["", "", "", "x"]
    assert extract(df.limit(0)).count() == 0


def test_spans_cost_what_their_cells_do():
    import time

    began = time.perf_counter()
    page = "<table><tr>" + "<td colspan=1000 rowspan=65534>x" * 400 + "<tr><td>y" * 400 + "</table>"
    assert visible_text(page).split() == ["x"] * 400 + ["y"] * 400
    ragged = "<table>" + "".join("<tr>" + "".join(f"<td rowspan={2 + (i * j) % 7}>c" for j in range(60)) for i in range(60)) + "</table>"
    assert visible_text(ragged).split() == ["c"] * 3600
    assert time.perf_counter() - began < 5


@pytest.mark.parametrize("page", [
    "<table><tr><td>" + "w" * 40_000 + "</td><td>b</td></tr>" + "<tr><td>a</td><td>b</td></tr>" * 1000 + "</table>",
    "<table><tr>" + "<td rowspan=900>" + "</td><td rowspan=900>".join(["w" * 70] * 200) + "</td></tr>" + "<tr><td>y" * 500 + "</table>",
    "<table><tr><td>a</td><td>" * 60 + "<br>".join("x" * 200) + "</table>" * 60,
])
def test_output_is_at_most_a_multiple_of_the_page(page):
    text = visible_text(page)
    assert len(text) <= 40 * len(page)
    assert text.replace(" ", "").replace("\n", "") == re.sub(r"<[^>]*>|\s", "", page)


def test_columns_below_a_long_cell_stay_aligned():
    long = "w" * 200
    assert visible_text(f"<table><tr><td>{long}<td>b<tr><td>aaa<td>b<tr><td>a<td>b</table>").split("\n") == [
        f"{long} b", "aaa  b", "a    b"]
