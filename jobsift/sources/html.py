"""HTML pages -> rows.

Rules on single tags are regular expressions evaluated JVM-side; rules that
name elements by class and position read a small tree (``dom``) in an Arrow UDF.
Listing pages give links and codes (S4, S6), detail pages give a title,
label/value pairs and visible text (S5, S7), and some pages carry a JSON
document inside an attribute (S8). Each page is processed whole; no page
is truncated.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift import schema as S
from jobsift.functions import text as X
from jobsift.sources import dom


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Every anchor href, entity-decoded, with its position on the page."""
    return (pages.select(id_col, F.posexplode(X.html_hrefs(html_col)).alias("pos", "href"))
            .withColumn("href", X.unescape_html("href")))


def link_codes(links: DataFrame, pattern: str, href_col: str = "href", group: int = 1) -> DataFrame:
    """Codes captured from links; links without a match are dropped."""
    return (links.withColumn("job_code", X.extract_code(href_col, pattern, group))
            .where(F.col("job_code").isNotNull()))


def page_record(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """S5 for generic pages: one record of named fields per page."""
    h = F.col(html_col)
    return pages.select(
        id_col,
        X.html_attr(h, "html", "lang").alias("lang"),
        X.html_element_text(h, "title").alias("title"),
        X.html_element_text(h, "h1").alias("heading"),
        X.html_element_text(h, "footer").alias("footer"),
        F.size(X.html_hrefs(h)).cast("bigint").alias("n_links"),
        F.size(F.regexp_extract_all(h, F.lit(r"(?i)<p\b"), 0)).cast("bigint").alias("n_paragraphs"),
        X.extract_code(F.col(url_col), r"^https?://([^/?#]+)", 1).alias("host"),
    )


def page_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Visible text of each page."""
    return pages.select(id_col, X.visible_text(html_col).alias("text"))


def url_parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """F6 on URLs: host, language segment and numeric code of each page URL."""
    u = F.col(url_col)
    return pages.select(
        id_col,
        X.extract_code(u, r"^https?://([^/?#]+)", 1).alias("host"),
        X.extract_code(u, r"/([a-z]{2})/[0-9]+", 1).alias("lang"),
        X.extract_code(u, r"/[a-z]{2}/([0-9]+)", 1).cast("bigint").alias("code"),
    )


def article_links(pages: DataFrame, article_class: str = S.ARTICLE_CLASS,
                  title_class: str = S.ARTICLE_TITLE_CLASS, keep=("page_id",), html_col: str = "html") -> DataFrame:
    """S4 on a listing page: the first link in the title of every article
    block, in page order; other links of the page are not postings."""

    @F.pandas_udf("array<string>")
    def links(htmls: pd.Series) -> pd.Series:
        def one(h):
            titles = [a.first(cls=title_class) for a in dom.parse(h or "").all("div", article_class)]
            found = [t.first("a") for t in titles if t is not None]
            return [a.attrs["href"] for a in found if a is not None and "href" in a.attrs]
        return htmls.map(one)

    return pages.select(*keep, F.posexplode(links(html_col)).alias("pos", "href"))


def container_text(pages: DataFrame, container_class: str, tag: str = "div", sep: str = "", id_col: str = "page_id",
                   html_col: str = "html") -> DataFrame:
    """Text of the first ``tag`` with the class: its pieces stripped and
    joined by ``sep`` (none, as the original does); NULL without the container."""

    @F.pandas_udf("string")
    def text(htmls: pd.Series) -> pd.Series:
        found = htmls.map(lambda h: dom.parse(h or "").first(tag, container_class))
        return found.map(lambda e: None if e is None else e.stripped(sep))

    return pages.select(id_col, text(html_col).alias("text"))


def detail_records(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                   code_pattern: str = S.CODE_PATTERNS["html_board"]) -> DataFrame:
    """S5 + F8 + F9 + F10: HTML detail pages -> canonical records.

    One page is one row throughout: its title (``h1.job-title``), company
    (first span of the company box) and the label/value pairs of the detail
    box come from the page's tree in one Arrow UDF, with no shuffle. The value
    of a label is the next ``div`` among its later siblings; of a label that
    repeats, the last one holds. Pay text yields (min, max) or (0, 0).
    """

    labels = list(S.DETAIL_LABELS)
    names = ["title", "company", *[f"v{i}" for i in range(len(labels))]]

    @F.pandas_udf(", ".join(f"{n} string" for n in names))
    def fields(htmls: pd.Series) -> pd.DataFrame:
        def one(h):
            root = dom.parse(h or "")
            title, box = root.first("h1", S.JOB_TITLE_CLASS), root.first("div", S.COMPANY_CLASS)
            company = box.first("span") if box is not None else None
            pairs = {}
            for detail in root.all("div", S.DETAIL_BOX_CLASS):
                for wrapper in detail.all("div", S.DETAIL_PART_CLASS):
                    for label in wrapper.all(cls=S.DETAIL_LABEL_CLASS):
                        value = label.later_sibling("div")
                        if value is not None:
                            pairs[label.text()] = value.text()
            return (title.text() if title is not None else None, company.text() if company is not None else None,
                    *[pairs.get(x) for x in labels])
        return pd.DataFrame([one(h) for h in htmls], columns=names, dtype=object)

    p = pages.select(url_col, fields(html_col).alias("_f"))
    f = {S.DETAIL_LABELS[label]: F.col(f"_f.v{i}") for i, label in enumerate(labels)}
    pay = X.parse_monthly_range(f["salary_period"])
    return p.select(
        F.col("_f.title").alias("job_title"),
        X.extract_code(url_col, code_pattern, 1).alias("job_code"),
        F.col("_f.company").alias("company_name"),
        f["job_location"].alias("job_location"),
        f["salary_period"].alias("salary_period"),
        pay["min_salary"].alias("min_salary"),
        pay["max_salary"].alias("max_salary"),
        f["edu_level"].alias("edu_level"),
        f["work_experience"].alias("work_experience"),
        f["skills"].alias("skills"),
        f["travel"].alias("travel"),
        f["management"].alias("management"),
        F.lit(None).cast("string").alias("remote"),
        F.col(url_col).alias("job_source"),
        F.split(f["job_category"], S.CATEGORY_SEPARATOR).alias("job_category"),
    )


def _held_value(element_id: str):
    """Arrow UDF: the attribute ``value`` of a page's first element with the id, entities decoded once more
    after the parser (pages carry the JSON escaped twice); NULL without the element or the attribute."""

    @F.pandas_udf("string")
    def value(htmls: pd.Series) -> pd.Series:
        def one(h):
            if not h or (element_id not in h and "&" not in h):
                return None
            found = (e for e in dom.parse(h).walk() if e.attrs.get("id") == element_id)
            held = next((e.attrs.get("value") for e in found), None)
            return None if held is None else X.unescaped(held)
        return htmls.map(one)

    return value


def embedded_json(pages: DataFrame, element_id: str, schema, html_col: str = "html") -> DataFrame:
    """JSON held in the attribute ``value`` of the element with
    ``id=element_id``, whatever the order and quotes of its attributes,
    entity-unescaped, then parsed (NULL when malformed)."""
    return pages.withColumn("doc", F.from_json(_held_value(element_id)(html_col), schema))


def embedded_variant(pages: DataFrame, element_id: str, html_col: str = "html") -> DataFrame:
    """S8/F26 without a schema: the document as VARIANT in ``doc``; text that is no JSON stands in
    ``malformed`` (NULL otherwise), so no page is lost. Pages without the element have neither."""
    held = pages.withColumn("_held", _held_value(element_id)(html_col))
    return (held.withColumn("doc", F.try_parse_json("_held"))
            .withColumn("malformed", F.when(F.col("doc").isNull(), F.col("_held"))).drop("_held"))


def variant_fields(df: DataFrame, fields: dict, keep=("page_id",), doc_col: str = "doc") -> DataFrame:
    """Fields of a VARIANT document: ``fields`` maps a name to (JSON path, type). A missing field, a JSON null and a
    value of another type are NULL; ``wrong`` lists the names of the latter, comma-joined ('' for none)."""
    typed = {name: F.try_variant_get(doc_col, path, kind) for name, (path, kind) in fields.items()}
    there = {name: F.try_variant_get(doc_col, path, "variant") for name, (path, _) in fields.items()}
    wrong = [F.when(there[n].isNotNull() & ~F.is_variant_null(there[n]) & typed[n].isNull(), F.lit(n)) for n in fields]
    return df.select(*keep, *[c.alias(n) for n, c in typed.items()], F.concat_ws(",", *wrong).alias("wrong"))
