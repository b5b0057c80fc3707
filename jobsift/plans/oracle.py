"""DuckDB SQL oracles.

Each oracle restates a query independently in plain SQL over the driver's
tables (pre-registered as views). The posting tables are derived by the CTEs
below, which mirror ``jobsift.bindings`` expression by expression.
"""

from __future__ import annotations

from jobsift import bindings as B
from jobsift.functions.text import STOP_WORDS

CTE = {}

CTE["job"] = """job AS (
  SELECT 'j' || CAST(o.o_orderkey AS VARCHAR) AS job_code,
         concat_ws(' ', o.o_orderpriority, c.c_mktsegment) AS job_title,
         c.c_name AS company_name,
         concat_ws(' ', r.r_name, n.n_name) AS job_location,
         CASE WHEN o.o_orderkey % 11 = 0 THEN '待遇面議'
              WHEN o.o_orderkey % 23 = 0 THEN NULL
              WHEN o.o_orderstatus = 'F' THEN '年薪'
              WHEN o.o_orderstatus = 'P' THEN '時薪'
              WHEN o.o_orderkey % 29 = 0 THEN '面議 年薪'
              ELSE '月薪' END AS salary_period,
         CAST(CASE WHEN o.o_orderkey % 13 = 0 THEN 0
                   ELSE floor(o.o_totalprice * 0.5) END AS BIGINT) AS min_salary,
         CAST(CASE WHEN o.o_orderkey % 13 = 0 THEN 0
                   WHEN o.o_orderkey % 17 = 0 THEN 9999999
                   ELSE floor(o.o_totalprice) END AS BIGINT) AS max_salary,
         CASE WHEN o.o_orderkey % 19 = 0 THEN NULL ELSE o.o_orderpriority END AS edu_level,
         CAST(NULL AS VARCHAR) AS work_experience,
         concat_ws(',', c.c_mktsegment, o.o_orderstatus) AS skills,
         CAST(NULL AS VARCHAR) AS travel,
         CAST(NULL AS VARCHAR) AS management,
         CAST(NULL AS VARCHAR) AS remote,
         'https://www.' || lower(replace(r.r_name, ' ', '')) || '.example/'
           || CAST(o.o_orderkey AS VARCHAR) AS job_source,
         CAST(o.o_orderdate AS TIMESTAMP) AS create_date
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CTE["job_category"] = """job_category AS (
  SELECT 'j' || CAST(l.l_orderkey AS VARCHAR) AS job_code, p.p_type AS job_category
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

CTE["listing"] = """listing AS (
  SELECT 'j' || CAST(l.l_orderkey AS VARCHAR) AS job_code,
         CAST(list_position(['ECONOMY','LARGE','MEDIUM','SMALL','STANDARD'], p.p_type) AS INTEGER)
           AS category_pos,
         CAST(l.l_linenumber AS INTEGER) AS page,
         l.l_partkey AS pos
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE p.p_type IN ('ECONOMY','LARGE','MEDIUM','SMALL','STANDARD'))"""

CTE["users"] = """users AS (
  SELECT c_custkey AS id, c_name AS name,
         CASE WHEN c_acctbal < 0 THEN replace(c_name, '#', '.') ELSE lower(replace(c_name, '#', '.')) END
           || '@' || lower(c_mktsegment) || '.example.com' AS email,
         CASE WHEN c_acctbal > 9000 THEN substring(c_name, 1, 5) ELSE c_name END AS password
  FROM customer)"""

CTE["toggles"] = """toggles AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id,
         'j' || json_extract_string(props, '$.k') AS job_code
  FROM events WHERE event_type = 'click')"""

CTE["bookmarks"] = """bookmarks AS (
  SELECT user_id, job_code FROM toggles GROUP BY user_id, job_code HAVING count(*) % 2 = 1)"""

CTE["stored"] = f"""stored AS (
  SELECT * FROM job WHERE create_date < TIMESTAMP '{B.SYNC_CUTOFF}')"""

CTE["batch"] = f"""batch AS (
  SELECT * REPLACE (TIMESTAMP '{B.SYNC_LOAD_DATE}' AS create_date) FROM job
  WHERE contains(job_source, '{B.SYNC_SITE}') AND create_date >= TIMESTAMP '{B.SYNC_BATCH_FROM}')"""

_DEPS = {"stored": ["job"], "batch": ["job"], "bookmarks": ["toggles"]}


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body


TRACKED = ["ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD"]
TRACKED_SQL = "('ECONOMY','LARGE','MEDIUM','SMALL','STANDARD')"
REGIONS_SQL = "('AFR','AME','ASI','EUR')"
EDU_SQL = "('1-','2-','3-','4-')"
STOP_SQL = "(" + ",".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + ")"

PAID = """(min_salary != 0 OR max_salary != 0) AND max_salary != 9999999
    AND salary_period != '待遇面議' AND LEFT(job_location, 3) IN """ + REGIONS_SQL
NOT_YEARLY_HOURLY_ANY = "NOT (salary_period LIKE '%年薪%' OR salary_period LIKE '%時薪%')"
NOT_YEARLY_HOURLY_PREFIX = "NOT (salary_period LIKE '年薪%' OR salary_period LIKE '時薪%')"
AVG = "CAST(ROUND(AVG((min_salary + max_salary) / 2), 0) AS BIGINT)"


def history_cte(name: str, jobs: str) -> str:
    cols = ",\n  ".join(
        f"COUNT(DISTINCT CASE WHEN jc.job_category = '{c}' THEN j.job_code END) AS {c.lower()}" for c in TRACKED)
    return f"""{name} AS (
  SELECT CAST(j.create_date AS DATE) AS date, COUNT(DISTINCT j.job_code) AS total_post,
  {cols}
  FROM {jobs} j LEFT JOIN job_category jc ON j.job_code = jc.job_code
  GROUP BY 1)"""


CTE["history"] = history_cte("history", "job")
_DEPS["history"] = ["job", "job_category"]
CTE["synced"] = """synced AS (
  SELECT * FROM stored WHERE job_code NOT IN (SELECT job_code FROM batch)
    AND NOT contains(job_source, 'www.asia')
  UNION ALL SELECT * FROM batch)"""
_DEPS["synced"] = ["stored", "batch"]
CTE["cat_set"] = """cat_set AS (
  SELECT DISTINCT job_code, job_category FROM (
    SELECT * FROM job_category WHERE job_code IN (SELECT job_code FROM stored)
    UNION ALL SELECT * FROM job_category WHERE job_code IN (SELECT job_code FROM batch)))"""
_DEPS["cat_set"] = ["stored", "batch", "job_category"]


def _rules_sql() -> str:
    req = ["job_code", "job_title", "company_name", "job_location", "job_source", "create_date"]
    txt = ["job_code", "job_title", "company_name", "job_location", "salary_period", "edu_level",
           "work_experience", "skills", "travel", "management", "remote", "job_source"]
    parts = [f"CASE WHEN {c} IS NULL THEN 'null_{c}' END" for c in req]
    parts += [f"CASE WHEN coalesce(length({c}) > 255, false) THEN 'long_{c}' END" for c in txt]
    return "concat_ws(',', " + ", ".join(parts) + ")"


CTE["tagged"] = f"tagged AS (SELECT *, {_rules_sql()} AS reasons FROM job)"
_DEPS["tagged"] = ["job"]
CTE["faulty"] = f"""faulty AS (
  SELECT *, {_rules_sql()} AS broken FROM (
    SELECT * REPLACE (CASE WHEN CAST(substr(job_code, 2) AS BIGINT) % 31 = 0 THEN repeat(job_title, 40) ELSE job_title END
                        AS job_title,
                      CASE WHEN CAST(substr(job_code, 2) AS BIGINT) % 37 <> 0 THEN job_source END AS job_source,
                      unnest(CASE WHEN CAST(substr(job_code, 2) AS BIGINT) % 41 = 0
                        THEN [create_date, TIMESTAMP '{B.SYNC_LOAD_DATE}'] ELSE [create_date] END) AS create_date)
    FROM job))"""
_DEPS["faulty"] = ["job"]

CTE["records"] = """records AS (
  SELECT b.job_code, b.job_title, b.min_salary, b.max_salary,
         COALESCE((SELECT string_agg(DISTINCT jc.job_category, '|' ORDER BY jc.job_category)
                   FROM job_category jc WHERE jc.job_code = b.job_code), '') AS categories
  FROM job b)"""
_DEPS["records"] = ["job", "job_category"]

SEARCH_COLS = "job_title, company_name, job_location, salary_period, job_source, job_code"
EXCLUDE_ANY = "NOT (salary_period LIKE '%年薪%' OR salary_period LIKE '%時薪%' OR salary_period LIKE '%待遇面議%')"
KW = "(job_title LIKE '%BUILDING%' OR company_name LIKE '%BUILDING%' OR job_location LIKE '%BUILDING%' OR skills LIKE '%BUILDING%')"
GROUPED = f"{EXCLUDE_ANY} AND {KW} AND min_salary > 100000 AND job_location LIKE '%ASIA%'"


def _terms(source: str, by: str | None = None, weight: str = "1") -> str:
    """Word-cloud frequencies ``(by, term, n)`` of ``source``'s ``text``:
    words in original case, trailing 's cut, digits-only and stop words
    dropped, a plural key folded into its singular key when that occurs in
    the group, the most frequent spelling shown (ties: smaller string)."""
    g = f"{by}, " if by else ""
    cg = f"c.{by}, " if by else ""
    on = f" AND k.{by} = c.{by}" if by else ""
    return f"""(WITH w0 AS (
  SELECT {g}unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_'']*', 0)) AS word,
         {weight} AS wt
  FROM ({source})),
w1 AS (
  SELECT {g}CASE WHEN ends_with(lower(word), '''s') THEN left(word, length(word) - 2) ELSE word END AS word, wt
  FROM w0),
cnt AS (
  SELECT {g}word, SUM(wt) AS c FROM w1
  WHERE NOT regexp_matches(word, '^\\p{{Nd}}+$') AND lower(word) NOT IN {STOP_SQL}
  GROUP BY {g}word),
keys AS (SELECT DISTINCT {g}lower(word) AS key FROM cnt),
mapped AS (
  SELECT {cg}CASE WHEN k.key IS NOT NULL THEN k.key ELSE lower(c.word) END AS key,
         CASE WHEN k.key IS NOT NULL THEN left(c.word, length(c.word) - 1) ELSE c.word END AS word,
         c.c
  FROM cnt c LEFT JOIN keys k
    ON k.key = CASE WHEN ends_with(lower(c.word), 's') AND NOT ends_with(lower(c.word), 'ss')
                    THEN left(lower(c.word), length(c.word) - 1) END{on}),
spell AS (SELECT {g}key, word, SUM(c) AS c FROM mapped GROUP BY {g}key, word)
SELECT {g}first(word ORDER BY c DESC, word) AS term, CAST(SUM(c) AS BIGINT) AS n
FROM spell GROUP BY {g}key)"""


def _visible(x: str) -> str:
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<script\\b[^>]*>.*?</script>', ' ', 'g')"
    x = f"regexp_replace({x}, '(?is)<style\\b[^>]*>.*?</style>', ' ', 'g')"
    x = f"regexp_replace({x}, '<[^>]*>', ' ', 'g')"
    return f"trim(regexp_replace({_unescape(x)}, '\\s+', ' ', 'g'))"


def _unescape(x: str) -> str:
    for a, b in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
                 ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def _element(tag: str) -> str:
    inner = f"regexp_extract(html, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}>', 1)"
    inner = f"regexp_replace({inner}, '<[^>]*>', ' ', 'g')"
    return f"nullif(trim(regexp_replace({_unescape(inner)}, '\\s+', ' ', 'g')), '')"


HREF_RE = """(?i)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*("[^"]*"|''[^'']*'')"""
PAY_RE = "月薪 (\\d{1,3}(?:,\\d{3})*) 至 (\\d{1,3}(?:,\\d{3})*)"

SQL: dict[str, str] = {}

# --- dashboard aggregates ------------------------------------------------------

SQL["region_salary"] = with_ctes(f"""
SELECT LEFT(job_location, 3) AS region, {AVG} AS region_average
FROM job LEFT JOIN job_category ON job.job_code = job_category.job_code
WHERE {PAID} AND {NOT_YEARLY_HOURLY_ANY}
GROUP BY 1 ORDER BY region_average DESC""", "job", "job_category")

SQL["region_salary_for_category"] = with_ctes(f"""
SELECT LEFT(job_location, 3) AS region, {AVG} AS region_average
FROM job LEFT JOIN job_category ON job.job_code = job_category.job_code
WHERE {PAID} AND {NOT_YEARLY_HOURLY_PREFIX} AND job_category = 'LARGE'
GROUP BY 1 ORDER BY region_average DESC""", "job", "job_category")

SQL["region_salary_by_category"] = with_ctes(f"""
SELECT job_category, LEFT(job_location, 3) AS region, {AVG} AS region_average
FROM job JOIN job_category ON job.job_code = job_category.job_code
WHERE {PAID} AND {NOT_YEARLY_HOURLY_PREFIX}
GROUP BY 1, 2""", "job", "job_category")

SQL["category_salary"] = with_ctes(f"""
SELECT job_category, {AVG} AS category_average
FROM job LEFT JOIN job_category ON job.job_code = job_category.job_code
WHERE job_category IN {TRACKED_SQL} AND {PAID} AND {NOT_YEARLY_HOURLY_ANY}
GROUP BY 1 ORDER BY category_average DESC""", "job", "job_category")

SQL["edu_distribution"] = with_ctes(f"""
SELECT min_edu_level, count, CAST(count AS DOUBLE) / CAST(SUM(count) OVER () AS DOUBLE) AS share
FROM (SELECT LEFT(edu_level, 2) AS min_edu_level, COUNT(*) AS count FROM job
      WHERE edu_level IS NOT NULL AND LEFT(edu_level, 2) IN {EDU_SQL} GROUP BY 1)""", "job")

SQL["edu_distribution_by_category"] = with_ctes(f"""
SELECT job_category, min_edu_level, count,
       CAST(count AS DOUBLE) / CAST(SUM(count) OVER (PARTITION BY job_category) AS DOUBLE) AS share
FROM (SELECT job_category, LEFT(edu_level, 2) AS min_edu_level, COUNT(*) AS count
      FROM job LEFT JOIN job_category ON job.job_code = job_category.job_code
      WHERE job_category IS NOT NULL AND edu_level IS NOT NULL AND LEFT(edu_level, 2) IN {EDU_SQL}
      GROUP BY 1, 2)""", "job", "job_category")

# --- history -------------------------------------------------------------------

_snap_cols = ",\n  ".join(f"count(*) FILTER (job_category = '{c}') AS {c.lower()}" for c in TRACKED)
SQL["posting_snapshot"] = with_ctes(f"""
, pairs AS (SELECT DISTINCT j.job_code, jc.job_category
            FROM job j LEFT JOIN job_category jc ON jc.job_code = j.job_code)
SELECT DATE '{B.SYNC_LOAD_DATE}' AS date, count(DISTINCT job_code) AS total_post, {_snap_cols}
FROM pairs""".lstrip(), "job", "job_category")

SQL["posting_history"] = with_ctes("SELECT * FROM history", "history")

SQL["posting_share_series"] = with_ctes("""
SELECT total_post - large AS others, large AS chose_cat, date FROM history
ORDER BY date DESC LIMIT 7""", "history")

SQL["posting_share_lists"] = with_ctes("""
SELECT list(others ORDER BY date DESC) AS others, list(chose_cat ORDER BY date DESC) AS chose_cat,
       list(strftime(date, '%Y-%m-%d') ORDER BY date DESC) AS dates
FROM (SELECT total_post - large AS others, large AS chose_cat, date FROM history
      ORDER BY date DESC LIMIT 7)""", "history")

SQL["posting_total_series"] = with_ctes("""
SELECT total_post - total_post AS others, total_post AS chose_cat, date FROM history
ORDER BY date DESC LIMIT 7""", "history")

_long = " UNION ALL ".join(f"SELECT date, '{c.lower()}' AS category, {c.lower()} AS posts FROM history"
                           for c in TRACKED)
SQL["posting_long"] = with_ctes(_long, "history")

SQL["posting_delta"] = with_ctes(f"""
SELECT date, category, posts, posts - lag(posts) OVER (PARTITION BY category ORDER BY date) AS delta
FROM ({_long})""", "history")

CTE["old_history"] = history_cte("old_history", "stored")
_DEPS["old_history"] = ["stored", "job_category"]
_counters = ",\n  ".join(f"count(DISTINCT s.job_code) FILTER (c.job_category = '{c}') AS {c.lower()}" for c in TRACKED)
SQL["history_upsert"] = with_ctes(f"""
SELECT * FROM old_history WHERE date <> DATE '{B.SYNC_LOAD_DATE}'
UNION ALL
SELECT DATE '{B.SYNC_LOAD_DATE}', count(DISTINCT s.job_code) AS total_post, {_counters}
FROM synced s LEFT JOIN cat_set c ON c.job_code = s.job_code""", "old_history", "synced", "cat_set")

SQL["history_incremental"] = with_ctes(f"""
, second AS (SELECT * FROM job WHERE contains(job_source, 'www.europe') AND create_date >= TIMESTAMP '1997-01-01'),
later AS (SELECT * FROM synced WHERE NOT contains(job_source, 'www.europe') AND job_code NOT IN (SELECT job_code FROM second)
          UNION ALL SELECT * FROM second)
SELECT DATE '2001-08-31' AS date, count(DISTINCT s.job_code) AS total_post, {_counters}
FROM stored s LEFT JOIN job_category c ON c.job_code = s.job_code
UNION ALL
SELECT DATE '{B.SYNC_LOAD_DATE}', count(DISTINCT s.job_code) AS total_post, {_counters}
FROM synced s LEFT JOIN job_category c ON c.job_code = s.job_code
UNION ALL
SELECT DATE '2001-09-02', count(DISTINCT s.job_code) AS total_post, {_counters}
FROM later s LEFT JOIN job_category c ON c.job_code = s.job_code""", "stored", "synced", "job_category")

SQL["batch_policy_observed"] = with_ctes("SELECT * FROM synced", "synced")

# --- search ----------------------------------------------------------------------

SQL["search_grouped"] = with_ctes(f"SELECT {SEARCH_COLS} FROM job WHERE {GROUPED}", "job")

SQL["search_reference_precedence"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job
WHERE ({EXCLUDE_ANY} AND job_title LIKE '%BUILDING%')
   OR company_name LIKE '%BUILDING%' OR job_location LIKE '%BUILDING%'
   OR (skills LIKE '%BUILDING%' AND min_salary > 100000 AND job_location LIKE '%ASIA%')""", "job")

SQL["search_page"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job WHERE {GROUPED} ORDER BY job_code LIMIT 10 OFFSET 20""", "job")

SQL["search_optional"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job WHERE {EXCLUDE_ANY} AND job_title LIKE '%1-URGENT%' AND min_salary > 4.5""", "job")

SQL["search_like"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job WHERE {EXCLUDE_ANY}
  AND (job_title LIKE '%AUTO_OBILE%' OR company_name LIKE '%AUTO_OBILE%'
       OR job_location LIKE '%AUTO_OBILE%' OR skills LIKE '%AUTO_OBILE%')""", "job")

SQL["search_request_table"] = with_ctes(f"""
, request AS (
  SELECT s_suppkey AS request_id,
         ['BUILDING', 'AUTO_OBILE', 'Customer#00000001', 'HOUSE%D', 'IN', 'FURNITURE,O', ''][s_suppkey % 7 + 1] AS k,
         CASE WHEN s_suppkey % 5 = 0 THEN '1-URGENT' WHEN s_suppkey % 5 = 1 THEN '5-' ELSE '' END AS t,
         CASE WHEN s_suppkey % 3 <> 0 OR s_suppkey % 7 = 4 THEN n_name ELSE '' END AS l,
         CASE WHEN s_suppkey % 4 = 0 THEN 100000 WHEN s_suppkey % 4 = 1 THEN 40000 END AS s
  FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT request_id, {SEARCH_COLS} FROM job JOIN request ON {EXCLUDE_ANY}
  AND (k = '' OR job_title LIKE '%' || k || '%' OR company_name LIKE '%' || k || '%'
       OR job_location LIKE '%' || k || '%' OR skills LIKE '%' || k || '%')
  AND (t = '' OR job_title LIKE '%' || t || '%') AND (l = '' OR job_location LIKE '%' || l || '%')
  AND (s IS NULL OR min_salary > s)""", "job")

SQL["search_collated"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job WHERE {EXCLUDE_ANY}
  AND (contains(lower(job_title), 'building') OR contains(lower(company_name), 'building')
       OR contains(lower(job_location), 'building') OR contains(lower(skills), 'building'))
  AND contains(lower(job_location), 'asia')""", "job")

SQL["search_leading_number"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job WHERE {EXCLUDE_ANY} AND min_salary > 40000""", "job")

SQL["search_keyset"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job WHERE {GROUPED} AND job_code > 'j5' ORDER BY job_code LIMIT 10""", "job")

SQL["recommend_sample"] = with_ctes(f"""
SELECT {SEARCH_COLS} FROM job
WHERE NOT (salary_period LIKE '年薪%' OR salary_period LIKE '時薪%') AND salary_period NOT LIKE '%待遇面議%'
ORDER BY md5('42' || job_code) LIMIT 5""", "job")

SQL["job_lookup"] = with_ctes("""
SELECT * FROM job WHERE job_code IN (SELECT job_code FROM bookmarks)""", "job", "bookmarks")

# --- related postings and bookmarks --------------------------------------------------

SQL["similar_jobs"] = with_ctes("""
, pairs AS (SELECT DISTINCT job_code, job_category FROM job_category
            WHERE job_code IN (SELECT job_code FROM job)),
members AS (SELECT job_category, list(job_code ORDER BY job_code) AS codes FROM pairs GROUP BY job_category),
own AS (SELECT job_code, list(job_category) AS cats FROM pairs GROUP BY job_code),
-- per distinct set of categories the codes of all its categories; a job's peers are these without itself
sets AS (SELECT DISTINCT list_sort(cats) AS cats FROM own),
peers AS (SELECT s.cats, list_sort(list_distinct(flatten(list(m.codes))))[1:3] AS codes
          FROM sets s JOIN members m ON list_contains(s.cats, m.job_category) GROUP BY s.cats),
ranked AS (SELECT o.job_code, unnest([1, 2]) AS rank,
                  unnest(list_filter(p.codes, lambda c: c <> o.job_code)[1:2]) AS similar_code
           FROM own o JOIN peers p ON p.cats = list_sort(o.cats))
SELECT r.job_code, CAST(r.rank AS INTEGER) AS rank, r.similar_code, j.job_title AS similar_title,
       j.company_name AS similar_company, j.job_location AS similar_location
FROM ranked r JOIN job j ON j.job_code = r.similar_code""".lstrip(), "job", "job_category")

SQL["job_categories_joined"] = with_ctes("""
SELECT jc.job_code, jc.job_category, j.job_title, j.company_name, j.job_location
FROM job_category jc JOIN job j ON jc.job_code = j.job_code""", "job", "job_category")

CTE["top_marks"] = """top_marks AS (
  SELECT user_id, job_code FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY job_code) AS r FROM bookmarks) WHERE r <= 5)"""
_DEPS["top_marks"] = ["bookmarks"]

SQL["user_bookmarks"] = with_ctes("""
SELECT u.id AS user_id, u.name, u.email, m.job_code, j.job_source, j.job_title,
       j.company_name AS company, j.job_location AS location
FROM users u LEFT JOIN top_marks m ON u.id = m.user_id LEFT JOIN job j ON m.job_code = j.job_code""",
                                  "users", "top_marks", "job")

# no user of the test data holds more than one chunk
SQL["bookmark_lists"] = with_ctes("""
SELECT user_id, 0 AS chunk_no, list_sort(list(job_code)) AS bookmark_list FROM bookmarks GROUP BY user_id""", "bookmarks")

SQL["view_flags"] = with_ctes("""
SELECT v.event_id, v.user_id, v.job_code, (b.user_id IS NOT NULL) AS bookmarked
FROM (SELECT event_id, user_id, 'j' || json_extract_string(props, '$.k') AS job_code
      FROM events WHERE event_type = 'view') v
LEFT JOIN bookmarks b ON b.user_id = v.user_id AND b.job_code = v.job_code""", "bookmarks")

SQL["bookmark_flags"] = with_ctes("""
SELECT j.job_code, j.job_title, COALESCE(b.n, 0) AS n_bookmarks, COALESCE(b.n, 0) > 0 AS bookmarked
FROM job j LEFT JOIN (SELECT job_code, COUNT(*) AS n FROM bookmarks GROUP BY 1) b ON j.job_code = b.job_code""",
                                  "job", "bookmarks")

SQL["bookmark_state"] = with_ctes("""
SELECT user_id, job_code, COUNT(*) AS n_toggles, COUNT(*) % 2 = 1 AS bookmarked
FROM toggles GROUP BY 1, 2""", "toggles")

SQL["bookmark_actions"] = with_ctes("""
SELECT event_id, ts, user_id, job_code, ordinal,
       CASE WHEN ordinal % 2 = 1 THEN 'add' ELSE 'remove' END AS action
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id, job_code ORDER BY ts, event_id) AS BIGINT)
        AS ordinal FROM toggles)""", "toggles")

# --- sync --------------------------------------------------------------------------

SQL["surrogate_ids"] = with_ctes("""
SELECT job_code, job_title, CAST(row_number() OVER (ORDER BY job_code) AS BIGINT) AS id FROM job""", "job")

SQL["insert_ids"] = with_ctes("""
SELECT job_code,
       CAST((SELECT count(*) FROM stored) + row_number() OVER (ORDER BY job_code) AS BIGINT) AS id
FROM batch WHERE job_code NOT IN (SELECT job_code FROM stored)""", "stored", "batch")

SQL["batch_policy_load"] = with_ctes("SELECT job_code, job_title, job_source, create_date FROM job", "job")

SQL["sync_bookmark_cascade"] = with_ctes("""
SELECT b.user_id, b.job_code FROM bookmarks b WHERE b.job_code IN (SELECT job_code FROM synced)""", "bookmarks", "synced")

SQL["sync_upsert"] = with_ctes("SELECT * FROM synced", "synced")

SQL["sync_commit"] = SQL["sync_upsert"]

SQL["sync_stale"] = with_ctes("""
SELECT job_code, job_source FROM stored
WHERE contains(job_source, 'www.asia') AND job_code NOT IN (SELECT job_code FROM batch)""", "stored", "batch")

SQL["sync_empty_guard"] = with_ctes("SELECT * FROM stored", "stored")

SQL["sync_sources"] = with_ctes("SELECT job_code, job_source, create_date FROM job", "job")

SQL["category_append"] = with_ctes("""
SELECT * FROM job_category WHERE job_code IN (SELECT job_code FROM stored)
UNION ALL SELECT * FROM job_category WHERE job_code IN (SELECT job_code FROM batch)""",
                                   "job_category", "stored", "batch")

SQL["category_set"] = with_ctes("SELECT * FROM cat_set", "cat_set")

SQL["sync_cascade"] = with_ctes("""
SELECT * FROM cat_set WHERE job_code IN (SELECT job_code FROM synced)""", "cat_set", "synced")

SQL["sync_orphans"] = with_ctes("""
SELECT * FROM cat_set WHERE job_code NOT IN (SELECT job_code FROM synced)""", "cat_set", "synced")

# --- dedupe and quality -----------------------------------------------------------------

SQL["first_wins_dedupe"] = with_ctes("""
SELECT job_code, category_pos, page, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY job_code ORDER BY category_pos, page, pos) AS r FROM listing)
WHERE r = 1""", "listing")

SQL["listing_roundtrip"] = with_ctes(f"""
SELECT job_code, category_pos, page, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY job_code ORDER BY category_pos, page, pos) AS first
  FROM (SELECT job_code,
               CAST(list_position({TRACKED}, job_category) AS INTEGER) AS category_pos,
               CAST((rn - 1) // 30 + 1 AS INTEGER) AS page,
               CAST((rn - 1) % 30 + 1 AS INTEGER) AS pos
        FROM (SELECT job_code, job_category,
                     row_number() OVER (PARTITION BY job_category ORDER BY job_code) AS rn
              FROM (SELECT DISTINCT job_code, job_category FROM job_category
                    WHERE job_category IN {TRACKED_SQL}))))
WHERE first = 1""", "job_category")

SQL["listing_until_empty"] = with_ctes(f"""
SELECT job_code, category_pos, page, pos
FROM (SELECT job_code,
             CAST(list_position({TRACKED}, job_category) AS INTEGER) AS category_pos,
             CAST((rn - 1) // 30 + 1 AS INTEGER) AS page,
             CAST((rn - 1) % 30 + 1 AS INTEGER) AS pos
      FROM (SELECT job_code, job_category,
                   row_number() OVER (PARTITION BY job_category ORDER BY job_code) AS rn
            FROM (SELECT DISTINCT job_code, job_category FROM job_category
                  WHERE job_category IN {TRACKED_SQL})))
WHERE page < 2 * category_pos + 1""", "job_category")

SQL["listing_duplicates"] = with_ctes("""
SELECT job_code, COUNT(*) AS n FROM listing GROUP BY 1 HAVING COUNT(*) > 1""", "listing")

SQL["unique_violations"] = with_ctes("""
SELECT job_code, job_category, COUNT(*) AS n FROM job_category GROUP BY 1, 2 HAVING COUNT(*) > 1""",
                                     "job_category")

SQL["reject_report"] = with_ctes("""
SELECT job_code, create_date, broken AS reasons FROM faulty WHERE broken <> ''
UNION ALL
SELECT job_code, create_date, 'duplicate_job_code' FROM (
  SELECT job_code, create_date, row_number() OVER (PARTITION BY job_code ORDER BY create_date) AS r
  FROM faulty WHERE broken = '') WHERE r > 1""", "faulty")

SQL["warning_report"] = with_ctes(f"""
SELECT job_code, concat_ws(',',
  CASE WHEN edu_level IS NOT NULL AND LEFT(edu_level, 2) NOT IN {EDU_SQL} THEN 'edu_vocabulary' END,
  CASE WHEN coalesce(max_salary != 0 AND min_salary > max_salary, false) THEN 'salary_order' END) AS reasons
FROM job WHERE (edu_level IS NOT NULL AND LEFT(edu_level, 2) NOT IN {EDU_SQL})
  OR coalesce(max_salary != 0 AND min_salary > max_salary, false)""", "job")

SQL["valid_jobs"] = with_ctes("SELECT job_code, edu_level FROM tagged WHERE reasons = ''", "tagged")

SQL["category_check"] = with_ctes(f"""
, pairs AS (SELECT DISTINCT job_code, job_category FROM job_category),
per AS (SELECT job_code, COUNT(*) AS n,
               COUNT(*) FILTER (WHERE job_category NOT IN {TRACKED_SQL}) AS o
        FROM pairs GROUP BY 1)
SELECT j.job_code, CAST(COALESCE(per.n, 0) AS BIGINT) AS n_categories,
       CAST(COALESCE(per.o, 0) AS BIGINT) AS n_out_of_vocabulary,
       COALESCE(per.n, 0) BETWEEN 1 AND 3 AND COALESCE(per.o, 0) = 0 AS ok
FROM job j LEFT JOIN per ON j.job_code = per.job_code""".lstrip(), "job", "job_category")

SQL["salary_normalise"] = with_ctes("""
SELECT job_code, salary_period, min_salary,
       CAST(COALESCE(mx, min_salary) AS BIGINT) AS max_salary FROM (
  SELECT job_code, salary_period,
         CAST(CASE WHEN coalesce(contains(salary_period, '年薪'), false) THEN round(min_salary / 12)
                   ELSE min_salary END AS BIGINT) AS min_salary,
         CAST(CASE WHEN coalesce(contains(salary_period, '年薪'), false) THEN round(max_salary / 12)
                   ELSE max_salary END AS BIGINT) AS mx
  FROM job)""", "job")

SQL["signup_check"] = with_ctes("""
SELECT id, email,
  coalesce(regexp_matches(email, '^[_a-z0-9-]+(\\.[_a-z0-9-]+)*@[a-z0-9-]+(\\.[a-z0-9-]+)*(\\.[a-z]{2,4})$'), false)
    AS email_ok,
  coalesce(regexp_matches(password, '^[A-Za-z0-9@#$%^&+=]{8,}'), false) AS password_ok,
  sha256(password) AS password_hash
FROM users""", "users")

SQL["signup_insert"] = """
WITH s AS (SELECT 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS email, ts, event_id
           FROM events WHERE event_type = 'signup'),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY ts, event_id) AS r FROM s)
      WHERE r = 1)
SELECT email, ts, event_id FROM f
WHERE email NOT IN (SELECT 'user' || CAST(c_custkey * 2 AS VARCHAR) || '@example.com' FROM customer)"""

# --- pages and text extraction ------------------------------------------------------------

_LINKS = f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, {_unescape("arr[i][2:-2]")} AS href FROM (
  SELECT page_id, arr, unnest(generate_series(1, len(arr))) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '{HREF_RE}', 1) AS arr FROM pages))"""
SQL["page_links"] = _LINKS

SQL["link_codes"] = f"""
SELECT * FROM (SELECT page_id, pos, href, nullif(regexp_extract(href, '^/([^/?#]+)$', 1), '') AS job_code
               FROM ({_LINKS})) WHERE job_code IS NOT NULL"""

SQL["page_records"] = f"""
SELECT page_id,
  nullif(regexp_extract(html, '(?i)<html\\b[^>]*\\blang="([^"]*)"', 1), '') AS lang,
  {_element("title")} AS title,
  {_element("h1")} AS heading,
  {_element("footer")} AS footer,
  CAST(len(regexp_extract_all(html, '{HREF_RE}', 1)) AS BIGINT) AS n_links,
  CAST(len(regexp_extract_all(html, '(?i)<p\\b', 0)) AS BIGINT) AS n_paragraphs,
  nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host
FROM pages"""

SQL["page_text"] = f"SELECT page_id, {_visible('html')} AS text FROM pages"

SQL["url_parts"] = """
SELECT page_id,
  nullif(regexp_extract(url, '^https?://([^/?#]+)', 1), '') AS host,
  nullif(regexp_extract(url, '/([a-z]{2})/[0-9]+', 1), '') AS lang,
  CAST(nullif(regexp_extract(url, '/[a-z]{2}/([0-9]+)', 1), '') AS BIGINT) AS code
FROM pages"""

SQL["embedded_json"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"

SQL["page_embedded_json"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"

SQL["page_variant_fields"] = """
SELECT page_id, IF(cut, substr(doc, 1, length(doc) - 1), NULL) AS malformed, IF(cut, NULL, code) AS code,
       IF(cut OR page_id % 3 = 0 OR page_id % 5 = 0 OR page_id % 11 = 0, NULL, k) AS pay_min,
       IF(cut, NULL, event_type) AS tag, IF(cut, NULL, 'x&y') AS second_tag,
       IF(NOT cut AND page_id % 3 <> 0 AND page_id % 5 = 0, 'pay_min', '') AS wrong
FROM (SELECT *, '{"job":{"code":"' || code || '","tags":["' || event_type || '","x&y"]' || CASE
               WHEN page_id % 3 = 0 THEN '}}' WHEN page_id % 5 = 0 THEN ',"pay":{"min":"by agreement"}}}'
               WHEN page_id % 11 = 0 THEN ',"pay":{"min":null}}}'
               ELSE ',"pay":{"min":' || CAST(k AS VARCHAR) || '}}}' END AS doc
      FROM (SELECT event_id AS page_id, event_type, 'e' || CAST(event_id AS VARCHAR) AS code, event_id % 7 = 0 AS cut,
                   CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events))"""

SQL["article_codes"] = with_ctes("""
SELECT job_code FROM job""", "job")

SQL["board_codes"] = with_ctes("""
SELECT job_code, board, CASE board WHEN 'json_board' THEN job_code WHEN 'html_board' THEN job_code
  WHEN 'hk_board' THEN substr(job_code, 2) ELSE lpad(substr(job_code, 2), 10, '0') END AS code
FROM job, (VALUES ('json_board'), ('html_board'), ('hk_board'), ('jp_board')) b(board)""", "job")

SQL["container_text"] = with_ctes("""
SELECT job_code, job_title || company_name || job_location AS text FROM job""", "job")

SQL["salary_text_parse"] = with_ctes(f"""
SELECT job_code, pay_text,
  COALESCE(CAST(replace(nullif(regexp_extract(pay_text, '{PAY_RE}', 1), ''), ',', '') AS BIGINT), 0) AS min_salary,
  COALESCE(CAST(replace(nullif(regexp_extract(pay_text, '{PAY_RE}', 2), ''), ',', '') AS BIGINT), 0) AS max_salary
FROM (SELECT job_code,
        CASE WHEN salary_period = '月薪'
             THEN '月薪 ' || format('{{:,}}', min_salary) || ' 至 ' || format('{{:,}}', max_salary)
             ELSE '時薪 ' || CAST(min_salary AS VARCHAR) END AS pay_text FROM job)""", "job")

SQL["delimited_explode"] = with_ctes("""
SELECT job_code, CAST(i - 1 AS INTEGER) AS pos, arr[i] AS skill FROM (
  SELECT job_code, arr, unnest(generate_series(1, len(arr))) AS i FROM (
    SELECT job_code, string_split(skills, ',') AS arr FROM job))""", "job")

SQL["load_dates"] = "SELECT event_id, CAST(ts + INTERVAL 8 HOUR AS DATE) AS load_date FROM events"

SQL["paging_plan"] = f"""
SELECT job_category, total, CAST(o * 30 AS INTEGER) AS page_offset FROM (
  SELECT job_category, total, unnest(range(0, total // 30 + 1)) AS o FROM (
    SELECT p.p_type AS job_category, COUNT(DISTINCT l.l_orderkey) AS total
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    WHERE p.p_type IN {TRACKED_SQL} GROUP BY 1))"""

# --- terms ------------------------------------------------------------------------------

SQL["skill_terms"] = with_ctes(f"""
SELECT term, n FROM {_terms("SELECT replace(skills, ',', ' ') AS text FROM job WHERE skills IS NOT NULL")} t
ORDER BY n DESC, term LIMIT 400""", "job")

SQL["term_frequency"] = f"""
SELECT term, n FROM {_terms("SELECT text FROM documents")} t
ORDER BY n DESC, term LIMIT 400"""

SQL["term_weight"] = f"""
SELECT term, n, CAST(n AS DOUBLE) / CAST(max(n) OVER () AS DOUBLE) AS weight FROM (
SELECT term, n FROM {_terms("SELECT text FROM documents")} t
ORDER BY n DESC, term LIMIT 400)"""

SQL["term_top_bounded"] = f"""
SELECT term, n FROM {_terms("SELECT text FROM documents")} t
ORDER BY n DESC, term LIMIT 400"""

SQL["term_top_by_lang"] = f"""
SELECT lang, term, n, rank FROM (
  SELECT lang, term, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS INTEGER) AS rank
  FROM {_terms("SELECT lang, text FROM documents", by="lang")} t)
WHERE rank <= 400"""

# --- backups ---------------------------------------------------------------------------------

SQL["json_backup_roundtrip"] = with_ctes("SELECT * FROM records", "records")
SQL["raw_backup_roundtrip"] = with_ctes(f"""
, cats AS (SELECT job_code, list_sort(list(DISTINCT job_category)) AS category FROM job_category GROUP BY 1),
out AS (SELECT j.*, c.category, CAST(substr(j.job_code, 2) AS BIGINT) AS k
        FROM job j LEFT JOIN cats c ON j.job_code = c.job_code),
shown AS (SELECT job_code AS code, k,
  CASE WHEN k % 71 = 0 THEN 'x' || job_code ELSE job_code END AS job_code, job_title, company_name, job_location,
  salary_period, min_salary, max_salary,
  CASE WHEN k % 7 <> 0 THEN ['不拘', '高中職', '專科', '大學', '碩士', '博士'][k % 6 + 1] ELSE edu_level END AS edu_level,
  CASE WHEN k % 43 = 0 THEN 'unclear' ELSE ['不拘', '3年以上', '10年以上'][k % 3 + 1] END AS work_experience, skills,
  CASE WHEN k % 47 = 0 THEN 'unclear' ELSE ['需出差外派', '無需出差外派'][k % 2 + 1] END AS travel,
  CASE WHEN k % 53 = 0 THEN 'unclear' ELSE ['需負擔管理責任', '不需負擔管理責任'][k % 2 + 1] END AS management,
  CASE WHEN k % 59 = 0 THEN 'unclear' ELSE ['可遠端工作', '不可遠端工作'][k % 2 + 1] END AS remote, category,
  CASE WHEN k % 61 = 0 THEN 'https://other.example/' ELSE 'https://www.board-c.example/job/' END || job_code
    AS job_source,
  CASE WHEN k % 67 = 0 THEN '1900-01-01 00:00:00' ELSE '{B.SYNC_LOAD_DATE} 00:00:00' END AS create_date
  FROM out)
SELECT code AS job_code, CAST(length(CASE
  WHEN k % 73 = 0 THEN 'Here is the posting you asked for.'
  WHEN k % 79 = 0 THEN CAST(to_json(struct_pack(job_code, job_title, company_name, job_location, salary_period, min_salary,
    max_salary, edu_level, work_experience, skills, management, category, job_source, create_date)) AS VARCHAR)
  WHEN k % 83 = 0 THEN CAST(to_json(struct_pack(job_code, job_title, company_name, job_location, salary_period, min_salary,
    max_salary, edu_level, work_experience, skills, travel, management, remote, category, job_source, create_date,
    note := 'extra')) AS VARCHAR)
  ELSE CAST(to_json(struct_pack(job_code, job_title, company_name, job_location, salary_period, min_salary, max_salary,
    edu_level, work_experience, skills, travel, management, remote, category, job_source, create_date)) AS VARCHAR) END) AS BIGINT)
  AS n_chars FROM shown""".lstrip(), "job", "job_category")
SQL["positional_json_read"] = with_ctes("SELECT * FROM records", "records")
SQL["staged_categories"] = with_ctes("""
SELECT DISTINCT job_code, job_category FROM job_category WHERE job_code IN (SELECT job_code FROM job)""",
                                     "job_category", "job")

# --- streaming -----------------------------------------------------------------------------

SQL["stream_toggle_state"] = SQL["bookmark_state"]
SQL["stream_daily_users"] = """
SELECT CAST(ts AS DATE) AS day, event_type, COUNT(DISTINCT user_id) AS n_users FROM events GROUP BY 1, 2"""
SQL["stream_category_counts"] = with_ctes(f"""
SELECT CAST(j.create_date AS DATE) AS day, jc.job_category, COUNT(DISTINCT j.job_code) AS n_jobs
FROM job j JOIN job_category jc ON jc.job_code = j.job_code
WHERE jc.job_category IN {TRACKED_SQL}
GROUP BY 1, 2""", "job", "job_category")

SQL["stream_category_sketches"] = with_ctes(f"""
, days AS (SELECT DISTINCT j.job_code, jc.job_category, unnest([CAST(j.create_date AS DATE), CAST(j.create_date AS DATE) + 1]) AS day
           FROM job j JOIN job_category jc ON jc.job_code = j.job_code WHERE jc.job_category IN {TRACKED_SQL})
SELECT job_category, COUNT(*) AS n_days_sum, COUNT(DISTINCT job_code) AS n_jobs, true AS within_bound
FROM days GROUP BY 1""", "job", "job_category")
SQL["stream_dedupe"] = with_ctes("SELECT DISTINCT CAST(ts AS DATE) AS day, job_code FROM toggles", "toggles")
SQL["stream_upsert"] = SQL["sync_upsert"]

SQL["extracted_contract"] = with_ctes(f"""
, cats AS (SELECT job_code, list(DISTINCT job_category) AS category FROM job_category GROUP BY 1),
out AS (SELECT j.job_code, j.edu_level, c.category, CAST(substr(j.job_code, 2) AS BIGINT) AS k
        FROM job j LEFT JOIN cats c ON j.job_code = c.job_code)
SELECT job_code, CASE WHEN k % 73 = 0 THEN 'malformed' ELSE concat_ws(',',
  CASE WHEN k % 79 = 0 OR k % 83 = 0 THEN 'keys' END,
  CASE WHEN k % 7 = 0 AND edu_level IS NOT NULL
        AND edu_level NOT IN ('不拘', '高中職', '專科', '大學', '碩士', '博士') THEN 'edu_level' END,
  CASE WHEN k % 43 = 0 THEN 'work_experience' END,
  CASE WHEN k % 47 = 0 AND k % 79 <> 0 THEN 'travel' END,
  CASE WHEN k % 53 = 0 THEN 'management' END,
  CASE WHEN k % 59 = 0 AND k % 79 <> 0 THEN 'remote' END,
  CASE WHEN coalesce(NOT (len(category) BETWEEN 1 AND 3), true) THEN 'category_count' END,
  CASE WHEN coalesce(NOT list_has_all([{", ".join(repr(x) for x in TRACKED)}], category), true)
       THEN 'category_vocabulary' END,
  CASE WHEN k % 71 = 0 THEN 'job_code' END,
  CASE WHEN k % 61 = 0 THEN 'job_source' END,
  CASE WHEN k % 67 = 0 THEN 'create_date' END) END AS reasons
FROM out""".lstrip(), "job", "job_category")

SQL["normalised_boards"] = with_ctes("""
SELECT board, job_code AS page_code, IF(ok, job_title, NULL) AS job_title,
       IF(ok AND board = 'doc_board', company_name, NULL) AS company_name, IF(ok, min_salary, NULL) AS min_salary,
       IF(ok AND board = 'doc_board', max_salary, NULL) AS max_salary,
       CASE WHEN ok THEN CASE k % 4 WHEN 0 THEN 'LARGE' WHEN 1 THEN 'SMALL|LARGE' WHEN 2 THEN 'PROMO' ELSE '' END END
         AS categories,
       CASE WHEN board = 'new_board' THEN 'no_step'
            WHEN k % 41 = 0 THEN IF(board = 'doc_board', 'failed:JSONDecodeError', 'failed:ValueError')
            WHEN NOT ok THEN 'failed:type_min_salary'
            WHEN k % 4 = 2 THEN 'category_vocabulary'
            WHEN k % 4 = 3 THEN IF(board = 'doc_board', 'category_count', 'category_vocabulary') ELSE '' END AS reasons
FROM (SELECT *, board <> 'new_board' AND k % 41 <> 0 AND NOT (board = 'doc_board' AND k % 37 = 0) AS ok
      FROM (SELECT *, CASE WHEN k % 101 = 0 THEN 'new_board' WHEN k % 3 = 0 THEN 'lines_board' ELSE 'doc_board' END AS board
            FROM (SELECT *, CAST(substr(job_code, 2) AS BIGINT) AS k FROM job)))""", "job")

SQL["bookmark_apply"] = with_ctes("""
SELECT user_id, job_code FROM toggles GROUP BY 1, 2 HAVING COUNT(*) % 2 = 1""", "toggles")

SQL["json_detail_roundtrip"] = with_ctes("""
SELECT j.job_code, j.job_title, j.company_name, j.job_location, j.salary_period,
       j.min_salary, j.max_salary, j.edu_level, j.skills,
       CASE WHEN j.edu_level IS NOT NULL THEN '可遠端工作' ELSE '不可遠端工作' END AS remote,
       'https://www.board-a.example/job/' || j.job_code AS job_source,
       COALESCE((SELECT string_agg(DISTINCT jc.job_category, '|' ORDER BY jc.job_category)
                 FROM job_category jc WHERE jc.job_code = j.job_code), '') AS categories
FROM job j WHERE j.salary_period IS DISTINCT FROM '待遇面議'""", "job", "job_category")

SQL["html_detail_roundtrip"] = with_ctes("""
SELECT j.job_code, j.job_title, j.company_name, j.job_location,
       CASE WHEN j.salary_period = '月薪'
            THEN '月薪 ' || format('{:,}', j.min_salary) || ' 至 ' || format('{:,}', j.max_salary)
            ELSE j.salary_period END AS salary_period,
       CASE WHEN j.salary_period = '月薪' THEN j.min_salary ELSE 0 END AS min_salary,
       CASE WHEN j.salary_period = '月薪' THEN j.max_salary ELSE 0 END AS max_salary,
       j.edu_level, j.skills,
       COALESCE((SELECT string_agg(DISTINCT jc.job_category, '|' ORDER BY jc.job_category)
                 FROM job_category jc WHERE jc.job_code = j.job_code), '') AS categories
FROM job j""", "job", "job_category")

SQL["skill_terms_by_category"] = with_ctes(f"""
SELECT job_category, term, n, rank FROM (
  SELECT job_category, term, n,
         CAST(row_number() OVER (PARTITION BY job_category ORDER BY n DESC, term) AS INTEGER) AS rank
  FROM {_terms("SELECT jc.job_category, replace(j.skills, ',', ' ') AS text "
               "FROM job j JOIN job_category jc ON jc.job_code = j.job_code WHERE j.skills IS NOT NULL",
               by="job_category")} t)
WHERE rank <= 400""", "job", "job_category")
