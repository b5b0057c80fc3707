"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry binds one or more operators to the driver's tables through
``jobsift.bindings``; ``jobsift.plans.oracle.SQL`` holds the matching
DuckDB statement under the same name. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import bindings as B
from jobsift import schema as S
from jobsift.bindings import TEST_VOCAB as V
from jobsift.bindings import Tables
from jobsift.functions import dates as D
from jobsift.functions import text as X
from jobsift.operators import bookmarks, heavy_hitters, history, market, ordering, quality, related, search, search_index, sync, terms
from jobsift.operators.search import SearchSpec
from jobsift.session import scratch_path
from jobsift.sources import html, landing, normalise
from jobsift.streaming import jobs as streams

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(fn):
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


# --- dashboard aggregates (A1-A5, A11, A13, R3, R4) --------------------------

@query
def region_salary(t: Tables) -> DataFrame:
    return market.region_salary(t.job, t.job_category, vocab=V)


@query
def region_salary_for_category(t: Tables) -> DataFrame:
    return market.region_salary(t.job, t.job_category, category="LARGE", vocab=V)


@query
def region_salary_by_category(t: Tables) -> DataFrame:
    return market.region_salary_by_category(t.job, t.job_category, V, B.CATEGORIES)


@query
def category_salary(t: Tables) -> DataFrame:
    return market.category_salary(t.job, t.job_category, vocab=V)


@query
def edu_distribution(t: Tables) -> DataFrame:
    return market.edu_distribution(t.job, vocab=V)


@query
def edu_distribution_by_category(t: Tables) -> DataFrame:
    return market.edu_distribution_by_category(t.job, t.job_category, V, B.CATEGORIES)


# --- history (A6, A7, A12, M7, R6, L2) ----------------------------------------

@query
def posting_snapshot(t: Tables) -> DataFrame:
    return history.posting_snapshot(t.job, t.job_category, B.SYNC_LOAD_DATE, vocab=V)


@query
def posting_history(t: Tables) -> DataFrame:
    return history.posting_history(t.job, t.job_category, vocab=V)


@query
def posting_share_series(t: Tables) -> DataFrame:
    h = history.posting_history(t.job, t.job_category, vocab=V)
    return history.category_share_series(h, history.resolve_category_column("LARGE", V))


@query
def posting_share_lists(t: Tables) -> DataFrame:
    """A12 + F18: the dashboard payload of the LARGE series as parallel lists."""
    h = history.posting_history(t.job, t.job_category, vocab=V)
    return history.series_lists(history.category_share_series(h, history.resolve_category_column("LARGE", V)))


@query
def posting_total_series(t: Tables) -> DataFrame:
    return history.category_share_series(history.posting_history(t.job, t.job_category, vocab=V))


@query
def posting_long(t: Tables) -> DataFrame:
    return history.history_long(history.posting_history(t.job, t.job_category, vocab=V), V)


@query
def posting_delta(t: Tables) -> DataFrame:
    return history.history_delta(history.posting_history(t.job, t.job_category, vocab=V), V)


@query
def history_upsert(t: Tables) -> DataFrame:
    """M7: the history of the stored snapshot; then, after the sync, the day's
    row over the whole synced table; sent twice, as a retried run does."""
    path = scratch_path(t.spark, "history")
    history.upsert_history(path, history.posting_history(t.stored_jobs, t.stored_categories, vocab=V))
    synced = sync.sync_jobs(t.stored_jobs, t.batch_jobs, B.SYNC_SITE)
    bridge = sync.append_categories(t.stored_categories, t.batch_categories)
    for _ in range(2):
        history.upsert_history(path, history.posting_snapshot(synced, bridge, B.SYNC_LOAD_DATE, vocab=V))
    return history.read_history(t.spark, path, vocab=V)


@query
def history_incremental(t: Tables) -> DataFrame:
    """M7 + A7 by incremental maintenance: the row of the stored table, then the rows after two sources' syncs
    on two days, each from the row before and the sync's own changes; every sync's counts are sent twice."""
    path, counts = scratch_path(t.spark, "history"), scratch_path(t.spark, "signed-counts")
    every, pairs = (sync.land(df, scratch_path(t.spark, "tables")) for df in (t.job, t.job_category))
    jobs = every.where(F.col("create_date") < F.lit(B.SYNC_CUTOFF).cast("timestamp_ntz"))
    bridge = sync.land(pairs.join(jobs.select("job_code"), "job_code", "left_semi"), scratch_path(t.spark, "bridge"))
    history.upsert_history(path, history.posting_snapshot(jobs, bridge, "2001-08-31", vocab=V))
    for site, since, date in ((B.SYNC_SITE, B.SYNC_BATCH_FROM, B.SYNC_LOAD_DATE), ("www.europe", "1997-01-01", "2001-09-02")):
        batch = every.where(F.col("job_source").contains(site) & (F.col("create_date") >= F.lit(since).cast("timestamp_ntz")))
        added = sync.land(pairs.join(batch.select("job_code"), "job_code", "left_semi"), scratch_path(t.spark, "added"))
        for _ in range(2):
            changes = sync.land(sync.sync_changes(jobs, batch, site), scratch_path(t.spark, "changes"))  # read three times
            history.put_counts(history.signed_counts(changes, bridge, added, vocab=V), counts, date, site)
        history.upsert_history(path, history.day_from_counts(t.spark, path, counts, date, vocab=V))
        after = sync.land(sync.sync_jobs(jobs, batch, site), scratch_path(t.spark, "synced"))
        bridge = sync.land(sync.cascade_categories(bridge, added, after), scratch_path(t.spark, "bridge"))
        jobs = after
    return history.read_history(t.spark, path, vocab=V)


# --- search (P3-P9, P13, L3, L4) ----------------------------------------------

SEARCH = SearchSpec(keyword="BUILDING", location="ASIA", salary="100000")


@query
def search_grouped(t: Tables) -> DataFrame:
    return search.search(t.job, SEARCH)


@query
def search_reference_precedence(t: Tables) -> DataFrame:
    return search.search(t.job, SearchSpec(keyword="BUILDING", location="ASIA", salary="100000",
                                           precedence="reference"))


@query
def search_page(t: Tables) -> DataFrame:
    return search.search_page(t.job, SearchSpec(keyword="BUILDING", location="ASIA",
                                                salary="100000", page=3))


@query
def search_optional(t: Tables) -> DataFrame:
    return search.search(t.job, SearchSpec(job_title="1-URGENT", salary="4.5"))


@query
def search_like(t: Tables) -> DataFrame:
    return search.search(t.job, SearchSpec(keyword="AUTO_OBILE", match="like"))


@query
def search_collated(t: Tables) -> DataFrame:
    return search.search(t.job, SearchSpec(keyword="building", location="asia", collation="UTF8_LCASE"))


@query
def search_leading_number(t: Tables) -> DataFrame:
    """A bound counts by its leading number."""
    return search.search(t.job, SearchSpec(salary="40000元"))


@query
def search_keyset(t: Tables) -> DataFrame:
    return search.search_after(t.job, SEARCH, last_code="j5")


@query
def recommend_sample(t: Tables) -> DataFrame:
    return search.recommend(t.job, seed="42")


@query
def job_lookup(t: Tables) -> DataFrame:
    """P13 for a batch of keys: details of every bookmarked posting."""
    return search.lookup(t.job, bookmarks.current_bookmarks(t.toggles))


def request_table(t: Tables) -> DataFrame:
    """A search request per supplier: terms with and without wildcards, short ones, other fields, or none."""
    k = F.col("s_suppkey")
    words = ["BUILDING", "AUTO_OBILE", "Customer#00000001", "HOUSE%D", "IN", "FURNITURE,O", ""]
    nation = t.raw("nation").select("n_nationkey", "n_name")
    return t.raw("supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(
        k.alias("request_id"),
        F.element_at(F.array(*[F.lit(w) for w in words]), (k % len(words) + 1).cast("int")).alias("keyword"),
        F.when(k % 5 == 0, F.lit("1-URGENT")).when(k % 5 == 1, F.lit("5-")).alias("job_title"),
        F.when((k % 3 != 0) | (k % 7 == 4), F.col("n_name")).otherwise("").alias("location"),
        F.when(k % 4 == 0, F.lit("100000")).when(k % 4 == 1, F.lit("40000元")).alias("salary"))


@query
def search_request_table(t: Tables) -> DataFrame:
    """P3, P6, P7, P9 for all requests of a table at once, through the trigram index."""
    job = sync.land(t.job, scratch_path(t.spark, "jobs"))
    return search_index.search_requests(job, request_table(t), match="like")


# --- related postings and bookmarks (J3-J5, J7, R1, R2, A10, M8) ----------------

@query
def similar_jobs(t: Tables) -> DataFrame:
    return related.similar_jobs(t.job, t.job_category)


@query
def job_categories_joined(t: Tables) -> DataFrame:
    return related.job_with_categories(t.job, t.job_category).select(
        "job_code", "job_category", "job_title", "company_name", "job_location")


@query
def user_bookmarks(t: Tables) -> DataFrame:
    return related.user_bookmarks(t.users, bookmarks.current_bookmarks(t.toggles), t.job)


@query
def bookmark_lists(t: Tables) -> DataFrame:
    return related.user_bookmark_list(bookmarks.current_bookmarks(t.toggles))


@query
def bookmark_flags(t: Tables) -> DataFrame:
    return related.bookmark_flags(t.job.select("job_code", "job_title"),
                                  bookmarks.current_bookmarks(t.toggles))


@query
def view_flags(t: Tables) -> DataFrame:
    """Every posting view flagged with the viewer's current bookmark."""
    views = (t.raw("events").where(F.col("event_type") == "view")
             .select("event_id", "user_id",
                     F.concat(F.lit("j"), F.get_json_object("props", "$.k")).alias("job_code")))
    return related.view_flags(views, bookmarks.current_bookmarks(t.toggles)).select(
        "event_id", "user_id", "job_code", "bookmarked")


@query
def bookmark_state(t: Tables) -> DataFrame:
    return bookmarks.bookmark_state(t.toggles)


@query
def bookmark_actions(t: Tables) -> DataFrame:
    return bookmarks.bookmark_actions(t.toggles)


@query
def bookmark_apply(t: Tables) -> DataFrame:
    """M8 applied to a stored table: bookmarks after the first half of the
    event period, then the second half's toggles applied; equals the parity
    over all events."""
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    first = bookmarks.current_bookmarks(t.toggles.where(F.col("ts") < cut))
    return bookmarks.apply_toggles(first, t.toggles.where(F.col("ts") >= cut))


# --- sync (M1-M6, J6, J8, J9) ---------------------------------------------------

@query
def sync_upsert(t: Tables) -> DataFrame:
    landed = sync.land(t.batch_jobs, scratch_path(t.spark, "batch"))
    return sync.guard_empty(t.stored_jobs, landed, lambda tgt, b: sync.sync_jobs(tgt, b, B.SYNC_SITE))


@query
def sync_commit(t: Tables) -> DataFrame:
    """The stored table, then the synced one, committed by pointer."""
    root = scratch_path(t.spark, "job-table")
    sync.commit_table(t.stored_jobs, root)
    sync.commit_table(sync.sync_jobs(sync.current_table(t.spark, root), t.batch_jobs, B.SYNC_SITE), root)
    return sync.current_table(t.spark, root)


@query
def sync_stale(t: Tables) -> DataFrame:
    return sync.stale_jobs(t.stored_jobs, t.batch_jobs, B.SYNC_SITE).select("job_code", "job_source")


@query
def sync_empty_guard(t: Tables) -> DataFrame:
    empty = t.job.where(F.col("job_source").contains("www.antarctica"))
    landed = sync.land(empty, scratch_path(t.spark, "batch"))
    return sync.guard_empty(t.stored_jobs, landed, lambda tgt, b: sync.sync_jobs(tgt, b, "www.antarctica"))


@query
def sync_sources(t: Tables) -> DataFrame:
    """M1: the postings of all five sources, one batch each, as one table."""
    sources = ("africa", "america", "asia", "europe", "middleeast")
    return sync.union_sources(*[t.job.where(F.col("job_source").contains(f"www.{s}.")) for s in sources]).select(
        "job_code", "job_source", "create_date")


@query
def category_append(t: Tables) -> DataFrame:
    return sync.append_categories(t.stored_categories, t.batch_categories)


@query
def category_set(t: Tables) -> DataFrame:
    return sync.set_categories(t.stored_categories, t.batch_categories)


@query
def sync_cascade(t: Tables) -> DataFrame:
    jobs_after = sync.sync_jobs(t.stored_jobs, t.batch_jobs, B.SYNC_SITE)
    return sync.cascade_categories(t.stored_categories, t.batch_categories, jobs_after)


@query
def sync_bookmark_cascade(t: Tables) -> DataFrame:
    """J8 on the other child: bookmarks of postings that the sync removed go."""
    jobs_after = sync.sync_jobs(t.stored_jobs, t.batch_jobs, B.SYNC_SITE)
    return sync.cascade(bookmarks.current_bookmarks(t.toggles), jobs_after)


@query
def sync_orphans(t: Tables) -> DataFrame:
    jobs_after = sync.sync_jobs(t.stored_jobs, t.batch_jobs, B.SYNC_SITE)
    return sync.orphans(sync.set_categories(t.stored_categories, t.batch_categories), jobs_after)


# --- deduplication and quality (D2-D5, Q1-Q10, M9) --------------------------------

@query
def first_wins_dedupe(t: Tables) -> DataFrame:
    return sync.first_wins(t.listing, "job_code", ["category_pos", "page", "pos"])


def listing_pages(t: Tables) -> DataFrame:
    """(category_pos, page, data): listing pages of 30 codes per tracked category (code order, a company
    link first on every page). Positions are numbered per category without a single-task window (``ordering``)."""
    tracked = list(V.tracked)
    pairs = (t.job_category.where(F.col("job_category").isin(tracked))
             .select("job_code", "job_category").distinct())
    ranked = ordering.ordinals(ordering.pinned_order(pairs, ["job_category", "job_code"]), ["job_category"], "_rn")
    size = S.LISTING_PAGE_SIZE
    link = lambda url: F.struct(F.struct(url.alias("job")).alias("link"))
    items = ranked.select(
        F.array_position(F.array(*[F.lit(c) for c in tracked]), F.col("job_category")).cast("int").alias("category_pos"),
        (F.floor((F.col("_rn") - 1) / size) + 1).cast("int").alias("page"),
        ((F.col("_rn") - 1) % size + 1).cast("int").alias("pos"),
        link(F.concat(F.lit("//www.board-a.example/job/"), F.col("job_code"), F.lit("?jobsource=list"))).alias("item"))
    pages = items.groupBy("category_pos", "page").agg(  # at most 30 items per page
        F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("_items"))
    company = link(F.concat(F.lit("//www.board-a.example/company/"), F.col("page").cast("string")))
    return pages.select("category_pos", "page", F.struct(
        F.concat(F.array(company), F.transform("_items", lambda x: x["item"])).alias("list")).alias("data"))


PAGE_FIELDS = [T.StructField("category_pos", T.IntegerType()), T.StructField("page", T.IntegerType())]


@query
def listing_roundtrip(t: Tables) -> DataFrame:
    """S2 + P17 + D2: the listing pages landed as JSON, read back into codes, then deduplicated
    first-wins in crawl order."""
    path = scratch_path(t.spark, "listing")
    listing_pages(t).write.json(path)
    codes = landing.listing_codes(t.spark, path, multi_line=False, page_fields=PAGE_FIELDS)
    return sync.first_wins(codes.select("job_code", "category_pos", "page", "pos"),
                           "job_code", ["category_pos", "page", "pos"])


@query
def listing_until_empty(t: Tables) -> DataFrame:
    """The same pages, some landed empty and some not at all; every listing ends at its first such page.
    Category c has its page 2c + 1 emptied if c is even, and lost if it is odd."""
    gap = F.col("page") == 2 * F.col("category_pos") + 1
    even = F.col("category_pos") % 2 == 0
    emptied = F.struct(F.filter("data.list", lambda x: F.lit(False)).alias("list"))
    path = scratch_path(t.spark, "listing")
    (listing_pages(t).where(~(gap & ~even)).withColumn("data", F.when(gap, emptied).otherwise(F.col("data")))
     .write.json(path))
    pages = landing.read_listing_pages(t.spark, path, PAGE_FIELDS)
    read = landing.until_first_empty(pages, ["category_pos"])
    return landing.page_codes(read, ["category_pos", "page"]).select("job_code", "category_pos", "page", "pos")


@query
def listing_duplicates(t: Tables) -> DataFrame:
    return sync.duplicate_keys(t.listing, ["job_code"])


@query
def unique_violations(t: Tables) -> DataFrame:
    return sync.duplicate_keys(t.job_category, ["job_code", "job_category"])


@query
def reject_report(t: Tables) -> DataFrame:
    """Q8/Q10 + D5: postings that cannot be loaded, with reasons: a title
    over the limit, a missing source, a repeated code."""
    k = F.substring("job_code", 2, 20).cast("long")
    later = F.lit(B.SYNC_LOAD_DATE).cast("timestamp_ntz")
    batch = (t.job.withColumn("job_title", F.when(k % 31 == 0, F.repeat("job_title", 40)).otherwise(F.col("job_title")))
             .withColumn("job_source", F.when(k % 37 != 0, F.col("job_source")))
             .withColumn("create_date", F.explode(F.when(k % 41 == 0, F.array(F.col("create_date"), later))
                                                  .otherwise(F.array("create_date")))))
    _, rejected = sync.row_policy(batch, quality.job_rules(), ["create_date"])
    return rejected.select("job_code", "create_date", "reasons")


@query
def valid_jobs(t: Tables) -> DataFrame:
    valid, _ = quality.split_valid(t.job, quality.job_rules())
    return valid.select("job_code", "edu_level")


@query
def warning_report(t: Tables) -> DataFrame:
    """Loadable postings that break a rule which does not block loading."""
    return quality.with_reasons(t.job, quality.job_warnings(V)).where("reasons <> ''").select("job_code", "reasons")


@query
def category_check(t: Tables) -> DataFrame:
    return quality.category_check(t.job, t.job_category, V)


@query
def salary_normalise(t: Tables) -> DataFrame:
    return quality.normalise_salary(t.job).select("job_code", "salary_period", "min_salary", "max_salary")


@query
def signup_check(t: Tables) -> DataFrame:
    return quality.signup_checks(t.users)


@query
def signup_insert(t: Tables) -> DataFrame:
    """M9: sign-up events as new accounts; existing e-mails and repeats are skipped."""
    signups = (t.raw("events").where(F.col("event_type") == "signup")
               .select(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email"),
                       "ts", "event_id"))
    existing = t.raw("customer").select(
        F.concat(F.lit("user"), (F.col("c_custkey") * 2).cast("string"), F.lit("@example.com")).alias("email"))
    return sync.insert_unique(existing, signups, "email", ["ts", "event_id"])


@query
def surrogate_ids(t: Tables) -> DataFrame:
    """AUTO_INCREMENT-style ids for every posting, in code order."""
    return sync.assign_ids(t.job.select("job_code", "job_title"), "job_code")


@query
def insert_ids(t: Tables) -> DataFrame:
    """M11 on insert: stored postings numbered in code order; today's
    postings that are not stored get the ids after the stored maximum."""
    stored = sync.assign_ids(t.stored_jobs.select("job_code"), "job_code")
    return sync.insert_with_ids(stored, t.batch_jobs.select("job_code"), "job_code")


@query
def batch_policy_load(t: Tables) -> DataFrame:
    """All postings, landed, under the all-or-nothing policy (no repeated
    code, no NULL in a required column); a valid batch loads whole."""
    landed = sync.land(t.job, scratch_path(t.spark, "batch"))
    return sync.batch_policy(landed).select("job_code", "job_title", "job_source", "create_date")


@query
def batch_policy_observed(t: Tables) -> DataFrame:
    """D4 + M5: today's batch, checked by the totals of the pass that lands it, synced into the stored table."""
    return sync.commit_observed(t.stored_jobs, t.batch_jobs, scratch_path(t.spark, "batch"),
                                lambda target, landed: sync.sync_jobs(target, landed, B.SYNC_SITE))


LANDED_FILES = 32  # a crawl lands many files; each one is a split of the readers
FILE_PAGES = 1 << 17
CONTRACT_PREFIX = "https://www.board-c.example/job/"


def model_output(t: Tables) -> DataFrame:
    """(job_code, text): every posting as a model would render it: 16 keys, with
    faults of every kind the contract knows, spread by the order number."""
    k = F.substring("job_code", 2, 20).cast("long")
    cats = (t.job_category.groupBy("job_code")
            .agg(F.array_sort(F.collect_set("job_category")).alias("category")))

    def pick(values, n):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int")) if not n else \
            F.when(k % n == 0, F.lit("unclear")).otherwise(pick(values, 0))

    shown = {c: F.col(c) for c in quality.EXTRACTED.names} | {
        "job_code": F.when(k % 71 == 0, F.concat(F.lit("x"), F.col("job_code"))).otherwise(F.col("job_code")),
        "edu_level": F.when(k % 7 != 0, pick(S.EDU_LEVELS, 0)).otherwise(F.col("edu_level")),
        "work_experience": pick(["不拘", "3年以上", "10年以上"], 43),
        "travel": pick(S.TRAVEL_VALUES, 47),
        "management": pick(S.MANAGEMENT_VALUES, 53),
        "remote": pick(S.REMOTE_VALUES, 59),
        "job_source": F.concat(F.when(k % 61 == 0, F.lit("https://other.example/")).otherwise(F.lit(CONTRACT_PREFIX)),
                               F.col("job_code")),
        "create_date": F.when(k % 67 == 0, F.lit("1900-01-01 00:00:00")).otherwise(F.lit(f"{B.SYNC_LOAD_DATE} 00:00:00")),
    }

    def rendered(*names, **more):
        return F.to_json(F.struct(*[shown[c].alias(c) for c in names], *[v.alias(c) for c, v in more.items()]),
                         {"ignoreNullFields": "false"})

    names = quality.EXTRACTED.names
    text = (F.when(k % 73 == 0, F.lit("Here is the posting you asked for."))
            .when(k % 79 == 0, rendered(*[c for c in names if c not in ("travel", "remote")]))
            .when(k % 83 == 0, rendered(*names, note=F.lit("extra")))
            .otherwise(rendered(*names)))
    return t.job.join(cats, "job_code", "left").select("job_code", text.alias("text"))


@query
def extracted_contract(t: Tables) -> DataFrame:
    """Q3-Q7: model output parsed with the 16-key contract and checked."""
    return quality.check_extracted(quality.parse_extracted(model_output(t)), V, CONTRACT_PREFIX, B.SYNC_LOAD_DATE)


def board_texts(t: Tables) -> DataFrame:
    """(board, code, text): every posting as one of two boards writes it, JSON or labelled lines, some broken,
    and some of a board that has no step."""
    k = F.substring("job_code", 2, 20).cast("long")
    kinds = F.element_at(F.array(F.array(F.lit("LARGE")), F.array(F.lit("SMALL"), F.lit("LARGE")), F.array(F.lit("PROMO")),
                                 F.array().cast("array<string>")), (k % 4 + 1).cast("int"))
    low = F.when(k % 37 == 0, F.lit('"n/a"')).otherwise(F.col("min_salary").cast("string"))
    doc = F.concat(F.lit('{"name":"'), "job_title", F.lit('","corp":"'), "company_name", F.lit('","lo":'), low,
                   F.lit(',"hi":'), F.col("max_salary").cast("string"), F.lit(',"kinds":'), F.to_json(kinds), F.lit("}"))
    doc = F.when(k % 41 == 0, F.left(doc, F.length(doc) - 1)).otherwise(doc)
    pay = F.when(k % 41 == 0, F.lit("open")).otherwise(F.format_number("min_salary", 0))
    lines = F.concat_ws("\n", F.concat(F.lit("Position: "), "job_title"), F.concat(F.lit(" Pay from : "), pay),
                        F.lit("Hours: 9:00"), F.concat(F.lit("Kinds: "), F.array_join(kinds, ", ")))
    return t.job.select(
        F.when(k % 101 == 0, "new_board").when(k % 3 == 0, "lines_board").otherwise("doc_board").alias("board"),
        F.col("job_code").alias("code"), F.when(k % 3 == 0, lines).otherwise(doc).alias("text"))


@query
def normalised_boards(t: Tables) -> DataFrame:
    """S3 + S5 + Q3-Q5: texts of two boards landed, brought into contract records by each board's own step, checked by the
    contract's rules; failing pages and unknown boards come back with a reason."""
    path = scratch_path(t.spark, "boards")
    board_texts(t).write.partitionBy("board").parquet(path)
    pages = t.spark.read.schema("code string, text string, board string").parquet(path)
    steps = {"doc_board": normalise.json_step({"name": "job_title", "corp": "company_name", "lo": "min_salary",
                                               "hi": "max_salary", "kinds": "category"}),
             "lines_board": normalise.lines_step({"Position": "job_title", "Pay from": "min_salary", "Kinds": "category"})}
    return normalise.normalise(pages, steps, V).select(
        "board", "page_code", "job_title", "company_name", "min_salary", "max_salary",
        F.array_join("category", "|").alias("categories"), "reasons")


# --- pages and text extraction (S4-S8, F6-F26) -------------------------------------

@query
def page_links(t: Tables) -> DataFrame:
    return html.page_links(t.texts("pages"))


@query
def link_codes(t: Tables) -> DataFrame:
    return html.link_codes(html.page_links(t.texts("pages")), r"^/([^/?#]+)$")


@query
def page_records(t: Tables) -> DataFrame:
    return html.page_record(t.texts("pages"))


@query
def page_text(t: Tables) -> DataFrame:
    return html.page_text(t.texts("pages"))


@query
def url_parts(t: Tables) -> DataFrame:
    return html.url_parts(t.raw("pages"))


@query
def embedded_json(t: Tables) -> DataFrame:
    e = t.raw("events")
    return e.select("event_id", F.from_json("props", "k bigint").k.alias("k"))


@query
def page_embedded_json(t: Tables) -> DataFrame:
    """S8 + F25 + F26: every event's JSON payload rendered into the value
    attribute of a page element (entity-escaped, as pages carry it), landed,
    then extracted, unescaped and parsed back."""
    esc = F.col("props")
    for raw, entity in (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"), (">", "&gt;")):
        esc = F.replace(esc, F.lit(raw), F.lit(entity))
    page = F.concat(F.lit('<html><body><form><input type="hidden" id="jobDetailJson" value="'), esc,
                    F.lit('"></form></body></html>'))
    path = scratch_path(t.spark, "json-pages")
    t.raw("events").select(F.col("event_id").alias("page_id"), page.alias("html")).write.parquet(path)
    return html.embedded_json(t.spark.read.parquet(path), "jobDetailJson", "k bigint").select(
        F.col("page_id").alias("event_id"), F.col("doc.k").alias("k"))


@query
def page_variant_fields(t: Tables) -> DataFrame:
    """S8 + F26: nested documents of no fixed schema in page attributes: some have no pay, some a pay that is no
    number, some are cut off. Fields are read by path, wrong types named, malformed text kept apart."""
    k = F.get_json_object("props", "$.k")
    code = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    tail = (F.when(F.col("event_id") % 3 == 0, F.lit("}}"))
            .when(F.col("event_id") % 5 == 0, F.lit(',"pay":{"min":"by agreement"}}}'))
            .when(F.col("event_id") % 11 == 0, F.lit(',"pay":{"min":null}}}'))
            .otherwise(F.concat(F.lit(',"pay":{"min":'), k, F.lit("}}}"))))
    doc = F.concat(F.lit('{"job":{"code":"'), code, F.lit('","tags":["'), F.col("event_type"), F.lit('","x&y"]'), tail)
    doc = F.when(F.col("event_id") % 7 == 0, F.left(doc, F.length(doc) - 1)).otherwise(doc)
    for raw, entity in (("&", "&amp;"), ('"', "&quot;")):
        doc = F.replace(doc, F.lit(raw), F.lit(entity))
    page = F.concat(F.lit('<html><body><input value="'), doc, F.lit('" type=hidden id=jobDetailJson></body></html>'))
    path = scratch_path(t.spark, "variant-pages")
    t.raw("events").select(F.col("event_id").alias("page_id"), page.alias("html")).write.parquet(path)
    docs = html.embedded_variant(t.spark.read.parquet(path), "jobDetailJson")
    fields = {"code": ("$.job.code", "string"), "pay_min": ("$.job.pay.min", "bigint"), "tag": ("$.job.tags[0]", "string"),
              "second_tag": ("$.job.tags[1]", "string")}
    return html.variant_fields(docs, fields, ["page_id", "malformed"])


@query
def article_codes(t: Tables) -> DataFrame:
    """S4 + S6: postings listed as article blocks, 20 a page, among other
    links; the codes of the blocks' title links, tracking marks cut off."""
    k = F.substring("job_code", 2, 20).cast("long")
    block = F.concat(F.lit('<div class="card all_job_hover new_job"><h2 class="job__title__inner"><em>new</em><a href='),
                     F.lit("'https://www.board-b.example/job-"), F.col("job_code"),
                     F.lit(".html?a=1&amp;b=2'>x</a></h2><a href='/job-other.html'>more</a></div>"))
    pages = t.job.groupBy(F.floor(k / 20).alias("page_id")).agg(
        F.concat(F.lit("<html><a href='/job-top.html'>top</a>"), F.concat_ws("\n", F.collect_list(block)),
                 F.lit("</html>")).alias("html"))
    return html.link_codes(html.article_links(pages), S.CODE_PATTERNS["html_board"]).select("job_code")


@query
def board_codes(t: Tables) -> DataFrame:
    """F6 + F7: the code in each board's own kind of link."""
    k = F.substring("job_code", 2, 20)
    links = {"json_board": F.concat(F.lit("//www.board-a.example/job/"), F.col("job_code"), F.lit("?src=list")),
             "html_board": F.concat(F.lit("/job-"), F.col("job_code"), F.lit(".html")),
             "hk_board": F.concat(F.lit("/job/"), k, F.lit("?type=standard")),
             "jp_board": F.concat(F.lit("/detail/"), F.lpad(k, 10, "0"), F.lit("/"))}
    codes = {b: X.first_match(u, S.CODE_PATTERNS[b]) if b == "jp_board" else X.extract_code(u, S.CODE_PATTERNS[b])
             for b, u in links.items()}
    each = F.explode(F.array(*[F.struct(F.lit(b).alias("board"), c.alias("code")) for b, c in codes.items()]))
    return t.job.select("job_code", each.alias("_e")).select("job_code", "_e.board", "_e.code")


@query
def container_text(t: Tables) -> DataFrame:
    """The text of one container of a page, without what stands around it."""
    page = F.concat(F.lit("<html><nav>menu</nav><div class='a body b'>\n <h2>"), F.col("job_title"),
                    F.lit(" </h2><script>x()</script><div><p> "), F.replace("company_name", F.lit("#"), F.lit("&#35;")),
                    F.lit("</p>\n</div>"), F.col("job_location"), F.lit("</div><footer>end</footer></html>"))
    return html.container_text(t.job.select("job_code", page.alias("html")), "body", id_col="job_code")


@query
def salary_text_parse(t: Tables) -> DataFrame:
    """F8: monthly range texts built from the pay columns, parsed back."""
    j = t.job
    txt = (F.when(F.col("salary_period") == "月薪",
                  F.concat(F.lit("月薪 "), F.format_number("min_salary", 0), F.lit(" 至 "),
                           F.format_number("max_salary", 0)))
           .otherwise(F.concat(F.lit("時薪 "), F.col("min_salary").cast("string"))))
    parsed = j.select("job_code", txt.alias("pay_text")).withColumn("p", X.parse_monthly_range("pay_text"))
    return parsed.select("job_code", "pay_text", "p.min_salary", "p.max_salary")


@query
def delimited_explode(t: Tables) -> DataFrame:
    return t.job.select("job_code", F.posexplode(F.split("skills", ",")).alias("pos", "skill"))


@query
def load_dates(t: Tables) -> DataFrame:
    return t.raw("events").select("event_id", D.load_date("ts").alias("load_date"))


@query
def paging_plan(t: Tables) -> DataFrame:
    """Listing offsets per tracked category from its posting total."""
    totals = (t.job_category.where(F.col("job_category").isin(list(V.tracked)))
              .groupBy("job_category").agg(F.count_distinct("job_code").alias("total")))
    return landing.listing_offsets(totals).select("job_category", "total", "page_offset")


# --- terms (A9, F20, F21, L6, R5) ------------------------------------------------

@query
def skill_terms(t: Tables) -> DataFrame:
    return terms.top_terms(terms.skills_text(t.job))


@query
def skill_terms_by_category(t: Tables) -> DataFrame:
    return terms.skill_terms_by_category(t.job, t.job_category)


@query
def term_frequency(t: Tables) -> DataFrame:
    return terms.top_terms(t.texts("documents").select("text"))


@query
def term_weight(t: Tables) -> DataFrame:
    return terms.term_weights(terms.top_terms(t.texts("documents").select("text")))


@query
def term_top_bounded(t: Tables) -> DataFrame:
    """A9 + L6: the 400 top terms of all documents by a summary of counters per task and an exact count of its candidates."""
    return heavy_hitters.top_terms(t.texts("documents"))


@query
def term_top_by_lang(t: Tables) -> DataFrame:
    return terms.top_terms_by(t.texts("documents").select("lang", "text"), "lang")


# --- backups (S10-S12, S14, P16) ------------------------------------------------

def _records(t: Tables) -> DataFrame:
    cats = (t.job_category.groupBy("job_code")
            .agg(F.array_sort(F.collect_set("job_category")).alias("job_category")))
    return t.job.join(cats, "job_code", "left").select(*S.RECORD_FIELDS)


@query
def json_backup_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "backup")
    for _ in range(2):  # a rerun of the day replaces its backup
        landing.write_backup(_records(t), path, "asia", B.SYNC_LOAD_DATE)
    back = landing.read_backup(t.spark, path, source="asia", load_date=B.SYNC_LOAD_DATE)
    return back.select("job_code", "job_title", "min_salary", "max_salary",
                       F.concat_ws("|", "job_category").alias("categories"))


@query
def raw_backup_roundtrip(t: Tables) -> DataFrame:
    """S12, raw zone: the (code, text) pairs before processing, backed up and read."""
    path = scratch_path(t.spark, "raw-backup")
    landing.write_raw_texts(model_output(t), path, "board-c", B.SYNC_LOAD_DATE)
    back = landing.read_raw_texts(t.spark, path, source="board-c", load_date=B.SYNC_LOAD_DATE)
    return back.select("job_code", F.length("text").cast("bigint").alias("n_chars"))


@query
def positional_json_read(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "positional")
    landing.records_to_positional(_records(t)).write.text(path)
    back = landing.read_positional(t.spark, path)
    return back.select("job_code", "job_title", "min_salary", "max_salary",
                       F.concat_ws("|", "job_category").alias("categories"))


@query
def json_detail_roundtrip(t: Tables) -> DataFrame:
    """S3: postings rendered as detail-API documents (JSON lines), landed,
    read back and normalised into canonical records. Negotiable-pay
    postings are landed as closed (switch 'off') and dropped on read."""
    cats = (t.job_category.groupBy("job_code")
            .agg(F.array_sort(F.collect_set("job_category")).alias("cats")))
    j = t.job.join(cats, "job_code", "left")
    desc = lambda arr: F.transform(arr, lambda x: F.struct(x.alias("description")))
    data = F.struct(
        F.when(F.col("salary_period") == S.NEGOTIABLE, F.lit("off")).otherwise(F.lit("on")).alias("switch"),
        F.struct(F.col("job_title").alias("jobName"), F.col("company_name").alias("custName")).alias("header"),
        F.struct(F.col("job_location").alias("addressRegion"), F.col("salary_period").alias("salary"),
                 F.col("min_salary").alias("salaryMin"), F.col("max_salary").alias("salaryMax"),
                 F.lit(None).cast("string").alias("businessTrip"), F.lit(None).cast("string").alias("manageResp"),
                 F.when(F.col("edu_level").isNotNull(), F.lit("1")).alias("remoteWork"),
                 desc(F.col("cats")).alias("jobCategory")).alias("jobDetail"),
        F.struct(F.col("edu_level").alias("edu"), F.lit(None).cast("string").alias("workExp"),
                 desc(F.split("skills", ",")).alias("specialty")).alias("condition"))
    path = scratch_path(t.spark, "details")
    j.select(F.to_json(F.struct("job_code", data.alias("data"))).alias("value")).write.text(path)
    recs = landing.detail_records(landing.read_detail_lines(t.spark, path))
    return recs.select("job_code", "job_title", "company_name", "job_location", "salary_period",
                       "min_salary", "max_salary", "edu_level", "skills", "remote", "job_source",
                       F.concat_ws("|", "job_category").alias("categories"))


@query
def html_detail_roundtrip(t: Tables) -> DataFrame:
    """S5 + F8-F10: postings rendered as HTML detail pages (label/value
    blocks, pay as '月薪 30,000 至 45,000' for monthly pay, categories joined
    by '、'), landed, then parsed back into canonical records."""
    cats = (t.job_category.groupBy("job_code")
            .agg(F.array_join(F.array_sort(F.collect_set("job_category")), S.CATEGORY_SEPARATOR).alias("cats")))
    j = t.job.join(cats, "job_code", "left")
    pay = (F.when(F.col("salary_period") == S.MONTHLY,
                  F.concat(F.lit(S.MONTHLY + " "), F.format_number("min_salary", 0), F.lit(" 至 "),
                           F.format_number("max_salary", 0)))
           .otherwise(F.col("salary_period")))

    def item(label: str, value) -> F.Column:
        return F.coalesce(F.concat(F.lit(f'<div class="wrapper"><span class="jobItemName">{label}</span><i>:</i><div>'),
                                   F.replace(F.replace(value, F.lit("&"), F.lit("&#38;")), F.lit("-"), F.lit("<b>-</b>")),
                                   F.lit("</div></div>\n")), F.lit(""))

    labels = {field: label for label, field in S.DETAIL_LABELS.items()}
    page = F.concat(
        F.lit("<html><body><h1>Board</h1><h1 class='job-title'>"), F.col("job_title"), F.lit("</h1>\n"),
        F.lit('<div class="company-info-container"><span>'), F.col("company_name"), F.lit("</span></div>\n"),
        F.lit('<div class="job-detail-box">\n'),
        *[item(labels[f], v) for f, v in (("salary_period", F.when(pay.isNotNull(), F.lit("old"))), ("salary_period", pay),
                                          ("job_location", F.col("job_location")), ("job_category", F.col("cats")),
                                          ("edu_level", F.col("edu_level")), ("skills", F.col("skills")))],
        F.lit("</div></body></html>"))
    path = scratch_path(t.spark, "html-details")
    # dealt before the pages are made: postings are a fraction of their pages, and a deal by key sorts nothing
    j.repartition(LANDED_FILES, "job_code").select(
        F.concat(F.lit("https://www.board-b.example/job-"), F.col("job_code"), F.lit(".html")).alias("url"),
        page.alias("html")).write.option("maxRecordsPerFile", FILE_PAGES).parquet(path)
    recs = html.detail_records(t.spark.read.parquet(path))
    return recs.select("job_code", "job_title", "company_name", "job_location", "salary_period",
                       "min_salary", "max_salary", "edu_level", "skills",
                       F.concat_ws("|", "job_category").alias("categories"))


@query
def staged_categories(t: Tables) -> DataFrame:
    """S14 + F14: records split into job rows and exploded category rows."""
    _, cats = landing.split_record(_records(t), B.SYNC_LOAD_DATE)
    return cats


# --- streaming (T1-T4) ---------------------------------------------------------

@query
def stream_toggle_state(t: Tables) -> DataFrame:
    return streams.toggle_state(t.spark, streams.event_stream(t.spark, t.sf_dir))


@query
def stream_daily_users(t: Tables) -> DataFrame:
    return streams.daily_active_users(t.spark, streams.event_stream(t.spark, t.sf_dir))


@query
def stream_category_counts(t: Tables) -> DataFrame:
    """Every (posting, category row) landed as JSON, then streamed into
    daily per-category posting counts."""
    land = scratch_path(t.spark, "bridge-landing")
    (t.job.select("job_code", "create_date").join(t.job_category, "job_code")
     .select("job_code", "job_category", "create_date").write.json(land))
    rows = t.spark.readStream.schema(streams.POSTING_CATEGORY).json(land)
    return streams.daily_category_counts(t.spark, rows, list(V.tracked))


@query
def stream_category_sketches(t: Tables) -> DataFrame:
    """T2 + A6: distinct postings per category over all days, from the micro-batches' sketches: within the stated
    bound of the exact count. (The days' exact counts cannot be added up where a posting is seen on several.)"""
    land = scratch_path(t.spark, "bridge-landing")
    for days in (0, 1):  # the same postings seen again a day later
        (t.job.select("job_code", (F.col("create_date") + F.expr(f"INTERVAL {days} DAY")).alias("create_date"))
         .join(t.job_category, "job_code").select("job_code", "job_category", "create_date").write.mode("append").json(land))
    rows = t.spark.readStream.schema(streams.POSTING_CATEGORY).json(land)
    days = streams.daily_category_sketches(t.spark, rows, list(V.tracked))
    merged = history.merged_distinct(days, ["job_category"])
    exact = (t.job.select("job_code").join(t.job_category, "job_code").groupBy("job_category")
             .agg(F.count_distinct("job_code").alias("n_jobs")))
    near = F.abs(F.col("n_distinct") - F.col("n_jobs")) <= streams.SKETCH_BOUND * F.col("n_jobs")
    return merged.join(exact, "job_category").select("job_category", F.col("n").alias("n_days_sum"), "n_jobs",
                                                     near.alias("within_bound"))


@query
def stream_dedupe(t: Tables) -> DataFrame:
    return streams.distinct_daily_codes(t.spark, streams.event_stream(t.spark, t.sf_dir))


@query
def stream_upsert(t: Tables) -> DataFrame:
    land = scratch_path(t.spark, "landing")
    t.batch_jobs.write.json(land)
    return streams.upsert_stream(t.spark, t.stored_jobs, land, B.SYNC_SITE)
