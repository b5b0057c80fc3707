"""Similar postings, bookmarks of users, bookmark flags.

The original answers these one key per request; here each is one job for
all keys. Ranked selections use ``row_number() <= k`` directly over the
window, which Spark turns into a per-task WindowGroupLimit before the
shuffle: a hot key ships at most k rows per task, never its whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift import schema as S
from jobsift.session import checkpoint_root


def top_k_per_group(df: DataFrame, keys, order, k: int, rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def similar_jobs(job: DataFrame, job_category: DataFrame, k: int = S.SIMILAR_SIZE,
                 salts: int = 32, broadcast_rows: int = 10_000) -> DataFrame:
    """R2: for every job, the k lowest other codes sharing a category.

    Exact without the category self-join: a code among a job's k lowest
    peers ranks at most k+1 in every category they share (only the job
    itself and lower peers can precede it), so keeping the k+1 lowest codes
    per category is enough. Work is linear in job_category; the candidate
    table has at most (k+1) rows per category.

    The bridge is reduced to one row per job (its set of categories, combined
    map-side and bounded by the category list) and semi-joined to the stored
    postings on the same key: that is the only shuffle of the bridge, and the
    result is written (checkpoint), as both steps that follow read it. The
    candidates, with what is shown of them, are computed once and written, too. Up to ``broadcast_rows`` of them, by count, are broadcast,
    and each job's row then meets them and is aggregated without another
    exchange. Beyond that the join is keyed by (category, salt of the job), so that
    a hot category is spread over ``salts`` tasks. Either way a job collects at
    most (k+1) x (its categories) candidates.
    """
    checkpoint_root(job.sparkSession)
    own = (job_category.where("job_category IS NOT NULL").groupBy("job_code")
           .agg(F.collect_set("job_category").alias("_cats"))
           .join(job.select("job_code"), "job_code", "left_semi").checkpoint())
    pairs = own.select("job_code", F.explode("_cats").alias("job_category"))
    lowest = (top_k_per_group(pairs, ["job_category"], ["job_code"], k + 1, "_r")
              .groupBy("job_code").agg(F.collect_list("job_category").alias("_cats")))
    shown = F.struct(F.col("job_code").alias("code"), F.col("job_title").alias("title"),
                     F.col("company_name").alias("company"), F.col("job_location").alias("location"))
    cand = (job.join(lowest, "job_code")
            .select(F.explode("_cats").alias("job_category"), shown.alias("_peer")).checkpoint())
    if cand.count() <= broadcast_rows:
        met = pairs.join(F.broadcast(cand), "job_category")
    else:
        salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        met = (pairs.withColumn("_salt", F.pmod(F.xxhash64("job_code"), F.lit(salts)).cast("int"))
               .join(cand.withColumn("_salt", salt), ["job_category", "_salt"]))
    return (met.where(F.col("_peer.code") != F.col("job_code"))
            .groupBy("job_code")
            .agg(F.slice(F.array_sort(F.collect_set("_peer")), 1, k).alias("_peers"))
            .select("job_code", F.posexplode("_peers").alias("_r", "_p"))
            .select("job_code", (F.col("_r") + 1).cast("int").alias("rank"), F.col("_p.code").alias("similar_code"),
                    F.col("_p.title").alias("similar_title"), F.col("_p.company").alias("similar_company"),
                    F.col("_p.location").alias("similar_location")))


def user_bookmarks(users: DataFrame, bookmarks: DataFrame, job: DataFrame,
                   k: int = S.PROFILE_SIZE) -> DataFrame:
    """R1 + J5: user ⟕ bookmark ⟕ job, k bookmarks per user in code order.

    A user without bookmarks yields one row with NULL job columns. The marks
    meet the postings first, so no join key is NULL: users without bookmarks
    never gather in one task.
    """
    marks = top_k_per_group(bookmarks.select("user_id", "job_code"), ["user_id"], ["job_code"], k)
    jobs = job.select("job_code", "job_source", "job_title",
                      F.col("company_name").alias("company"), F.col("job_location").alias("location"))
    return (users.select(F.col("id").alias("user_id"), "name", "email")
            .join(marks.join(jobs, "job_code", "left"), "user_id", "left")
            .select("user_id", "name", "email", "job_code", "job_source", "job_title", "company", "location"))


def user_bookmark_list(bookmarks: DataFrame, chunk: int = 1000, salts: int = 32) -> DataFrame:
    """A10: every user's whole list, as arrays (user_id, chunk_no, bookmark_list).

    A user with up to ``chunk`` bookmarks has one array, chunk 0. A user with
    more has ceil(n / chunk) arrays of about ``chunk`` codes, dealt by a hash of
    the code, so no array (and no task) holds an unbounded list and none of
    the codes is left out. Only such heavy users are looked up, by (user, salt).
    """
    marks = bookmarks.select("user_id", "job_code")
    heavy = (marks.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk)
             .select("user_id", F.ceil(F.col("_n") / chunk).alias("_chunks"),
                     F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")))
    salted = marks.withColumn("_salt", F.pmod(F.xxhash64("job_code"), F.lit(salts)).cast("int"))
    deal = F.pmod(F.xxhash64(F.lit("chunk"), "job_code"), F.coalesce("_chunks", F.lit(1))).cast("int")
    return (salted.join(heavy, ["user_id", "_salt"], "left")
            .groupBy("user_id", deal.alias("chunk_no"))
            .agg(F.array_sort(F.collect_list("job_code")).alias("bookmark_list")))


def bookmark_flags(listing: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """J7 for all users at once: each listed posting with the number of users
    holding it and a bookmarked flag (pre-aggregated before the join)."""
    per_job = bookmarks.groupBy("job_code").agg(F.count(F.lit(1)).alias("n_bookmarks"))
    return (listing.join(per_job, "job_code", "left")
            .withColumn("n_bookmarks", F.coalesce("n_bookmarks", F.lit(0)).cast("bigint"))
            .withColumn("bookmarked", F.col("n_bookmarks") > 0))


def view_flags(views: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """J7 per user: each (user, posting) request flagged with whether that
    user has the posting bookmarked, the flag the original sets on every
    listed posting from the viewer's bookmark list.

    A left join on (user_id, job_code) to the bookmark table (one row per
    key) replaces building each user's whole list: no list is collected,
    and a hot (user, job) key on the request side can be split by AQE.
    """
    marks = bookmarks.select("user_id", "job_code").distinct().withColumn("_b", F.lit(True))
    return (views.join(marks, ["user_id", "job_code"], "left")
            .withColumn("bookmarked", F.coalesce(F.col("_b"), F.lit(False)))
            .drop("_b"))


def job_with_categories(job: DataFrame, job_category: DataFrame) -> DataFrame:
    """job_category ⋈ job."""
    return job_category.join(job, "job_code")
