"""Daily posting counts (the history table) and the series built on it.

The original issues eleven COUNT(DISTINCT) queries per snapshot over
job ⟕ job_category. Here the bridge is first reduced to one row of 0/1
category flags per job (``category_flags``, combined map-side), so a job
joins to at most one row: every counter is a plain count or sum, with no
join fan-out, no distinct aggregation and no Expand of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobsift import schema as S
from jobsift.functions.dates import day_string


def posting_snapshot(job: DataFrame, job_category: DataFrame, snapshot_date: str,
                     vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """A6 + A7: one history row: date, total_post and one count per category.

    The original's eleven COUNT(DISTINCT) queries become one pass: jobs
    (unique codes) left-joined to their per-job category flags, then one
    global aggregate of counts and sums, combined per task before the
    single final merge.
    """
    names = list(vocab.tracked.values())
    rows = job.select("job_code").join(category_flags(job_category, vocab), "job_code", "left")
    return rows.agg(F.count(F.lit(1)).cast("bigint").alias("total_post"),
                    *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names]).select(
        F.lit(snapshot_date).cast("date").alias("date"), "total_post", *names)


def category_flags(job_category: DataFrame, vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """(job_code, one 0/1 flag per tracked category): the bridge reduced to
    one row per job. ``max`` combines map-side, so a job with many
    (duplicate) bridge rows costs one partial row per task."""
    c = F.col("job_category")
    return (job_category.where(c.isin(list(vocab.tracked)))
            .groupBy("job_code")
            .agg(*[F.max(F.when(c == cat, 1).otherwise(0)).alias(name) for cat, name in vocab.tracked.items()]))


def posting_history(job: DataFrame, job_category: DataFrame,
                    vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """M7 over all days at once: one history row per last-seen date.

    Postings are assigned to the calendar day of ``create_date`` (the day
    they were last loaded). ``job_code`` is the posting table's unique key,
    so once the bridge is reduced to one flag row per job there is no join
    fan-out: the distinct counts of the original become plain counts and
    sums, all combinable before the shuffle on the date.
    """
    names = list(vocab.tracked.values())
    rows = (job.select("job_code", F.to_date("create_date").alias("date"))
            .join(category_flags(job_category, vocab), "job_code", "left"))
    return (rows.groupBy("date")
            .agg(F.count(F.lit(1)).cast("bigint").alias("total_post"),
                 *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names]))


def merged_distinct(sketches: DataFrame, by: list[str]) -> DataFrame:
    """A6/A7 from sketches kept per day and category: (by, n, n_distinct).

    ``sketches``: (..., n, sketch) rows with HLL sketches. ``n`` is the sum of the rows'
    exact counts, ``n_distinct`` the estimate over their union, which counts a posting once however many of the
    merged rows hold it: a month, or all categories, without reading a posting again.
    """
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def upsert_history(path: str, day_rows: DataFrame) -> None:
    """M7: put ``day_rows`` into the history table at ``path``.

    The table is partitioned by date and only the days written are
    replaced (dynamic partition overwrite), so a rerun of a day changes
    nothing else, and no row of other days is read.
    """
    (day_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(path))


def signed_counts(changes: DataFrame, categories: DataFrame, new_categories: DataFrame,
                  vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """M7 kept from a sync's own changes: one row (total_post, one signed count per category).

    ``changes``: ``sync.sync_changes``; ``categories``: the bridge before the sync; ``new_categories``: what the sync
    adds. An inserted posting counts +1 in each of its categories, a removed one -1, a changed one in the categories
    that it gains. Only bridge rows of changed codes are counted; a posting that the sync leaves alone is not read.
    """
    names = list(vocab.tracked.values())

    def flags(bridge, prefix):
        of = category_flags(bridge.join(changes.select("job_code"), "job_code", "left_semi"), vocab)
        return of.select("job_code", *[F.col(n).alias(f"{prefix}{n}") for n in names])

    rows = changes.join(flags(categories, "_old_"), "job_code", "left").join(flags(new_categories, "_new_"), "job_code", "left")
    before, after = (F.col("kind").isin(*kinds).cast("int") for kinds in (("changed", "removed"), ("inserted", "changed")))
    old, new = ({n: F.coalesce(F.col(f"{p}{n}"), F.lit(0)) for n in names} for p in ("_old_", "_new_"))
    signed = {n: after * F.greatest(old[n], new[n]) - before * old[n] for n in names}
    return rows.agg(F.coalesce(F.sum(after - before), F.lit(0)).cast("bigint").alias("total_post"),
                    *[F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias(n) for n, v in signed.items()])


def put_counts(counts: DataFrame, path: str, date: str, sync_name: str) -> None:
    """Keep one sync's signed counts; the same sync of the day, run again, replaces its own."""
    counts.write.mode("overwrite").parquet(f"{path}/date={date}/sync={sync_name}")


def day_from_counts(spark: SparkSession, history_path: str, counts_path: str, date: str,
                    vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """The day's history row: the latest row before the day plus the signed counts of the day's syncs.
    Reads one row per sync, whatever the table's size; days are taken in order."""
    counters = ["total_post", *vocab.tracked.values()]
    day = F.lit(date).cast("date")
    base = read_history(spark, history_path, vocab).where(F.col("date") < day).orderBy(F.desc("date")).limit(1)
    schema = ", ".join(f"{c} bigint" for c in counters) + ", date date, sync string"
    signed = spark.read.schema(schema).parquet(counts_path).where(F.col("date") == day)
    rows = base.select(*counters).unionByName(signed.select(*counters))
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counters]).select(day.alias("date"), *counters)


def read_history(spark: SparkSession, path: str, vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    counters = ["total_post", *vocab.tracked.values()]
    schema = ", ".join(f"{c} bigint" for c in counters) + ", date date"
    return spark.read.schema(schema).parquet(path).select("date", *counters)


def category_share_series(history: DataFrame, category_column: str | None = None,
                          days: int = S.SERIES_DAYS) -> DataFrame:
    """A12 + L2: latest ``days`` history rows as (others, chose_cat, date).

    ``category_column`` must be a counter column of the history table (it
    is looked up, never formatted into SQL); without one, the whole total
    is the chosen series and others is 0.
    """
    if category_column is not None and category_column not in history.columns:
        raise ValueError(f"unknown category column {category_column!r}")
    chosen = F.col(category_column or "total_post")
    return (history.select((F.col("total_post") - chosen).alias("others"),
                           chosen.alias("chose_cat"), "date")
            .orderBy(F.desc("date")).limit(days))


def series_lists(series: DataFrame) -> DataFrame:
    """A12 payload: one row of three parallel lists (others, chose_cat,
    dates), newest day first, dates as 'yyyy-MM-dd' strings (F18).

    Input is the bounded series of ``category_share_series`` (``days``
    rows), so the one collected list is bounded too.
    """
    s = F.sort_array(F.collect_list(F.struct("date", "others", "chose_cat")), asc=False)
    return series.agg(s.alias("_s")).select(
        F.transform("_s", lambda x: x["others"]).alias("others"),
        F.transform("_s", lambda x: x["chose_cat"]).alias("chose_cat"),
        F.transform("_s", lambda x: day_string(x["date"])).alias("dates"))


def resolve_category_column(label: str, vocab: S.Vocabulary = S.DOMAIN) -> str:
    """Dashboard label -> history column (dictionary lookup, default = input)."""
    return vocab.tracked.get(label, label)


def history_long(history: DataFrame, vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """Wide history -> (date, category, posts)."""
    return history.unpivot(["date"], list(vocab.tracked.values()), "category", "posts")


def history_delta(history: DataFrame, vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """Day-over-day change per category (a derived measure of ours)."""
    w = Window.partitionBy("category").orderBy("date")
    return (history_long(history, vocab)
            .withColumn("delta", F.col("posts") - F.lag("posts").over(w)))
