"""Incremental jobs on Structured Streaming.

Sources are file streams read at most ``max_files`` files a micro-batch.
``run_available`` processes what has landed in bounded micro-batches and
stops; a later run with the same path and checkpoint takes up where the last
one ended. Defaults put both below the shared checkpoint folder, for single runs.

What has to be remembered per key is Spark's own keyed state (the state store
below the checkpoint): running counts, keys seen, keys seen within a
watermark. A micro-batch of k rows appends at most about k result rows, as plain
Parquet below ``batches/batch=<id>``; a replayed micro-batch overwrites its own
folder, so it changes nothing. What is read is settled from the batches by one
aggregate on the key, with Spark's own partitions. No table is rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift.operators import sync as sync_ops
from jobsift.schema import JOB, JOB_COLUMNS
from jobsift.session import scratch_path

MAX_FILES = 64

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

POSTING_CATEGORY = T.StructType([
    T.StructField("job_code", T.StringType()),
    T.StructField("job_category", T.StringType()),
    T.StructField("create_date", T.TimestampNTZType()),
])


def event_stream(spark: SparkSession, directory: str, file_glob: str = "events.parquet",
                 max_files: int = MAX_FILES) -> DataFrame:
    return (spark.readStream.schema(EVENTS).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files).parquet(directory))


def toggle_stream(events: DataFrame) -> DataFrame:
    """Click events as bookmark toggles."""
    return (events.where(F.col("event_type") == "click")
            .select("event_id", "ts", "user_id",
                    F.concat(F.lit("j"), F.get_json_object("props", "$.k")).alias("job_code")))


def run_available(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


# --- batches of results -------------------------------------------------------------

def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _places(spark: SparkSession, name: str, path: str | None, checkpoint: str | None) -> tuple[str, str]:
    """Where results and checkpoint go. Results without their checkpoint raise: the
    state that they follow from is lost, and batch numbers would start again."""
    path = (path or scratch_path(spark, name)).rstrip("/")
    checkpoint = checkpoint or f"{path}-checkpoint"
    if _exists(spark, f"{path}/batches") and not _exists(spark, checkpoint):
        raise ValueError(f"{path} holds results of another checkpoint than {checkpoint}")
    return path, checkpoint


def put_batch(rows: DataFrame, path: str, batch_id: int, by: tuple = ()) -> None:
    """The result rows of one micro-batch; written again, they replace themselves."""
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batches/batch={batch_id}")


def batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all micro-batches, with their ``batch``; none before the first."""
    if not _exists(spark, f"{path}/batches"):
        return spark.createDataFrame([], f"{schema}, batch bigint")
    return spark.read.schema(f"{schema}, batch bigint").parquet(f"{path}/batches")


# --- T4: toggles --------------------------------------------------------------------

TOGGLES = "user_id bigint, job_code string, n_toggles bigint"


def toggle_state(spark: SparkSession, events: DataFrame, path: str | None = None,
                 checkpoint: str | None = None) -> DataFrame:
    """T4: running toggle count per (user, job) and the bookmark parity.

    The count lives in the state store; in update mode a micro-batch gives the
    keys that it changed with their new counts. Counts only grow, so a key stands at its largest.
    """
    path, checkpoint = _places(spark, "toggle-state", path, checkpoint)
    counts = toggle_stream(events).groupBy("user_id", "job_code").agg(F.count(F.lit(1)).alias("n_toggles"))
    run_available(counts.writeStream.outputMode("update").foreachBatch(lambda rows, n: put_batch(rows, path, n)), checkpoint)
    return (batches(spark, path, TOGGLES).groupBy("user_id", "job_code").agg(F.max("n_toggles").alias("n_toggles"))
            .withColumn("bookmarked", F.col("n_toggles") % 2 == 1))


# --- T2: distinct counts and their sketches -------------------------------------------

SKETCH_BITS = 14  # 2^14 registers: relative standard error 0.8 %
SKETCH_BOUND = 0.05  # six standard errors


def _distinct_counts(spark: SparkSession, rows: DataFrame, groups: list[str], key: str, path: str, checkpoint: str) -> DataFrame:
    """(groups, n, sketch): distinct ``key`` values per group, exact and as a sketch that can be merged.

    ``dropDuplicates`` keeps every (group, key) seen in the state store and lets it
    through once, whenever it lands. A micro-batch then writes one row per group that
    it changed: how many keys were new, and a sketch of them. Exact counts are sums of
    those, sketches their unions; neither reads a key again.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{g} {kinds[g]}" for g in groups) + ", n bigint, sketch binary"

    def add(new: DataFrame, batch_id: int) -> None:
        put_batch(new.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(key, SKETCH_BITS).alias("sketch")),
                  path, batch_id)

    once = rows.select(*groups, key).dropDuplicates([*groups, key])
    run_available(once.writeStream.outputMode("append").foreachBatch(add), checkpoint)
    return batches(spark, path, schema).groupBy(*groups).agg(
        F.sum("n").alias("n"), F.hll_union_agg("sketch").alias("sketch"))


def daily_active_users(spark: SparkSession, events: DataFrame, path: str | None = None,
                       checkpoint: str | None = None) -> DataFrame:
    """Distinct users per (day, event_type), exact, late rows included."""
    path, checkpoint = _places(spark, "daily-users", path, checkpoint)
    counts = _distinct_counts(spark, events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "user_id", path, checkpoint)
    return counts.select("day", "event_type", F.col("n").alias("n_users"))


def daily_category_sketches(spark: SparkSession, rows: DataFrame, categories: list[str], path: str | None = None,
                            checkpoint: str | None = None) -> DataFrame:
    """(day, job_category, n, sketch) of the postings per last-seen day and
    tracked category. ``rows``: a stream of (job_code, job_category, create_date)
    bridge rows, duplicates included; rows that land late count in their day."""
    path, checkpoint = _places(spark, "daily-categories", path, checkpoint)
    tracked = rows.where(F.col("job_category").isin(list(categories))).withColumn("day", F.to_date("create_date"))
    return _distinct_counts(spark, tracked, ["day", "job_category"], "job_code", path, checkpoint)


def daily_category_counts(spark: SparkSession, rows: DataFrame, categories: list[str], path: str | None = None,
                          checkpoint: str | None = None) -> DataFrame:
    """The exact counts of ``daily_category_sketches``."""
    return daily_category_sketches(spark, rows, categories, path, checkpoint).select(
        "day", "job_category", F.col("n").alias("n_jobs"))


# --- T3: duplicates on event time -----------------------------------------------------

HORIZON = "2 days"
DAY_KEYS = "day date, job_code string, kind string"


def distinct_daily_codes(spark: SparkSession, events: DataFrame, path: str | None = None, checkpoint: str | None = None,
                         horizon: str = HORIZON) -> DataFrame:
    """Each (day, job_code) clicked, once.

    ``dropDuplicatesWithinWatermark`` lets a key's first row through and forgets
    the key ``horizon`` after it, so its state is bounded by the keys of that time. A key
    belongs to one day and the horizon is longer: no row that is in time can
    come after its key was forgotten. Rows older than the watermark are dropped by the
    operator, without a trace; they are caught beside it. The watermark of a micro-batch
    follows from the event times of earlier ones, so every row not younger than the latest earlier event time
    less the horizon is written as late (all that the operator drops, at most a few more). ``seen/batch=<id>``
    keeps each micro-batch's latest event time. Reading adds the late keys that are not there yet.
    """
    path, checkpoint = _places(spark, "daily-codes", path, checkpoint)
    clicks = (toggle_stream(events).withColumn("at", F.col("ts").cast("timestamp")).withColumn("day", F.to_date("ts"))
              .withWatermark("at", horizon).select("at", "day", "job_code"))
    first = clicks.dropDuplicatesWithinWatermark(["day", "job_code"]).withColumn("kind", F.lit("first"))
    both = first.unionByName(clicks.withColumn("kind", F.lit("late")))

    def add(rows: DataFrame, batch_id: int) -> None:
        latest = None
        if _exists(spark, f"{path}/seen"):
            before = spark.read.schema("at timestamp, batch bigint").parquet(f"{path}/seen").where(F.col("batch") < batch_id)
            latest = before.agg(F.max("at")).first()[0]
        late = F.col("at") <= F.lit(latest) - F.expr(f"INTERVAL {horizon}") if latest is not None else F.lit(False)
        seen = Observation()
        kept = rows.observe(seen, F.max("at").alias("at")).where((F.col("kind") == "first") | late)
        put_batch(kept.select("day", "job_code", "kind"), path, batch_id, ("kind",))
        newest = spark.createDataFrame([(seen.get["at"],)], "at timestamp")
        newest.write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")

    run_available(both.writeStream.outputMode("append").foreachBatch(add), checkpoint)
    keys = batches(spark, path, DAY_KEYS)
    on_time = keys.where("kind = 'first'").select("day", "job_code")
    late = keys.where("kind = 'late'").select("day", "job_code").distinct()
    same = late["day"].eqNullSafe(on_time["day"]) & late["job_code"].eqNullSafe(on_time["job_code"])
    return on_time.unionByName(late.join(on_time, same, "left_anti"))


# --- T1: upsert -----------------------------------------------------------------------

def upsert_stream(spark: SparkSession, stored: DataFrame, landing: str, site: str, path: str | None = None,
                  checkpoint: str | None = None, max_files: int = MAX_FILES) -> DataFrame:
    """Landed daily snapshots of one source -> synced job table.

    A row's snapshot is the day of its ``create_date``, which the load stamps; rows without one are in no
    snapshot. A micro-batch appends its rows, by day, and reads nothing else. The table is settled
    when it is read (``settled_jobs``). ``stored`` is the table before the first run.
    """
    path, checkpoint = _places(spark, "jobs", path, checkpoint)
    if not _exists(spark, f"{path}/base/CURRENT"):
        sync_ops.commit_table(stored.select(*JOB_COLUMNS, F.lit(None).cast("date").alias("_day")), f"{path}/base")
    rows = spark.readStream.schema(JOB).option("maxFilesPerTrigger", max_files).json(landing)
    rows = rows.select(*JOB_COLUMNS, F.to_date("create_date").alias("_day")).where("_day IS NOT NULL")
    run_available(rows.writeStream.foreachBatch(lambda new, n: put_batch(new, path, n, ("_day",))), checkpoint)
    return settled_jobs(spark, path, site)


JOB_ROWS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in JOB.fields) + ", _day date"


def _settled(spark: SparkSession, path: str, site: str) -> DataFrame:
    base, landed = sync_ops.current_table(spark, f"{path}/base"), batches(spark, path, JOB_ROWS).drop("batch")
    newest = base.select("_day").unionByName(landed.select("_day")).agg(F.max("_day")).first()[0]  # one date
    last = F.struct(F.datediff(F.lit("9999-12-31").cast("date"), F.coalesce("_day", F.lit("0001-01-01").cast("date"))).alias("_age"),
                    *JOB_COLUMNS, "_day")
    each = (base.select(*JOB_COLUMNS, "_day").unionByName(landed.select(*JOB_COLUMNS, "_day"))
            .groupBy("job_code").agg(F.min(last).alias("_row")).select("_row.*").drop("_age"))
    if newest is None:  # no snapshot yet
        return each
    gone = F.coalesce(F.col("job_source").contains(site), F.lit(False)) & ~F.col("_day").eqNullSafe(F.lit(newest))
    return each.where(~gone)


def settled_jobs(spark: SparkSession, path: str, site: str) -> DataFrame:
    """The synced table: snapshots taken in the order of their days, whatever the order they landed in.

    A code stands as its latest day has it (the smallest of that day's rows). Codes of ``site`` that the newest day
    does not have are gone; rows of other sources stay. One aggregate per code over the stored table and
    the appended rows.
    """
    return _settled(spark, path, site).select(*JOB_COLUMNS)


def fold_jobs(spark: SparkSession, path: str, site: str) -> None:
    """Write the settled table as the new base, then drop the batches that are in it. Between the two,
    rows that stand in both settle to the same table. Not while the stream runs."""
    sync_ops.commit_table(_settled(spark, path, site), f"{path}/base")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/batches")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(at):
        for folder in fs.listStatus(at):
            fs.delete(folder.getPath(), True)
