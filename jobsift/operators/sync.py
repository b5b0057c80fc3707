"""Keeping the posting table in step with each source's daily snapshot.

The original runs staged SQL statements with separate commits (upsert by
unique job_code, append categories, delete this source's codes missing
from today). Here the new state is one DataFrame, built from anti joins and
a union, and written once (``commit_table``), so a failure leaves the old
version in place.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobsift.functions.predicates import text_match
from jobsift.operators.ordering import ordinals, pinned_order
from jobsift.operators.quality import split_valid
from jobsift.schema import JOB_COLUMNS


def _source_match(site: str, collation: str | None):
    # NULL sources never match, so they are never deleted.
    return F.coalesce(text_match("job_source", site, "contains", collation), F.lit(False))


def union_sources(*batches: DataFrame) -> DataFrame:
    """M1: several normalised sources into one table."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b)
    return out


def sync_changes(target: DataFrame, batch: DataFrame, site: str, collation: str | None = None) -> DataFrame:
    """(job_code, kind): what ``sync_jobs`` does to each code: ``inserted``, ``changed`` (upserted) or
    ``removed``; codes that it leaves alone have no row. One full join on the unique code."""
    old = target.select("job_code", _source_match(site, collation).alias("_mine"))
    new = batch.select("job_code").distinct().withColumn("_new", F.lit(True))
    kind = (F.when(F.col("_mine").isNull(), F.lit("inserted")).when(F.col("_new").isNotNull(), F.lit("changed"))
            .when(F.col("_mine"), F.lit("removed")))
    return old.join(new, "job_code", "full").select("job_code", kind.alias("kind")).where("kind IS NOT NULL")


def stale_jobs(target: DataFrame, batch: DataFrame, site: str,
               collation: str | None = None) -> DataFrame:
    """This source's stored rows whose code is not in today's batch."""
    return (target.where(_source_match(site, collation))
            .join(batch.select("job_code"), "job_code", "left_anti"))


def _key_anti(left: DataFrame, right: DataFrame, key: str, key_collation: str | None) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``; with ``key_collation``
    keys compare under that collation (e.g. ``UNICODE_CI_AI``, as the
    original's unique key does), still as an equi join."""
    if key_collation is None:
        return left.join(right.select(key), key, "left_anti")
    r = right.select(F.collate(F.col(key), key_collation).alias("_rk"))
    return left.join(r, F.collate(left[key], key_collation) == r["_rk"], "left_anti")


def sync_jobs(target: DataFrame, batch: DataFrame, site: str,
              collation: str | None = None, key_collation: str | None = None) -> DataFrame:
    """M2 + M4: upsert today's batch and drop this source's missing codes.

    Rows of other sources are untouched, except that a code present in the
    batch is replaced wherever it was stored (upsert by unique key). Use
    ``guard_empty`` first: an empty batch must leave the table unchanged.
    ``key_collation`` makes codes that differ only in case (and accents)
    the same key, as the original's unique index does. A code that the batch
    holds more than once enters once (``unique_batch``), so the target's key
    stays unique.
    """
    batch = unique_batch(batch.select(*JOB_COLUMNS), "job_code", key_collation)
    kept = _key_anti(target, batch, "job_code", key_collation).where(~_source_match(site, collation))
    return kept.select(*JOB_COLUMNS).unionByName(batch.select(*JOB_COLUMNS))


def unique_batch(batch: DataFrame, key: str, key_collation: str | None = None) -> DataFrame:
    """One row per key: the smallest of its rows (compared column by column),
    a min over a struct that combines map-side."""
    k = F.col(key) if key_collation is None else F.collate(F.col(key), key_collation)
    least = F.min(F.struct(*[F.col(c) for c in batch.columns])).alias("_row")
    return batch.groupBy(k.alias("_key")).agg(least).select("_row.*")


def land(batch: DataFrame, path: str) -> DataFrame:
    """Write a derived batch once and read it back, so that a guard, a policy
    check and the load itself do not each run what derived it."""
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.parquet(path)


def guard_empty(target: DataFrame, landed: DataFrame, step) -> DataFrame:
    """M5: run ``step(target, landed)`` only when the batch has a row.

    ``landed`` is the batch as files (``land``, or a reader): ``isEmpty`` then
    reads one row of a scan. On a derived batch it would run its shuffles.
    """
    return target if landed.isEmpty() else step(target, landed)


def append_categories(categories: DataFrame, new: DataFrame) -> DataFrame:
    """M3 as the original behaves: pairs are appended, duplicates included."""
    return categories.select("job_code", "job_category").unionByName(new.select("job_code", "job_category"))


def set_categories(categories: DataFrame, new: DataFrame) -> DataFrame:
    """M3 with set semantics: distinct (job_code, job_category) pairs."""
    return append_categories(categories, new).distinct()


def cascade(children: DataFrame, jobs: DataFrame) -> DataFrame:
    """Keep child rows whose job still exists (ON DELETE CASCADE)."""
    return children.join(jobs.select("job_code"), "job_code", "left_semi")


def cascade_categories(categories: DataFrame, new: DataFrame, jobs: DataFrame) -> DataFrame:
    """M3 + J8 in one shuffle of the bridge: the set of categories per job (map-side
    combined, bounded by the category list), semi-joined on the same key, exploded."""
    per_job = (append_categories(categories, new).groupBy("job_code")
               .agg(F.collect_set("job_category").alias("_cats")))
    return cascade(per_job, jobs).select("job_code", F.explode("_cats").alias("job_category"))


def orphans(children: DataFrame, jobs: DataFrame) -> DataFrame:
    """Child rows pointing at no job."""
    return children.join(jobs.select("job_code"), "job_code", "left_anti")


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the first row per key in ``order``.

    A min over a struct of the order columns (plus the row) combines
    map-side, so a key repeated across a third of the input costs one
    partial aggregate per task instead of one oversized window partition.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest])
    return (df.groupBy(key).agg(F.min(packed).alias("_first"))
            .select(key, *[F.col(f"_first.{c}").alias(c) for c in order + rest]))


def duplicate_keys(df: DataFrame, keys: list[str], key_collation: str | None = None) -> DataFrame:
    """Q9: keys that occur more than once, with their count.

    With ``key_collation`` keys are grouped under that collation (the
    smallest spelling is reported); the count combines map-side either way.
    """
    if key_collation is None:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    grouped = df.groupBy(*[F.collate(F.col(k), key_collation).alias(f"_{k}") for k in keys])
    return (grouped.agg(*[F.min(k).alias(k) for k in keys], F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select(*keys, "n"))


REQUIRED = ("job_code", "job_title", "company_name", "job_location", "job_source", "create_date")


def batch_policy(batch: DataFrame, key: str = "job_code", required: tuple = REQUIRED) -> DataFrame:
    """All-or-nothing load. Raises if any key repeats or any required
    column is NULL; otherwise returns the batch unchanged."""
    any_null = reduce(or_, [F.col(c).isNull() for c in required])
    per_key = batch.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max(any_null).alias("bad"))
    most, bad = per_key.agg(F.max("n"), F.max("bad")).first()
    if (most or 0) > 1:
        raise ValueError("batch rejected: duplicate keys")
    if bad:
        raise ValueError("batch rejected: NULL in a required column")
    return batch


def land_observed(batch: DataFrame, path: str, key: str = "job_code", required: tuple = REQUIRED) -> tuple[DataFrame, dict]:
    """Write a batch once and know, from that same pass, whether it may be loaded.

    Rows meet on their key on the way to the file, each with how often its key occurs; ``observe`` carries the
    totals of the written rows to the driver: ``rows``, ``most`` (rows of the most frequent key) and ``nulls`` (rows with a NULL in a
    required column). Returns (landed batch, totals). A repeated key lands as its smallest row: such a batch is rejected
    (``commit_observed``) or loaded by ``sync_jobs``, which takes that row as well.
    """
    any_null = reduce(or_, [F.col(c).isNull() for c in required])
    least = F.min(F.struct(*[F.col(c) for c in batch.columns])).alias("_row")
    met = batch.groupBy(F.col(key).alias("_key")).agg(
        least, F.count(F.lit(1)).alias("_n"), F.sum(any_null.cast("long")).alias("_nulls"))
    totals = Observation()
    met = met.observe(totals, F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.coalesce(F.max("_n"), F.lit(0)).alias("most"),
                      F.coalesce(F.sum("_nulls"), F.lit(0)).alias("nulls"))
    met.select("_row.*").write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path), totals.get


def commit_observed(target: DataFrame, batch: DataFrame, path: str, step) -> DataFrame:
    """All-or-nothing load in one scan of the batch: an empty batch leaves ``target`` as it is (M5), a
    repeated key or a NULL in a required column rejects it (D4, raises), else ``step(target, landed)``."""
    landed, totals = land_observed(batch, path)
    if totals["rows"] == 0:
        return target
    if totals["most"] > 1:
        raise ValueError("batch rejected: duplicate keys")
    if totals["nulls"]:
        raise ValueError("batch rejected: NULL in a required column")
    return step(target, landed)


def row_policy(batch: DataFrame, rules: dict, order: list[str], key: str = "job_code",
               salts: int = 32) -> tuple[DataFrame, DataFrame]:
    """Row-by-row load: (loaded, rejected with ``reasons``).

    Rows that break a rule are rejected with the rules' names; of the others
    the first per key in ``order`` (then by the other columns) loads and
    every later one is rejected as ``duplicate_<key>``. Identical rows are
    counted before they meet their key's first row, and only keys that
    repeat are looked up, by (key, salt), so a key that repeats through a third of the
    batch is spread.
    """
    valid, broken = split_valid(batch, rules)
    rest = [c for c in batch.columns if c not in order]
    whole = F.struct(*order, *rest)
    rows = valid.groupBy(*batch.columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_row", whole).withColumn(
        "_salt", F.pmod(F.xxhash64(*order, *rest), F.lit(salts)).cast("int"))
    again = (rows.groupBy(key).agg(F.min("_row").alias("_first"), F.sum("_n").alias("_all")).where("_all > 1")
             .select(key, "_first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")))
    met = rows.join(again, [key, "_salt"], "left")
    first = F.col("_first").isNull() | (F.col("_row") == F.col("_first"))
    loaded = met.where(first).select(*batch.columns)
    late = met.withColumn("_late", F.col("_n") - F.when(first, 1).otherwise(0)).where("_late > 0")
    late = (late.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_late"))))
            .select(*batch.columns, F.lit(f"duplicate_{key}").alias("reasons")))
    return loaded, broken.unionByName(late)


def assign_ids(df: DataFrame, key: str, start: int = 0, path: str | None = None) -> DataFrame:
    """AUTO_INCREMENT-style surrogate ids ``start + 1, start + 2, ...``
    in ``key`` order.

    Unique and dense, unlike a 64-bit hash of the key (which collides with
    noticeable probability at 10^9 keys). The order is computed with a
    global sort and per-slice offsets (``ordering``), never a window over
    the whole table.
    """
    numbered = ordinals(pinned_order(df, [key], path), [], "_pos")
    return numbered.withColumn("id", F.lit(int(start)).cast("bigint") + F.col("_pos")).drop("_pos")


def insert_with_ids(table: DataFrame, new: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """M11 on insert: rows of ``new`` whose key is not stored get ids after
    the table's current maximum (one aggregate value fetched)."""
    top = table.agg(F.max("id")).first()[0] or 0
    return assign_ids(new.join(table.select(key), key, "left_anti"), key, top, path)


def insert_unique(existing: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """M9: new rows whose key is not stored yet; within the batch the first wins."""
    firsts = first_wins(new, key, order)
    return firsts.join(existing.select(key), key, "left_anti")


def commit_table(df: DataFrame, root: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Write the new state once below ``root`` and switch the pointer to it.

    The version is written in full to a folder of its own. Only then the file
    ``root/CURRENT`` is replaced, in one rename, so readers see the old
    state or the new one and a failure before the rename changes nothing. The
    version before stays for readers that still have it open; older ones go.
    Returns the new version's path.
    """
    spark = df.sparkSession
    name = f"v-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(f"{root}/{name}")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path, fs_api = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs
    before = _pointer(spark, root)
    fs = path(root).getFileSystem(conf)
    out = fs.create(path(f"{root}/next-{name}"), True)
    out.writeBytes(name)
    out.close()
    rename = spark.sparkContext._gateway.new_array(fs_api.Options.Rename, 1)
    rename[0] = fs_api.Options.Rename.OVERWRITE
    qualified = fs.makeQualified(path(root))
    fs_api.FileContext.getFileContext(qualified.toUri(), conf).rename(
        path(qualified, f"next-{name}"), path(qualified, "CURRENT"), rename)
    for s in fs.listStatus(path(root)):
        if s.getPath().getName().startswith("v-") and s.getPath().getName() not in (name, before):
            fs.delete(s.getPath(), True)
    return f"{root}/{name}"


def _pointer(spark: SparkSession, root: str) -> str | None:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(f"{root}/CURRENT")
    if not at.getFileSystem(sc._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.text(f"{root}/CURRENT").first()[0]


def current_table(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The committed state below ``root``."""
    name = _pointer(spark, root)
    if name is None:
        raise FileNotFoundError(f"nothing committed under {root}")
    return spark.read.format(fmt).load(f"{root}/{name}")
