"""Stored posting tables, bucketed on the join key.

``job`` and ``job_category`` are joined on job_code by almost every query.
Written with the same ``bucketBy(n, "job_code")``, the sort-merge joins
between them read matching buckets directly, with no shuffle of either
side; the daily sync rewrites them once per load. Tables live under the
shared checkpoint folder unless a location is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsift.session import scratch_path


def save_bucketed(spark: SparkSession, df: DataFrame, name: str, key: str = "job_code",
                  buckets: int = 64, location: str | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` bucketed and sorted by ``key``.

    Pick ``buckets`` so one bucket is a few hundred MB at the target size;
    every table joined on ``key`` must use the same number.
    """
    (df.write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key)
     .option("path", location or scratch_path(spark, name))
     .saveAsTable(name))
    return spark.table(name)


def save_posting_tables(spark: SparkSession, job: DataFrame, job_category: DataFrame,
                        buckets: int = 64, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    return (save_bucketed(spark, job, f"{prefix}job", buckets=buckets),
            save_bucketed(spark, job_category, f"{prefix}job_category", buckets=buckets))
