"""Positions in a global order, computed without a single-task window.

``row_number()`` over a whole table or over one very large key puts every
row of that window in one task. Here the rows are sorted globally instead:
range partitioning cuts the order (and any hot key's run in it) into
contiguous slices, one per task, and each row gets its slice number and its
position in the slice. Everything else is arithmetic on small per-slice
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift.session import scratch_path


def pinned_order(df: DataFrame, order: list[str], path: str | None = None) -> DataFrame:
    """``df`` sorted by ``order`` with ``_p`` (slice) and ``_i`` (row id).

    ``_i`` is consecutive within a slice (``monotonically_increasing_id``).
    Range bounds come from sampling, so the result is written once to
    ``path`` (default: a fresh folder under the shared checkpoint folder)
    and read back: every later use sees the same slices, and a lost
    executor cannot renumber rows.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "pinned-order")
    (df.orderBy(*order)
     .withColumn("_p", F.spark_partition_id())
     .withColumn("_i", F.monotonically_increasing_id())
     .write.parquet(path))
    return spark.read.parquet(path)


def ordinals(pinned: DataFrame, keys: list[str], name: str = "ordinal") -> DataFrame:
    """1-based position of each row within its key, in the pinned order.

    A key's rows in one slice are a segment; its ordinals continue from the
    key's rows in earlier slices (a running sum over at most one row per
    slice the key spans). With no keys this is the position in the table.
    """
    seg = pinned.groupBy(*keys, "_p").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = seg.select(*keys, "_p", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    if not keys:
        # one row per slice: the table of offsets is bounded by the number
        # of partitions, so it is broadcast
        offsets = F.broadcast(offsets)
    pos = F.col("_before") + (F.col("_i") - F.col("_first")) + 1
    return (pinned.join(offsets, [*keys, "_p"])
            .withColumn(name, pos.cast("bigint"))
            .drop("_p", "_i", "_first", "_before"))
