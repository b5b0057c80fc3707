"""The five tables from a relational database, read in parallel.

``partition_column`` must be numeric, date or timestamp; Spark issues one
range query per partition, so the read scales with ``num_partitions``
(bounds only set the stride: rows outside them land in the first or last
partition, none are dropped). ``load`` connects once to resolve the
schema; rows move when an action runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("job", "job_category", "job_post_change", "user", "user_bookmark")


def read_table(spark: SparkSession, url: str, table: str, properties: dict,
               partition_column: str | None = None, lower: int | None = None,
               upper: int | None = None, num_partitions: int = 64) -> DataFrame:
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in properties.items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    return reader.load()
