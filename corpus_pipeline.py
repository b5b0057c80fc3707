"""Corpus pipeline: quality, exact dedup, near dedup, mixing, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet in the shared scratch folder
and read again as the next stage's ``docs``. All stages but the last return
the columns of ``documents``, of the rows they keep:

- quality: rows that the classifier keeps;
- exact dedup: the row with the largest doc_id of each group of equal texts;
- near dedup: the row with the smallest doc_id of each SimHash component;
- mixing: each row as often as the mix takes it, which can be not at all;
- packing: token pieces in windows.

Null and repeated ids, null columns, extra columns and empty tables are handled as
the operators state; rows are told apart by doc_id and all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift.llm import exact_dedup, mixing, packing, quality_classifier, simhash
from jobsift.llm.common import documents, drop, fresh, one_row_each, quoted
from jobsift.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = fresh(docs, "verdict")
    judged = docs.withColumn(verdict, quality_classifier.judge(quality_classifier.fit(docs), F.col("text")))
    return judged.where(F.col(f"{verdict}.kept")).select(*[quoted(c) for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_row_each(docs, exact_dedup.exact_dedup(docs, keep="largest").where("kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_row_each(docs, simhash.simhash_dedup(docs).where("doc_id <=> component_id AND row_hash = owner_hash"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_row_each(docs, mixing.mix(docs), copies="copies")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.byte_bpe())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("mixing", mixed),
    ("packing", packed),
]

# the classifier is fitted, the mix tossed for and the tokens BPE: tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; every stage's folder goes once the next one is written."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
