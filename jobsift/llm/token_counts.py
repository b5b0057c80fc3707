"""Token counts: delta-maintained rollups by source, language and tokenizer version.

A batch is a set of signed rows: +1 inserts a document, -1 deletes it, and a
revision is both (-1 with the old row, +1 with the new one). Each task counts its
documents' tokens under every tokenizer version; ``delta`` adds up the signed
counts per (source, lang, tokenizer), so that a batch becomes a few additive
rows before any shuffle of documents.

``Rollup`` keeps one folder per batch id under a shared path. A batch is
committed when Spark's writer has put its marker into the folder; a
batch that is sent again is left alone, one that was cut off is written
anew. Totals are the sum over committed batches; ``compact`` folds them into
a base that lists the batches it holds, so that the sum stays short.

Defined results: null text has no tokens but is a document; null source or
language is a group; repeated rows count each time; an empty batch commits
as such; a group whose documents and tokens all come to zero is
not listed; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsift.llm.common import TokenIds, quoted
from jobsift.session import scratch_path

GROUP = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, documents long, tokens long"


def byte_bpe(name: str) -> Callable:
    def load():
        import public_tokenizers as P

        ids = TokenIds(P.path(f"{name}.json"), P.path(f"{name}.tiktoken"), P.PATTERN)
        return lambda text: len(ids(text))

    return load


def white_space() -> Callable:
    return lambda text: len(text.encode("utf-8", "replace").split())


def counted(docs: DataFrame, tokenizers: dict[str, Callable], id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens): one row per row of ``docs`` and tokenizer version."""
    names = list(tokenizers)

    def run(batches):
        loaded = [tokenizers[n]() for n in names]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            counts = [[f(t) if t else 0 for f in loaded] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(counts, pa.list_(pa.int64()))],
                names=["doc_id", "source", "lang", "counts"])

    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"),
                       quoted(source_col).cast("string").alias("source"), quoted(lang_col).cast("string").alias("lang"))
    pairs = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("tokenizer"), F.col("counts").alias("tokens"))
    return (rows.mapInArrow(run, "doc_id long, source string, lang string, counts array<long>")
            .select("doc_id", "source", "lang", F.explode(pairs).alias("p"))
            .select("doc_id", "source", "lang", F.col("p.tokenizer").alias("tokenizer"), F.col("p.tokens").alias("tokens")))


def delta(signed: DataFrame) -> DataFrame:
    """Additive rows of a batch from (sign, source, lang, tokenizer, tokens)."""
    return signed.groupBy(*GROUP).agg(F.sum(F.col("sign").cast("long")).alias("documents"),
                                      F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"))


class Rollup:
    """Totals kept as committed deltas below ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self.at = jvm.org.apache.hadoop.fs.Path
        self.fs = self.at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, batch_id: str) -> str:
        return f"{self.path}/batches/{quote(batch_id, safe='')}"

    def _names(self, folder: str) -> list[str]:
        """Folders below ``folder`` whose writer finished."""
        if not self.fs.exists(self.at(folder)):
            return []
        found = [s.getPath() for s in self.fs.listStatus(self.at(folder))]
        return sorted(p.getName() for p in found if self.fs.exists(self.at(p, "_SUCCESS")))

    def committed(self, batch_id: str) -> bool:
        base = self._base()
        return self.fs.exists(self.at(self._folder(batch_id), "_SUCCESS")) or \
            base is not None and quote(batch_id, safe="") in base[1]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Write the batch unless it is committed already; whether it was written."""
        if self.committed(batch_id):
            return False
        delta(changes).coalesce(1).write.mode("overwrite").parquet(self._folder(batch_id))
        return True

    def _base(self) -> tuple[str, set[str]] | None:
        """The newest base that is complete: its folder and the batches it holds."""
        names = self._names(f"{self.path}/bases")
        if not names:
            return None
        folder = f"{self.path}/bases/{names[-1]}"
        held = self.spark.read.parquet(f"{folder}/held").first()[0]
        return f"{folder}/totals", set(json.loads(held))

    def totals(self) -> DataFrame:
        base, held = self._base() or (None, set())
        parts = [f"{self.path}/batches/{n}" for n in self._names(f"{self.path}/batches") if n not in held]
        # names are escaped again by Spark's path reader only where they hold glob signs: quote() leaves none
        rows = self.spark.createDataFrame([], DELTA)
        for p in [*([base] if base else []), *parts]:
            rows = rows.unionByName(self.spark.read.schema(DELTA).parquet(p))
        return (rows.groupBy(*GROUP).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
                .where("documents <> 0 OR tokens <> 0"))

    def compact(self) -> None:
        """Fold all committed batches into a new base; the marker that makes it count is written last."""
        base = self._base()
        held = sorted((base[1] if base else set()) | set(self._names(f"{self.path}/batches")))
        number = int(base[0].split("/")[-2]) + 1 if base else 0
        folder = f"{self.path}/bases/{number:012d}"
        self.totals().coalesce(1).write.mode("overwrite").parquet(f"{folder}/totals")
        self.spark.createDataFrame([(json.dumps(held),)], "held string").write.mode("overwrite").parquet(f"{folder}/held")
        self.fs.create(self.at(folder, "_SUCCESS"), True).close()


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    """Rollup of all documents after four batches.

    load: all documents; revise: documents labelled low in quality move to the
    source "quarantine"; withdraw: documents labelled toxic are deleted from
    where they then stand; revise again, which changes nothing.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = (spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id")
              .agg((F.max("toxic") == 1).alias("toxic"), (F.min("quality") == 0).alias("low")))
    counts = counted(docs, {"byte_bpe_50k": byte_bpe("byte_bpe_50k"), "white space": white_space}).checkpoint()
    # rows without an id have no label; they stay out of the join, where they would share one key
    flags = [F.coalesce("toxic", F.lit(False)).alias("toxic"), F.coalesce("low", F.lit(False)).alias("low")]
    known = counts.where("doc_id IS NOT NULL").join(labels, "doc_id", "left").select(*counts.columns, *flags)
    known = known.union(counts.where("doc_id IS NULL").select("*", F.lit(False), F.lit(False)))
    moved = F.lit("quarantine").alias("source")
    rest = ["lang", "tokenizer", "tokens"]
    rollup = Rollup(spark, scratch_path(spark, "token-rollup"))
    rollup.commit("load", counts.withColumn("sign", F.lit(1)))
    revise = (known.where("low").select(F.lit(-1).alias("sign"), "source", *rest)
              .union(known.where("low").select(F.lit(1).alias("sign"), moved, *rest)))
    rollup.commit("revise", revise)
    stands = F.when(F.col("low"), F.lit("quarantine")).otherwise(F.col("source")).alias("source")
    rollup.commit("withdraw", known.where("toxic").select(F.lit(-1).alias("sign"), stands, *rest))
    rollup.compact()
    rollup.commit("revise", revise)
    return rollup.totals()
