"""Top terms of a vocabulary too large to shuffle: a summary per task, then an exact count of its candidates.

Web-scale text has more distinct words (codes, typos, hashes) than any top list needs. Pass 1 keeps at most ``slots``
counters a task (Misra and Gries; the summaries are mergeable): when a task holds more, the (slots + 1)-th largest count c is
taken off every counter and added to the task's error. A word's true count then lies between its summed counters
(``low``) and low + D, where D is the sum of all errors; D is at most the number of words / (slots + 1). Pass 2 counts
candidates exactly.

No top word is missed: let L be the k-th largest ``low``. At least k words occur L times or more, so a word of the
top k, ties included, occurs at least L times. A word with low + D < L occurs fewer times. As long as D < L this
holds for words in no summary (low = 0) as well, so all words of the top k are among those with low + D >= L. If D >= L,
or if the candidates are too many to broadcast, the full count is taken instead: the result is the same either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsift import schema as S
from jobsift.functions.text import STOP_WORDS, keep_word, plural_stem, strip_possessive, words
from jobsift.operators import terms
from jobsift.session import scratch_path

SLOTS = 1 << 16
BROADCAST_ROWS = 100_000
SUMMARY = "item string, low long, error long"


def summarise(slots: int):
    """For ``mapInArrow`` over one column of arrays: the task's counters, one row each, and its error in a row without an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, counts, error = pa.array([], pa.string()), np.zeros(0, np.int64), 0
        for batch in batches:
            found = pc.list_flatten(batch.column(0)).cast(pa.string()).drop_null()
            if not len(found):
                continue
            seen = found.value_counts()
            merged = pa.table({"item": pa.concat_arrays([items, seen.field("values")]),
                               "n": pa.concat_arrays([pa.array(counts), seen.field("counts").cast(pa.int64())])})
            merged = merged.group_by("item").aggregate([("n", "sum")]).combine_chunks()
            items, counts = merged["item"].combine_chunks(), merged["n_sum"].to_numpy().copy()
            if len(counts) > slots:
                cut = int(np.partition(counts, -(slots + 1))[-(slots + 1)])
                error += cut
                left = counts > cut
                items, counts = items.filter(pa.array(left)), counts[left] - cut
        if len(items) or error:
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([items, pa.array([None], pa.string())]),
                pa.array(np.append(counts, 0)),
                pa.array(np.append(np.zeros(len(items), np.int64), error))], names=["item", "low", "error"])

    return run


def candidates(lists: DataFrame, k: int, slots: int = SLOTS) -> DataFrame | None:
    """(item): every item of the exact top ``k`` (ties included) and some more, of a frame with one column of arrays; None if
    the summaries cannot prove that. The summaries, at most ``slots`` rows a task, are written once."""
    spark = lists.sparkSession
    path = scratch_path(spark, "summaries")
    lists.mapInArrow(summarise(slots), SUMMARY).write.parquet(path)
    held = spark.read.schema(SUMMARY).parquet(path)
    error = held.agg(F.coalesce(F.sum("error"), F.lit(0))).first()[0]
    low = held.where(F.col("item").isNotNull()).groupBy("item").agg(F.sum("low").alias("low"))
    top = low.orderBy(F.desc("low")).limit(k)
    n, least = top.agg(F.count(F.lit(1)), F.min("low")).first()
    if error == 0:  # the summaries are the whole count
        return low.where(F.col("low") >= (least if n == k else 0)).select("item")
    if n < k or error >= least:
        return None
    return low.where(F.col("low") + error >= least).select("item")


def group_key(word: Column) -> Column:
    """The group whose words are shown as one term (``terms.fuse_terms``): a function of the word alone."""
    key = F.lower(strip_possessive(word))
    return F.coalesce(plural_stem(key), key)


def top_terms(texts: DataFrame, text_col: str = "text", k: int = S.TOP_TERMS, stop_words=STOP_WORDS, slots: int = SLOTS,
              broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A9 + L6: equals ``terms.top_terms`` without a shuffle of the vocabulary.

    A term's frequency is that of its group, so groups are summarised and counted. Candidates go out by broadcast
    only after they are counted (at most ``broadcast_rows``); beyond that, or without a proof, the full count
    runs. NULL texts have no words; no words give no rows.
    """
    kept = F.filter(words(text_col), lambda w: keep_word(strip_possessive(w), stop_words))
    found = candidates(texts.where(F.col(text_col).isNotNull()).select(F.transform(kept, group_key).alias("items")), k, slots)
    if found is None or found.limit(broadcast_rows + 1).count() > broadcast_rows:
        return terms.top_terms(texts, text_col, k, stop_words)
    occurring = terms.word_rows(texts, text_col).withColumn("item", group_key(F.col("word")))
    exact = (occurring.join(F.broadcast(found), "item", "left_semi")
             .groupBy("word").agg(F.count(F.lit(1)).alias("c")))
    return terms.fuse_terms(exact, (), stop_words).orderBy(F.desc("n"), "term").limit(k)
