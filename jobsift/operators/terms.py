"""Term frequencies (the word-cloud input) over whole texts.

The original joins every skills text into one string and hands it to a
word-cloud generator (no collocations, 400 words). Its frequencies follow
the library's rules: words in their original case, trailing "'s" cut,
digits-only words and stop words dropped, a plural ("apis") folded into its
singular ("api") when the singular occurs too, and each word shown in its
most frequent spelling (ties: the smaller string; the original's tie
follows fetch order, which has no ORDER BY).

Here texts are split into words JVM-side (``regexp_extract_all``) and
counted per spelling with a partial (map-side) aggregation, so a very
common word never makes a skewed shuffle partition. The word rules, plural
folding and case fusion then run once per distinct spelling on that
vocabulary-sized table, grouped by stem (see ``fuse_terms``). Only the final top-k is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift import schema as S
from jobsift.functions.text import STOP_WORDS, keep_word, plural_stem, strip_possessive, words
from jobsift.operators.market import category_weights


def skills_text(job: DataFrame) -> DataFrame:
    """the comma-separated skills of each job as blank-separated text."""
    return job.where(F.col("skills").isNotNull()).select(
        "job_code", F.replace(F.col("skills"), F.lit(","), F.lit(" ")).alias("text"))


def word_rows(texts: DataFrame, text_col: str = "text", keep=()) -> DataFrame:
    """One row per word occurrence: (*keep, word), original case, as found."""
    return texts.select(*keep, F.explode(words(text_col)).alias("word"))


def spelling_counts(texts: DataFrame, text_col: str = "text", by=()) -> DataFrame:
    """(*by, word, c): occurrences of each spelling as found in the texts."""
    return word_rows(texts, text_col, by).groupBy(*by, "word").agg(F.count(F.lit(1)).alias("c"))


def fuse_terms(counts: DataFrame, by=(), stop_words=STOP_WORDS) -> DataFrame:
    """(*by, word, c) spelling counts -> (*by, term, n) word-cloud frequencies.

    Spellings are cut at "'s"; digits-only and stop words are dropped. A
    lower-case key ending in one 's' is folded into key[:-1] when that key
    occurs in the same group; its spellings lose their last character. The
    shown term is the spelling with the largest count (then the smaller
    string); n sums every spelling of the key.

    The word rules depend on a spelling's text only, so they run once per
    distinct spelling here, after the map-side combined count, never per
    occurrence. (As a filter they would be pushed below that aggregate, so
    they travel as a ``_keep`` flag and the rows are dropped after the
    window.) Every key is grouped under its stem (``plural_stem``, or the
    key itself when it is not plural-like). A stem is never plural-like, so
    a group holds at most the singular key and its one plural key, and
    always yields exactly one term: folded when the kept singular is
    present, else the lone key. So one shuffle on (group, stem) of the
    spelling table does it: a window flags groups holding the singular, and
    the two aggregates after it run on the same partitioning with no further
    exchange, no self-join and no second pass over the texts.
    """
    by = list(by)
    spelled = counts.select(*by, strip_possessive("word").alias("word"), "c")
    key = F.lower("word")
    grouped = (spelled.withColumn("_keep", keep_word("word", stop_words))
               .withColumn("_g", F.coalesce(plural_stem(key), key)))
    singular = F.max((F.col("_keep") & (key == F.col("_g"))).cast("int")).over(Window.partitionBy(*by, "_g"))
    folded = (grouped.withColumn("_s", singular).where("_keep")
              .withColumn("word", F.when((F.col("_s") == 1) & (key != F.col("_g")),
                                         F.col("word").substr(F.lit(1), F.length("word") - 1))
                          .otherwise(F.col("word"))))
    spellings = folded.groupBy(*by, "_g", "word").agg(F.sum("c").alias("c"))
    fused = spellings.groupBy(*by, "_g").agg(
        F.sum("c").cast("bigint").alias("n"),
        F.min(F.struct((-F.col("c")).alias("neg"), F.col("word").alias("w"))).alias("_shown"))
    return fused.select(*by, F.col("_shown.w").alias("term"), "n")


def term_counts(texts: DataFrame, text_col: str = "text", by=(), stop_words=STOP_WORDS) -> DataFrame:
    """(*by, term, n): word-cloud frequencies of the texts of each group."""
    return fuse_terms(spelling_counts(texts, text_col, by), by, stop_words)


def top_terms(texts: DataFrame, text_col: str = "text", k: int = S.TOP_TERMS,
              stop_words=STOP_WORDS) -> DataFrame:
    """A9 + L6: the k most frequent terms (ties by term)."""
    return term_counts(texts, text_col, (), stop_words).orderBy(F.desc("n"), "term").limit(k)


def term_weights(top: DataFrame) -> DataFrame:
    """relative weight n / max(n) over the (bounded) top-k result."""
    return top.withColumn("weight", F.col("n").cast("double") / F.max("n").over(Window.partitionBy()).cast("double"))


def _top_per_group(counts: DataFrame, by: str, k: int) -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.desc("n"), "term")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_terms_by(texts: DataFrame, by: str, text_col: str = "text", k: int = S.TOP_TERMS,
                 stop_words=STOP_WORDS) -> DataFrame:
    """Top-k terms per group, each group's word cloud on its own texts;
    the per-group cut is applied per task before the shuffle
    (WindowGroupLimit)."""
    return _top_per_group(term_counts(texts, text_col, (by,), stop_words), by, k)


def skill_terms_by_category(job: DataFrame, job_category: DataFrame, k: int = S.TOP_TERMS) -> DataFrame:
    """R5 on skills: the word-cloud terms of every category at once.

    As in the original's ``job ⟕ job_category`` form, a job's skills count
    once per category row; the bridge is first reduced to (job, category,
    weight) so duplicate pairs are not re-tokenised, and spelling counts are
    summed weights. Top-k per category uses the per-task WindowGroupLimit.
    """
    occ = word_rows(skills_text(job), keep=("job_code",))
    counts = (occ.join(category_weights(job_category), "job_code")
              .groupBy("job_category", "word").agg(F.sum("w").alias("c")))
    return _top_per_group(fuse_terms(counts, ("job_category",)), "job_category", k)
