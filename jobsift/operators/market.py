"""Dashboard aggregates: average pay by category and region, education mix.

Joins are ``job ⟕ job_category`` on job_code, so a job counts once per
category row (duplicate pairs included) and once with a NULL category when
it has none: the original dashboard's weighting. The bridge table is first
reduced to (job_code, job_category, weight) with a map-side combined count,
so the join fans a job out to at most its number of distinct categories,
however many duplicate rows an append-only bridge has piled up for it (a
hot job cannot skew the join), and the weights carry the duplicates into
the aggregates. Averages use exact integer sums (see ``functions.numeric``),
so they are independent of partitioning and summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsift import schema as S
from jobsift.functions.numeric import weighted_mid_salary_average
from jobsift.functions.predicates import known_pay, period_excluded

_PAY_COLS = ["job_code", "job_location", "min_salary", "max_salary", "salary_period"]


def region_of(vocab: S.Vocabulary, col: str = "job_location"):
    return F.left(F.col(col), F.lit(vocab.region_chars))


def edu_of(vocab: S.Vocabulary, col: str = "edu_level"):
    return F.left(F.col(col), F.lit(vocab.edu_chars))


def category_weights(job_category: DataFrame, category: str | None = None,
                     categories=None) -> DataFrame:
    """(job_code, job_category, w): distinct pairs with their row count."""
    jc = job_category.select("job_code", "job_category")
    if category is not None:
        jc = jc.where(F.col("job_category") == category)
    if categories is not None:
        jc = jc.where(F.col("job_category").isin(list(categories)))
    return jc.groupBy("job_code", "job_category").agg(F.count(F.lit(1)).alias("w"))


def category_counters(job_category: DataFrame, categories) -> DataFrame:
    """(job_code, _cats): one row per job with its row count in each of the
    given categories, combined map-side: one shuffle, keyed as ``job`` is."""
    c = F.col("job_category")
    named = list(enumerate(categories))
    counters = [F.count(F.when(c == cat, 1)).alias(f"_w{i}") for i, cat in named]
    pairs = F.array(*[F.struct(F.lit(cat).alias("job_category"), F.col(f"_w{i}").alias("w")) for i, cat in named])
    return (job_category.where(c.isin([cat for _, cat in named])).groupBy("job_code").agg(*counters)
            .select("job_code", F.filter(pairs, lambda p: p["w"] > 0).alias("_cats")))


def weighted_by_category(job: DataFrame, job_category: DataFrame, categories=None) -> DataFrame:
    """``job`` rows once per category of theirs, with the weight ``w``.

    With the closed list of ``categories`` the bridge is shuffled once, as
    counters per job; without one it is reduced per pair first.
    """
    if categories is None:
        return job.join(category_weights(job_category), "job_code")
    return (job.join(category_counters(job_category, categories), "job_code")
            .select(*job.columns, F.inline("_cats")))


def job_weights(job_category: DataFrame) -> DataFrame:
    """(job_code, w): number of category rows per job."""
    return job_category.groupBy("job_code").agg(F.count(F.lit(1)).alias("w"))


def _paid_jobs(job: DataFrame, vocab: S.Vocabulary, period_match: str) -> DataFrame:
    """Jobs with a known monthly pay in a whitelisted region."""
    return (job.select(*_PAY_COLS)
            .where(known_pay() & ~period_excluded(match=period_match, negotiable=False))
            .where(region_of(vocab).isin(vocab.regions)))


def category_salary(job: DataFrame, job_category: DataFrame,
                    vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """A1: average mid salary per tracked category, highest first."""
    return (weighted_by_category(_paid_jobs(job, vocab, "contains"), job_category, vocab.tracked)
            .groupBy("job_category")
            .agg(weighted_mid_salary_average("w").alias("category_average"))
            .orderBy(F.desc("category_average"), "job_category"))


def region_salary(job: DataFrame, job_category: DataFrame, category: str | None = None,
                  vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """A2/A3: average mid salary per region, optionally for one category.

    Without a category the period markers are excluded anywhere in the text
    and every (job, category row) counts; with one, the markers are excluded
    by prefix (the original's two variants) and the join is inner.
    """
    if category is None:
        # a job without category rows still counts once (left join)
        base = (_paid_jobs(job, vocab, "contains")
                .join(job_weights(job_category), "job_code", "left")
                .withColumn("w", F.coalesce("w", F.lit(1))))
    else:
        base = _paid_jobs(job, vocab, "prefix").join(
            category_weights(job_category, category=category), "job_code")
    return (base.groupBy(region_of(vocab).alias("region"))
            .agg(weighted_mid_salary_average("w").alias("region_average"))
            .orderBy(F.desc("region_average"), "region"))


def region_salary_by_category(job: DataFrame, job_category: DataFrame,
                              vocab: S.Vocabulary = S.DOMAIN, categories=None) -> DataFrame:
    """A3 for every category in one pass: (job_category, region, region_average).
    ``categories``: see ``weighted_by_category``."""
    return (weighted_by_category(_paid_jobs(job, vocab, "prefix"), job_category, categories)
            .groupBy("job_category", region_of(vocab).alias("region"))
            .agg(weighted_mid_salary_average("w").alias("region_average"))
            .orderBy("job_category", F.desc("region_average"), "region"))


def edu_distribution(job: DataFrame, vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """A4 + A11: postings per education prefix and their share of the total.

    The grouped result has at most ``len(vocab.edu_prefixes)`` rows, so the
    global share window runs over a bounded input.
    """
    edu = edu_of(vocab)
    counts = (job.select("edu_level")
              .where(F.col("edu_level").isNotNull() & edu.isin(vocab.edu_prefixes))
              .groupBy(edu.alias("min_edu_level"))
              .agg(F.count(F.lit(1)).alias("count")))
    return counts.withColumn("share", share_of_total("count"))


def edu_distribution_by_category(job: DataFrame, job_category: DataFrame,
                                 vocab: S.Vocabulary = S.DOMAIN, categories=None) -> DataFrame:
    """Per (category, education prefix) count, weighted by category
    rows, and the share within the category. ``categories``: see
    ``weighted_by_category``."""
    edu = edu_of(vocab)
    known = (job.select("job_code", "edu_level")
             .where(F.col("edu_level").isNotNull() & edu.isin(vocab.edu_prefixes)))
    counts = (weighted_by_category(known, job_category, categories)
              .groupBy("job_category", edu.alias("min_edu_level"))
              .agg(F.sum("w").cast("bigint").alias("count")))
    return counts.withColumn("share", share_of_total("count", "job_category"))


def share_of_total(col: str, *partition: str):
    """n / sum(n) over the partition, as a double (A11, pie percentages)."""
    w = Window.partitionBy(*partition)
    return F.col(col).cast("double") / F.sum(F.col(col)).over(w).cast("double")
