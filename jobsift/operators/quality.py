"""Validation: split rows into valid and rejected-with-reasons.

The original logs and drops bad records one at a time; here each rule is a
boolean column, the reasons are concatenated per row, and one pass yields
both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import schema as S
from jobsift.functions.numeric import half_up_div

REQUIRED = ["job_code", "job_title", "company_name", "job_location", "job_source", "create_date"]
TEXT_LIMITED = ["job_code", "job_title", "company_name", "job_location", "salary_period", "edu_level",
                "work_experience", "skills", "travel", "management", "remote", "job_source"]


def job_rules() -> dict:
    """Rule name -> Column that is TRUE when the row violates a constraint of
    the posting table (Q8): NULL in a required column, or a text over the
    limit. Only these block loading."""
    rules = {}
    for c in REQUIRED:
        rules[f"null_{c}"] = F.col(c).isNull()
    for c in TEXT_LIMITED:
        rules[f"long_{c}"] = F.coalesce(F.char_length(c) > S.MAX_TEXT_LENGTH, F.lit(False))
    return rules


def job_warnings(vocab: S.Vocabulary = S.DOMAIN) -> dict:
    """Rules that a loadable posting may break: reported, never rejected."""
    edu = F.left(F.col("edu_level"), F.lit(vocab.edu_chars))
    return {
        "edu_vocabulary": F.col("edu_level").isNotNull() & ~edu.isin(vocab.edu_prefixes),
        "salary_order": F.coalesce(
            (F.col("max_salary") != 0) & (F.col("min_salary") > F.col("max_salary")), F.lit(False)),
    }


def with_reasons(df: DataFrame, rules: dict) -> DataFrame:
    reasons = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    return df.withColumn("reasons", reasons)


def split_valid(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    """Q10: (valid rows, rejected rows with a ``reasons`` column)."""
    tagged = with_reasons(df, rules)
    valid = tagged.where(F.col("reasons") == "").drop("reasons")
    rejected = tagged.where(F.col("reasons") != "")
    return valid, rejected


def extracted_rules(vocab: S.Vocabulary = S.DOMAIN) -> dict:
    """Q4/Q5/Q7 for model-extracted postings (field contract of 16 keys)."""
    cats = F.col("category")
    return {
        "edu_level": F.col("edu_level").isNotNull() & ~F.col("edu_level").isin(S.EDU_LEVELS),
        "work_experience": F.col("work_experience").isNotNull() & ~F.col("work_experience").rlike(S.EXPERIENCE_PATTERN),
        "travel": F.col("travel").isNotNull() & ~F.col("travel").isin(S.TRAVEL_VALUES),
        "management": F.col("management").isNotNull() & ~F.col("management").isin(S.MANAGEMENT_VALUES),
        "remote": F.col("remote").isNotNull() & ~F.col("remote").isin(S.REMOTE_VALUES),
        "category_count": F.coalesce(~F.size(cats).between(1, 3), F.lit(True)),
        "category_vocabulary": F.coalesce(
            ~F.forall(cats, lambda x: x.isin(vocab.category_vocabulary)), F.lit(True)),
    }


def category_check(job: DataFrame, job_category: DataFrame, vocab: S.Vocabulary = S.DOMAIN) -> DataFrame:
    """Q5 per stored job: number of distinct categories, how many are out of
    the vocabulary, and whether the job satisfies 1..3 in-vocabulary."""
    pairs = job_category.select("job_code", "job_category").distinct()
    per_job = pairs.groupBy("job_code").agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.count(F.when(~F.col("job_category").isin(vocab.category_vocabulary), 1)).alias("n_out_of_vocabulary"))
    return (job.select("job_code").join(per_job, "job_code", "left")
            .select("job_code",
                    F.coalesce("n_categories", F.lit(0)).cast("bigint").alias("n_categories"),
                    F.coalesce("n_out_of_vocabulary", F.lit(0)).cast("bigint").alias("n_out_of_vocabulary"))
            .withColumn("ok", F.col("n_categories").between(1, 3) & (F.col("n_out_of_vocabulary") == 0)))


def normalise_salary(df: DataFrame) -> DataFrame:
    """Q6: yearly amounts to monthly (rounded), a single figure is both
    bounds, a missing figure stays absent."""
    yearly = F.coalesce(F.col("salary_period").contains(S.YEARLY), F.lit(False))
    mn = F.when(yearly, half_up_div("min_salary", 12)).otherwise(F.col("min_salary"))
    mx = F.when(yearly, half_up_div("max_salary", 12)).otherwise(F.col("max_salary"))
    # one projection: both bounds are computed from the input columns
    return df.withColumns({"min_salary": mn.cast("bigint"),
                           "max_salary": F.coalesce(mx, mn).cast("bigint")})


def signup_checks(users: DataFrame) -> DataFrame:
    """Q1/Q2 + F19: e-mail and password rules, and the stored password hash."""
    return users.select(
        "id", "email",
        F.coalesce(F.col("email").rlike(S.EMAIL_PATTERN), F.lit(False)).alias("email_ok"),
        F.coalesce(F.col("password").rlike(S.PASSWORD_PATTERN), F.lit(False)).alias("password_ok"),
        F.sha2(F.col("password"), 256).alias("password_hash"))


# Q3: the 16-key field contract of a model-extracted posting.
EXTRACTED = T.StructType([
    T.StructField("job_code", T.StringType()),
    T.StructField("job_title", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("job_location", T.StringType()),
    T.StructField("salary_period", T.StringType()),
    T.StructField("min_salary", T.LongType()),
    T.StructField("max_salary", T.LongType()),
    T.StructField("edu_level", T.StringType()),
    T.StructField("work_experience", T.StringType()),
    T.StructField("skills", T.StringType()),
    T.StructField("travel", T.StringType()),
    T.StructField("management", T.StringType()),
    T.StructField("remote", T.StringType()),
    T.StructField("category", T.ArrayType(T.StringType())),
    T.StructField("job_source", T.StringType()),
    T.StructField("create_date", T.StringType()),
])


def parse_extracted(texts: DataFrame, text_col: str = "text", key_col: str = "job_code") -> DataFrame:
    """Q3: model output text -> contract fields, never evaluated as code.

    Text that is no JSON object carries ``malformed``; ``keys_ok`` tells
    whether the object has exactly the contract's keys.
    """
    t = F.col(text_col)
    parsed = texts.select(F.col(key_col).alias("_key"), F.from_json(t, EXTRACTED).alias("r"),
                          F.json_object_keys(t).alias("_keys"))
    wanted = F.array(*[F.lit(k) for k in sorted(EXTRACTED.names)])
    return parsed.select("_key", "r.*", (F.col("r").isNull() | F.col("_keys").isNull()).alias("malformed"),
                         F.coalesce(F.array_sort("_keys") == wanted, F.lit(False)).alias("keys_ok"))


def tag_extracted(parsed: DataFrame, vocab: S.Vocabulary = S.DOMAIN, source_prefix: str | None = None,
                  run_date: str | None = None) -> DataFrame:
    """Q3-Q7 on parsed output: its columns and ``reasons``; empty reasons = accepted.

    ``source_prefix``, ``run_date`` (yyyy-MM-dd): Q7, the source must be the
    prefix and the code, and the load date must be the run's. Nothing more
    is said of malformed text.
    """
    rules = {"keys": ~F.col("keys_ok")}
    rules.update(extracted_rules(vocab))
    rules["job_code"] = F.coalesce(F.col("job_code") != F.col("_key"), F.lit(True))
    if source_prefix is not None:
        rules["job_source"] = F.coalesce(
            F.col("job_source") != F.concat(F.lit(source_prefix), F.col("_key")), F.lit(True))
    if run_date is not None:
        rules["create_date"] = F.coalesce(F.left("create_date", F.lit(10)) != F.lit(run_date), F.lit(True))
    tagged = with_reasons(parsed, rules)
    return tagged.withColumn("reasons", F.when(F.col("malformed"), F.lit("malformed")).otherwise(F.col("reasons")))


def check_extracted(parsed: DataFrame, vocab: S.Vocabulary = S.DOMAIN, source_prefix: str | None = None,
                    run_date: str | None = None) -> DataFrame:
    """(key, reasons) of ``tag_extracted``."""
    tagged = tag_extracted(parsed, vocab, source_prefix, run_date)
    return tagged.select(F.col("_key").alias("job_code"), "reasons")
