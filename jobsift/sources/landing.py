"""Landed JSON: listing pages, job details, backups in two layouts.

A crawler lands raw responses as files; these readers turn them into the
canonical record (S2, S3), and the writers keep one backup per source and
load date (S10-S12) as a partitioned dataset, so readers prune by
partition instead of opening every file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import schema as S
from jobsift.functions import text as X


def listing_codes(spark: SparkSession, path: str, pattern: str = S.CODE_PATTERNS["json_board"],
                  multi_line: bool = True, page_fields: list | None = None) -> DataFrame:
    """Listing JSON pages -> (file, *page_fields, pos, job_code) in page order.

    ``multi_line``: one JSON document per file (pages as the crawler lands
    them); ``False`` for one page per line. ``page_fields``: extra top-level
    fields (``StructField``) that identify a page, kept on every code.
    Links that carry no job code are dropped.
    """
    extra = list(page_fields or [])
    schema = T.StructType(extra + list(S.JSON_LISTING.fields))
    df = spark.read.schema(schema).json(path, multiLine=multi_line)
    keep = [f.name for f in extra]
    return (df.select(F.input_file_name().alias("file"), *keep,
                      F.posexplode("data.list").alias("pos", "item"))
            .select("file", *keep, "pos", X.extract_code("item.link.job", pattern).alias("job_code"))
            .where(F.col("job_code").isNotNull()))


def until_first_empty(pages: DataFrame, by: list[str], page_col: str = "page", items: str = "data.list",
                      first_page: int = 1) -> DataFrame:
    """The pages that a crawl reads: of every listing (``by``), page ``first_page`` and on, up to the first
    page that is empty or missing. Pages after such a gap give no codes.

    The end is the least page that is no filled page but follows one (or is the first): an anti join on
    (listing, page) and a minimum per listing, combined map-side; no listing is ordered in one task. Pages meet
    their listing's end by (listing, salt of 32), so a listing with a third of all pages is spread. A page landed
    twice is filled if one copy is. NULL page numbers, a NULL listing and pages before ``first_page`` are not read.
    """
    salts = 32
    keys = [F.col(c) for c in by]
    numbered = pages.where(F.col(page_col) >= first_page)
    filled = numbered.where(F.size(items) > 0).select(*keys, F.col(page_col).cast("long").alias("_p")).distinct()
    begin = numbered.select(*keys).distinct().withColumn("_p", F.lit(first_page).cast("long"))
    asked = filled.withColumn("_p", F.col("_p") + 1).unionByName(begin)
    end = asked.join(filled, [*by, "_p"], "left_anti").groupBy(*by).agg(F.min("_p").alias("_end"))
    end = end.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = numbered.withColumn("_salt", F.pmod(F.xxhash64(page_col), F.lit(salts)).cast("int"))
    return (salted.join(end, [*by, "_salt"]).where(F.col(page_col) < F.col("_end"))
            .select(*pages.columns))


def read_listing_pages(spark: SparkSession, path: str, page_fields: list, multi_line: bool = False) -> DataFrame:
    """Landed listing pages, one row a page: (*page_fields, data)."""
    schema = T.StructType(list(page_fields) + list(S.JSON_LISTING.fields))
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def page_codes(pages: DataFrame, keep: list[str], pattern: str = S.CODE_PATTERNS["json_board"]) -> DataFrame:
    """(*keep, pos, job_code) of listing pages; items without a job link are dropped."""
    return (pages.select(*keep, F.posexplode("data.list").alias("pos", "item"))
            .select(*keep, "pos", X.extract_code("item.link.job", pattern).alias("job_code"))
            .where(F.col("job_code").isNotNull()))


def listing_offsets(totals: DataFrame, total_col: str = "total", page_size: int = S.LISTING_PAGE_SIZE) -> DataFrame:
    """The listing requests a crawler issues for a result total: pages
    ``0 .. total div page_size`` at offset ``page * page_size``, one row each.

    As in the original, a total that is a multiple of the page size asks for
    one more (empty) page. Rows per total are total/page_size + 1, made by
    ``explode`` inside the task that holds the total.
    """
    n_pages = F.floor(F.col(total_col) / page_size).cast("int")
    return (totals.withColumn("_page", F.explode(F.sequence(F.lit(0), n_pages)))
            .withColumn("page_offset", (F.col("_page") * page_size).cast("int"))
            .drop("_page"))


def detail_records(details: DataFrame, code_col: str = "job_code", doc_col: str = "doc",
                   url_prefix: str = "https://www.board-a.example/job/") -> DataFrame:
    """S3 + F12-F16 + F27 + P14: parsed detail JSON -> canonical record.

    Closed postings (``switch`` not 'on') are dropped. Skills are the
    specialty descriptions joined by commas (NULL when none); remote is a
    yes/no label from the presence of ``remoteWork``.
    """
    d = F.col(f"{doc_col}.data")
    return (details.where(d["switch"] == "on").select(
        d["header"]["jobName"].alias("job_title"),
        F.col(code_col).alias("job_code"),
        d["header"]["custName"].alias("company_name"),
        d["jobDetail"]["addressRegion"].alias("job_location"),
        d["jobDetail"]["salary"].alias("salary_period"),
        d["jobDetail"]["salaryMin"].alias("min_salary"),
        d["jobDetail"]["salaryMax"].alias("max_salary"),
        d["condition"]["edu"].alias("edu_level"),
        d["condition"]["workExp"].alias("work_experience"),
        X.join_nonempty(X.field_of(d["condition"]["specialty"], "description")).alias("skills"),
        d["jobDetail"]["businessTrip"].alias("travel"),
        d["jobDetail"]["manageResp"].alias("management"),
        F.when(d["jobDetail"]["remoteWork"].isNotNull(), F.lit(S.REMOTE_YES))
        .otherwise(F.lit(S.REMOTE_NO)).alias("remote"),
        F.concat(F.lit(url_prefix), F.col(code_col)).alias("job_source"),
        X.field_of(d["jobDetail"]["jobCategory"], "description").alias("job_category"),
    ))


def read_details(spark: SparkSession, path: str, code_pattern: str = r"([^/\\]+)\.json$") -> DataFrame:
    """Detail JSON files (one object per file) -> (job_code, doc)."""
    df = spark.read.schema(S.JSON_DETAIL).json(path, multiLine=True)
    return df.select(X.extract_code(F.input_file_name(), code_pattern).alias("job_code"),
                     F.struct("data").alias("doc"))


def read_detail_lines(spark: SparkSession, path: str) -> DataFrame:
    """Detail JSON landed as JSON lines, each ``{"job_code": …, "data": {…}}``:
    the splittable layout for many documents -> (job_code, doc)."""
    schema = T.StructType([T.StructField("job_code", T.StringType())] + S.JSON_DETAIL.fields)
    df = spark.read.schema(schema).json(path)
    return df.select("job_code", F.struct("data").alias("doc"))


def split_record(records: DataFrame, load_date) -> tuple[DataFrame, DataFrame]:
    """S14 + F14: canonical records -> (job rows stamped with the load date,
    (job_code, job_category) rows). A NULL category list yields no rows."""
    jobs = records.select(*[c for c in S.RECORD_FIELDS if c != "job_category"],
                          F.lit(load_date).cast("timestamp_ntz").alias("create_date"))
    cats = records.select("job_code", F.explode("job_category").alias("job_category"))
    return jobs.select(*S.JOB_COLUMNS), cats


def write_backup(records: DataFrame, path: str, source: str, load_date: str,
                 fmt: str = "json") -> None:
    """One dataset partitioned by source and load date; writing a
    source's day again replaces that day's backup and no other."""
    (records.withColumn("source", F.lit(source))
     .withColumn("snapshot_date", F.lit(load_date).cast("date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "snapshot_date").format(fmt).save(path))


def read_backup(spark: SparkSession, path: str, source: str | None = None,
                load_date: str | None = None, fmt: str = "json") -> DataFrame:
    """Backups for one source/date; filters prune partitions. The schema is
    given, never inferred."""
    schema = T.StructType(S.RECORD.fields + [T.StructField("source", T.StringType()),
                                             T.StructField("snapshot_date", T.DateType())])
    df = spark.read.schema(schema).format(fmt).load(path)
    if source is not None:
        df = df.where(F.col("source") == source)
    if load_date is not None:
        df = df.where(F.col("snapshot_date") == F.lit(load_date).cast("date"))
    return df


def write_raw_texts(texts: DataFrame, path: str, source: str, load_date: str, code_col: str = "job_code",
                    text_col: str = "text") -> None:
    """S12, raw zone: ``[code, text]`` pairs as landed, one JSON array a line,
    kept apart from the processed records; a day written again is replaced."""
    pair = F.to_json(F.array(F.col(code_col).cast("string"), F.col(text_col).cast("string")))
    (texts.select(pair.alias("value"), F.lit(source).alias("source"), F.lit(load_date).cast("date").alias("snapshot_date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source", "snapshot_date").text(path))


def read_raw_texts(spark: SparkSession, path: str, source: str | None = None, load_date: str | None = None) -> DataFrame:
    """(source, snapshot_date, job_code, text) of the raw zone; filters prune partitions."""
    df = spark.read.schema("value string, source string, snapshot_date date").text(path)
    if source is not None:
        df = df.where(F.col("source") == source)
    if load_date is not None:
        df = df.where(F.col("snapshot_date") == F.lit(load_date).cast("date"))
    pair = F.from_json("value", "array<string>")
    return df.select("source", "snapshot_date", pair[0].alias("job_code"), pair[1].alias("text"))


def positional_to_record(arrays: DataFrame, col: str = "slots") -> DataFrame:
    """A 15-slot positional array (strings) -> named, typed record."""
    a = F.col(col)
    out = []
    for i, name in enumerate(S.RECORD_FIELDS[:-1]):
        v = a[i]
        if name in ("min_salary", "max_salary"):
            v = v.cast("bigint")
        out.append(v.alias(name))
    out.append(F.from_json(a[len(S.RECORD_FIELDS) - 1], "array<string>").alias("job_category"))
    return arrays.select(*out)


def records_to_positional(records: DataFrame) -> DataFrame:
    """The old backup layout: each record as a JSON array of 15 slots."""
    slots = [F.col(c).cast("string") for c in S.RECORD_FIELDS[:-1]] + [F.to_json("job_category")]
    return records.select(F.to_json(F.array(*slots)).alias("value"))


def read_positional(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Positional backups -> records.

    ``whole_file=True`` reads files that hold one JSON array of arrays (the
    original dump layout); each file is one task, so files stay as small as
    one source-day. Default: one JSON array per line.
    """
    if whole_file:
        arrays = (spark.read.text(path, wholetext=True)
                  .select(F.explode(F.from_json("value", "array<array<string>>")).alias("slots")))
    else:
        arrays = spark.read.text(path).select(F.from_json("value", "array<string>").alias("slots"))
    return positional_to_record(arrays)
