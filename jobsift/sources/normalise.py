"""Landed texts of several boards -> contract records, by one pluggable step per board.

The original sends a page's text to a language model and takes what comes back as the record. Here that is a function
``step(code, text) -> dict`` with the contract's keys (``quality.EXTRACTED``), one per board, run as a Python table
function joined laterally to the board's pages. Whatever it yields is checked by the same rules as the model's
output (Q3-Q7). A page whose step fails gives a row with a reason, so no page is lost and none ends the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsift import schema as S
from jobsift.operators import quality

Step = Callable[[str, str], dict]
KINDS = {"string": str, "bigint": int, "array<string>": list}


def table_function(step: Step):
    """The step as a table function (code, text) -> contract fields, ``keys_ok`` and ``fault``: the name of
    the exception, ``no_record``, or ``type_<field>`` for a value that is not of its field's type."""
    fields = quality.EXTRACTED.fields
    names, kinds = [f.name for f in fields], [f.dataType.simpleString() for f in fields]
    out = T.StructType([*fields, T.StructField("keys_ok", T.BooleanType()), T.StructField("fault", T.StringType())])

    def fits(value, kind: str) -> bool:
        if value is None:
            return True
        if kind == "array<string>":
            return isinstance(value, list) and all(v is None or isinstance(v, str) for v in value)
        return isinstance(value, KINDS[kind]) and not isinstance(value, bool) and (kind != "bigint" or -2**63 <= value < 2**63)

    def record(code, text):
        none = (None,) * len(names)
        try:
            got = step(code, text)
        except Exception as e:  # any fault of a pluggable step is a reason, never the end of the job
            return *none, False, type(e).__name__
        if not isinstance(got, dict):
            return *none, False, "no_record"
        wrong = [n for n, kind in zip(names, kinds, strict=True) if not fits(got.get(n), kind)]
        if wrong:
            return *none, False, ",".join(f"type_{n}" for n in wrong)
        return *[got.get(n) for n in names], set(got) == set(names), None

    class Normalise:
        def eval(self, code, text):
            yield record(code, text)

    return F.udtf(Normalise, returnType=out)


def normalise(pages: DataFrame, steps: dict[str, Step], vocab: S.Vocabulary = S.DOMAIN, source_prefix: dict | None = None,
              run_date: str | None = None) -> DataFrame:
    """``pages`` (board, code, text) -> (board, page_code, *contract fields, reasons), one row a page.

    ``reasons`` is '' for an accepted record, else the rules it breaks; ``failed:<fault>`` for a page whose step
    failed, ``no_step`` for a board (or NULL) without one. Each board's pages are filtered by themselves, so
    the scan prunes to them and its step runs alone; pages move in no shuffle. Land the result before it is split.
    """
    prefix = source_prefix or {}
    columns = ["board", F.col("_key").alias("page_code"), *quality.EXTRACTED.names, "reasons"]
    keyed = pages.select("board", F.col("code").alias("_key"), F.col("text").alias("_text"))
    parts = []
    for board, step in steps.items():
        found = keyed.where(F.col("board") == board).lateralJoin(
            table_function(step)(F.col("_key").outer(), F.col("_text").outer()))
        tagged = quality.tag_extracted(found.withColumn("malformed", F.lit(False)), vocab, prefix.get(board), run_date)
        reasons = F.when(F.col("fault").isNotNull(), F.concat(F.lit("failed:"), "fault")).otherwise(F.col("reasons"))
        parts.append(tagged.withColumn("reasons", reasons).select(*columns))
    other = keyed.where(F.coalesce(~F.col("board").isin(list(steps)), F.lit(True)))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in quality.EXTRACTED.fields]
    parts.append(other.select("board", F.col("_key").alias("page_code"), *empty, F.lit("no_step").alias("reasons")))
    return reduce(DataFrame.unionByName, parts)


def json_step(renamed: dict[str, str], **fixed) -> Step:
    """A board whose text is a JSON object: ``renamed`` maps its keys to fields; other fields are ``fixed`` or None."""

    def step(code, text):
        held = json.loads(text)
        return dict.fromkeys(quality.EXTRACTED.names) | fixed | {"job_code": code} | {f: held[k] for k, f in renamed.items()}

    return step


def lines_step(labels: dict[str, str], sep: str = ":", listed: str = ",", **fixed) -> Step:
    """A board whose text is ``label<sep> value`` lines; lines of other labels are left out. Whole numbers and lists (cut at
    ``listed``) are read by the field's type; a number that is none raises."""
    kinds = {f.name: f.dataType.simpleString() for f in quality.EXTRACTED.fields}

    def read(field, value):
        if kinds[field] == "bigint":
            return int(value.replace(",", ""))
        return [v.strip() for v in value.split(listed)] if kinds[field] == "array<string>" else value

    def step(code, text):
        out = dict.fromkeys(quality.EXTRACTED.names) | fixed | {"job_code": code}
        for line in text.split("\n"):
            label, found, value = line.partition(sep)
            if found and label.strip() in labels:
                field = labels[label.strip()]
                out[field] = read(field, value.strip())
        return out

    return step
