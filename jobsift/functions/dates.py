"""Load-date arithmetic (calendar dates at UTC+8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift import schema as S


def load_date(ts_col) -> Column:
    """Calendar date at UTC+8 of a UTC wall-clock timestamp.

    Works on TIMESTAMP_NTZ (UTC wall clock) without depending on the
    session time zone.
    """
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    ntz = c.cast("timestamp_ntz")
    return F.to_date(ntz + F.expr(f"INTERVAL {S.LOAD_DATE_OFFSET_HOURS} HOURS"))


def day_string(col) -> Column:
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyy-MM-dd")
