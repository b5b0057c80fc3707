"""jobsift: a PySpark-native engine for job-posting analytics.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, so Catalyst prunes, pushes down and plans the whole
job; nothing in the library collects rows to the driver.
"""

from jobsift.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
