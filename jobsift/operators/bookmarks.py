"""Bookmark toggles (M8) as an event log.

The original flips one row per request (delete if present, else insert).
Over a log of toggle events the state of a (user, job) key is the parity of
its toggle count, and the action a toggle performed is the parity of its
ordinal within the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.operators.ordering import ordinals, pinned_order

KEY = ["user_id", "job_code"]


def bookmark_state(toggles: DataFrame) -> DataFrame:
    """(user_id, job_code, n_toggles, bookmarked) for every toggled key.

    A count per key combines map-side, so a hot key costs no more than a
    cold one.
    """
    return (toggles.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_toggles"))
            .withColumn("bookmarked", (F.col("n_toggles") % 2) == 1))


def current_bookmarks(toggles: DataFrame) -> DataFrame:
    """The ``user_bookmark`` table implied by the log: keys toggled an odd number of times."""
    return bookmark_state(toggles).where("bookmarked").select(*KEY)


def bookmark_actions(toggles: DataFrame, path: str | None = None) -> DataFrame:
    """Action ('add'/'remove') of every toggle event: the parity of its
    ordinal within its (user, job) key in (ts, event_id) order.

    No key's events have to sit in one task, however many it has: the
    ordinals come from a global sort whose range partitioning splits a hot
    key's run over several tasks (``ordering.pinned_order``, written once to
    ``path`` under the shared checkpoint folder), then per-slice segment
    offsets (``ordering.ordinals``).
    """
    pinned = pinned_order(toggles.select("event_id", "ts", *KEY), [*KEY, "ts", "event_id"], path)
    return (ordinals(pinned, KEY)
            .select("event_id", "ts", *KEY, "ordinal")
            .withColumn("action", F.when(F.col("ordinal") % 2 == 1, F.lit("add")).otherwise(F.lit("remove"))))


def apply_toggles(marks: DataFrame, toggles: DataFrame) -> DataFrame:
    """Apply a batch of toggles to a bookmark table: keys toggled an odd
    number of times flip (present -> removed, absent -> added)."""
    flips = bookmark_state(toggles).where("bookmarked").select(*KEY)
    kept = marks.select(*KEY).distinct().join(flips, KEY, "left_anti")
    added = flips.join(marks.select(*KEY), KEY, "left_anti")
    return kept.unionByName(added)
