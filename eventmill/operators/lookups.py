"""Point lookups and timelines over events.

Each is a filter (pushed to the scan) followed by an ordered top-n, which Spark plans as
TakeOrderedAndProject: every task keeps only its best n rows, so no full sort or
global shuffle of the table happens.  Ties are broken by `event_id` so results repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.functions.category import priority_rank_of


def user_latest(events: DataFrame, user_id: int, n: int = 100) -> DataFrame:
    """Newest n events of one user."""
    return (events.where(F.col("user_id") == F.lit(user_id))
            .orderBy(F.desc("timestamp"), "event_id").limit(n))


def type_sample(events: DataFrame, event_type: str, n: int = 100) -> DataFrame:
    """N events of one type (ordered by id so the sample repeats)."""
    return events.where(F.col("event_type") == F.lit(event_type)).orderBy("event_id").limit(n)


def type_timeline(events: DataFrame, event_type: str, n: int = 100) -> DataFrame:
    """Newest n events of one type."""
    return (events.where(F.col("event_type") == F.lit(event_type))
            .orderBy(F.desc("timestamp"), "event_id").limit(n))


def session_timeline(events: DataFrame, session_id: str) -> DataFrame:
    """I4: all events of one session, oldest first."""
    return (events.where(F.col("session_id") == F.lit(session_id))
            .orderBy("timestamp", "event_id"))


def latest_events(events: DataFrame, n: int = 100) -> DataFrame:
    """Globally newest n events."""
    return events.orderBy(F.desc("timestamp"), "event_id").limit(n)


def category_timeline(events: DataFrame, category: str, n: int = 100) -> DataFrame:
    """Newest n events of one category."""
    return (events.where(F.col("event_category") == F.lit(category))
            .orderBy(F.desc("timestamp"), "event_id").limit(n))


def country_timeline(events: DataFrame, country: str, n: int = 100) -> DataFrame:
    """Newest n events of one country; rows without a country never match."""
    return (events.where(F.col("country").isNotNull() & (F.col("country") == F.lit(country)))
            .orderBy(F.desc("timestamp"), "event_id").limit(n))


def capped_latest(events: DataFrame, cap: int = 1000) -> DataFrame:
    """I8: the newest `cap` rows (a capped collection kept as a table)."""
    return events.orderBy(F.desc("timestamp"), "event_id").limit(cap)


def priority_first(events: DataFrame, n: int | None = None) -> DataFrame:
    """High-priority types first, then by time."""
    out = events.orderBy(priority_rank_of(F.col("event_type")), "timestamp", "event_id")
    return out.limit(n) if n else out


def type_in_range(events: DataFrame, event_type: str, start, end) -> DataFrame:
    """One type in a half-open time range [start, end)."""
    return events.where((F.col("event_type") == F.lit(event_type))
                        & (F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
                        & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz")))
