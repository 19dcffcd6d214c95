"""Rollups (G8, G9, G11) and their mergeable partial form.

Distinct counts are never added across partials (that over-counts); partials keep an
HLL sketch that is unioned on merge, or the rollup is recomputed exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOURLY_KEYS = ["event_date", "event_hour", "event_type", "event_category"]
DAILY_KEYS = ["event_date", "user_id"]


def _hour(ts: str = "timestamp"):
    return F.date_trunc("HOUR", F.col(ts)).cast("timestamp_ntz")


def events_hourly(events: DataFrame) -> DataFrame:
    """(date, hour start, type, category) -> event count and exact distinct users."""
    return (events.groupBy("event_date", _hour().alias("event_hour"), "event_type", "event_category")
            .agg(F.count(F.lit(1)).alias("event_count"), F.count_distinct("user_id").alias("unique_users")))


def hourly_partials(events: DataFrame, block_col: str = "block", lg_k: int = 12) -> DataFrame:
    """Per-block partial rollup: counts plus an HLL sketch of user ids (mergeable)."""
    return (events.groupBy(F.col(block_col).alias("block"), "event_date", _hour().alias("event_hour"),
                           "event_type", "event_category")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.hll_sketch_agg(F.col("user_id"), lg_k).alias("users_sketch")))


def combine_hourly_partials(partials: DataFrame) -> DataFrame:
    """Several blocks' partial rollups as one: counts added, sketches united and kept as sketches."""
    return (partials.groupBy(*HOURLY_KEYS)
            .agg(F.sum("event_count").alias("event_count"), F.hll_union_agg("users_sketch").alias("users_sketch")))


def merge_hourly_partials(partials: DataFrame) -> DataFrame:
    """Merge partial rollups: sum counts, union sketches; `approx_users` is the sketch's estimate."""
    return combine_hourly_partials(partials).select(*HOURLY_KEYS, "event_count", F.hll_sketch_estimate("users_sketch").alias("approx_users"))


def _user_days(events: DataFrame, keys: list[str]) -> DataFrame:
    """Per keys: first and last time, events, distinct types and sessions.

    One row per (keys, session, type) first, then one per (keys, session) with its types, of which there are few.  No
    row ever holds a set of sessions, so a user with millions of them is counted like any other, and no row is
    multiplied for a second distinct count.
    """
    fine = events.groupBy(*keys, "session_id", "event_type").agg(
        F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count(F.lit(1)).alias("n"))
    sessions = fine.groupBy(*keys, "session_id").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"), F.collect_set("event_type").alias("types"))
    types = F.size(F.array_distinct(F.flatten(F.collect_set("types"))))
    return sessions.groupBy(*keys).agg(
        F.min("lo").alias("first_event_time"), F.max("hi").alias("last_event_time"), F.sum("n").alias("event_count"),
        types.cast("long").alias("unique_event_types"), F.count("session_id").alias("session_count"))


def daily_users(events: DataFrame) -> DataFrame:
    """Per (date, user): first/last time, events, distinct types, distinct sessions."""
    return _user_days(events, DAILY_KEYS)
