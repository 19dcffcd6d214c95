"""Table layout and retention (M1-M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmill.functions.timefn import year_month


def partition_counts_by_month(events: DataFrame) -> DataFrame:
    """M1: rows per yyyymm partition, with the date span of each."""
    return (events.groupBy(year_month(F.col("event_date")).alias("event_month"))
            .agg(F.count(F.lit(1)).alias("event_count"), F.min("event_date").alias("first_date"),
                 F.max("event_date").alias("last_date")))


def retention_filter(events: DataFrame, as_of_date, days: int = 365) -> DataFrame:
    """M3: rows inside the retention window (event_date >= as_of - days)."""
    as_of = as_of_date if isinstance(as_of_date, Column) else F.lit(as_of_date)
    return events.where(F.col("event_date") >= F.date_sub(as_of.cast("date"), days))


def shard_balance(events: DataFrame, shard: Column) -> DataFrame:
    """M4: rows and users per shard, and each shard's load relative to the mean."""
    per = events.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("rows"),
                                                   F.count_distinct("user_id").alias("users"))
    return per
