"""Timestamp parsing and derived time fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 shapes accepted by the source: date, optional time (T or blank), optional
# fraction, optional Z / offset.  Plain Spark casts also take "2024", "2024-01" or
# "10:30", which the source refuses, hence the guard.
ISO_GUARD = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?$"
# Compact basic form, e.g. 20240115T103000 (Spark casts refuse it; a pattern takes it).
COMPACT_GUARD = r"^[0-9]{8}T[0-9]{6}$"
COMPACT_PATTERN = "yyyyMMdd'T'HHmmss"


def _strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def parse_ts(text: Column, offset_mode: str = "utc") -> Column:
    """Text -> timestamp_ntz (UTC wall clock); NULL when the text is not a valid time.

    offset_mode="utc": an explicit offset is applied (10:30+05:00 -> 05:30).
    offset_mode="wall": the offset is dropped and the wall clock kept (source parity).
    """
    t = text
    if offset_mode == "utc":
        cast = t.try_cast("timestamp").cast("timestamp_ntz")
    elif offset_mode == "wall":
        cast = t.try_cast("timestamp_ntz")
    else:
        raise ValueError(f"offset_mode must be 'utc' or 'wall', not {offset_mode!r}")
    iso = F.when(t.rlike(ISO_GUARD), cast)
    compact = F.when(t.rlike(COMPACT_GUARD),
                     F.try_to_timestamp(t, F.lit(COMPACT_PATTERN)).cast("timestamp_ntz"))
    return F.coalesce(iso, compact)


def with_time_fields(df, ts: str = "timestamp"):
    """C4: event_date, hour_of_day, day_of_week (Monday = 0), is_weekend (bool)."""
    c = F.col(ts)
    return (df.withColumn("event_date", F.to_date(c))
              .withColumn("hour_of_day", F.hour(c))
              .withColumn("day_of_week", F.weekday(c))
              .withColumn("is_weekend", F.weekday(c) >= 5))


def iso_z_text(c: Column) -> Column:
    """ISO text with a Z suffix, microseconds kept when present."""
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.date_format(c, "SSSSSS") != "000000",
                           F.concat(F.lit("."), F.date_format(c, "SSSSSS"))).otherwise(F.lit("")),
                    F.lit("Z"))


def year_month(c: Column) -> Column:
    """K3: yyyymm as an integer."""
    return (F.year(c) * 100 + F.month(c)).cast("int")
