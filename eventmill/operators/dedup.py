"""De-duplication and unique-key joins.

All forms are aggregates or hash joins on the key, never per-key windows: partial
aggregation collapses repeats of a hot id inside each map task before the shuffle, so
one id repeated in a third of all rows does not land whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, key: str = "event_id", order: str | None = None) -> DataFrame:
    """keep one row per key.

    order=None: any one row (copies are identical deliveries).
    order=col: the row with the smallest `order` wins ("first delivery wins"); done with
    `min_by` so partial aggregation still applies.
    """
    if order is None:
        return df.dropDuplicates([key])
    others = [c for c in df.columns if c != key]
    w = F.min_by(F.struct(*[F.col(c) for c in others]), F.col(order))
    return df.groupBy(key).agg(w.alias("_w")).select(key, *[F.col(f"_w.{c}").alias(c) for c in others])


def duplicate_report(df: DataFrame, key: str = "event_id") -> DataFrame:
    """keys seen more than once, with their count."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
            .where(F.col("count") > 1))


def new_rows_anti(new: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key is not stored yet (left anti join on the unique key)."""
    return new.join(stored.select(key), on=key, how="left_anti")


def stored_rows_semi(new: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows whose key is already stored (skipped as duplicates)."""
    return new.join(stored.select(key), on=key, how="left_semi")
