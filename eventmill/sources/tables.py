"""Batch table sources.

`read_table` is a plain Parquet scan: Catalyst prunes columns and pushes filters into
it, so callers select and filter freely.  `events` exposes the driver's event table in
the flat analytic shape (event_date, timestamp, event_category ...) as lazy column
expressions, so a query touching two columns still reads two columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmill.functions.category import category_of

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table.

    The driver tables are fixed, so their schema is inferred once per path (a job that
    reads Parquet footers) and passed on later reads; building a query then touches no
    data before it runs.
    """
    path = table_path(sf_dir, name)
    if path not in _SCHEMAS:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver `events` in analytic shape.

    Columns: event_id (bigint), user_id, event_type, timestamp (timestamp_ntz, UTC wall
    clock), event_date, hour_of_day, day_of_week (Mon=0), is_weekend (0/1),
    event_category, session_id, value, props.
    """
    e = read_table(spark, sf_dir, "events")
    ts = F.col("ts")
    return e.select(
        "event_id", "user_id", "event_type",
        ts.alias("timestamp"),
        F.to_date(ts).alias("event_date"),
        F.hour(ts).alias("hour_of_day"),
        F.weekday(ts).alias("day_of_week"),
        (F.weekday(ts) >= 5).cast("int").alias("is_weekend"),
        category_of(F.col("event_type")).alias("event_category"),
        session_key(F.col("user_id"), ts).alias("session_id"),
        "value", "props",
    )


def session_key(user_id: Column, ts: Column) -> Column:
    """Session id of the driver data: s-<user>-<yyyyMMdd>-<hour div 8>."""
    return F.concat(F.lit("s-"), user_id.cast("string"), F.lit("-"), F.date_format(ts, "yyyyMMdd"),
                    F.lit("-"), F.floor(F.hour(ts) / 8).cast("string"))


def as_of_column(df: DataFrame, ts: str = "timestamp", as_of=None) -> Column:
    """The 'now' of a query as a literal: the given time, else the newest event time.

    The newest time is fetched first (one aggregate over the time column, one value to
    the driver) and the query is planned with it as a literal.  A date or time bound is
    then known at planning time: Catalyst turns `to_date(ts) = d` into a range on `ts`
    that reaches the Parquet scan (row groups of other days are skipped) or prunes
    `event_date` partitions of the flat sink.  A scalar subquery would keep the bound
    unknown until run time and read every row group of every day.  The value travels as
    text, so no driver time zone touches it.
    """
    if as_of is None:
        as_of = df.select(F.max(ts).cast("string")).first()[0]
    return F.lit(as_of).cast("timestamp_ntz")
