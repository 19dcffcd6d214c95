"""Modelled inputs of the metric operators, derived from the driver `events` table.

The source system keeps these figures in process memory; here they are ordinary tables
whose size grows with the events, each with the same formula in DuckDB SQL.

batch_log:   one row per consumer batch (batch_id = id div 1000).
op_log:      one store operation per event: operation = type, database by id parity,
             duration = value / 100 s, status error for type `error`.
dim_versions: each distinct event type in two versions of its category row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.functions.category import category_of
from eventmill.plans.sqlgen import category_case
from eventmill.sources.tables import read_table

BATCH_SIZE = 1000


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    err = (F.col("event_type") == "error").cast("long")
    return (e.groupBy(F.floor(F.col("event_id") / BATCH_SIZE).cast("long").alias("batch_id"))
            .agg(F.count(F.lit(1)).alias("consumed"),
                 (F.count(F.lit(1)) - F.sum(err)).alias("transformed"),
                 (F.count(F.lit(1)) - F.sum(err)).alias("written_flat"),
                 (F.count(F.lit(1)) - F.sum(err)).alias("written_doc"),
                 F.sum(err).alias("errors")))


def batch_log_sql() -> str:
    return f"""(SELECT CAST(event_id // {BATCH_SIZE} AS BIGINT) AS batch_id, count(*) AS consumed,
  count(*) - count(*) FILTER (WHERE event_type = 'error') AS transformed,
  count(*) - count(*) FILTER (WHERE event_type = 'error') AS written_flat,
  count(*) - count(*) FILTER (WHERE event_type = 'error') AS written_doc,
  count(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1)"""


def op_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id"), F.col("ts"),
        F.col("event_type").alias("operation"),
        F.when(F.col("event_id") % 2 == 0, F.lit("flat")).otherwise(F.lit("document")).alias("database"),
        (F.col("value") / 100).alias("duration"),
        F.when(F.col("event_type") == "error", F.lit("error")).otherwise(F.lit("ok")).alias("status"),
        F.octet_length("props").alias("payload_bytes"),
    )


def op_log_sql() -> str:
    return """(SELECT event_id AS id, ts, event_type AS operation,
  CASE WHEN event_id % 2 = 0 THEN 'flat' ELSE 'document' END AS database, value / 100 AS duration,
  CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, octet_length(props::BLOB) AS payload_bytes FROM events)"""


def dim_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = read_table(spark, sf_dir, "events").select(F.lower("event_type").alias("event_type")).distinct()
    v1 = types.select("event_type", F.lit("other").alias("category"), F.lit(1).alias("version"))
    v2 = types.select("event_type", category_of(F.col("event_type")).alias("category"), F.lit(2).alias("version"))
    return v1.unionByName(v2)


def dim_versions_sql() -> str:
    return f"""(SELECT event_type, 'other' AS category, 1 AS version FROM (SELECT DISTINCT lower(event_type) AS event_type FROM events)
  UNION ALL SELECT event_type, {category_case('event_type')} AS category, 2 AS version
  FROM (SELECT DISTINCT lower(event_type) AS event_type FROM events))"""
