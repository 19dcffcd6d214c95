"""Registered pipeline-quality metrics over modelled logs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventmill import dims
from eventmill.operators import metrics as Mx
from eventmill.operators.transform import transform
from eventmill.plans.registry import register
from eventmill.plans.sqlgen import transform_sql
from eventmill.sources.modelled import batch_log, batch_log_sql, op_log, op_log_sql
from eventmill.sources.raw import raw_events, raw_events_sql

OPS = op_log_sql()


@register("batch_totals", f"""SELECT count(*) AS batches, sum(consumed) AS consumed, sum(transformed) AS transformed,
  sum(written_flat) AS written_flat, sum(written_doc) AS written_doc, sum(errors) AS errors FROM {batch_log_sql()} b""")
def q_batch_totals(spark, sf):
    return Mx.batch_totals(batch_log(spark, sf))


@register("sink_error_rate", f"""SELECT count(*) FILTER (WHERE status = 'ok') AS batches_written,
  count(*) FILTER (WHERE status <> 'ok') AS errors,
  round(count(*) FILTER (WHERE status <> 'ok') / greatest(1, count(*) FILTER (WHERE status = 'ok')), 6) AS combined_error_rate
  FROM {OPS} o""")
def q_sink_error_rate(spark, sf):
    return Mx.sink_error_rate(op_log(spark, sf))


@register("status_counts", f"SELECT status, operation AS event_type, 'kafka' AS source, count(*) AS n FROM {OPS} o GROUP BY ALL")
def q_status_counts(spark, sf):
    return Mx.status_counts(op_log(spark, sf))


COMPONENT_SQL = f"""SELECT database || '_writer' AS component, count(*) AS total,
  count(*) FILTER (WHERE status = 'error') AS errors,
  round(100.0 * count(*) FILTER (WHERE status = 'error') / count(*), 6) AS error_rate_percent FROM {OPS} o GROUP BY 1"""


@register("error_rate_by_component", COMPONENT_SQL)
def q_error_rate_by_component(spark, sf):
    return Mx.error_rate_by_component(op_log(spark, sf))


@register("store_op_counts", f"SELECT database, operation, status, count(*) AS n FROM {OPS} o GROUP BY ALL")
def q_store_op_counts(spark, sf):
    return Mx.store_op_counts(op_log(spark, sf))


def _hist_sql() -> str:
    parts = []
    for b in dims.DURATION_BUCKETS:
        parts.append(f"SELECT operation, database, '{repr(float(b))}' AS le, count(*) FILTER (WHERE duration <= {b}) AS cumulative_count, "
                     f"round(sum(duration), 6) AS sum, count(*) AS count FROM {OPS} o GROUP BY 1, 2")
    parts.append(f"SELECT operation, database, '+Inf' AS le, count(*) AS cumulative_count, round(sum(duration), 6) AS sum, "
                 f"count(*) AS count FROM {OPS} o GROUP BY 1, 2")
    return " UNION ALL ".join(parts)


@register("duration_histogram", _hist_sql())
def q_duration_histogram(spark, sf):
    return Mx.duration_histogram(op_log(spark, sf), dims.DURATION_BUCKETS)


@register("throughput", f"""WITH s AS (SELECT count(*) AS n, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed,
  sum(payload_bytes) AS bytes, count(*) FILTER (WHERE status = 'error') AS errs,
  count(DISTINCT floor(id / 1000)) AS batches FROM {OPS} o)
SELECT n AS messages, round(n / greatest(elapsed, 1e-6), 6) AS messages_per_second,
  round(bytes / greatest(elapsed, 1e-6), 6) AS bytes_per_second,
  round(100.0 * errs / greatest(1, n), 6) AS failure_percent, round(n / batches, 6) AS avg_batch_size FROM s""")
def q_throughput(spark, sf):
    return Mx.throughput(op_log(spark, sf))


@register("errors_by_kind", f"""SELECT split_part(reject_reason, ':', 1) AS error_kind, count(*) AS n
  FROM {transform_sql(raw_events_sql())} t WHERE reject_reason IS NOT NULL GROUP BY 1""")
def q_errors_by_kind(spark, sf):
    return Mx.errors_by_kind(transform(raw_events(spark, sf)))


# three limits, so that every state occurs: a tight one, the mean of the rates, one that all keep
GATE_LIMITS = {"tight": "CAST(5.0 AS DOUBLE)", "mean": "avg(error_rate_percent) OVER ()", "loose": "CAST(100.0 AS DOUBLE)"}


@register("quality_gate", " UNION ALL ".join(f"""SELECT '{gate}' AS gate, count(*) AS components,
  count(*) FILTER (WHERE error_rate_percent <= l) AS healthy_components,
  CASE WHEN bool_and(error_rate_percent <= l) THEN 'healthy'
       WHEN NOT bool_or(error_rate_percent <= l) THEN 'unhealthy' ELSE 'degraded' END AS status
  FROM (SELECT error_rate_percent, {limit} AS l FROM ({COMPONENT_SQL}) c) g""" for gate, limit in GATE_LIMITS.items()))
def q_quality_gate(spark, sf):
    rates = Mx.error_rate_by_component(op_log(spark, sf))
    limits = {"tight": F.lit(5.0), "mean": F.avg("error_rate_percent").over(Window.partitionBy()), "loose": F.lit(100.0)}
    gates = [Mx.quality_gate(rates.withColumn("l", limits[g]), F.col("l")).withColumn("gate", F.lit(g)) for g in GATE_LIMITS]
    return gates[0].unionByName(gates[1]).unionByName(gates[2])
