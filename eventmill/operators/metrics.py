"""Pipeline-quality metrics as ordinary aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reject_ratio_gate(tagged: DataFrame, batch_col: str = "batch_id", threshold: float = 0.5) -> DataFrame:
    """Per batch, reject share and whether it exceeds the threshold (fails the batch)."""
    rej = F.col("reject_reason").isNotNull()
    ratio = F.avg(rej.cast("double"))
    return tagged.groupBy(F.col(batch_col).cast("long").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(rej).alias("rejects"),
        F.round(ratio, 6).alias("reject_ratio"), (ratio > F.lit(threshold)).alias("failed"))


def batch_totals(batch_log: DataFrame) -> DataFrame:
    """Running totals of the per-batch outcome log (the final value of each counter)."""
    return batch_log.agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.sum(c).alias(c) for c in ["consumed", "transformed", "written_flat", "written_doc", "errors"]])


def sink_error_rate(op_log: DataFrame) -> DataFrame:
    """Written batches, errors and combined error rate = errors / max(1, batches)."""
    ok = F.col("status") == "ok"
    return op_log.agg(
        F.count_if(ok).alias("batches_written"),
        F.count_if(~ok).alias("errors"),
        F.round(F.count_if(~ok) / F.greatest(F.lit(1), F.count_if(ok)), 6).alias("combined_error_rate"))


def status_counts(op_log: DataFrame, source: str = "kafka") -> DataFrame:
    """Events counted by (status, event_type, source)."""
    return (op_log.groupBy("status", F.col("operation").alias("event_type"), F.lit(source).alias("source"))
            .agg(F.count(F.lit(1)).alias("n")))


def error_rate_by_component(op_log: DataFrame) -> DataFrame:
    """Per component (<database>_writer): total, errors, error percent."""
    err = F.col("status") == "error"
    return (op_log.groupBy(F.concat(F.col("database"), F.lit("_writer")).alias("component"))
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(err).alias("errors"),
                 F.round(F.lit(100.0) * F.count_if(err) / F.count(F.lit(1)), 6).alias("error_rate_percent")))


def store_op_counts(op_log: DataFrame) -> DataFrame:
    """Store operations by (database, operation, status)."""
    return op_log.groupBy("database", "operation", "status").agg(F.count(F.lit(1)).alias("n"))


def _le_text(b: float) -> str:
    return repr(float(b))


def duration_histogram(op_log: DataFrame, buckets: list[float], value: str = "duration",
                       keys: tuple[str, ...] = ("operation", "database")) -> DataFrame:
    """Cumulative histogram per key: one aggregate pass computes every bucket's count
    (count_if(v <= le)) plus +Inf, sum and count; the one-row-per-key result is then
    turned into one row per bucket.  No join with a bounds table, no per-row explode."""
    aggs = [F.count_if(F.col(value) <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(buckets)]
    per = op_log.groupBy(*keys).agg(*aggs, F.count(F.lit(1)).alias("_inf"),
                                    F.sum(value).alias("sum"), F.count(F.lit(1)).alias("count"))
    pairs = [F.struct(F.lit(_le_text(b)).alias("le"), F.col(f"_b{i}").alias("cumulative_count"))
             for i, b in enumerate(buckets)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("_inf").alias("cumulative_count")))
    return (per.select(*keys, F.round("sum", 6).alias("sum"), "count", F.explode(F.array(*pairs)).alias("_p"))
            .select(*keys, "_p.le", "_p.cumulative_count", "sum", "count"))


def throughput(op_log: DataFrame, batch_size: int = 1000) -> DataFrame:
    """messages/s and bytes/s over the time span of the log, failure percent and
    mean batch size (batches of `batch_size` consecutive ids)."""
    elapsed = (F.unix_micros(F.max(F.col("ts").cast("timestamp")))
               - F.unix_micros(F.min(F.col("ts").cast("timestamp")))) / F.lit(1e6)
    n = F.count(F.lit(1))
    return op_log.agg(
        n.alias("messages"),
        F.round(n / F.greatest(elapsed, F.lit(1e-6)), 6).alias("messages_per_second"),
        F.round(F.sum("payload_bytes") / F.greatest(elapsed, F.lit(1e-6)), 6).alias("bytes_per_second"),
        F.round(F.lit(100.0) * F.count_if(F.col("status") == "error") / F.greatest(F.lit(1), n), 6)
         .alias("failure_percent"),
        F.round(n / F.count_distinct(F.floor(F.col("id") / batch_size)), 6).alias("avg_batch_size"))


def errors_by_kind(tagged: DataFrame) -> DataFrame:
    """Failures by kind (the rule family of the reject reason)."""
    return (tagged.where(F.col("reject_reason").isNotNull())
            .groupBy(F.split_part(F.col("reject_reason"), F.lit(":"), F.lit(1)).alias("error_kind"))
            .agg(F.count(F.lit(1)).alias("n")))


def quality_gate(component_rates: DataFrame, max_error_percent: float | Column = 5.0) -> DataFrame:
    """Healthy when every component is under the error threshold (a number or a
    column), unhealthy when none is, degraded otherwise."""
    limit = max_error_percent if isinstance(max_error_percent, Column) else F.lit(max_error_percent)
    healthy = F.col("error_rate_percent") <= limit
    return component_rates.agg(
        F.count(F.lit(1)).alias("components"),
        F.count_if(healthy).alias("healthy_components"),
        F.when(F.bool_and(healthy), F.lit("healthy"))
         .when(~F.bool_or(healthy), F.lit("unhealthy")).otherwise(F.lit("degraded")).alias("status"))
