"""Topic rows (B5, B6, B7, N1): key / value / partition rows for a message sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def default_partition(n: int = 6) -> Callable[[DataFrame], Column]:
    """Stable placement by user: pmod(xxhash64(user_id), n) (same in every process)."""
    return lambda df: F.pmod(F.xxhash64(F.col("user_id")), F.lit(n)).cast("int")


def to_topic_rows(df: DataFrame, topic: str, key: str = "event_id",
                  partition: Callable[[DataFrame], Column] | None = None,
                  headers: dict[str, Column] | None = None) -> DataFrame:
    """(topic, key, partition, value, headers, bytes) rows; value is the row as JSON text.

    `partition` is the pluggable strategy (N1): a function DataFrame -> Column.  `headers`
    are name -> column, written as the connector takes them (an array of key and binary
    value).  Write with `.write.format("kafka")` when the connector is on the class path,
    or to files for tests.
    """
    part = (partition or default_partition())(df)
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    heads = [F.struct(F.lit(n).alias("key"), F.encode(c.cast("string"), "UTF-8").alias("value")) for n, c in (headers or {}).items()]
    out = df.select(F.lit(topic).alias("topic"), F.col(key).cast("string").alias("key"),
                    part.alias("partition"), value.alias("value"),
                    (F.array(*heads) if heads else F.array().cast("array<struct<key:string,value:binary>>")).alias("headers"))
    # Serialised size of each message (feeds bytes/s in the throughput metric)
    return out.withColumn("bytes", F.octet_length("value"))


def wrapped(value: Column) -> Column:
    """A record's JSON text as an object: one that is no JSON object goes under "data"."""
    parsed = F.try_parse_json(value)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    quoted = F.to_json(F.struct(value.alias("v")))
    inner = F.when(value.isNotNull(), F.when(parsed.isNotNull(), value).otherwise(quoted.substr(F.lit(6), F.length(quoted) - 6)))
    return F.when(is_object, value).otherwise(F.concat(F.lit('{"data":'), F.coalesce(inner, F.lit("null")), F.lit("}")))


def partition_batch_counts(rows: DataFrame, max_bytes: int = 1_000_000) -> DataFrame:
    """Rows per partition, as sent / failed / total counts.

    A message fails if it has no partition or no value, or is larger than the sink takes.
    """
    bad = F.col("partition").isNull() | F.col("value").isNull() | (F.col("bytes") > max_bytes)
    return rows.groupBy("partition").agg(F.count_if(~bad).alias("sent"), F.count_if(bad).alias("failed"),
                                         F.count(F.lit(1)).alias("total"))
