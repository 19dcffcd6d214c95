"""Enrichment joins and declared features: category dimension join (E2), private
address ranges as a range join (E5), per-type sampling (D12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill import dims
from eventmill.functions.ipaddr import md5_prefix_num
from eventmill.operators.joins import range_join
from eventmill.operators.windows import latest_per_key


def category_join(events: DataFrame, dim: DataFrame, version_col: str | None = None) -> DataFrame:
    """Events LEFT JOIN the category table on event_type (last version per type wins).

    The dimension is de-duplicated to one row per type first (H2).
    """
    d = latest_per_key(dim, ["event_type"], version_col) if version_col else dim
    return events.join(d, on="event_type", how="left")


def ip_private_ranges(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """E5: (ip_address, ip_num) -> is_private via a bucketed range join with the block
    table; an address is private when inside a private block and in no exception."""
    j = range_join(ips, ranges, "ip_num", "lo", "hi", how="left")
    return (j.groupBy("ip_address", "ip_num")
            .agg((F.coalesce(F.bool_or("private"), F.lit(False))
                  & ~F.coalesce(F.bool_or(~F.col("private")), F.lit(False))).alias("is_private")))


def sample_by_type(events: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Keep a repeatable share of each listed type (md5 of event_id vs rate);
    unlisted types are kept whole."""
    rate = F.try_element_at(dims.map_literal(dims.SAMPLING_RATES), F.col("event_type"))
    if rates is not None:
        # a custom rate table (one row per type) replaces the fixed one
        events = events.join(rates.withColumnRenamed("rate", "_rate"), "event_type", "left")
        rate = F.col("_rate")
    h = F.pmod(md5_prefix_num(F.col("event_id").cast("string")), F.lit(10000))
    out = events.where(rate.isNull() | (h < rate * 10000))
    return out.drop("_rate") if rates is not None else out
