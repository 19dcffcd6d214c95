"""Bucketed range (interval containment) join; Catalyst and AQE choose broadcast or shuffle by the sides' bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_join(points: DataFrame, ranges: DataFrame, point_col: str, lo: str = "lo", hi: str = "hi",
               bucket_bits: int = 16, how: str = "inner") -> DataFrame:
    """Rows of `points` joined with every range [lo, hi] containing `point_col`.

    Each range is exploded into the buckets (value >> bucket_bits) it covers, so the join
    is an equi-join on the bucket plus a BETWEEN filter instead of a nested loop; with
    2^16 buckets it also spreads over many shuffle partitions when the range table is
    too big to broadcast.
    """
    rb = ranges.withColumn("_bucket", F.explode(F.sequence(F.shiftright(F.col(lo), bucket_bits),
                                                           F.shiftright(F.col(hi), bucket_bits))))
    pb = points.withColumn("_bucket", F.shiftright(F.col(point_col), bucket_bits))
    cond = (pb["_bucket"] == rb["_bucket"]) & pb[point_col].between(rb[lo], rb[hi])
    return pb.join(rb, cond, how).drop(rb["_bucket"]).drop(pb["_bucket"])
