"""The fixed analytic query set over the flat event table.

Every function takes the flat event DataFrame (see `sources.tables.events` or the flat
sink) and an optional `as_of` time ("now"); all plans are partial + final hash
aggregates with one exchange on the grouping keys, and the date predicates reach the
Parquet scan (or prune `event_date` partitions of the flat sink).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmill.sources.tables import as_of_column


def _today(events: DataFrame, as_of=None):
    return F.to_date(as_of_column(events, as_of=as_of))


def daily_total(events: DataFrame, as_of=None) -> DataFrame:
    """G1: events on the as-of day."""
    return (events.where(F.col("event_date") == _today(events, as_of))
            .agg(F.count(F.lit(1)).alias("event_count")))


def type_counts_recent(events: DataFrame, as_of=None, days: int = 1) -> DataFrame:
    """Events per type since the day before the as-of day."""
    return (events.where(F.col("event_date") >= F.date_sub(_today(events, as_of), days))
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")))


def approx_users(events: DataFrame, as_of=None, rsd: float = 0.01) -> DataFrame:
    """Estimate of the distinct users on the as-of day (an HLL sketch of standard error `rsd` at most).

    The sketch is one binary buffer; `approx_count_distinct` would carry some 1600 long columns at this error.
    """
    lg_k = min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))
    return (events.where(F.col("event_date") == _today(events, as_of))
            .agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", lg_k)).alias("approx_users")))


def hourly_profile(events: DataFrame, as_of=None) -> DataFrame:
    """Events per hour of the as-of day, ordered by hour."""
    return (events.where(F.col("event_date") == _today(events, as_of))
            .groupBy(F.hour("timestamp").alias("hour"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy("hour"))


def type_by_hour(events: DataFrame, as_of=None, days: int = 1) -> DataFrame:
    """Events per (type, hour of day) since yesterday, biggest first."""
    return (events.where(F.col("event_date") >= F.date_sub(_today(events, as_of), days))
            .groupBy("event_type", F.hour("timestamp").alias("hour"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(F.desc("event_count"), "event_type", "hour"))


def daily_unique_users(events: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Exact distinct users per day over the last `days` days."""
    return (events.where(F.col("event_date") >= F.date_sub(_today(events, as_of), days))
            .groupBy("event_date").agg(F.count_distinct("user_id").alias("unique_users"))
            .orderBy("event_date"))


def top_types(events: DataFrame, as_of=None, hours: int = 24, k: int = 10) -> DataFrame:
    """Top-k event types in the last `hours` hours (TakeOrderedAndProject)."""
    now = as_of_column(events, as_of=as_of)
    return (events.where(F.col("timestamp") >= now - F.expr(f"INTERVAL {int(hours)} HOURS"))
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("total_events"))
            .orderBy(F.desc("total_events"), "event_type").limit(k))


def performance_summary(events: DataFrame, as_of=None) -> DataFrame:
    """G12 + J1: four headline metrics as (metric, value) rows.

    One scan and one aggregate: conditional counts replace the four separate queries of a
    UNION ALL; `stack` then turns the single row into four.  Distinct users are exact.
    """
    now = as_of_column(events, as_of=as_of)
    today = F.to_date(now)
    last_hour = F.col("timestamp") >= now - F.expr("INTERVAL 1 HOUR")
    is_today = F.col("event_date") == today
    agg = events.where(last_hour | is_today).agg(
        F.count_if(last_hour).alias("n_hour"),
        F.count_if(is_today).alias("n_today"),
        F.count_distinct(F.when(is_today, F.col("user_id"))).alias("u_today"),
    )
    return agg.select(F.expr(
        "stack(4,"
        " 'Events per second (last hour)', round(n_hour / 3600, 2),"
        " 'Total events today', cast(n_today as double),"
        " 'Unique users today', cast(u_today as double),"
        " 'Average events per user today', round(try_divide(n_today, u_today), 2)"
        ") as (metric, value)"))


def total_events(events: DataFrame) -> DataFrame:
    """Count of all events (answered from Parquet row counts when nothing is read)."""
    return events.agg(F.count(F.lit(1)).alias("event_count"))


def doc_type_counts(events: DataFrame) -> DataFrame:
    """Events per type."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def distinct_users(events: DataFrame) -> DataFrame:
    """Distinct user ids (hash aggregate; partial distinct before the shuffle)."""
    return events.select("user_id").distinct()


def exact_quantiles(df: DataFrame, col: str, probs: list[float], accuracy: int = 100_000, cells: int = 1024) -> DataFrame:
    """One row: n, mean, and `q`, the exact quantiles of `col` with linear interpolation.

    Lazy, without gathering the values or multiplying the rows.  A sketch brackets each wanted rank (its rank error is at
    most n / accuracy).  The brackets' ends cut the values into bins; one grouped count keeps the distinct values of the
    bins inside a bracket, dealt to `cells` equal cells per bin, and only count, least and greatest of each other bin,
    which can be a wanted rank where a bracket is a rank or two wide.  The counts of the cells (a few thousand rows,
    whatever the size) say which cells hold the wanted ranks; only the values of those, two a quantile, are ranked.
    NULLs are left out.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    slack = 2.0 / accuracy
    at = [min(1.0, max(0.0, p + s * slack)) for p in probs for s in (-1, 1)]
    heads = v.agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.percentile_approx("v", at, accuracy).alias("ends"))
    ends = [f"e{i}" for i in range(len(at))]
    bounds = heads.select(F.lit(1).alias("one"), "n", *[F.get("ends", F.lit(i)).alias(e) for i, e in enumerate(ends)])
    x = F.col("v")
    is_end, inside = F.lit(False), F.lit(False)
    below = F.lit(0)
    for i, e in enumerate(ends):
        below = below + (F.col(e) < x).cast("int")
        is_end = is_end | (F.col(e) == x)
        if i % 2:
            inside = inside | x.between(F.col(ends[i - 1]), F.col(e))
    left = F.greatest(*[F.when(F.col(e) < x, F.col(e)) for e in ends])
    right = F.least(*[F.when(F.col(e) > x, F.col(e)) for e in ends])
    place = F.nanvl(F.coalesce(F.try_divide(x - left, right - left), F.lit(0.0)), F.lit(0.0)) * cells
    cell = F.when(inside & ~is_end, F.floor(F.greatest(F.lit(0.0), F.least(F.lit(cells - 1.0), place)))).otherwise(0)
    grouped = (v.withColumn("one", F.lit(1)).join(F.broadcast(bounds), "one")
               .groupBy("n", (below * 2 + is_end.cast("int")).alias("bin"), cell.alias("cell"), F.when(inside, x).alias("value"))
               .agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("least"), F.max("v").alias("most")))
    counts = grouped.groupBy("n", "bin", "cell").agg(F.sum("c").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("n").orderBy("bin", "cell").rowsBetween(Window.unboundedPreceding, 0))
    lows = [F.floor(F.lit(p) * (F.col("n") - 1)) for p in probs]
    ranks = [r for low in lows for r in (low, F.least(low + 1, F.col("n") - 1))]
    holds = F.lit(False)
    for r in ranks:
        holds = holds | ((F.col("upto") > r) & (F.col("upto") - F.col("c") <= r))
    hits = counts.withColumn("upto", upto).where(holds).select("bin", "cell", (F.col("upto") - F.col("c")).alias("before"))
    pair = lambda value, count: F.struct(F.col(value).alias("v"), count.cast("long").alias("c"))
    values = F.when(F.col("least") == F.col("most"), F.array(pair("least", F.col("c")))).otherwise(
        F.array(pair("least", F.lit(1)), pair("most", F.col("c") - 1)))
    entries = (grouped.join(F.broadcast(hits), ["bin", "cell"]).select("n", "bin", "cell", "before", F.inline(values)))
    ranked = entries.withColumn("upto", F.col("before") + F.sum("c").over(
        Window.partitionBy("bin", "cell").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
    found = ranked.agg(F.max("n").alias("n"), *[F.min(F.when(F.col("upto") > r, F.col("v"))).alias(f"r{i}") for i, r in enumerate(ranks)])
    quantile = [F.col(f"r{2 * i}") + (F.lit(p) * (F.col("n") - 1) - lows[i]) * (F.col(f"r{2 * i + 1}") - F.col(f"r{2 * i}"))
                for i, p in enumerate(probs)]
    q = found.select(F.array(*quantile).alias("q"), F.lit(1).alias("one"))
    return heads.select("n", "mean", F.lit(1).alias("one")).join(q, "one").drop("one")


def latency_percentiles(events: DataFrame, processed_col: str = "processed_at") -> DataFrame:
    """Count, mean, p50 / p95 / p99 of (processed - event time) in seconds, exact."""
    lat = (F.unix_micros(F.col(processed_col).cast("timestamp"))
           - F.unix_micros(F.col("timestamp").cast("timestamp"))) / F.lit(1e6)
    out = exact_quantiles(events.select(lat.alias("latency_s")), "latency_s", [0.5, 0.95, 0.99])
    return out.select("n", F.round("mean", 6).alias("mean_s"), *[
        F.round(F.get("q", F.lit(i)), 6).alias(c) for i, c in enumerate(["p50_s", "p95_s", "p99_s"])])
