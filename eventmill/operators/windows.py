"""Last-row-per-key, ring buffers and sessions (H1-H4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], version_col: str | None) -> DataFrame:
    """H1 / H2: the row with the greatest version per key (replacing merge).

    A `max_by` aggregate (partial aggregation before the shuffle, so a hot key is
    collapsed map-side) rather than a row_number window.
    """
    if version_col is None:
        return df.dropDuplicates(keys)
    others = [c for c in df.columns if c not in keys]
    w = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(version_col))
    return df.groupBy(*keys).agg(w.alias("_w")).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in others])


def metric_history(samples: DataFrame, key: str = "metric", ts: str = "ts", value: str = "value",
                   n: int = 100, tie: str | None = None) -> DataFrame:
    """H3: last n samples per metric, each with its rolling mean over those samples.

    A rank window per metric: metrics are few and each partition holds one metric's
    samples; n bounds the output, not the sort.
    """
    order = [F.desc(ts)] + ([F.desc(tie)] if tie else [])
    w = Window.partitionBy(key).orderBy(*order)
    last = samples.withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= n)
    roll = Window.partitionBy(key).orderBy(F.desc("recency")).rowsBetween(Window.unboundedPreceding, 0)
    return (last.withColumn("rolling_sum", F.sum(value).over(roll))
                .withColumn("rolling_mean", F.avg(value).over(roll)))


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "timestamp",
               gap_minutes: int = 30, tie: str | None = None, chunk: str = "1 day") -> DataFrame:
    """H4: sessions with an inactivity gap; one row per (user, session_no).

    Output: user_id, session_no (1, 2, ... per user), session_start, session_end,
    event_count.  A new session starts when at least `gap_minutes` have passed since the
    user's event before, as in a session window.

    One shuffle by (user, chunk) reduces each chunk to session fragments, so one very
    active user is spread over many tasks; a second one by user joins fragments that
    touch across chunks.  Fragments of a chunk lie a gap apart, so a user has at most
    (time span / gap) of them however many events there are.
    """
    gap = F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    order = [F.col(ts)] + ([F.col(tie)] if tie else [])
    in_chunk = Window.partitionBy(user, "_chunk").orderBy(*order)
    d = events.select(user, ts, *([tie] if tie else [])).withColumn(
        "_chunk", F.window(F.col(ts).cast("timestamp"), chunk).start)
    prev = F.lag(ts).over(in_chunk)
    d = d.withColumn("_new", F.when(prev.isNull() | (F.col(ts) >= prev + gap), 1).otherwise(0))
    d = d.withColumn("_run", F.sum("_new").over(in_chunk.rowsBetween(Window.unboundedPreceding, 0)))
    fragments = d.groupBy(user, "_chunk", "_run").agg(
        F.min(ts).alias("_start"), F.max(ts).alias("_end"), F.count(F.lit(1)).alias("_n"))
    of_user = Window.partitionBy(user).orderBy("_start")
    before = F.lag("_end").over(of_user)
    joined = fragments.withColumn("_new", F.when(before.isNull() | (F.col("_start") >= before + gap), 1).otherwise(0))
    joined = joined.withColumn(
        "session_no", F.sum("_new").over(of_user.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    return (joined.groupBy(user, "session_no")
            .agg(F.min("_start").alias("session_start"), F.max("_end").alias("session_end"),
                 F.sum("_n").alias("event_count")))


def contiguous_index(df: DataFrame, part: str, order: str, bucket_width: int = 100_000,
                     name: str = "offset") -> DataFrame:
    """0-based position of each row by `order` within `part` (e.g. topic offsets), without
    a window over a whole partition: rows are ranked inside (part, order-bucket) groups
    and shifted by the row counts of the earlier buckets (a small prefix-sum table)."""
    b = F.floor(F.col(order) / bucket_width).alias("_ob")
    d = df.withColumn("_ob", b)
    counts = d.groupBy(part, "_ob").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(part).orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_c").over(wb), F.lit(0))).drop("_c")
    d = d.join(starts, [part, "_ob"])
    w = Window.partitionBy(part, "_ob").orderBy(order)
    return d.withColumn(name, (F.col("_start") + F.row_number().over(w) - 1).cast("long")).drop("_ob", "_start")
