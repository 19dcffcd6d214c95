"""Registered analytic queries and lookups over the flat event table (G1-G15, I*, D10)."""

from __future__ import annotations

from eventmill.operators import analytics as A
from eventmill.operators import lookups as L
from eventmill.plans.registry import register
from eventmill.plans.sqlgen import AS_OF, EVENTS_VIEW, TODAY, priority_rank_case
from eventmill.sources.tables import events

EV = EVENTS_VIEW
EV_COLS = ("event_id, user_id, event_type, \"timestamp\", event_date, hour_of_day, day_of_week, "
           "is_weekend, event_category, session_id, value, props")

# Fixed lookup parameters of the registered point queries.
LOOKUP_USER = 7
SAMPLE_TYPE = "view"
TIMELINE_TYPE = "purchase"
TIMELINE_CATEGORY = "revenue"
RANGE_TYPE, RANGE_START, RANGE_END = "purchase", "2024-01-10 00:00:00", "2024-01-11 00:00:00"


@register("daily_total", f"SELECT count(*) AS event_count FROM {EV} e WHERE event_date = {TODAY}")
def daily_total(spark, sf):
    return A.daily_total(events(spark, sf))


@register("type_counts_recent",
          f"SELECT event_type, count(*) AS event_count FROM {EV} e WHERE event_date >= {TODAY} - 1 GROUP BY event_type")
def type_counts_recent(spark, sf):
    return A.type_counts_recent(events(spark, sf))


@register("approx_users")
def approx_users(spark, sf):
    return A.approx_users(events(spark, sf))


@register("approx_users_check", f"SELECT count(DISTINCT user_id) AS unique_users, true AS within_three_sigma FROM {EV} e WHERE event_date = {TODAY}")
def approx_users_check(spark, sf):
    """The estimate against the exact count, at three standard errors."""
    from pyspark.sql import functions as F
    ev = events(spark, sf)
    exact = A.daily_unique_users(ev, days=0).agg(F.sum("unique_users").alias("unique_users"))
    both = exact.withColumn("k", F.lit(1)).join(A.approx_users(ev).withColumn("k", F.lit(1)), "k")
    return both.select("unique_users", (F.abs(F.col("approx_users") - F.col("unique_users")) <= 0.03 * F.col("unique_users") + 1).alias("within_three_sigma"))


@register("hourly_profile",
          f"SELECT CAST(hour(\"timestamp\") AS INTEGER) AS hour, count(*) AS event_count FROM {EV} e "
          f"WHERE event_date = {TODAY} GROUP BY 1 ORDER BY 1")
def hourly_profile(spark, sf):
    return A.hourly_profile(events(spark, sf))


@register("type_by_hour",
          f"SELECT event_type, CAST(hour(\"timestamp\") AS INTEGER) AS hour, count(*) AS event_count FROM {EV} e "
          f"WHERE event_date >= {TODAY} - 1 GROUP BY 1, 2 ORDER BY event_count DESC, event_type, hour")
def type_by_hour(spark, sf):
    return A.type_by_hour(events(spark, sf))


@register("daily_unique_users",
          f"SELECT event_date, count(DISTINCT user_id) AS unique_users FROM {EV} e "
          f"WHERE event_date >= {TODAY} - 7 GROUP BY 1 ORDER BY 1")
def daily_unique_users(spark, sf):
    return A.daily_unique_users(events(spark, sf))


@register("top_types",
          f"SELECT event_type, count(*) AS total_events FROM {EV} e "
          f"WHERE \"timestamp\" >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1 ORDER BY total_events DESC, event_type LIMIT 10")
def top_types(spark, sf):
    return A.top_types(events(spark, sf))


@register("performance_summary", f"""
WITH t AS (SELECT
  count(*) FILTER (WHERE "timestamp" >= {AS_OF} - INTERVAL 1 HOUR) AS n_hour,
  count(*) FILTER (WHERE event_date = {TODAY}) AS n_today,
  count(DISTINCT CASE WHEN event_date = {TODAY} THEN user_id END) AS u_today
  FROM {EV} e)
SELECT 'Events per second (last hour)' AS metric, round(n_hour / 3600, 2) AS value FROM t
UNION ALL SELECT 'Total events today', CAST(n_today AS DOUBLE) FROM t
UNION ALL SELECT 'Unique users today', CAST(u_today AS DOUBLE) FROM t
UNION ALL SELECT 'Average events per user today', round(n_today / nullif(u_today, 0), 2) FROM t""")
def performance_summary(spark, sf):
    return A.performance_summary(events(spark, sf))


@register("total_events", "SELECT count(*) AS event_count FROM events")
def total_events(spark, sf):
    return A.total_events(events(spark, sf))


@register("doc_type_counts", "SELECT event_type, count(*) AS event_count FROM events GROUP BY 1")
def doc_type_counts(spark, sf):
    return A.doc_type_counts(events(spark, sf))


@register("distinct_users", "SELECT DISTINCT user_id FROM events")
def distinct_users(spark, sf):
    return A.distinct_users(events(spark, sf))


@register("latency_percentiles", f"""
WITH l AS (SELECT (epoch_us(ts + to_microseconds(CAST(floor(value * 10000) AS BIGINT))) - epoch_us(ts)) / 1e6 AS latency_s
           FROM events)
SELECT count(*) AS n, round(avg(latency_s), 6) AS mean_s,
  round(quantile_cont(latency_s, 0.5), 6) AS p50_s, round(quantile_cont(latency_s, 0.95), 6) AS p95_s,
  round(quantile_cont(latency_s, 0.99), 6) AS p99_s FROM l""")
def latency_percentiles(spark, sf):
    from pyspark.sql import functions as F
    ev = events(spark, sf)
    # Modelled processing time: value/100 seconds after the event (whole microseconds).
    proc = F.timestamp_add("MICROSECOND", F.floor(F.col("value") * 10000), F.col("timestamp"))
    return A.latency_percentiles(ev.withColumn("processed_at", proc))


@register("user_latest",
          f"SELECT {EV_COLS} FROM {EV} e WHERE user_id = {LOOKUP_USER} ORDER BY \"timestamp\" DESC, event_id LIMIT 100")
def user_latest(spark, sf):
    return L.user_latest(events(spark, sf), LOOKUP_USER)


@register("type_sample",
          f"SELECT {EV_COLS} FROM {EV} e WHERE event_type = '{SAMPLE_TYPE}' ORDER BY event_id LIMIT 100")
def type_sample(spark, sf):
    return L.type_sample(events(spark, sf), SAMPLE_TYPE)


@register("type_timeline",
          f"SELECT {EV_COLS} FROM {EV} e WHERE event_type = '{TIMELINE_TYPE}' ORDER BY \"timestamp\" DESC, event_id LIMIT 100")
def type_timeline(spark, sf):
    return L.type_timeline(events(spark, sf), TIMELINE_TYPE)


@register("latest_events", f"SELECT {EV_COLS} FROM {EV} e ORDER BY \"timestamp\" DESC, event_id LIMIT 100")
def latest_events(spark, sf):
    return L.latest_events(events(spark, sf))


@register("category_timeline",
          f"SELECT {EV_COLS} FROM {EV} e WHERE event_category = '{TIMELINE_CATEGORY}' ORDER BY \"timestamp\" DESC, event_id LIMIT 100")
def category_timeline(spark, sf):
    return L.category_timeline(events(spark, sf), TIMELINE_CATEGORY)


@register("capped_latest", f"SELECT {EV_COLS} FROM {EV} e ORDER BY \"timestamp\" DESC, event_id LIMIT 1000")
def capped_latest(spark, sf):
    return L.capped_latest(events(spark, sf))


@register("type_in_range",
          f"SELECT {EV_COLS} FROM {EV} e WHERE event_type = '{RANGE_TYPE}' "
          f"AND \"timestamp\" >= TIMESTAMP '{RANGE_START}' AND \"timestamp\" < TIMESTAMP '{RANGE_END}'")
def type_in_range(spark, sf):
    return L.type_in_range(events(spark, sf), RANGE_TYPE, RANGE_START, RANGE_END)


@register("priority_tag", f"""
SELECT event_type, {priority_rank_case('event_type')} AS priority_rank,
  (CASE {priority_rank_case('event_type')} WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END) AS priority,
  count(*) AS event_count
FROM events GROUP BY ALL""")
def priority_tag(spark, sf):
    from pyspark.sql import functions as F
    from eventmill.functions.category import priority_of, priority_rank_of
    ev = events(spark, sf)
    return (ev.groupBy("event_type", priority_rank_of(F.col("event_type")).alias("priority_rank"),
                       priority_of(F.col("event_type")).alias("priority"))
            .agg(F.count(F.lit(1)).alias("event_count")))


@register("priority_first", f"""SELECT event_id, event_type, {priority_rank_case('event_type')} AS priority_rank, "timestamp" FROM {EV} e
  ORDER BY priority_rank, "timestamp", event_id LIMIT 200""")
def priority_first(spark, sf):
    from pyspark.sql import functions as F
    from eventmill.functions.category import priority_rank_of
    out = L.priority_first(events(spark, sf), 200)
    return out.select("event_id", "event_type", priority_rank_of(F.col("event_type")).alias("priority_rank"), "timestamp")
