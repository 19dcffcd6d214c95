"""Registered rollups, last-row, window and layout keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventmill import dims
from eventmill.operators import layout as M
from eventmill.operators import rollups as R
from eventmill.operators import windows as W
from eventmill.plans.registry import register
from eventmill.plans.sqlgen import EVENTS_VIEW, TODAY, q
from eventmill.session import scratch_dir
from eventmill.sinks.clustered import buckets_for, write_bucketed
from eventmill.sources.modelled import dim_versions, dim_versions_sql, op_log, op_log_sql
from eventmill.sources.tables import as_of_column, events

EV = EVENTS_VIEW
N_BLOCKS = 10      # insert blocks of the modelled partial rollups (block = id % 10)
N_SHARDS = 6
RETENTION_DAYS = 14     # shorter than the test data, so that rows do expire

HOURLY_SQL = f"""SELECT event_date, date_trunc('hour', "timestamp") AS event_hour, event_type, event_category,
  count(*) AS event_count, count(DISTINCT user_id) AS unique_users FROM {EV} e GROUP BY 1, 2, 3, 4"""


@register("events_hourly", HOURLY_SQL)
def q_events_hourly(spark, sf):
    return R.events_hourly(events(spark, sf))


@register("merge_hourly_partials", HOURLY_SQL.replace("unique_users", "approx_users"))
def q_merge_hourly_partials(spark, sf):
    ev = events(spark, sf).withColumn("block", F.col("event_id") % N_BLOCKS)
    return R.merge_hourly_partials(R.hourly_partials(ev, "block"))


DAILY_SQL = f"""SELECT event_date, user_id, min("timestamp") AS first_event_time, max("timestamp") AS last_event_time,
  count(*) AS event_count, count(DISTINCT event_type) AS unique_event_types, count(DISTINCT session_id) AS session_count
  FROM {EV} e GROUP BY 1, 2"""


@register("daily_users", DAILY_SQL)
def q_daily_users(spark, sf):
    return R.daily_users(events(spark, sf))


_BUCKETED: dict[tuple[str, str], str] = {}


def bucketed_events(spark, sf):
    """The events as a table bucketed by user, written once per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BUCKETED:
        ev = events(spark, sf)
        path = scratch_dir(spark, "events-by-user")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        write_bucketed(ev, name, path, "user_id", buckets_for(ev.count()), sort=("timestamp",))
        _BUCKETED[key] = name
    return spark.table(_BUCKETED[key])


@register("daily_users_bucketed", DAILY_SQL)
def q_daily_users_bucketed(spark, sf):
    """G9 over the bucketed table: no exchange (M4)."""
    return R.daily_users(bucketed_events(spark, sf))


@register("user_first_purchase", f"""SELECT p.user_id, p.first_purchase, count(*) AS events_before
  FROM (SELECT user_id, min("timestamp") AS first_purchase FROM {EV} e WHERE event_type = 'purchase' GROUP BY user_id) p
  JOIN {EV} e ON e.user_id = p.user_id AND e."timestamp" < p.first_purchase GROUP BY 1, 2""")
def q_user_first_purchase(spark, sf):
    """Per user the first purchase and the events before it: a self-join on the bucket key, no exchange (M4)."""
    ev = bucketed_events(spark, sf)
    first = ev.where(F.col("event_type") == "purchase").groupBy("user_id").agg(F.min("timestamp").alias("first_purchase"))
    return (ev.select("user_id", "timestamp").join(first, "user_id").where(F.col("timestamp") < F.col("first_purchase"))
            .groupBy("user_id", "first_purchase").agg(F.count(F.lit(1)).alias("events_before")))


@register("latest_daily_user", f"""SELECT event_date, user_id, "timestamp", event_id, event_type, session_id FROM {EV} e
  QUALIFY row_number() OVER (PARTITION BY event_date, user_id ORDER BY "timestamp" DESC, event_id DESC) = 1""")
def q_latest_daily_user(spark, sf):
    rows = events(spark, sf).select("event_date", "user_id", "timestamp", "event_id", "event_type", "session_id")
    versioned = rows.withColumn("version", F.struct("timestamp", "event_id"))
    return W.latest_per_key(versioned, ["event_date", "user_id"], "version").drop("version")


@register("latest_category", f"""SELECT event_type, category, version FROM {dim_versions_sql()} d
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY version DESC) = 1""")
def q_latest_category(spark, sf):
    return W.latest_per_key(dim_versions(spark, sf), ["event_type"], "version")


@register("metric_history", f"""SELECT metric, ts, id, value, recency,
  round(sum(value) OVER (PARTITION BY metric ORDER BY recency DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS rolling_sum
  FROM (SELECT operation AS metric, ts, id, duration AS value,
        row_number() OVER (PARTITION BY operation ORDER BY ts DESC, id DESC) AS recency FROM {op_log_sql()} o)
  WHERE recency <= 100""")
def q_metric_history(spark, sf):
    s = op_log(spark, sf).select(F.col("operation").alias("metric"), "ts", "id", F.col("duration").alias("value"))
    out = W.metric_history(s, "metric", "ts", "value", 100, tie="id")
    # the rolling sum is compared (exact at 4 decimals); the library also returns the mean
    return out.withColumn("rolling_sum", F.round("rolling_sum", 4)).drop("rolling_mean")


@register("sessionize", f"""SELECT user_id, session_no, min("timestamp") AS session_start, max("timestamp") AS session_end,
  count(*) AS event_count FROM (
  SELECT user_id, "timestamp", sum(new) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no FROM (
    SELECT user_id, "timestamp", event_id, CASE WHEN lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) IS NULL
      OR "timestamp" >= lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) + INTERVAL 30 MINUTE
      THEN 1 ELSE 0 END AS new FROM {EV} e) x) y GROUP BY 1, 2""")
def q_sessionize(spark, sf):
    return W.sessionize(events(spark, sf), gap_minutes=30, tie="event_id")


@register("partition_counts_by_month", f"""SELECT CAST(year(event_date) * 100 + month(event_date) AS INTEGER) AS event_month,
  count(*) AS event_count, min(event_date) AS first_date, max(event_date) AS last_date FROM {EV} e GROUP BY 1""")
def q_partition_counts_by_month(spark, sf):
    return M.partition_counts_by_month(events(spark, sf))


@register("retention_filter", f"""SELECT event_date, count(*) AS event_count FROM {EV} e
  WHERE event_date >= {TODAY} - {RETENTION_DAYS} GROUP BY 1""")
def q_retention_filter(spark, sf):
    ev = events(spark, sf)
    today = F.to_date(as_of_column(ev))
    kept = M.retention_filter(ev, today, RETENTION_DAYS)
    return kept.groupBy("event_date").agg(F.count(F.lit(1)).alias("event_count"))


@register("shard_balance", f"""SELECT CAST(user_id % {N_SHARDS} AS INTEGER) AS shard, count(*) AS rows,
  count(DISTINCT user_id) AS users FROM {EV} e GROUP BY 1""")
def q_shard_balance(spark, sf):
    return M.shard_balance(events(spark, sf), F.pmod(F.col("user_id"), F.lit(N_SHARDS)).cast("int"))


def _config_dim_sql() -> str:
    rows = []
    for cat, desc, types in dims.CATEGORIES:
        rows += [f"({q(t)}, {q(cat)}, {q(desc)})" for t in types]
    return f"(VALUES {', '.join(rows)}) AS d(event_type, category, description)"


@register("category_dim", f"""SELECT coalesce(d.category, '{dims.DEFAULT_CATEGORY}') AS category, d.description,
  count(*) AS event_count FROM events e LEFT JOIN {_config_dim_sql()} ON lower(e.event_type) = d.event_type GROUP BY ALL""")
def q_category_dim(spark, sf):
    dim = dims.category_dim(spark, "config").drop("source")
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select(F.lower("event_type").alias("event_type"))
    j = ev.join(dim, "event_type", "left")
    return (j.groupBy(F.coalesce(F.col("category"), F.lit(dims.DEFAULT_CATEGORY)).alias("category"), "description")
            .agg(F.count(F.lit(1)).alias("event_count")))


def _all_dim_sql() -> str:
    rows, known = [], set()
    for cat, desc, types in dims.CATEGORIES:
        src = "code" if cat in dims.CODE_CATEGORIES else "config"
        for t in types:
            rows.append(f"({q(t)}, {q(cat)}, {q(src)})")
            known.add(t)
    rows += [f"({q(t)}, {q(c)}, 'seed')" for t, c, _d in dims.CATEGORY_SEED if t not in known]
    return f"(VALUES {', '.join(rows)}) AS d(event_type, category, source)"


@register("category_seed", f"""SELECT lower(e.event_type) AS event_type, d.category, d.source, count(*) AS event_count
  FROM events e LEFT JOIN {_all_dim_sql()} ON lower(e.event_type) = d.event_type GROUP BY ALL""")
def q_category_seed(spark, sf):
    dim = dims.category_dim(spark, "all").drop("description")
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select(F.lower("event_type").alias("event_type"))
    j = ev.join(F.broadcast(dim), "event_type", "left")   # fixed literal table: size bound proven
    return j.groupBy("event_type", "category", "source").agg(F.count(F.lit(1)).alias("event_count"))

