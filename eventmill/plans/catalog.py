"""SQL views with the source system's table names, so existing analytic SQL runs as
Spark SQL with only function-name changes (toHour -> hour, uniqExact -> count(DISTINCT),
uniq -> approx_count_distinct, today() -> current_date() or an as-of literal).

    register_views(spark, events_df)
    spark.sql("SELECT event_type, hour(timestamp) AS hour, count(*) AS event_count "
              "FROM events_distributed WHERE event_date >= date_sub(current_date(), 1) "
              "GROUP BY 1, 2 ORDER BY event_count DESC")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmill import dims
from eventmill.operators import analytics as A
from eventmill.operators import rollups as R


def register_views(spark: SparkSession, events: DataFrame, as_of=None) -> list[str]:
    """Create temp views over a flat event DataFrame (e.g. `sources.tables.events` or the
    flat sink read back).  Views are lazy: each query plans from the base table."""
    views = {
        "events_distributed": events,
        "events_local": events,
        "raw_events": events,
        "events_hourly_distributed": R.events_hourly(events),
        "daily_users_distributed": R.daily_users(events),
        "event_categories": dims.category_seed(spark),
        "performance_summary": A.performance_summary(events, as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
