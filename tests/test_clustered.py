"""Clustered and bucketed tables: what a lookup reads, and plans without an exchange."""

import pytest
from pyspark.sql import functions as F

from core_helpers import SF_SMALL
from eventmill.operators import lookups as L
from eventmill.plans.registry import queries
from eventmill.plans.rollup_queries import bucketed_events
from eventmill.sinks.clustered import buckets_for, curve_bounds, curve_position, write_clustered

ROWS = 60_000


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """60 000 events of 2000 users (a third of the rows are one user's), 10 countries and types, as one clustered table."""
    h = lambda i: F.xxhash64("id", F.lit(i))
    user = F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(h(1), F.lit(2000)))
    df = spark.range(ROWS).select(
        F.concat(F.lit("e"), F.col("id")).alias("event_id"), user.cast("long").alias("user_id"),
        F.concat(F.lit("t"), F.pmod(h(2), F.lit(10))).alias("event_type"), F.concat(F.lit("c"), F.pmod(h(3), F.lit(10))).alias("country"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.pmod(h(4), F.lit(30 * 86400)))).alias("timestamp"))
    df = df.withColumn("session_id", F.concat_ws("-", F.lit("s"), "user_id", F.date_format("timestamp", "yyyyMMdd")))
    df = df.withColumn("event_date", F.to_date("timestamp")).withColumn("country", F.when(F.pmod(F.xxhash64("event_id"), F.lit(50)) != 0, F.col("country")))
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    write_clustered(df, path, ["user_id", "country", "event_date", "event_type"], bloom=("user_id", "session_id"), files=256,
                    bloom_values=300)
    return df, spark.read.parquet(path)


def rows_read(spark, df):
    """Rows that the scan handed on, after skipped row groups, and the result."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        qe = df._jdf.queryExecution()
        leaves = qe.executedPlan().collectLeaves()
        got = [r for r in qe.executedPlan().executeCollectPublic()]
        return leaves.apply(0).metrics().apply("numOutputRows").value(), len(got)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name, lookup, share", [
    ("user", lambda t: L.user_latest(t, 77), 0.1),
    ("session", lambda t: L.session_timeline(t, "s-77-20240103"), 0.1),
    ("country", lambda t: L.country_timeline(t, "c4"), 0.4),
    ("type", lambda t: L.type_timeline(t, "t4"), 0.6),
    ("days", lambda t: t.where(F.col("event_date") < F.lit("2024-01-04").cast("date")), 0.6),
])
def test_one_layout_lets_every_lookup_skip(spark, stored, name, lookup, share):
    df, table = stored
    read, found = rows_read(spark, lookup(table))
    assert read <= share * ROWS, (name, read)
    assert found == lookup(df).count()
    assert lookup(table).exceptAll(lookup(df)).count() == 0


def test_clustered_keeps_every_row(spark, stored):
    df, table = stored
    assert table.columns == df.columns and table.exceptAll(df).count() == 0 and table.count() == ROWS


def test_curve_of_odd_input(spark, tmp_path):
    rows = [(1, None, "a"), (1, None, "a"), (2, "x", None), (None, None, None)]
    df = spark.createDataFrame(rows, "user_id long, country string, note string")
    for i, d in enumerate((df, df.limit(0))):
        write_clustered(d, f"{tmp_path}/{i}", ["country", "user_id"])
        assert sorted(map(str, spark.read.schema(df.schema).parquet(f"{tmp_path}/{i}").collect())) == sorted(map(str, d.collect()))
    assert curve_bounds(df, ["country", "user_id"]) == {"country": [("x", 32)], "user_id": [(1, 21), (2, 53)]}
    z = spark.createDataFrame([(0b10, 0b01)], "a int, b int").select(curve_position(["a", "b"], 2)).first()[0]
    assert z == 0b1001


@pytest.mark.parametrize("name", ["daily_users_bucketed", "user_first_purchase"])
def test_bucketed_plans_need_no_exchange(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # as with tables too large to send
    try:
        plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert "Exchange" in queries()["daily_users"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_self_join_on_user_needs_no_exchange(spark):
    ev = bucketed_events(spark, SF_SMALL).select("user_id", "timestamp")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ev.join(ev.groupBy("user_id").agg(F.max("timestamp").alias("last")), "user_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan


def test_buckets_grow_with_the_rows():
    assert [buckets_for(n) for n in (0, 10 ** 6, 10 ** 9, 10 ** 12)] == [8, 8, 256, 262144]
