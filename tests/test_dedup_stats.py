"""De-duplication and pipeline counters."""

from pyspark.sql import functions as F

from core_helpers import raw_df, sample
from eventmill.operators.dedup import dedup, duplicate_report
from eventmill.operators.transform import split, transform, transform_events, transform_stats


def test_same_event_twice_second_dropped(spark):
    out = transform_events(raw_df(spark, [sample(), sample()]))
    assert out.count() == 1


def test_counters_valid_duplicate_invalid(spark):
    rows = [sample(), sample(), sample(event_id="bad-1", user_id="x")]
    s = transform_stats(transform(raw_df(spark, rows))).first()
    assert (s["processed"], s["duplicates"], s["errors"], s["validation_errors"]) == (3, 1, 1, 1)
    assert s["enriched"] == 1


def test_first_delivery_wins(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")], "event_id string, seq int, v string")
    got = {r["event_id"]: r["v"] for r in dedup(df, "event_id", "seq").collect()}
    assert got == {"a": "early", "b": "only"}


def test_hot_key_collapses_before_shuffle(spark):
    # one id carrying most rows: the plan aggregates partially before the exchange
    df = spark.range(0, 20000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
                                      .alias("event_id"), F.col("id").alias("seq"))
    out = dedup(df, "event_id", "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan or "Partial" in plan
    assert out.where("event_id = 'hot'").first()["seq"] == 0


def test_duplicate_report(spark):
    rows = [sample(), sample(), sample(event_id="x-2")]
    ok, _ = split(transform(raw_df(spark, rows)))
    rep = duplicate_report(transform(raw_df(spark, rows)).where("reject_reason is null")).collect()
    assert [(r["event_id"], r["count"]) for r in rep] == [("ev-7f", 2)]
    assert ok.count() == 2
