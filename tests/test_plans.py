"""Plan checks: pushdown, pruning, broadcast, no Python in the plans (SURVEY §5 (5))."""

import pytest

from core_helpers import SF_SMALL

import __spark_entry__ as E
from eventmill.plans.registry import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    p = plan(E.queries()["type_in_range"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)" in p or "EqualTo(event_type,purchase)" in p
    assert "GreaterThanOrEqual(ts" in p


@pytest.mark.parametrize("name", ["daily_total", "hourly_profile", "type_counts_recent", "top_types"])
def test_as_of_day_bound_reaches_the_scan(spark, name):
    # the default 'now' (newest event) is planned as a literal, so the day / hour bound is
    # a pushed range on ts (row groups of other days skipped), not a run-time subquery
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts," in p
    assert "Subquery" not in p


def test_two_column_query_reads_two_columns(spark):
    p = plan(E.queries()["doc_type_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string>" in p


def test_dimension_join_is_broadcast(spark):
    # no hint and no count: AQE sees the bytes of the dimension when it runs
    df = E.queries()["category_join"](spark, SF_SMALL)
    df.collect()
    p = plan(df)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_top_k_is_take_ordered(spark):
    p = plan(E.queries()["top_types"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", [k for k in queries() if not k.startswith(("stream_", "sink_", "dual_", "replay"))])
def test_no_python_udf_in_plan(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, f"{name} runs Python: {bad}"


def test_stream_decodes_once_and_shares_one_shuffle(spark):
    # the accepted (dedup) and rejected branches of the ingest query read one event_id
    # shuffle: the rejected branch reuses it, and the dedup adds no exchange of its own
    from eventmill.session import scratch_dir
    from eventmill.sources.raw import raw_events
    from eventmill.streaming.ingest import StreamSource, run_stream, write_message_files
    base = scratch_dir(spark, "plan-stream")
    glob = write_message_files(raw_events(spark, SF_SMALL), f"{base}/in", 2)
    prev = spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")   # last run = a data batch
    try:
        qs = run_stream(spark, StreamSource(kind="files", path=glob, max_files=10, min_partitions=4),
                        f"{base}/out", f"{base}/ckpt", state_partitions=4)
        for q in qs:
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", prev)
    assert len(qs) == 1
    p = qs[0]._jsq.streamingQuery().lastExecution().executedPlan().toString()
    assert p.count("ReusedExchange") == 1
    shuffles = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln and "ReusedExchange" not in ln]
    assert len(shuffles) == 1
    assert "REQUIRED_BY_STATEFUL_OPERATOR" not in p
