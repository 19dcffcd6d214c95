"""Levelled tables, the id index, retention and progress logs."""

import glob
import os
import uuid

import pytest
from core_helpers import raw_df, sample
from pyspark.sql import functions as F
from test_sinks_stream import drain, land

from eventmill.operators import rollups as R
from eventmill.operators.transform import transform_events
from eventmill.session import scratch_dir
from eventmill.sinks.files import drop_dates, read_flat, write_document, write_flat
from eventmill.sinks.idindex import IdIndex, linear_bucket
from eventmill.sinks.levels import Levels


def sums(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def totals(levels):
    return {r["k"]: r["n"] for r in sums(levels.read()).collect()}


def test_levels_hold_the_same_rows_before_during_and_after_merges(spark):
    t = Levels(spark, scratch_dir(spark, "levels"), lambda d: sums(d).coalesce(1), fanout=3)
    assert t.read() is None
    want = {}
    for b in range(40):
        early = t.read()                                   # planned before this batch and its merges
        t.append(spark.createDataFrame([(b % 4, 1), (9, b)], "k int, n long").coalesce(1), b)
        before = dict(want)
        want[b % 4], want[9] = want.get(b % 4, 0) + 1, want.get(9, 0) + b
        if b in (1, 9, 27, 28):
            assert totals(t) == want and (early is None or {r["k"]: r["n"] for r in sums(early).collect()} == before)
    runs = t.runs()
    assert len(runs) <= 3 * 4 and max(r["level"] for r in runs) == 3 and totals(t) == want
    assert sum(len(glob.glob(f"{t.path(r)}/*.parquet")) for r in runs) <= 12      # 40 batches, a dozen files


def test_a_batch_written_again_replaces_its_rows_and_merged_ones_cannot(spark):
    t = Levels(spark, scratch_dir(spark, "levels"), sums, fanout=2)
    for b in range(3):
        t.append(spark.createDataFrame([(1, 10)], "k int, n long"), b)
    t.append(spark.createDataFrame([(1, 1)], "k int, n long"), 2)
    assert totals(t) == {1: 21}
    with pytest.raises(ValueError, match="merged"):
        t.append(spark.createDataFrame([(1, 1)], "k int, n long"), 0)


def test_vacuum_keeps_what_recent_readers_use(spark):
    t = Levels(spark, scratch_dir(spark, "levels"), sums, fanout=2)
    for b in range(6):
        t.append(spark.createDataFrame([(1, 1)], "k int, n long"), b)
    there = len(glob.glob(f"{t.root}/runs/run=*"))
    assert there > len(t.runs())                            # replaced runs wait for their readers
    Levels(spark, t.root, sums, grace=-60.0).vacuum()
    assert len(glob.glob(f"{t.root}/runs/run=*")) == len(t.runs()) and totals(t) == {1: 6}


def test_merged_partials_equal_unmerged_ones(spark):
    rows = [sample(event_id=f"p-{i}", user_id=str(i % 7), session_id=f"s{i % 11}", timestamp=f"2024-01-1{i % 3}T0{i % 5}:00:00Z") for i in range(90)]
    ev = transform_events(raw_df(spark, rows)).persist()
    from eventmill.streaming.ingest import daily_partials, daily_runs, hourly_runs, merge_daily_partials
    root = scratch_dir(spark, "partials")
    hourly, daily = hourly_runs(spark, root, fanout=3), daily_runs(spark, root, fanout=3)
    for b in range(10):
        part = ev.where(F.pmod(F.xxhash64("event_id"), F.lit(10)) == b)
        hourly.append(R.hourly_partials(part.withColumn("block", F.lit(b))).drop("block"), b)
        daily.append(daily_partials(part), b)
    one = R.merge_hourly_partials(R.hourly_partials(ev.withColumn("block", F.lit(0))))
    assert sorted(map(tuple, R.merge_hourly_partials(hourly.read()).collect())) == sorted(map(tuple, one.collect()))
    assert sorted(map(tuple, merge_daily_partials(daily.read()).collect())) == sorted(map(tuple, merge_daily_partials(daily_partials(ev)).collect()))
    assert len(daily.runs()) < 10


def test_linear_buckets_split_one_at_a_time(spark):
    ids = spark.range(4000).select(F.xxhash64("id").alias("h"))
    cols = [linear_bucket(F.col("h"), n).alias(f"b{n}") for n in range(1, 12)]
    rows = ids.select(*cols).collect()
    for n in range(1, 12):
        assert {r[f"b{n}"] for r in rows} == set(range(n))
    for n in range(1, 11):
        split = n - (1 << (n.bit_length() - 1))             # the bucket whose ids the new one takes over
        assert all(r[f"b{n}"] == r[f"b{n + 1}"] or (r[f"b{n}"] == split and r[f"b{n + 1}"] == n) for r in rows)


def ids_df(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_index_finds_all_stored_ids_and_opens_few_files_for_new_ones(spark):
    index = IdIndex(spark, scratch_dir(spark, "ids"), bucket_ids=1000, page_ids=512, fanout=4)
    name = lambda i: str(uuid.UUID(int=i * 7919 + 12345))
    stored = spark.range(20000).select(F.concat(F.lit("00000000-aaaa-"), F.sha1(F.col("id").cast("string"))).alias("id"))
    assert index.fresh(stored.limit(5), "id").count() == 5  # nothing stored yet
    index.add(stored, 0)
    assert index.levels.runs()[0]["buckets"] == 20          # as many as the table needs
    assert index.fresh(stored, "id").count() == 0 and index.fresh(stored, "id", 0).count() == 20000
    batch = ids_df(spark, [name(i) for i in range(200)])    # 200 ids against 20 000: a hundredth
    files = index.files_for(batch)
    size = lambda paths: sum(os.path.getsize(f) for p in paths for f in glob.glob(f"{p.replace('file:', '')}/*.parquet"))
    everything = glob.glob(f"{index.levels.root.replace('file:', '')}/runs/run=*/kind=id/bucket=*")
    assert size(files) < 0.1 * size(everything)
    assert index.fresh(batch, "id").count() == 200
    mixed = batch.unionByName(stored.limit(3))
    assert index.fresh(mixed, "id").count() == 200
    index.add(ids_df(spark, [None, "x", "x", ""]), 1)       # null ids are not stored, the empty one is
    assert index.levels.runs()[1]["n"] == 2 and sorted(r[0] or "-" for r in index.fresh(ids_df(spark, [None, "x", "", "y"]), "id").collect()) == ["-", "y"]
    for b in range(2, 9):
        index.add(ids_df(spark, [f"{b}-{i}" for i in range(30)]), b)
    assert len(index.levels.runs()) <= 5
    assert index.fresh(ids_df(spark, [f"{b}-{i}" for b in range(2, 9) for i in range(40)]), "id").count() == 70
    assert index.fresh(stored, "id").count() == 0


def test_filter_passes_few_new_ids(spark):
    index = IdIndex(spark, scratch_dir(spark, "fpp"))
    index.add(spark.range(40000).select(F.col("id").cast("string").alias("id")), 0)
    new = spark.range(50000, 90000).select(F.col("id").cast("string").alias("id"))
    assert index.maybe_stored(new, index.levels.runs()).count() < 40000 * 0.003


def test_documents_written_without_batch_numbers_stay_unique(spark):
    path = scratch_dir(spark, "nobatch")
    for _ in range(2):
        write_document(spark, transform_events(raw_df(spark, [sample(event_id="n-1"), sample(event_id="n-2")])), path)
    assert sorted(r[0] for r in spark.read.parquet(path).select("_id").collect()) == ["n-1", "n-2"]


def test_a_repeat_after_the_window_is_stored_nowhere_twice(spark):
    from eventmill.streaming.ingest import daily_runs, hourly_runs, live_root, read_batch_log
    base = scratch_dir(spark, "window")
    # no state window at all: the arrival watermark has passed each batch when the next one comes
    batches = [[sample(event_id="a", timestamp="2024-01-10T08:00:00Z"), sample(event_id="b", timestamp="2024-01-10T08:30:00Z")],
               [sample(event_id="c", timestamp="2024-01-10T09:00:00Z")],
               [sample(event_id="d", timestamp="2024-01-10T09:00:00Z")],
               [sample(event_id="b", timestamp="2024-01-10T08:30:00Z")],     # nothing but a repeat
               [sample(event_id="a", timestamp="2024-01-10T08:00:00Z"), sample(event_id="c", timestamp="2024-01-11T09:00:00Z"), sample(event_id="e", timestamp="2024-01-10T08:00:00Z")]]
    drain(spark, land(base, batches), f"{base}/out", f"{base}/ckpt", window="0 seconds")
    live = live_root(spark, f"{base}/out")
    assert sorted(r[0] for r in read_flat(spark, f"{live}/flat").select("event_id").collect()) == list("abcde")
    assert sorted(r[0] for r in spark.read.parquet(f"{live}/documents").select("_id").collect()) == list("abcde")
    assert R.merge_hourly_partials(hourly_runs(spark, live).read()).agg(F.sum("event_count")).first()[0] == 5
    assert daily_runs(spark, live).read().agg(F.sum("event_count")).first()[0] == 5
    log = read_batch_log(spark, live).where("sink = 'documents'").agg(F.sum("rows")).first()[0]
    assert log == 5                                          # rows the sink took, not rows offered


def test_retention_drops_whole_dates_and_rewrites_nothing(spark):
    path = scratch_dir(spark, "retention")
    for b, day in enumerate(("2024-01-10", "2024-01-11", "2024-01-12")):
        write_flat(transform_events(raw_df(spark, [sample(event_id=f"{day}-{i}", timestamp=f"{day}T10:00:00Z") for i in range(3)])), path, batch_id=b)
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/event_date=*/batch_id=*/*.parquet") if "2024-01-10" not in f}
    early = read_flat(spark, path)
    assert drop_dates(spark, path, "2024-01-11") == []       # the bound has only just moved
    assert read_flat(spark, path).count() == 6 and early.count() == 9
    assert drop_dates(spark, path, "2024-01-11", grace_seconds=-60.0) == ["2024-01-10"]
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/event_date=*/batch_id=*/*.parquet")} == kept
    assert drop_dates(spark, path, "2024-01-01", grace_seconds=-60.0) == [] and read_flat(spark, path).count() == 6


def test_progress_log_keeps_every_batch_across_a_restart(spark):
    from eventmill.streaming.progress import ProgressLog, progress_table
    base = scratch_dir(spark, "progress")
    log = ProgressLog(spark, f"{base}/progress", roll=5)
    spark.streams.addListener(log)
    try:
        for part in (range(7), range(7, 12)):
            for i in part:
                os.makedirs(f"{base}/in/c{i}".replace("file:", ""))
                with open(f"{base}/in/c{i}/part-0".replace("file:", ""), "w") as f:
                    f.write("x\ny\n")
            q = (spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{base}/in/c*/part-*").writeStream.format("noop")
                 .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
            q.awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(log)
    rows = progress_table(spark, f"{base}/progress").collect()
    assert sorted(r["batch_id"] for r in rows) == list(range(12)) and {r["input_rows"] for r in rows} == {2}
    assert len(glob.glob(f"{base}/progress/*.json".replace("file:", ""))) < 12 and len({r["run"] for r in rows}) == 2
    assert progress_table(spark, f"{base}/none").count() == 0


def test_lag_of_a_half_drained_folder_is_the_files_left(spark):
    from eventmill.streaming.ingest import StreamSource, run_stream
    from eventmill.streaming.progress import consumer_lag, partition_counts, source_offsets, with_messages
    base = scratch_dir(spark, "lag")
    glob_ = land(base, [[sample(event_id=f"{c}")] for c in "abcde"])
    assert {(r["partition"], r["lag"]) for r in consumer_lag(source_offsets(spark, glob_, f"{base}/ckpt/events")).collect()} == {(f"c{i}", 1) for i in range(5)}
    seen = []

    def stop(d, batch):
        seen.append(batch)
        if batch == 2:
            raise RuntimeError("stop here")
    q = run_stream(spark, StreamSource(path=glob_), f"{base}/out", f"{base}/ckpt", state_partitions=2, on_batch=stop)[0]
    with pytest.raises(Exception, match="stop here"):
        q.awaitTermination()
    offsets = source_offsets(spark, glob_, f"{base}/ckpt/events")
    lag = {r["partition"]: (r["end_offset"], r["committed_offset"], r["lag"]) for r in consumer_lag(offsets).collect()}
    assert lag == {"c0": (1, 1, 0), "c1": (1, 1, 0), "c2": (1, 0, 1), "c3": (1, 0, 1), "c4": (1, 0, 1)}
    counted = with_messages(spark, offsets, glob_)
    assert {(r["topic"], r["partition"], r["messages"]) for r in partition_counts(counted).collect()} == {("in", "c0", 1), ("in", "c1", 1)}
    assert sorted(map(tuple, consumer_lag(counted).collect())) == sorted(map(tuple, consumer_lag(offsets).collect()))
    drain(spark, glob_, f"{base}/out", f"{base}/ckpt")
    assert all(r["lag"] == 0 for r in consumer_lag(source_offsets(spark, glob_, f"{base}/ckpt/events")).collect())


def test_filters_and_stored_ids_are_not_broadcast(spark):
    """They grow with the table, and every batch would send them through the driver."""
    index = IdIndex(spark, scratch_dir(spark, "sent"))
    index.add(ids_df(spark, ["a", "b"]), 0)
    batch = ids_df(spark, ["b", "c"])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    fresh = index.fresh(batch, "id")
    assert "Broadcast" not in plan(index.maybe_stored(batch, index.levels.runs())) and "Broadcast" not in plan(fresh)
    assert [r[0] for r in fresh.collect()] == ["c"]


def test_new_ids_that_a_filter_lets_pass_cost_no_join(spark):
    """A large batch has such ids in every bucket; they are looked up, and its rows are joined only if an id is stored."""
    index = IdIndex(spark, scratch_dir(spark, "chance"), bucket_ids=10_000, page_ids=1_000_000)
    stored = spark.range(20000).select(F.col("id").cast("string").alias("id"))
    index.add(stored, 0, unique=True, at_most=20000)         # pages so full that most new ids pass
    new = spark.range(50000, 50300).select(F.col("id").cast("string").alias("id"))
    assert index.maybe_stored(new, index.levels.runs()).select("bucket").distinct().count() == 2
    assert index.files_for(new) == [] and index.fresh(new, "id", unique=True) is new
    mixed = new.unionByName(stored.limit(2)).unionByName(ids_df(spark, [None]))
    assert index.fresh(mixed, "id").count() == 301
