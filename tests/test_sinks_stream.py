"""Sinks and streaming: empty batch, two-row batch, replay safety, document anti join,
stream = batch, dead letters (B1-B3, B8, B10, A3, L1-L4)."""


from core_helpers import SF_SMALL, raw_df, sample
from eventmill.session import scratch_dir
from eventmill.sinks.files import dual_sink, read_flat, write_document, write_flat
from eventmill.operators.transform import transform, transform_events


def test_empty_batch_writes_nothing(spark):
    path = scratch_dir(spark, "empty")
    ev = transform_events(raw_df(spark, [sample()])).where("false")
    write_flat(ev, path, batch_id=0)
    import glob
    assert glob.glob(f"{path}/**/*.parquet", recursive=True) == []


def test_two_rows_one_batch(spark):
    path = scratch_dir(spark, "two")
    ev = transform_events(raw_df(spark, [sample(event_id="test-1"), sample(event_id="test-2")]))
    write_flat(ev, path, batch_id=0)
    df = read_flat(spark, path)
    assert df.count() == 2 and df.select("batch_id").distinct().count() == 1


def test_replayed_batch_overwrites(spark):
    path = scratch_dir(spark, "replay")
    ev = transform_events(raw_df(spark, [sample(event_id="r-1"), sample(event_id="r-2")]))
    write_flat(ev, path, batch_id=3)
    write_flat(ev, path, batch_id=3)
    assert read_flat(spark, path).count() == 2


def test_documents_skip_stored_ids(spark):
    path = scratch_dir(spark, "docs")
    ev1 = transform_events(raw_df(spark, [sample(event_id="d-1"), sample(event_id="d-2")]))
    ev2 = transform_events(raw_df(spark, [sample(event_id="d-2"), sample(event_id="d-3")]))
    write_document(spark, ev1, path, batch_id=0)
    write_document(spark, ev2, path, batch_id=1)
    ids = sorted(r["_id"] for r in spark.read.parquet(path).select("_id").collect())
    assert ids == ["d-1", "d-2", "d-3"]


def test_dual_sink_and_dead_letter(spark):
    base = scratch_dir(spark, "dual")
    rows = [sample(event_id="a"), sample(event_id="a"), sample(event_id="b", timestamp="garbage")]
    write = dual_sink(spark, f"{base}/flat", f"{base}/doc", f"{base}/dead")
    write(transform(raw_df(spark, rows)), 0)
    assert read_flat(spark, f"{base}/flat").count() == 1
    assert spark.read.parquet(f"{base}/doc").count() == 1
    dead = spark.read.parquet(f"{base}/dead").collect()
    assert [(r["event_id"], r["reject_reason"]) for r in dead] == [("b", "format:timestamp")]


def test_reject_ratio_gate_raises(spark):
    import pytest
    base = scratch_dir(spark, "gate")
    rows = [sample(event_id="a", timestamp="garbage"), sample(event_id="b", timestamp="garbage"), sample(event_id="c")]
    write = dual_sink(spark, f"{base}/flat", f"{base}/doc", reject_ratio_limit=0.5)
    with pytest.raises(RuntimeError):
        write(transform(raw_df(spark, rows)), 0)


def drain(spark, glob, root, ckpt, max_files=1, **kw):
    from eventmill.streaming.ingest import StreamSource, run_stream
    src = StreamSource(kind="files", path=glob, max_files=max_files, min_partitions=4)
    qs = run_stream(spark, src, root, ckpt, state_partitions=4, **kw)
    for q in qs:
        q.awaitTermination()
    return qs


def test_stream_equals_batch_and_replay_adds_nothing(spark):
    from eventmill.sources.raw import raw_events
    from eventmill.streaming.ingest import live_root, progress_log, read_batch_log, run_name, set_live, write_message_files
    base = scratch_dir(spark, "stream")
    raw = raw_events(spark, SF_SMALL)
    glob = write_message_files(raw, f"{base}/in", 3)
    taken, refused = [], []
    qs = drain(spark, glob, f"{base}/out", f"{base}/ckpt", on_batch=lambda d, i: taken.append(d.count()), on_reject=lambda d, i: refused.append(d.count()))
    # every message is counted once per query in the observed per-batch metrics
    prog = progress_log(spark, qs).where("consumed is not null")
    totals = [r[1] for r in prog.groupBy("query").sum("consumed").collect()]
    assert totals and all(t == raw.count() for t in totals)
    assert prog.agg({"dropped_by_watermark": "sum"}).first()[0] == 0
    batch = transform_events(raw).select("event_id")
    live = live_root(spark, f"{base}/out")
    streamed = read_flat(spark, f"{live}/flat")
    assert streamed.count() == batch.count() == sum(taken)
    assert streamed.select("event_id").exceptAll(batch).count() == 0
    dead = spark.read.parquet(f"{live}/dead_letter")
    tagged = transform(raw)
    assert dead.count() == tagged.where("reject_reason is not null").count() == sum(refused)
    # nothing is lost: consumed = flat + repeats + dead letters
    accepted = tagged.where("reject_reason is null")
    repeats = accepted.count() - accepted.select("event_id").distinct().count()
    assert raw.count() == streamed.count() + repeats + dead.count()
    log = read_batch_log(spark, live)
    assert {r["sink"]: r["n"] for r in log.groupBy("sink").sum("rows").withColumnRenamed("sum(rows)", "n").collect()}["flat"] == batch.count()
    # the same checkpoint finds nothing new, tables unchanged
    drain(spark, glob, f"{base}/out", f"{base}/ckpt")
    assert read_flat(spark, f"{live}/flat").count() == batch.count()
    # a replay from the start with other batch cuts fills a run of its own; readers then see that one
    drain(spark, glob, f"{base}/out", f"{base}/ckpt2", max_files=2)
    assert live_root(spark, f"{base}/out") == live
    set_live(spark, f"{base}/out", run_name(f"{base}/ckpt2"))
    again = live_root(spark, f"{base}/out")
    assert again != live and read_flat(spark, f"{again}/flat").count() == batch.count()
    assert spark.read.parquet(f"{again}/documents").select("_id").distinct().count() == batch.count()


def test_compaction_keeps_rows_in_fewer_files(spark):
    import glob

    from eventmill.sinks.files import compact_flat
    path, out = scratch_dir(spark, "many"), scratch_dir(spark, "few")
    for b in range(4):
        write_flat(transform_events(raw_df(spark, [sample(event_id=f"c-{b}-{i}") for i in range(3)])), path, batch_id=b)
    compact_flat(spark, path, out)
    assert sorted(r[0] for r in read_flat(spark, out).select("event_id").collect()) == sorted(r[0] for r in read_flat(spark, path).select("event_id").collect())
    assert len(glob.glob(f"{out}/event_date=*/*.parquet")) < len(glob.glob(f"{path}/event_date=*/batch_id=*/*.parquet"))
    plan = read_flat(spark, path).where("event_date = date'2024-01-15'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_one_id_on_two_dates_is_stored_once(spark):
    path = scratch_dir(spark, "docdates")
    for b, day in enumerate(("2024-01-15", "2024-01-16")):
        write_document(spark, transform_events(raw_df(spark, [sample(timestamp=f"{day}T10:00:00Z"), sample(event_id=f"only-{b}", timestamp=f"{day}T11:00:00Z")])), path, batch_id=b)
    assert sorted(r[0] for r in spark.read.parquet(path).select("_id").collect()) == ["ev-7f", "only-0", "only-1"]


def test_sink_outcomes_are_recorded(spark):
    import pytest

    from eventmill.sinks.files import WriteError, run_writes

    def fails():
        raise ValueError("no space")
    got = run_writes(spark, {"flat": lambda: None, "documents": fails}, require="any")
    assert [(o.sink, o.ok) for o in got] == [("flat", True), ("documents", False)] and "no space" in got[1].error
    with pytest.raises(WriteError):
        run_writes(spark, {"flat": lambda: None, "documents": fails})
    with pytest.raises(WriteError):
        run_writes(spark, {"flat": fails, "documents": fails}, require="any")


def test_topic_headers_wrapping_and_failures(spark):
    from pyspark.sql import functions as F

    from eventmill.sinks.topic import partition_batch_counts, to_topic_rows, wrapped
    df = spark.createDataFrame([("a", 1), ("b", None)], "event_id string, user_id long")
    rows = to_topic_rows(df, "t", partition=lambda d: F.pmod(F.col("user_id"), F.lit(2)).cast("int"), headers={"source": F.lit("x")})
    assert bytes(rows.first()["headers"][0]["value"]) == b"x"
    assert {r["partition"]: (r["sent"], r["failed"]) for r in partition_batch_counts(rows).collect()} == {1: (1, 0), None: (0, 1)}
    default = to_topic_rows(df, "t").orderBy("key").collect()
    assert [r["partition"] for r in default] == [r["partition"] for r in to_topic_rows(df, "t").orderBy("key").collect()]
    texts = spark.createDataFrame([('{"a":1}',), ("[1,2]",), ("plain \"q\"",), (None,)], "v string").select(wrapped(F.col("v")).alias("w")).collect()
    assert [r["w"] for r in texts] == ['{"a":1}', '{"data":[1,2]}', '{"data":"plain \\"q\\""}', '{"data":null}']


def test_snapshot_refuses_overwrite(spark):
    import pytest
    from eventmill.sinks.files import snapshot
    root = scratch_dir(spark, "snap")
    df = spark.range(3)
    p = snapshot(df, root, "20240101T000000")
    assert spark.read.parquet(p).count() == 3
    with pytest.raises(Exception):
        snapshot(df, root, "20240101T000000")


def land(base, batches):
    """Message files in arrival order, one per batch."""
    import json
    import os

    from eventmill.session import local_makedirs
    for i, batch in enumerate(batches):
        d = f"{base}/in/c{i}"
        local_makedirs(d)
        p = f"{d.replace('file:', '')}/part-0.json"
        with open(p, "w") as f:
            f.write("\n".join(b if isinstance(b, str) else json.dumps(b) for b in batch) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    return f"{base}/in/c*/part-*"


def test_late_rows_are_kept_and_rejects_can_be_read_again(spark):
    from eventmill.streaming.ingest import live_root
    base = scratch_dir(spark, "late")
    glob = land(base, [
        [sample(event_id="bad-1", user_id="not_a_number", timestamp="2099-01-01T00:00:00Z"), sample(event_id="ok-1", timestamp="2024-01-10T08:00:00Z")],
        ["{broken json text 42", sample(event_id="ok-2", timestamp="2024-01-10T08:30:00Z")],
        [sample(event_id="ok-3", timestamp="2024-01-05T08:45:00Z"), sample(event_id="ok-1", timestamp="2024-01-10T08:00:00Z")],  # five days late; a repeat
    ])
    drain(spark, glob, f"{base}/out", f"{base}/ckpt", window="1 hour")
    live = live_root(spark, f"{base}/out")
    assert sorted(r[0] for r in read_flat(spark, f"{live}/flat").select("event_id").collect()) == ["ok-1", "ok-2", "ok-3"]
    dead = {r["reject_reason"]: r for r in spark.read.parquet(f"{live}/dead_letter").collect()}
    assert set(dead) == {"decode:json", "type:user_id"}
    assert dead["decode:json"]["raw_message"] == "{broken json text 42"
    assert dead["type:user_id"]["user_id"] == "not_a_number" and "not_a_number" in dead["type:user_id"]["raw_message"]
    assert spark.read.parquet(f"{live}/dead_letter").columns.count("batch_id") == 1


def test_stream_gate_fails_the_batch_and_logs_it(spark):
    from eventmill.streaming.ingest import read_batch_log, run_name
    base = scratch_dir(spark, "streamgate")
    glob = land(base, [[sample(event_id="x", timestamp="garbage"), sample(event_id="y", timestamp="garbage"), sample(event_id="z")]])
    import pytest
    with pytest.raises(Exception):
        drain(spark, glob, f"{base}/out", f"{base}/ckpt", reject_ratio_limit=0.5)
    log = read_batch_log(spark, f"{base}/out/run={run_name(f'{base}/ckpt')}").collect()
    assert [(r["sink"], r["ok"]) for r in log] == [("batch", False)] and "reject ratio" in log[0]["error"]


def test_landed_chunk_is_one_file_however_many_tasks_read_the_table(spark, monkeypatch):
    import glob
    from pyspark.sql import functions as F
    from eventmill.schemas import RAW_FIELDS
    from eventmill.streaming import ingest
    fields = {"user_id": "1", "event_type": "click", "timestamp": "2024-01-15T10:30:00.000Z"}
    raw = spark.range(400).repartition(7).select(
        *[(F.col("id").cast("string") if f == "event_id" else F.lit(fields.get(f)).cast("string")).alias(f) for f in RAW_FIELDS],
        F.col("id").alias("src_id"), F.lit(0).alias("delivery"))
    ids = lambda path: spark.read.json(path).select(F.min(F.col("event_id").cast("int")), F.max(F.col("event_id").cast("int")), F.count("*")).first()
    base = scratch_dir(spark, "landed")
    ingest.write_message_files(raw, base, 2)
    assert [len(glob.glob(f"{base}/c{i:04d}/part-*")) for i in range(3)] == [1, 1, 1]
    assert tuple(ids(f"{base}/c0000")) == (0, 199, 200) and tuple(ids(f"{base}/c0001")) == (200, 399, 200)
    monkeypatch.setattr(ingest, "FILE_ROWS", 70)             # 200 messages fill three files, id ranges again
    base = scratch_dir(spark, "landed")
    ingest.write_message_files(raw, base, 2)
    found = sorted(tuple(ids(p)) for p in glob.glob(f"{base}/c0001/part-*"))
    assert len(found) == 3 and sum(n for _, _, n in found) == 200 and all(a[1] < b[0] for a, b in zip(found, found[1:]))


def test_keys_that_drain_the_messages_themselves_only_land_them(spark, tmp_path):
    from eventmill.plans import stream_queries as Q
    spark.read.parquet(f"{SF_SMALL}/events.parquet").limit(200).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    assert Q.q_consumer_lag(spark, str(tmp_path)).count() >= 4
    assert (spark.sparkContext.applicationId, str(tmp_path)) not in Q._RUNS


def test_stored_ids_are_counted_with_one_decoding_of_the_messages(spark):
    import json

    from eventmill.plans.stream_queries import stored_and_delivered
    texts = [json.dumps(sample(event_id=i)) for i in ("a", "a", "b", "c")]
    texts += [json.dumps(sample(event_id="a", timestamp="garbage")), json.dumps(sample(event_id="d", user_id="x")), "{broken", "{}"]
    messages = spark.createDataFrame([(x,) for x in texts], "value string")
    flat = spark.createDataFrame([("a",), ("b",), ("d",), ("e",)], "event_id string")
    got = stored_and_delivered(flat, messages)
    assert sorted(map(tuple, got.collect())) == [("a", 1, 2), ("b", 1, 1)]
    assert got.dtypes == [("event_id", "string"), ("stored", "bigint"), ("delivered", "bigint")]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # filters pushed below the decoding had repeated it
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1


def test_only_rejected_messages_carry_their_text_through_the_stream(spark):
    from eventmill.streaming.ingest import StreamSource, tagged_stream
    base = scratch_dir(spark, "texts")
    glob = land(base, [[sample(event_id="ok-1"), sample(event_id="no-1", timestamp="garbage"), "{broken"]])
    seen = []
    q = (tagged_stream(spark, StreamSource(path=glob)).writeStream.foreachBatch(lambda d, i: seen.extend(d.select("reject_reason", "raw_message", "_key").collect()))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["reject_reason"]: r for r in seen}
    assert got[None]["raw_message"] is None and got[None]["_key"] == "ok-1"
    assert got["decode:json"]["raw_message"] == "{broken" and "garbage" in got["format:timestamp"]["raw_message"]
    assert len({r["_key"] for r in seen}) == 3
