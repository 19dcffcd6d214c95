"""Registered stream and sink keys.

Each stream key lands the raw events (derived from the driver table) as JSON message
files in the shared scratch folder, runs the streaming ingest to completion with an
available-now trigger, and reads back what the sinks wrote.  One run per (session,
tables) is shared by all stream keys; those that drain the landed messages themselves only land them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventmill.operators import rollups as R
from eventmill.operators.transform import tag, to_flat, transform_events
from eventmill.operators.validate import decode_json
from eventmill.plans.registry import register
from eventmill.plans.sqlgen import accepted_sql, transform_sql
from eventmill.session import scratch_dir
from eventmill.sinks.files import dual_sink, read_documents, read_flat, write_document, write_flat
from eventmill.sources.raw import raw_events, raw_events_sql
from eventmill.streaming.ingest import (StreamSource, daily_runs, hourly_runs, live_root, merge_daily_partials, read_batch_log, run_name,
                                        run_stream,
                                        session_stream, set_live, state_partitions_for_start,
                                        tagged_stream, write_message_files)
from eventmill.streaming.progress import consumer_lag, partition_counts, source_offsets, with_messages

RAW = raw_events_sql()
TR = transform_sql(RAW)
ACC = accepted_sql(RAW)
WATERMARK = "1 day"
N_FILES = 4
STATE_PARTITIONS = 8

_LANDED: dict[tuple[str, str], str] = {}
_RUNS: dict[tuple[str, str], str] = {}


def _landed(spark, sf) -> str:
    """Folder whose `input` holds the messages."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDED:
        base = scratch_dir(spark, "stream")
        write_message_files(raw_events(spark, sf), f"{base}/input", N_FILES)
        _LANDED[key] = base
    return _LANDED[key]


def _stream_root(spark, sf) -> str:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        base = _landed(spark, sf)
        _drain(spark, f"{base}/input/c*/part-*", f"{base}/out", f"{base}/checkpoint", 1)
        _RUNS[key] = base
    return _RUNS[key]


def _drain(spark, glob, root, checkpoint, max_files) -> None:
    # at least a task for each core
    tasks = max(STATE_PARTITIONS, spark.sparkContext.defaultParallelism)
    src = StreamSource(kind="files", path=glob, max_files=max_files, min_partitions=tasks)
    for q in run_stream(spark, src, root, checkpoint, state_partitions=tasks, window=WATERMARK):
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))


def _live(spark, sf) -> str:
    return live_root(spark, f"{_stream_root(spark, sf)}/out")


FLAT_SQL = f"""SELECT event_id, user_id, event_type, event_date,
  date_trunc('millisecond', "timestamp") AS "timestamp", hour_of_day, day_of_week, CAST(is_weekend AS INTEGER) AS is_weekend,
  event_category, session_id, ip_address, user_agent, coalesce(referrer, '') AS referrer, page_url,
  properties_text AS properties FROM {ACC} a"""

FLAT_OUT = ["event_id", "user_id", "event_type", "event_date", "timestamp", "hour_of_day", "day_of_week",
            "is_weekend", "event_category", "session_id", "ip_address", "user_agent", "referrer", "page_url",
            "properties"]


@register("stream_ingest", FLAT_SQL)
def q_stream_ingest(spark, sf):
    return read_flat(spark, f"{_live(spark, sf)}/flat").select(*FLAT_OUT)


@register("stream_dedup", f'SELECT event_id, count(*) AS stored, sum(copies) AS delivered FROM (SELECT event_id, (SELECT count(*) FROM {TR} t WHERE t.reject_reason IS NULL AND t.event_id = a.event_id) AS copies FROM {ACC} a) x GROUP BY 1')
def q_stream_dedup(spark, sf):
    """L4: each accepted id is stored once, however often it was delivered (repeats within and across batches)."""
    base = _stream_root(spark, sf)
    return stored_and_delivered(read_flat(spark, f"{_live(spark, sf)}/flat"), spark.read.text(f"{base}/input/c*/part-*"))


def stored_and_delivered(flat, messages):
    """Per stored id: its rows in the flat table and its accepted messages.

    One aggregate over both sides.  A filter or a join's null test on the decoded columns would be pushed below the
    decoding and repeat it, so rejected messages are counted as none.
    """
    told = tag(decode_json(messages)).select("event_id", F.lit(0).alias("stored"),
                                             F.when(F.col("reject_reason").isNull(), 1).otherwise(0).alias("delivered"))
    both = flat.select("event_id", F.lit(1).alias("stored"), F.lit(0).alias("delivered")).unionByName(told)
    return (both.groupBy("event_id").agg(F.sum("stored").alias("stored"), F.sum("delivered").alias("delivered"))
            .where("stored > 0 and delivered > 0"))


@register("stream_dead_letter", f"""SELECT r.event_id, r.user_id, r.event_type, r."timestamp", 
  -- a JSON null is there but of the wrong type
  CASE WHEN r.event_type IS NULL AND t.reject_reason = 'missing:event_type' THEN 'type:event_type' ELSE t.reject_reason END AS reject_reason
  FROM {TR} t JOIN {RAW} r ON r.src_id = t.src_id AND r.delivery = t.delivery WHERE t.reject_reason IS NOT NULL""")
def q_stream_dead_letter(spark, sf):
    """Every rejected message, told again from its stored raw text."""
    dead = spark.read.parquet(f"{_live(spark, sf)}/dead_letter")
    again = tag(decode_json(dead.select(F.col("raw_message").alias("value"), F.col("reject_reason").alias("stored_reason"))))
    return again.select("event_id", "user_id", "event_type", "timestamp", F.col("stored_reason").alias("reject_reason"))


@register("stream_late", f"""SELECT event_date, count(*) AS event_count FROM {ACC} a GROUP BY 1""")
def q_stream_late(spark, sf):
    """Newest events first, so that nearly all rows arrive days late; every one is stored under its date."""
    base = scratch_dir(spark, "late")
    raw = raw_events(spark, sf)
    backwards = raw.withColumn("src_id", -F.col("src_id"))
    glob = write_message_files(backwards, f"{base}/input", N_FILES)
    _drain(spark, glob, f"{base}/out", f"{base}/checkpoint", 1)
    flat = read_flat(spark, f"{live_root(spark, f'{base}/out')}/flat")
    return flat.groupBy("event_date").agg(F.count(F.lit(1)).alias("event_count"))


@register("stream_batch_log", f"""WITH n AS (SELECT count(*) AS kept FROM {ACC} a), d AS (SELECT count(*) AS dead FROM {TR} t WHERE reject_reason IS NOT NULL)
SELECT sink, CAST(0 AS BIGINT) AS failed, CASE WHEN sink = 'dead_letter' THEN dead ELSE kept END AS rows FROM n, d,
  (VALUES ('flat'), ('documents'), ('hourly_partials'), ('daily_partials'), ('dead_letter')) s(sink)""")
def q_stream_batch_log(spark, sf):
    """G17 + B3: totals per sink of the real stream's batch log."""
    log = read_batch_log(spark, _live(spark, sf))
    return log.groupBy("sink").agg(F.count_if(~F.col("ok")).alias("failed"), F.sum("rows").alias("rows"))


#: Message files in arrival order: the chunk of a row by `write_message_files`.
CHUNK_SQL = f"""(SELECT 'c' || lpad(CAST(CAST(floor((src_id - lo) / greatest(1, (hi - lo + {N_FILES}) // {N_FILES})) AS BIGINT)
  + CASE WHEN delivery <> 0 AND (src_id // 50) % 2 = 1 THEN 1 ELSE 0 END AS VARCHAR), 4, '0') AS chunk
  FROM {RAW} r, (SELECT min(src_id) AS lo, max(src_id) AS hi FROM {RAW} b) x)"""


def _offsets(spark, glob, checkpoint):
    return with_messages(spark, source_offsets(spark, glob, checkpoint), glob)


@register("partition_counts", f"SELECT 'input' AS topic, chunk AS partition, count(*) AS messages FROM {CHUNK_SQL} c GROUP BY 2")
def q_partition_counts(spark, sf):
    """Messages that the drained stream consumed, by source folder, from its own log of files."""
    base = _stream_root(spark, sf)
    return partition_counts(_offsets(spark, f"{base}/input/c*/part-*", f"{base}/checkpoint/events"))


@register("consumer_lag", f"""SELECT 'input' AS topic, chunk AS partition, 'eventmill' AS consumer_group, count(*) AS end_offset,
  count(*) FILTER (WHERE chunk < 'c0002') AS committed_offset, count(*) FILTER (WHERE chunk >= 'c0002') AS lag FROM {CHUNK_SQL} c GROUP BY 2""")
def q_consumer_lag(spark, sf):
    """Lag of a stream that has drained the first two folders of its source when the others are there."""
    inputs, base = f"{_landed(spark, sf)}/input", scratch_dir(spark, "lag")
    _drain(spark, f"{inputs}/c000[01]/part-*", f"{base}/out", f"{base}/checkpoint", 100)
    return consumer_lag(_offsets(spark, f"{inputs}/c*/part-*", f"{base}/checkpoint/events"))


@register("stream_hourly", f"""SELECT event_date, date_trunc('hour', "timestamp") AS event_hour, event_type, event_category,
  count(*) AS event_count, count(DISTINCT user_id) AS approx_users FROM {ACC} a GROUP BY 1, 2, 3, 4""")
def q_stream_hourly(spark, sf):
    return R.merge_hourly_partials(hourly_runs(spark, _live(spark, sf)).read())


@register("stream_daily_users", f"""SELECT event_date, user_id, min("timestamp") AS first_event_time,
  max("timestamp") AS last_event_time, count(*) AS event_count, count(DISTINCT event_type) AS approx_event_types,
  count(DISTINCT session_id) AS approx_sessions FROM {ACC} a GROUP BY 1, 2""")
def q_stream_daily_users(spark, sf):
    return merge_daily_partials(daily_runs(spark, _live(spark, sf)).read())


STREAM_SESSIONS_SQL = f"""WITH a AS (SELECT user_id, "timestamp", event_id FROM {ACC} a)
SELECT user_id, min("timestamp") AS session_start, max("timestamp") + INTERVAL 30 MINUTE AS session_end,
  count(*) AS event_count FROM (
  SELECT user_id, "timestamp", sum(new) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no FROM (
    SELECT user_id, "timestamp", event_id, CASE WHEN lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) IS NULL
      OR "timestamp" >= lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", event_id) + INTERVAL 30 MINUTE
      THEN 1 ELSE 0 END AS new FROM a) x) y GROUP BY user_id, session_no"""


@register("stream_sessions", STREAM_SESSIONS_SQL)
def q_stream_sessions(spark, sf):
    """Every session; a heartbeat after the last event closes the open ones."""
    out = scratch_dir(spark, "sessions")
    first = raw_events(spark, sf).where("delivery = 0")
    glob = write_message_files(first, f"{out}_in", N_FILES, heartbeat=True)
    src = StreamSource(kind="files", path=glob, max_files=1, min_partitions=STATE_PARTITIONS)
    with state_partitions_for_start(spark, STATE_PARTITIONS):
        q = (session_stream(tagged_stream(spark, src)).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", f"{out}_ckpt").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out).where("user_id >= 0")


@register("sink_flat", FLAT_SQL)
def q_sink_flat(spark, sf):
    path = scratch_dir(spark, "flat")
    write_flat(transform_events(raw_events(spark, sf)), path)
    return read_flat(spark, path).select(*FLAT_OUT)


DOC_OUT = ["_id", "event_id", "user_id", "event_type", "event_date", "hour_of_day", "day_of_week", "is_weekend",
           "event_category", "session_id", "ip_address", "user_agent", "referrer", "page_url"]


@register("sink_document", f"""SELECT event_id AS _id, event_id, user_id, event_type, CAST(event_date AS VARCHAR) AS event_date,
  hour_of_day, day_of_week, is_weekend, event_category, session_id, ip_address, user_agent, referrer, page_url FROM {ACC} a""")
def q_sink_document(spark, sf):
    path = scratch_dir(spark, "documents")
    ev = transform_events(raw_events(spark, sf))
    write_document(spark, ev, path, batch_id=0)
    write_document(spark, ev, path, batch_id=1)     # a second delivery of the same batch adds nothing
    return read_documents(spark, path).select(*DOC_OUT)


@register("dual_sink", f"""SELECT event_date, count(*) AS flat_rows, count(*) AS documents FROM {ACC} a GROUP BY 1""")
def q_dual_sink(spark, sf):
    from eventmill.operators.transform import transform
    base = scratch_dir(spark, "dual")
    write = dual_sink(spark, f"{base}/flat", f"{base}/documents", f"{base}/dead_letter",
                      order="_seq", reject_ratio_limit=0.5)
    tagged = transform(raw_events(spark, sf))
    tagged = tagged.withColumn("_seq", F.col("delivery") * F.lit(1 << 40) + F.col("src_id"))
    write(tagged, 0)
    flat = read_flat(spark, f"{base}/flat").groupBy("event_date").agg(F.count(F.lit(1)).alias("flat_rows"))
    docs = (read_documents(spark, f"{base}/documents")
            .groupBy(F.col("event_date").cast("date").alias("event_date")).agg(F.count(F.lit(1)).alias("documents")))
    return flat.join(docs, "event_date", "full")



@register("replay", FLAT_SQL)
def q_replay(spark, sf):
    """A3 + B10: the landed input once in one-file batches, then again from the start with a fresh checkpoint and
    other batch cuts into the same root: the replay fills a run of its own, and readers then see that one."""
    glob = f"{_landed(spark, sf)}/input/c*/part-*"
    root = scratch_dir(spark, "replay")
    _drain(spark, glob, f"{root}/out", f"{root}/first", 1)
    _drain(spark, glob, f"{root}/out", f"{root}/second", 3)
    set_live(spark, f"{root}/out", run_name(f"{root}/second"))
    return read_flat(spark, f"{live_root(spark, f'{root}/out')}/flat").select(*FLAT_OUT)


@register("snapshot", FLAT_SQL)
def q_snapshot(spark, sf):
    """Export the flat rows to a timestamped folder and read the snapshot back."""
    from eventmill.sinks.files import snapshot
    flat = to_flat(transform_events(raw_events(spark, sf)))
    path = snapshot(flat, scratch_dir(spark, "snapshots"), "20240131T000000")
    return spark.read.parquet(path).select(*FLAT_OUT)
