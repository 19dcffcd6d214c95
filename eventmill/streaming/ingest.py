"""Structured Streaming ingest.

Source (Kafka topic or a folder of JSON message files) -> decode -> rules -> one shuffle
by event id -> one streaming query with two branches over that shuffle:

* accepted rows: `dropDuplicatesWithinWatermark` by id, with the ARRIVAL time as the
  watermark column.  Arrival times only grow, so no accepted row is ever late: an event
  days old is written to its date like any other, and its bucket is merged, not closed.
  The state holds the ids that arrived within the window; a repeat that comes later is
  found in the index of all stored ids (`sinks.idindex`), before any sink sees it;
* rejected rows: passed through, keyed by a hash of the message, so that the many without
  an id do not meet in one task.

`foreachBatch` shapes and enriches the kept rows and writes the flat table, the document
table, rollup partials (levelled tables, `sinks.levels`: a bounded number of runs however
many batches there were) and the dead letters with the raw message and its source columns;
one row per batch and sink goes to `batch_log`, with the rows that sink took.  A batch
without rows writes nothing.
For any input: consumed = flat rows + repeats + dead letters.

Offsets are committed in the checkpoint only after the batch's writes succeed, and a
batch overwrites its own partitions (at-least-once input + idempotent output =
exactly-once tables).  Each checkpoint writes under a run folder of its own; a replay
with a fresh checkpoint, whatever its batch cuts, fills a new run, and readers move to
it when the replay has drained (`set_live`).
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmill.operators import rollups as R
from eventmill.operators.transform import shape, tag, to_document
from eventmill.operators.validate import decode_json
from eventmill.sinks import store
from eventmill.sinks.files import (Outcome, WriteError, counted, id_index, overwrite_batch, put_documents, reject_ratio_error,
                                   run_writes, write_flat)
from eventmill.sinks.levels import Levels
from eventmill.streaming.progress import ProgressLog, progress_row


@dataclass
class StreamSource:
    """Where messages come from.

    kind="files": a folder (glob) of JSON-lines text files, `max_files` per micro-batch.
    kind="kafka": `servers` + `topic`; needs the spark-sql-kafka connector on the class
    path (not present in the test image, so this branch is untested here).
    """
    kind: str = "files"
    path: str | None = None
    servers: str | None = None
    topic: str = "events_raw"
    starting_offsets: str = "latest"     # "earliest" replays the topic (A3)
    max_offsets: int | None = None       # rate limit per micro-batch (L10)
    max_files: int = 1
    min_partitions: int | None = None    # spread a micro-batch over at least this many tasks

    def read(self, spark: SparkSession) -> DataFrame:
        if self.kind == "files":
            d = (spark.readStream.format("text").option("maxFilesPerTrigger", self.max_files)
                 .load(self.path).select("value"))
            # a batch of few files is few tasks; round-robin it over the cores (stateless)
            return d.repartition(self.min_partitions) if self.min_partitions else d
        if self.kind == "kafka":
            r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", self.servers)
                 .option("subscribe", self.topic).option("startingOffsets", self.starting_offsets))
            if self.max_offsets:
                r = r.option("maxOffsetsPerTrigger", self.max_offsets)
            if self.min_partitions:
                # split topic partitions into more Spark tasks (6 topic partitions would
                # otherwise cap a large cluster at 6 concurrent tasks)
                r = r.option("minPartitions", self.min_partitions)
            return r.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "headers")
        raise ValueError(f"unknown source kind {self.kind}")


def tagged_stream(spark: SparkSession, source: StreamSource, offset_mode: str = "utc") -> DataFrame:
    """Decoded messages with source columns, reject reason and two times; rejected ones with their raw text.

    `arrival` is the time of the micro-batch (the same when a batch is retried);
    `event_time` is the event's own UTC time as a `timestamp`, NULL for rejected rows.
    """
    messages = source.read(spark).withColumn("raw_message", F.col("value"))
    tagged = tag(decode_json(messages), offset_mode=offset_mode)
    ok = F.col("reject_reason").isNull()
    # only a dead letter keeps its text: the others need not carry it through the shuffle and the batch
    tagged = tagged.withColumn("raw_message", F.when(~ok, F.col("raw_message")))
    return tagged.select("*", F.current_timestamp().alias("arrival"),
                         F.when(ok, F.col("_ts").cast("timestamp")).alias("event_time"),
                         F.when(ok, F.col("event_id")).otherwise(F.md5(F.coalesce("raw_message", F.lit("")))).alias("_key"))


def observed(tagged: DataFrame, name: str = "batch_metrics") -> DataFrame:
    """L9 / G16 per micro-batch: consumed and rejected counts collected with the batch
    (`observe`, no extra job) and reported in each StreamingQueryProgress."""
    return tagged.observe(name, F.count(F.lit(1)).alias("consumed"),
                          F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))


def dedup_stream(tagged: DataFrame, watermark: str = "1 day", time_col: str = "event_time") -> DataFrame:
    """L4: accepted rows, first delivery per event_id within the watermark on `time_col`."""
    ok = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return ok.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["event_id"])


BATCH_LOG = "run string, batch_id long, sink string, ok boolean, rows long, seconds double, error string"


def batch_writer(spark: SparkSession, root: str, run: str, *, reject_ratio_limit: float | None = None, require: str = "all",
                 on_batch: Callable[[DataFrame, int], None] | None = None,
                 on_reject: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """B3 + B4 + B8 + N2 in `foreachBatch`: persist the kept rows (accepted after the stateful
    dedup, plus rejected) once, leave out ids that an earlier batch stored, then write flat
    rows, documents, the two partial rollups and the dead letters; every output is keyed by
    batch id (replay-safe).

    One count computes the batch (the stateful dedup runs once); the writes then run as
    concurrent jobs over the cached rows, the id index among them: it must succeed whatever
    `require` says.  Each sink's outcome, rows taken and seconds go to `batch_log` (G17, N3),
    also when the batch fails.  `on_batch` gets the accepted
    rows, `on_reject` the rejected ones.
    """
    index = id_index(spark, f"{root}/documents")
    hourly, daily = hourly_runs(spark, root), daily_runs(spark, root)

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.drop("arrival", "event_time", "_key").persist()
        began, outcomes, fresh = time.time(), [], None
        try:
            good = F.col("reject_reason").isNull()
            n = kept.agg(F.count_if(good).alias("ok"), F.count_if(~good).alias("bad")).first()
            if not n["ok"] and not n["bad"]:
                return
            reject_ratio_error(n["bad"], n["ok"] + n["bad"], batch_id, reject_ratio_limit)
            accepted = kept.where(good).drop("reject_reason", "raw_message")
            # shaped and enriched once for all sinks
            fresh = ok = shape(index.fresh(accepted, "event_id", batch_id, unique=True)).persist()
            bad = kept.where(~good).drop("_ts", "_uid", "_props_kind").withColumn("ingest_time", F.current_timestamp().cast("timestamp_ntz"))

            def taken(rows: DataFrame, put: Callable[[DataFrame], None]) -> Callable[[], int]:
                def one() -> int:
                    seen, count = counted(rows)
                    put(seen)
                    return count()
                return one
            writes = {}
            if n["ok"]:
                writes = {
                    "flat": taken(ok, lambda d: write_flat(d, f"{root}/flat", batch_id, small=True)),
                    "documents": taken(ok, lambda d: put_documents(to_document(d), f"{root}/documents", batch_id)),
                    "hourly_partials": taken(ok, lambda d: hourly.append(R.hourly_partials(d.withColumn("block", F.lit(batch_id))).drop("block"), batch_id)),
                    "daily_partials": taken(ok, lambda d: daily.append(daily_partials(d), batch_id)),
                }
                # the index never shows a batch its own ids, so it can be written beside the sinks
                writes["ids"] = lambda: index.add(fresh.select("event_id"), batch_id, unique=True, at_most=n["ok"])
            if n["bad"]:
                writes["dead_letter"] = taken(bad, lambda d: overwrite_batch(d, f"{root}/dead_letter", batch_id))
            outcomes = run_writes(spark, writes, require, computed=True)
            if any(o.sink == "ids" and not o.ok for o in outcomes):
                raise WriteError(outcomes)
            if on_batch:
                on_batch(ok, batch_id)
            if on_reject:
                on_reject(bad, batch_id)
        except WriteError as e:
            outcomes = e.outcomes
            raise
        except Exception as e:
            outcomes = outcomes or [Outcome("batch", False, time.time() - began, f"{type(e).__name__}: {e}"[:2000])]
            raise
        finally:
            rows = [{"run": run, "sink": o.sink, "ok": o.ok, "rows": o.rows, "seconds": o.seconds, "error": o.error} for o in outcomes if o.sink != "ids" or not o.ok]
            if rows:
                # a few lines: written by the driver itself, without a job
                store.write_text(spark, f"{root}/batch_log/batch_id={batch_id}/log.json", "".join(json.dumps(r) + "\n" for r in rows))
            if fresh is not None:
                fresh.unpersist()
            kept.unpersist()
    return write


def read_batch_log(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch and sink of a run's root."""
    return spark.read.schema(BATCH_LOG).option("basePath", f"{root}/batch_log").json(f"{root}/batch_log")


def hourly_runs(spark: SparkSession, root: str, **sizes) -> Levels:
    """The hourly partials of a run's root as a levelled table."""
    return Levels(spark, f"{root}/hourly_partials", R.combine_hourly_partials, **sizes)


def daily_runs(spark: SparkSession, root: str, **sizes) -> Levels:
    """The daily-user partials of a run's root as a levelled table."""
    return Levels(spark, f"{root}/daily_partials", combine_daily_partials, **sizes)


def run_name(checkpoint: str) -> str:
    """The run that a checkpoint belongs to."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def set_live(spark: SparkSession, root: str, run: str) -> None:
    """Readers of `root` see this run from now on: a marker with the next number is made, in one step."""
    last = max((int(n.split("-")[0]) for n in store.names(spark, f"{root}/live") if not n.startswith(".")), default=-1)
    store.write_text(spark, f"{root}/live/{last + 1:08d}-{run}", "")


def live_root(spark: SparkSession, root: str) -> str:
    """Folder of the run that readers of `root` see."""
    newest = max(n for n in store.names(spark, f"{root}/live") if not n.startswith("."))
    return f"{root}/run={newest.split('-', 1)[1]}"


def daily_partials(events: DataFrame, lg_k: int = 12) -> DataFrame:
    """Per-batch daily-user partials: min/max time, count, sketches of types and sessions."""
    return (events.groupBy(*R.DAILY_KEYS)
            .agg(F.min("timestamp").alias("first_event_time"), F.max("timestamp").alias("last_event_time"),
                 F.count(F.lit(1)).alias("event_count"),
                 F.hll_sketch_agg(F.col("event_type"), lg_k).alias("types_sketch"),
                 F.hll_sketch_agg(F.col("session_id"), lg_k).alias("sessions_sketch")))


def combine_daily_partials(partials: DataFrame) -> DataFrame:
    """Several batches' daily-user partials as one: min / max / sum, sketches united and kept as sketches."""
    return (partials.groupBy(*R.DAILY_KEYS)
            .agg(F.min("first_event_time").alias("first_event_time"),
                 F.max("last_event_time").alias("last_event_time"),
                 F.sum("event_count").alias("event_count"),
                 F.hll_union_agg("types_sketch").alias("types_sketch"),
                 F.hll_union_agg("sessions_sketch").alias("sessions_sketch")))


def merge_daily_partials(partials: DataFrame) -> DataFrame:
    """L6 read side: merge partials with min / max / sum / sketch union (never replace)."""
    return combine_daily_partials(partials).select(
        *R.DAILY_KEYS, "first_event_time", "last_event_time", "event_count",
        F.hll_sketch_estimate("types_sketch").alias("approx_event_types"), F.hll_sketch_estimate("sessions_sketch").alias("approx_sessions"))


def run_stream(spark: SparkSession, source: StreamSource, root: str, checkpoint: str, *, state_partitions: int,
               window: str = "1 day", available_now: bool = True, processing_time: str | None = None,
               offset_mode: str = "utc", reject_ratio_limit: float | None = None, require: str = "all",
               progress: str | None = None,
               on_batch: Callable[[DataFrame, int], None] | None = None,
               on_reject: Callable[[DataFrame, int], None] | None = None) -> list[StreamingQuery]:
    """A1 + L1-L4, B8: start the ingest query (accepted and rejected rows in one query).

    available_now=True drains what is there and stops (L2); otherwise a processing-time
    trigger (L1, default 5 seconds).  `state_partitions` is the number of dedup state
    partitions, fixed in the checkpoint at the first start.  Repeats are found among the
    ids that arrived within `window` by the state, among all earlier ones by the id index.
    `progress`: folder where a listener keeps every progress report (L9; remove it with
    `spark.streams.removeListener`).  The first run of a root is live from the start;
    after a replay has drained, call `set_live(spark, root, run_name(checkpoint))`.
    Returns the started queries; callers wait on them.
    """
    run = run_name(checkpoint)
    if not store.names(spark, f"{root}/live"):
        set_live(spark, root, run)
    if progress is not None:
        spark.streams.addListener(ProgressLog(spark, progress))
    tagged = tagged_stream(spark, source, offset_mode)
    # the watermark goes below the shuffle (it does not pass on its input's partitioning), then one
    # hash shuffle by key: both branches read it, and the dedup needs no exchange of its own
    shared = observed(tagged.withWatermark("arrival", window).repartition("_key"))
    accepted = shared.where(F.col("reject_reason").isNull()).dropDuplicatesWithinWatermark(["_key"])
    rejected = shared.where(F.col("reject_reason").isNotNull())
    write = batch_writer(spark, f"{root}/run={run}", run, reject_ratio_limit=reject_ratio_limit, require=require, on_batch=on_batch, on_reject=on_reject)
    w = (accepted.unionByName(rejected).writeStream.foreachBatch(write)
         .option("checkpointLocation", f"{checkpoint}/events"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    with state_partitions_for_start(spark, state_partitions):
        return [w.start()]


@contextmanager
def state_partitions_for_start(spark: SparkSession, n: int):
    """Start streaming queries with `n` state partitions.

    A streaming query clones the session when it starts and keeps the partition count
    of its state in the checkpoint, so the setting is restored right after the start.

    State lives in RocksDB unless the launcher chose a provider: a day of event ids
    (the dedup state under a 1-day watermark) does not fit in executor heaps, which is
    where the default provider keeps every state row.  Changelog checkpointing uploads
    only each batch's changes to the checkpoint folder instead of whole snapshots.
    """
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    set_here = []
    for k, v in STATE_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
            set_here.append(k)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
        for k in set_here:
            spark.conf.unset(k)


STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session_stream(tagged: DataFrame, gap: str = "30 minutes", watermark: str = "1 day") -> DataFrame:
    """Session windows per user over the de-duplicated accepted stream (two chained
    stateful operators: watermark dedup, then the session aggregation).  Append mode
    emits a session once the watermark passes its end.  Sessions still open when the
    input ends come out as soon as any later event (a heartbeat) moves the watermark."""
    return (dedup_stream(tagged, watermark).withColumnRenamed("_uid", "uid").drop("user_id").withColumnRenamed("uid", "user_id")
            .groupBy("user_id", F.session_window("event_time", gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("event_count"))
            .select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"), "event_count"))


#: Messages of one landed file (about 0.7 GB): what one micro-batch of a one-file stream takes.
FILE_ROWS = 2_000_000


def write_message_files(raw: DataFrame, path: str, n_files: int = 4, heartbeat: bool = False) -> str:
    """Land raw events as JSON message files in arrival order: `n_files` id ranges, each with its first
    deliveries and repeats: of every other id the repeat comes with the first delivery, of the others one file
    later; one folder per chunk, written one after another so file times follow arrival order.  A chunk is one file for
    each FILE_ROWS messages, however many tasks read the table, so that a stream of one file a batch has as many
    batches as the messages fill.  heartbeat=True adds a last message three days after the newest event.  Returns the
    glob to read."""
    from eventmill.sources.raw import to_json_messages
    bounds = raw.agg(F.min("src_id").alias("lo"), F.max("src_id").alias("hi")).first()
    lo, hi = int(bounds["lo"]), int(bounds["hi"])
    step = max(1, (hi - lo + n_files) // n_files)
    chunk = F.floor((F.col("src_id") - lo) / step) + F.when((F.col("delivery") != 0) & (F.floor(F.col("src_id") / 50) % 2 == 1), 1).otherwise(0)
    placed = raw.withColumn("_chunk", chunk)
    # one row per chunk
    rows = {r["_chunk"]: r["count"] for r in placed.groupBy("_chunk").count().collect()}
    for i in range(n_files + 1):
        messages = to_json_messages(placed.where(F.col("_chunk") == i), keep_meta=True)
        files = max(1, -(-rows.get(i, 0) // FILE_ROWS))
        # the files of a large chunk are id ranges too
        messages = messages.repartitionByRange(files, "src_id") if files > 1 else messages.repartition(1)
        messages.select("value").write.mode("errorifexists").text(f"{path}/c{i:04d}")
    if heartbeat:
        newest = raw.where(F.col("timestamp").rlike("^[0-9]{4}-")).agg(F.max("timestamp").alias("t")).first()["t"]
        later = F.concat(F.date_format(F.lit(newest[:19]).cast("timestamp_ntz") + F.expr("INTERVAL 3 DAYS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
        beat = raw.sparkSession.range(1).select(F.to_json(F.struct(F.lit("heartbeat").alias("event_id"), F.lit("-1").alias("user_id"), F.lit("heartbeat").alias("event_type"), later.alias("timestamp"))).alias("value"))
        beat.write.mode("errorifexists").text(f"{path}/c{n_files + 1:04d}")
    return f"{path}/c*/part-*"


PROGRESS_SCHEMA = ("query string, batch_id long, timestamp string, input_rows long, input_rows_per_second double, "
                   "processed_rows_per_second double, trigger_ms long, batch_ms long, state_rows long, "
                   "dropped_by_watermark long, consumed long, rejected long")


def progress_log(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """L9 + N3: the recent progress of the queries as a table (one row per micro-batch):
    input rows and rates, trigger / batch durations (feed `duration_histogram`), state
    rows, rows dropped as later than the watermark (L8), and the observed counts.

    Spark keeps the progress of the last `spark.sql.streaming.numRecentProgressUpdates`
    batches; `ProgressLog` keeps all of them.
    """
    names = [c.split()[0] for c in PROGRESS_SCHEMA.split(", ")]
    rows = [tuple(progress_row(p)[c] for c in names) for q in queries for p in q.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)
