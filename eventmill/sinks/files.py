"""Table sinks (B1-B4, B8-B10) on Parquet folders.

Idempotence: rows carry the batch id as the inner partition and a batch overwrites its
own partitions, so a replayed batch replaces its earlier output instead of adding to it
(B10).  `event_date` is the outer partition of the flat table, so a date filter lists one
folder.  Documents skip ids already stored, whatever their date (B2): an index of ids
beside the table decides, see `sinks.idindex`.  A batch is persisted once and written to
all sinks, and every sink's outcome is recorded (B3).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventmill.operators.transform import split, to_document, to_flat
from eventmill.operators.validate import with_reject_reason
from eventmill.schemas import RAW_FIELDS
from eventmill.sinks import store
from eventmill.sinks.idindex import IdIndex


@dataclass
class Outcome:
    """What became of one sink's write: seconds, the error text if it failed, and the rows it took (if it told)."""
    sink: str
    ok: bool
    seconds: float
    error: str | None = None
    rows: int | None = None


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """df and a function that tells, once a job has read it, how many rows went through."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: seen.get["rows"]


def run_writes(spark: SparkSession, writes: dict[str, Callable[[], int | None]], require: str = "all", computed: bool = False) -> list[Outcome]:
    """Run the writes of one persisted batch as concurrent jobs; a write may return the rows it took.

    Unless the batch is computed already, the first write runs alone: it computes the
    persisted batch (and with it any stateful streaming step upstream) once.  The others
    read the cached blocks and are independent jobs, so they run side by side and fill the
    executors instead of queueing one after another.  Every outcome is returned.
    require="all": any failure raises, so the batch is retried as a whole; "any": it raises
    only if no sink took the batch.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.util import inheritable_thread_target

    def run(name: str) -> Outcome:
        began = time.time()
        try:
            rows = writes[name]()
        except Exception as e:  # noqa: BLE001 - recorded, and raised below
            return Outcome(name, False, time.time() - began, f"{type(e).__name__}: {e}"[:2000])
        return Outcome(name, True, time.time() - began, rows=rows)

    names = list(writes)
    done = [] if computed else [run(n) for n in names[:1]]
    rest = names[len(done):]
    if rest:
        with ThreadPoolExecutor(max_workers=len(rest)) as pool:
            done += [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), n) for n in rest]]
    failed = [o for o in done if not o.ok]
    if failed and (require == "all" or len(failed) == len(done)):
        raise WriteError(done)
    return done


class WriteError(RuntimeError):
    """A batch that its sinks did not take; `outcomes` has each sink's."""

    def __init__(self, outcomes: list[Outcome]) -> None:
        super().__init__("; ".join(f"{o.sink}: {o.error}" for o in outcomes if not o.ok))
        self.outcomes = outcomes


CLUSTER_KEY = ["event_date", "event_type", "user_id", "timestamp"]


def overwrite_batch(df: DataFrame, path: str, batch_id: int | None, *outer: str) -> None:
    """Write rows partitioned by `outer` and then the batch id; a batch replaces its own partitions only."""
    if batch_id is None:
        df.write.mode("append").partitionBy(*outer).parquet(path)
    else:
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*outer, "batch_id").parquet(path))


def write_flat(df: DataFrame, path: str, batch_id: int | None = None, wide: bool = False,
               files: int | None = None, small: bool = False) -> None:
    """B1 + M1 + M2: flat rows partitioned by event_date and clustered by
    (event_date, event_type, user_id, timestamp) for min/max skipping.

    Range partitioning on the cluster key (sampled bounds) keeps output tasks even: a
    date holding a third of all rows is split over many tasks instead of one.  With a
    batch id the rows of a date go to `event_date=<d>/batch_id=<n>/`, replaced when the
    batch is written again; an empty batch writes no data files.  small=True, for
    micro-batches that a compaction rewrites later: rows are rebalanced by date (AQE joins
    small dates and splits a hot one), which saves the job that samples the bounds.
    """
    flat = to_flat(df, wide=wide).withColumn("processed_at", F.current_timestamp().cast("timestamp_ntz"))
    # without an explicit file count AQE sizes the range partitions (advisory partition
    # size), so a small load writes a few files and a big one writes many
    if small:
        flat = flat.hint("rebalance", "event_date")
    else:
        flat = flat.repartitionByRange(files, *CLUSTER_KEY) if files else flat.repartitionByRange(*CLUSTER_KEY)
    overwrite_batch(flat.sortWithinPartitions(*CLUSTER_KEY), path, batch_id, "event_date")


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """Read the flat table back (date partitions and batch folders are discovered), from its retention bound on."""
    flat = spark.read.option("basePath", path).parquet(path)
    bound = retention_bound(spark, path)
    return flat if bound is None else flat.where(F.col("event_date") >= F.lit(bound).cast("date"))


def retention_bound(spark: SparkSession, path: str) -> str | None:
    """The first date that readers of a flat table see; None if all."""
    return max((n[len("from-"):] for n in store.names(spark, f"{path}/_retention") if n.startswith("from-")), default=None)


def drop_dates(spark: SparkSession, path: str, first: str, grace_seconds: float = 3600.0) -> list[str]:
    """M3: retention by dropping whole date folders; no data file is read or rewritten.

    The bound moves first, so that readers from now on plan without the older dates.  A folder goes once the bound above
    it has stood for `grace_seconds`, for readers that planned before: call again later (each run of a daily job does).
    A bound never moves back.  Returns the dates whose folders were deleted.
    """
    bound = retention_bound(spark, path)
    if bound is None or first > bound:
        store.write_text(spark, f"{path}/_retention/from-{first}", "")
    marks = {n[len("from-"):]: t for n, t in store.names(spark, f"{path}/_retention").items() if n.startswith("from-")}
    settled = max((d for d, t in marks.items() if t <= (time.time() - grace_seconds) * 1000), default=None)
    gone = []
    for name in store.names(spark, path):
        day = name[len("event_date="):] if name.startswith("event_date=") else None
        if settled is not None and day is not None and day < settled:
            store.delete(spark, f"{path}/{name}")
            gone.append(day)
    return sorted(gone)


def compact_flat(spark: SparkSession, path: str, out: str, start_date: str | None = None, end_date: str | None = None) -> None:
    """Rewrite the dates from start to before end into a new table: clustered files of even size instead of one
    set per micro-batch.  Readers switch to `out` when it is complete; the old table is not touched."""
    rows = read_flat(spark, path)
    if start_date is not None:
        rows = rows.where(F.col("event_date") >= F.lit(start_date).cast("date"))
    if end_date is not None:
        rows = rows.where(F.col("event_date") < F.lit(end_date).cast("date"))
    rows = rows.drop("batch_id").repartitionByRange(*CLUSTER_KEY).sortWithinPartitions(*CLUSTER_KEY)
    rows.write.mode("errorifexists").partitionBy("event_date").parquet(out)


def id_index(spark: SparkSession, path: str, **sizes) -> IdIndex:
    """The index of the ids that a document table holds, in a hidden folder of it."""
    return IdIndex(spark, f"{path}/_ids", **sizes)


def write_document(spark: SparkSession, df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """B2: insert documents with a unique `_id`: in-batch repeats are dropped and ids
    already stored, under whatever date, are skipped, never failed.

    The id index beside the table decides: a batch opens only the index files that may hold
    one of its ids, and the index's buckets grow with the table.  A batch that is written
    again does not meet its own earlier rows; without a batch id the next number is taken.
    The index is written last, so a batch cut short is written again as a whole.
    """
    index = id_index(spark, path)
    batch_id = index.last_batch() + 1 if batch_id is None else batch_id
    docs = index.fresh(to_document(df).dropDuplicates(["_id"]), "_id", batch_id).persist()
    try:
        put_documents(docs, path, batch_id)
        index.add(docs.select("_id"), batch_id, unique=True)
    finally:
        docs.unpersist()


def put_documents(docs: DataFrame, path: str, batch_id: int) -> None:
    """Write documents whose ids are known to be new."""
    overwrite_batch(docs.sortWithinPartitions("_id"), path, batch_id)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read documents back as written, without the layout column."""
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")


def dead_letter_rows(raw: DataFrame, offset_mode: str = "utc") -> DataFrame:
    """Rejected raw rows with their reason (raw text fields kept as received)."""
    t = with_reject_reason(raw, offset_mode)
    return t.where(F.col("reject_reason").isNotNull()).select(
        *RAW_FIELDS, "reject_reason", *[c for c in raw.columns if c not in RAW_FIELDS and not c.startswith("_")])


def dual_sink(spark: SparkSession, flat_path: str, doc_path: str, dead_path: str | None = None,
              *, order: str | None = None, reject_ratio_limit: float | None = None, require: str = "all",
              on_batch: Callable[[DataFrame, int], None] | None = None,
              on_reject: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], list[Outcome]]:
    """B3 (+ B4, B8, N2): a `foreachBatch` function writing each transformed batch to both
    sinks and the rejects to the dead-letter sink; `on_batch` / `on_reject` are per-batch
    hooks (the success / error callbacks of the source, per batch instead of per row).

    The tagged batch is persisted once and read by every write.  With
    `reject_ratio_limit`, a batch whose reject share exceeds it raises (B4) before any
    write, so the checkpoint does not advance and the batch is retried.  The function
    returns the sinks' outcomes; require="any" lets a batch pass that either one took.
    """
    def run(batch: DataFrame, batch_id: int) -> list[Outcome]:
        tagged = batch.persist()
        try:
            check_reject_ratio(tagged, batch_id, reject_ratio_limit)
            ok, bad = split(tagged, order=order)
            ok = ok.drop("_seq") if "_seq" in ok.columns else ok
            writes = {"flat": lambda: write_flat(ok, flat_path, batch_id),
                      "documents": lambda: write_document(spark, ok, doc_path, batch_id)}
            if dead_path:
                writes["dead_letter"] = lambda: overwrite_batch(
                    bad.drop("properties").withColumn("ingest_time", F.current_timestamp().cast("timestamp_ntz")), dead_path, batch_id)
            outcomes = run_writes(spark, writes, require)
            if on_batch:
                on_batch(ok, batch_id)
            if on_reject:
                on_reject(bad, batch_id)
            return outcomes
        finally:
            tagged.unpersist()
    return run


def check_reject_ratio(tagged: DataFrame, batch_id: int, limit: float | None) -> None:
    """Raise if the share of rejected rows is over the limit."""
    if limit is not None:
        n = tagged.agg(F.count_if(F.col("reject_reason").isNotNull()).alias("bad"), F.count(F.lit(1)).alias("n")).first()
        reject_ratio_error(n["bad"], n["n"], batch_id, limit)


def reject_ratio_error(bad: int, n: int, batch_id: int, limit: float | None) -> None:
    if limit is not None and n and bad / n > limit:
        raise RuntimeError(f"batch {batch_id}: reject ratio {bad / n:.3f} over {limit}")


def snapshot(df: DataFrame, root: str, stamp: str) -> str:
    """Export to `<root>/<stamp>`; refuses to overwrite an existing snapshot."""
    path = f"{root.rstrip('/')}/{stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path
