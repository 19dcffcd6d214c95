"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Every document of a source expects the same number of copies, target / source size. The expected copies are summed in
a fixed order within the source, one offset drawn per source is added, and a document is taken once per integer
boundary that its stretch crosses. Documents are ordered from large to small, so the taken words stray from the target
by about one document at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmill.llm.common import WORD, cut, hex_number, n_words

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST_COPIES = 2
SEED = "mix-1"
#: Hex digits of the document hash that split a run of equally long documents into blocks to be ranked apart.
BLOCK_DIGITS = 3
#: Rows of one run of equal rows that are spelt out at once.
PIECE = 65_536


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(has_source, source, source_size, target) from one row per source.

    Each source gets its weight's part of share * all sizes; what lies above most * its size is shared again by weight
    among the others until none is above. That has a closed form: with sources by rising cap / weight, the common level
    is the largest of (what is left after the caps before) / (the weights from here on). One row per source: the window
    without a partition holds the list of sources, never documents.
    """
    by_name = Window.orderBy(F.desc("has_source"), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    named = sizes.withColumns({"place": F.row_number().over(by_name), "weight": weight, "cap": F.lit(float(most)) * F.col("source_size")})
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = named.withColumns({
        "left": F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    }).withColumn("level", F.max(F.col("left") / F.col("open")).over(everything))
    return level.select("has_source", "source", "source_size", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"))


def offset(has_source: Column, source: Column, seed: str) -> Column:
    """The source's offset in [0, 1): a fixed function of seed and source, so reruns agree."""
    key = F.md5(F.concat(F.lit(f"{seed}|"), F.when(has_source, F.concat(F.lit("="), source)).otherwise(F.lit(""))))
    return hex_number(key, 1, 8).cast("double") / F.lit(float(16**8))


def spelt_out(runs: DataFrame) -> DataFrame:
    """The rows of runs (n rows each, ranks from `first` on), one per rank.

    Runs longer than PIECE are cut into pieces, and the pieces dealt to all tasks before they are spelt out.
    """
    last = F.floor((F.col("n") - 1) / PIECE)
    pieces = runs.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long = pieces.filter(F.col("n") > PIECE).repartition(tasks, "digest", "piece")
    from_, to = F.col("piece") * PIECE, F.least((F.col("piece") + 1) * PIECE, F.col("n")) - 1
    short = runs.filter(F.col("n") <= PIECE).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    listed = long.withColumn("i", F.explode(F.sequence(from_, to))).drop("piece").unionByName(short)
    return listed.withColumn("rank", F.col("first") + F.col("i")).drop("i", "n", "first")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size (words), source_size, target (both its source's), copies, taken.

    Nulls: a null text has size 0 and takes nothing; a null source is a source of its own, last in order; rows with a
    null id are ranked like any other. Repeated rows are separate documents; rows equal in id, source and size are
    counted before the shuffle and ranked as one run, in which it does not matter which one is taken. Empty tables give no rows. Other columns of docs are ignored. No document is taken
    more than `most` times. Ranks are counted per (source, size, block of the id's hash), so neither a source nor a run
    of equal documents meets in one task.
    """
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.md5(ident).alias("digest"), n_words(F.col(text_col)).alias("size"),
        F.col(source_col).isNotNull().alias("has_source"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    rows = cut(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))).withColumn("block", F.substring("digest", 1, BLOCK_DIGITS))
    key = ["has_source", "source"]
    blocks = cut(rows.groupBy(*key, "size", "block").agg(F.sum("n").alias("n")))
    sizes = blocks.groupBy(*key, "size").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy(*key).orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    by_size = sizes.select(*key, "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("larger"))
    sources = sizes.groupBy(*key).agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sources, weights, share, most)
    in_size = Window.partitionBy(*key, "size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (blocks.withColumn("same", F.coalesce(F.sum("n").over(in_size), F.lit(0)))
              .join(by_size, [*key, "size"]).join(targets, key)
              .select(*key, "size", "block", (F.col("larger") + F.col("same")).alias("start"), "source_size", "target"))
    in_block = Window.partitionBy(*key, "size", "block").orderBy("digest", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("start") + F.coalesce(F.sum("n").over(in_block), F.lit(0)) + 1
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    shift = offset(F.col("has_source"), F.col("source"), seed)
    runs = rows.join(starts, [*key, "size", "block"]).withColumns({"first": first, "rate": rate, "shift": shift}).drop("start", "block")
    placed = spelt_out(cut(runs))
    copies = F.floor(F.col("shift") + F.col("rate") * F.col("rank")) - F.floor(F.col("shift") + F.col("rate") * (F.col("rank") - 1))
    return placed.withColumn("copies", F.least(copies, F.lit(most)).cast("long")).select(
        "doc_id", F.when(F.col("has_source"), F.col("source")).alias("source"), "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def mix_sql(docs: str = "documents", *, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, seed: str = SEED) -> str:
    """The same in DuckDB SQL over a relation with doc_id, text, source."""
    pick = " ".join(f"WHEN {i} THEN CAST({w!r} AS DOUBLE)" for i, w in enumerate(weights))
    return f"""
WITH d AS (SELECT doc_id, source IS NOT NULL AS hs, coalesce(source, '') AS src, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
    CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM {docs}),
s AS (SELECT hs, src, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY hs, src),
p AS (SELECT *, row_number() OVER (ORDER BY hs DESC, src) AS place FROM s),
w AS (SELECT *, CASE CAST((place - 1) % {len(weights)} AS INTEGER) {pick} END AS weight, CAST({float(most)!r} AS DOUBLE) * source_size AS cap FROM p),
l AS (SELECT *, CAST({float(share)!r} AS DOUBLE) * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open FROM w),
t AS (SELECT hs, src, source_size, least(cap, max(rest / open) OVER () * weight) AS target,
    CAST(CAST('0x' || substr(md5('{seed}|' || CASE WHEN hs THEN '=' || src ELSE '' END), 1, 8) AS BIGINT) AS DOUBLE) / {float(16**8)!r} AS shift FROM l),
r AS (SELECT d.doc_id, hs, src, d.size, t.source_size, t.target, t.shift, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY hs, src ORDER BY d.size DESC, d.digest, d.doc_id) AS k FROM d JOIN t USING (hs, src)),
c AS (SELECT *, CAST(least(floor(shift + rate * k) - floor(shift + rate * (k - 1)), {int(most)}) AS BIGINT) AS copies FROM r)
SELECT doc_id, CASE WHEN hs THEN src END AS source, size, source_size, target, copies, copies * size AS taken FROM c"""
