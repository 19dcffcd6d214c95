"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; only a local master without one gets a folder of its own."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="llm-checkpoint-")
    spark.sparkContext.setCheckpointDir(shared)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written as Parquet to a new folder under the shared checkpoint folder and read again."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """The same rows read back from the shared checkpoint folder: computed once, lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def n_words(text: Column) -> Column:
    """Words of a text; 0 for null or empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hex_number(text: Column, start: int, length: int) -> Column:
    """Integer value of some hex digits of a text."""
    return F.conv(F.substring(text, start, length), 16, 10).cast("long")


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that df does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
