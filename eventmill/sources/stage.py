"""Staging: write a DataFrame to the shared checkpoint folder and read it back.

Cuts lineage (a lost executor re-reads the staged files instead of recomputing the
whole plan) and models a landed topic / table.  Never a machine-local folder on a
cluster: the folder comes from `spark.checkpoint.dir`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmill.session import scratch_dir


def staged(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    path = scratch_dir(spark, name)
    df.write.mode("errorifexists").format(fmt).save(path)
    return spark.read.format(fmt).load(path)
