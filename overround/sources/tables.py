"""Table scans that keep every core busy.

A Parquet row group is the smallest unit a scan can split, so a table
stored as a few large row groups is read by only a few tasks, and every
operator before the first shuffle inherits that parallelism.  When a scan
yields fewer partitions than the cluster has cores, a round-robin
repartition spreads the rows first; a well-laid-out large table (many row
groups) is returned unchanged, so on a big cluster this is a no-op.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def balance_partitions(df: DataFrame, target: int | None = None) -> DataFrame:
    """Repartition to ``target`` (default: default parallelism) only when
    the input has fewer partitions than that."""
    try:
        want = target or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD API (e.g. a Spark Connect session): leave as is
        return df
    return df.repartition(want) if have < want else df


def read_table(spark: SparkSession, path: str, balance: bool = True) -> DataFrame:
    """Parquet table, spread over all cores when stored as too few row groups."""
    df = spark.read.parquet(path)
    return balance_partitions(df) if balance else df
