"""Row numbers over a whole table, without bringing the table into one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

_IN_PARTITION = (1 << 33) - 1


def with_ordinal(df: DataFrame, ord_cols: Sequence[str], name: str = "pos") -> DataFrame:
    """``df`` with the position of each row (from 0) in ``ord_cols`` order, nulls last.

    Rows are range-partitioned by the order and sorted within partitions, so
    only neighbours meet in a task; a partition's offset is the sum of the
    counts before it (one number for each partition comes to the driver).
    Ties in the order are broken by a hash of the whole row, and copies of a
    row by where they came from, so a value that a third of the rows share is
    spread over partitions like any other; which copy of equal rows comes first
    makes no difference.  The ordered rows are written to shared storage, so
    that counting and numbering see the same partitions whatever is recomputed.
    """
    if name in df.columns:
        raise ValueError(f"the table has a column {name!r} already")
    spark = df.sparkSession
    tied = df.withColumns({"_hash": F.xxhash64(*df.columns), "_from": F.monotonically_increasing_id()})
    order = [*(F.col(c).asc_nulls_last() for c in ord_cols), F.col("_hash"), F.col("_from")]
    placed = tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_from").withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))})
    path = scratch_path(spark, "ordinals")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    counts = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    before = [0, *accumulate(n for _, n in counts)]
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_part int, _before long")
    return placed.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")
