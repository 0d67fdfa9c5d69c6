"""An ordered table in CSV files: written in parallel, and read back in the same order.

Rows are range-partitioned by the order, so file k holds what comes before file
k + 1, each sorted.  A manifest beside the files has a row for each of them:
its number, rows, a checksum of its rows and the key it begins with.  The
folder, manifest included, takes its place in one step.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import CSV_TEXT, remove_folder, swap_in

MANIFEST = "file string, number int, n_rows long, before long, checksum decimal(38,0), first_key string"


def number_text(c: Column) -> Column:
    """A number as the feed scripts write it: ``2``, not ``2.0``, and no exponent for whole numbers."""
    whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
    return F.when(whole, c.cast("long").cast("string")).otherwise(
        F.lower(F.regexp_replace(c.cast("string"), r"\.0(?=E|$)", "")))


def _as_text(df: DataFrame) -> list[Column]:
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return [number_text(F.col(c)).alias(c) if c in real else F.col(c).cast("string").alias(c) for c in df.columns]


def _rows_in_files(spark: SparkSession, path: str, columns: Sequence[str], null_value: str) -> DataFrame:
    """Text rows of the files with the name of each and their place in it; a file is one task, so places are in order."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    rows = (spark.read.schema(text).option("header", True).option("multiLine", True).option("nullValue", null_value)
                 .options(**CSV_TEXT).csv(path))
    return rows.select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_id"))


def write_csv_ordered(df: DataFrame, path: str, ord_cols: Sequence[str], null_value: str = "NA",
                      files: int | None = None) -> DataFrame:
    """Write ``df`` in ``ord_cols`` order (nulls last), in ``files`` files or as many as the planner finds right;
    returns the manifest.

    Ties are broken by a hash of the row, so a value that very many rows share
    spreads over files.  Counts and checksums come from the files as written,
    read back once.  The old table stays until the new one is complete.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}-staging-{uuid.uuid4().hex[:12]}"
    order = [*(F.col(c).asc_nulls_last() for c in ord_cols), F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    try:
        (ranged.sortWithinPartitions(*order).select(*_as_text(df)).write.option("header", True)
               .option("nullValue", null_value).options(**CSV_TEXT).csv(staged))
        rows = _rows_in_files(spark, staged, df.columns, null_value)
        line = F.to_json(F.struct(*df.columns))
        each = rows.groupBy("_file").agg(
            F.count("*").alias("n_rows"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("checksum"),
            F.min_by(F.to_json(F.struct(*ord_cols)) if ord_cols else line, "_id").alias("first_key"))
        # A row for each file; names of Spark's files begin with the number of their partition.
        number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("int")
        sums = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
        manifest = each.select(F.col("_file").alias("file"), number.alias("number"), "n_rows", "checksum", "first_key").withColumn(
            "before", F.coalesce(F.sum("n_rows").over(sums), F.lit(0)))
        manifest.select("file", "number", "n_rows", "before", "checksum", "first_key").coalesce(1).write.json(f"{staged}/_manifest")
        swap_in(spark, staged, path)
    finally:
        remove_folder(spark, staged)
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{path.rstrip('/')}/_manifest")


def read_csv_ordered(spark: SparkSession, path: str, schema: T.StructType, null_value: str = "NA",
                     pos_name: str = "pos") -> DataFrame:
    """The table with each row's position (from 0) in the order that it was written in."""
    rows = _rows_in_files(spark, path, schema.fieldNames(), null_value)
    placed = rows.withColumn("_at", F.row_number().over(Window.partitionBy("_file").orderBy("_id")) - 1)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    known = read_manifest(spark, path).select(F.col("file").alias("_file"), "before")
    return placed.join(known, "_file").select((F.col("before") + F.col("_at")).alias(pos_name), *typed)


def damaged_files(spark: SparkSession, path: str, columns: Sequence[str], null_value: str = "NA") -> DataFrame:
    """Files that are missing, unknown to the manifest, or whose rows differ from what it says."""
    rows = _rows_in_files(spark, path, columns, null_value)
    found = rows.groupBy(F.col("_file").alias("file")).agg(
        F.count("*").alias("n_found"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("checksum_found"))
    both = read_manifest(spark, path).join(found, "file", "full_outer")
    same = (F.col("n_rows") == F.col("n_found")) & (F.col("checksum") == F.col("checksum_found"))
    return both.where(~F.coalesce(same, F.lit(False))).select("file", "n_rows", "n_found")
