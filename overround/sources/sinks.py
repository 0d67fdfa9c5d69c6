"""Sinks: market tables as CSV/Parquet, raw responses as JSON landing."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

CSV_TEXT = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = "NA") -> None:
    """CSV with a header; null written as ``NA``.  Writes a directory of part
    files (one per partition) so the write is parallel.

    Text comes back as it was: spaces at its ends are kept, a quote inside a
    quoted field is doubled.  Only a text equal to ``null_value`` can't be told
    from a null."""
    (df.write.mode(mode).option("header", True).option("nullValue", null_value).options(**CSV_TEXT).csv(path))


def read_csv(spark, path: str, schema, null_value: str = "NA", multi_line: bool = False) -> DataFrame:
    """Read CSV written by ``write_csv`` with an explicit schema (no inference).

    ``multi_line`` is for fields with line breaks; a file is then one task, so
    it is off unless a table needs it."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
                 .option("nullValue", null_value).options(**CSV_TEXT).csv(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: tuple[str, ...] = ()) -> None:
    """Parquet write; with ``partition_by`` an overwrite replaces only the
    partitions present in ``df`` (dynamic overwrite), never the whole table.
    Rows are dealt by partition first (AQE splits large ones), so a partition
    is a few files, not one for each task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its ``Path`` type: any store that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Put a completely written folder in the place of ``target`` (which may not exist).

    The old folder is renamed aside, the new one renamed in, and only then the
    old one deleted; where the second rename fails, the old folder comes back.
    """
    fs, path = _file_system(spark, target)
    old = path(f"{target.rstrip('/')}")
    aside = path(old.getParent(), f"_old-{uuid.uuid4().hex[:12]}")
    fs.mkdirs(old.getParent())
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"can't move {target} aside")
    try:
        moved = fs.rename(path(staged), old)
    except Exception:
        moved = False
    if not moved:
        if had:
            fs.rename(aside, old)
        raise OSError(f"can't move {staged} to {target}")
    if had:
        fs.delete(aside, True)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is in it, if it is there."""
    fs, path = _file_system(spark, folder)
    fs.delete(path(folder), True)


def _partition_folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """Folders ``a=1/b=2`` of a partitioned table, relative to it."""
    fs, path = _file_system(spark, root)
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{s.getPath().getName()}".lstrip("/") for f in found
                 for s in fs.listStatus(path(f"{root}/{f}" if f else root)) if s.isDirectory() and "=" in s.getPath().getName()]
    return found


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...],
                       replaced: Sequence[Mapping[str, str]] | None) -> None:
    """Write ``df`` as the whole content of the ``replaced`` partitions (given as
    column -> value), or of the whole table when that is None.

    The rows are written to a staging folder of the table first, by one job; a
    failure there leaves the table as it was.  Then each partition is renamed
    into its place, and named partitions without rows are emptied.  Only folder
    names come to the driver.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    staged = f"{path}/_staging-{uuid.uuid4().hex[:12]}"
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path(path))
    try:
        df.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(staged)
        new = _partition_folders(spark, staged, len(partition_by))
        if replaced is None:
            gone = set(_partition_folders(spark, path, len(partition_by))) - set(new)
        else:
            gone = {"/".join(f"{c}={values[c]}" for c in partition_by) for values in replaced} - set(new)
        for folder in new:
            swap_in(spark, f"{staged}/{folder}", f"{path}/{folder}")
        for folder in gone:
            remove_folder(spark, f"{path}/{folder}")
    finally:
        remove_folder(spark, staged)


def write_landing(df: DataFrame, path: str, valid_col: str = "is_valid",
                  cols: tuple[str, ...] = ("url", "body"), mode: str = "append") -> None:
    """Land raw responses as JSON lines, only those that parsed."""
    df.filter(valid_col).select(*cols).write.mode(mode).json(path)


def read_market_csv(spark, path: str, table: str) -> DataFrame:
    """Read a market CSV (header, ``NA`` nulls) with its declared schema."""
    from ..schemas import MARKET_TABLES
    return read_csv(spark, path, MARKET_TABLES[table])
