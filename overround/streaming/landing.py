"""Incremental ingestion of the landing zone with Structured Streaming.

New landing files (JSON lines ``{url, body}``) are parsed with the same
batch operators into canonical selections and appended to the selections
table; rejects go to their own table.  One stream covers the whole landing
root; the snapshot id of a file comes from its folder
(``<root>/snapshot_id=<id>/...``), so snapshots never need separate streams.  ``availableNow`` processes whatever
has landed and stops, so a scheduler can run it after each fetch; the
progress folder next to the table makes reruns exactly-once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..sources import landed_records, parse_documents, sportsbet_selections, tab_selections

_PARSERS = {
    "tab": (S.TAB_RESPONSE, tab_selections),
    "sportsbet": (S.SB_MARKETS_RESPONSE, sportsbet_selections),
}


SNAPSHOT_FROM_PATH = r"snapshot_id=([^/]+)"


def landed_stream(spark: SparkSession, landing_dir: str, max_files: int = 1000) -> DataFrame:
    """Landing records of every file under ``landing_dir`` (recursively),
    with the snapshot id read from the file's folder.  ``max_files`` paces the
    micro-batches only: every file is read, in one batch or a later one."""
    snap = F.regexp_extract(F.col("_metadata.file_path"), SNAPSHOT_FROM_PATH, 1)
    lines = (spark.readStream.option("maxFilesPerTrigger", max_files)
                  .option("recursiveFileLookup", True).text(landing_dir))
    return (landed_records(lines, keep=("_metadata",))
            .withColumn("snapshot_id", F.coalesce(F.nullif(snap, F.lit("")), F.lit("latest"))).drop("_metadata"))


def selection_stream(spark: SparkSession, landing_dir: str, kind: str,
                     manifest: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(selections, rejects) as streaming DataFrames.  ``manifest`` (url, match_id,
    endpoint) gives Sportsbet-style responses their match and endpoint."""
    schema, to_selections = _PARSERS[kind]
    docs = parse_documents(landed_stream(spark, landing_dir), schema)
    good = docs.filter("is_valid")
    rejects = docs.filter("NOT is_valid").select("snapshot_id", "url", "body")
    known = {"manifest": manifest} if manifest is not None else {}
    sel = to_selections(good, snapshot_id=F.col("snapshot_id"), **known)
    return sel.select(*S.SELECTION_COLUMNS), rejects


def start_selection_ingest(spark: SparkSession, landing_dir: str, selections_path: str, kind: str,
                           checkpoint: str | None = None, available_now: bool = True,
                           manifest: DataFrame | None = None) -> StreamingQuery:
    """Append parsed selections to Parquet partitioned by (agency, snapshot).

    The progress lies next to the table, so a later session goes on where this
    one ended, unless ``checkpoint`` names another shared folder."""
    sel, _ = selection_stream(spark, landing_dir, kind, manifest)
    ckpt = checkpoint or f"{selections_path.rstrip('/')}-progress-{kind}"
    writer = (sel.writeStream.format("parquet").outputMode("append")
                 .partitionBy(*S.SNAPSHOT_KEYS)
                 .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(selections_path)


def start_reject_ingest(spark: SparkSession, landing_dir: str, rejects_path: str, kind: str,
                        checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Land the responses that do not parse (``snapshot_id, url, body``),
    exactly once, next to the selections.  A separate query because each file
    sink keeps its own commit log; it re-reads only the validity of each new
    landing file."""
    _, rejects = selection_stream(spark, landing_dir, kind)
    ckpt = checkpoint or f"{rejects_path.rstrip('/')}-progress-{kind}"
    writer = (rejects.writeStream.format("parquet").outputMode("append")
                     .partitionBy("snapshot_id").option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(rejects_path)
