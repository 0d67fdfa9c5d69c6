"""Runs of several market tables that don't depend on each other's success.

Each table is written to a staging folder and renamed into its place when it is
complete, so readers see the last complete table and a failure changes nothing.
What became of each table is a row of ``<out>/run_ledger``: which run, feed and
snapshot, how many rows, how long it took, or the error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import remove_folder, replace_partitions, swap_in

LEDGER = ("run_id string, agency string, snapshot_id string, market string, status string, n_rows long, path string, "
          "error string, started timestamp, ended timestamp")
WRITTEN, FAILED = "written", "failed"


def _observed(seen: Observation) -> int:
    """The observed number of rows; the planner drops the count of a table that it knows to be empty."""
    try:
        return seen.get.get("n", 0)
    except Py4JError:
        return 0


class MarketRun:
    """One run over the tables of a feed: ``table`` or ``partitions`` for each, then ``close``."""

    def __init__(self, spark: SparkSession, out_dir: str, agency: str, snapshot_id: str | None) -> None:
        self.spark, self.out_dir, self.agency, self.snapshot_id = spark, out_dir.rstrip("/"), agency, snapshot_id
        self.run_id = uuid.uuid4().hex[:12]
        self.rows: list[tuple] = []
        self.paths: dict[str, str] = {}

    def _attempt(self, name: str, build: Callable[[], DataFrame], path: str, write: Callable[[DataFrame], None]) -> bool:
        """Build and write one table; whatever goes wrong with it is a row of the ledger.

        Rows are counted while they are written, not by a job of their own.
        """
        started, seen = datetime.now(timezone.utc), Observation()
        try:
            write(build().observe(seen, F.count(F.lit(1)).alias("n")))
            n, error = _observed(seen), None
            self.paths[name] = path
        except Exception as exc:  # noqa: BLE001 - any failure of one market must not stop the others
            n, error = None, f"{type(exc).__name__}: {exc}"[:2000]
        self.rows.append((self.run_id, self.agency, self.snapshot_id, name, FAILED if error else WRITTEN, n, path, error,
                          started, datetime.now(timezone.utc)))
        return error is None

    def table(self, name: str, build: Callable[[], DataFrame], path: str, write: Callable[[DataFrame, str], None]) -> bool:
        """A table that takes the place of the folder ``path``; false where it failed."""
        def staged(df: DataFrame) -> None:
            folder = f"{self.out_dir}/_staging/{self.run_id}/{name}"
            write(df, folder)
            swap_in(self.spark, folder, path)

        return self._attempt(name, build, path, staged)

    def partitions(self, name: str, build: Callable[[], DataFrame], path: str, partition_by: tuple[str, ...],
                   replaced: Sequence[Mapping[str, str]] | None) -> bool:
        """A table whose ``replaced`` partitions (all if None) are written anew; false where it failed."""
        return self._attempt(name, build, path, lambda df: replace_partitions(df, path, partition_by, replaced))

    def ledger(self) -> DataFrame:
        """The rows so far."""
        return self.spark.createDataFrame(self.rows, LEDGER)

    def close(self) -> dict[str, str]:
        """Append to the ledger; returns the paths of the tables that were written."""
        remove_folder(self.spark, f"{self.out_dir}/_staging/{self.run_id}")
        self.ledger().coalesce(1).write.mode("append").parquet(f"{self.out_dir}/run_ledger")
        return self.paths


def read_run_ledger(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(f"{out_dir.rstrip('/')}/run_ledger")
