"""One document in one file, written by a Python data source with task and job commit.

``LandedDocuments`` takes rows ``(name, body)`` and lands each body as a file of
that name. A task writes to a folder of its own; the job's commit names the
folders of the tasks that ended well in one small file, and only those are ever
read. What a failed or repeated task wrote is removed or stays unread.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "name string, body string"
_COMMITS = "_commits"


def _open(path: str):
    """File system and plain path of a folder, in any store that Arrow knows; each process opens its own."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Landed(WriterCommitMessage):
    """What a task wrote: its folder and the number of documents."""

    folder: str
    count: int


class LandedDocuments(DataSource):
    """``df.write.format("landed_documents").mode("append").save(path)`` for rows (name, body)."""

    @classmethod
    def name(cls) -> str:
        return "landed_documents"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return DocumentWriter(self.options["path"])


class DocumentWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[Row]) -> Landed:
        system, root = _open(self.path)
        folder = f"part-{uuid.uuid4().hex}"
        count, seen = 0, set()
        try:
            system.create_dir(f"{root}/{folder}", recursive=True)
            for row in iterator:
                name = row["name"]
                if not name or name != posixpath.basename(name) or name.startswith(("_", ".")):
                    raise ValueError(f"not a file name: {name!r}")
                if name in seen:
                    raise ValueError(f"two documents are named {name!r}")
                if not row["body"]:
                    raise ValueError(f"{name!r} is empty, and readers skip empty files")
                seen.add(name)
                with system.open_output_stream(f"{root}/{folder}/{name}") as out:
                    out.write(row["body"].encode())
                count += 1
        except BaseException:
            system.delete_dir(f"{root}/{folder}")
            raise
        return Landed(folder, count)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """One new file names the folders that count; until it is there, nothing does."""
        system, root = _open(self.path)
        system.create_dir(f"{root}/{_COMMITS}", recursive=True)
        lines = [json.dumps({"folder": m.folder, "count": m.count}) for m in messages if m is not None and m.count]
        with system.open_output_stream(f"{root}/{_COMMITS}/{uuid.uuid4().hex}.json") as out:
            out.write("".join(line + "\n" for line in lines).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = _open(self.path)
        for m in messages:
            if m is not None:
                system.delete_dir(f"{root}/{m.folder}")


def land_documents(df: DataFrame, path: str, name_col: str = "name", body_col: str = "body", valid_col: str | None = None) -> None:
    """Land each body (only rows whose ``valid_col`` is true, if given) as a file of its own under ``path``.

    Names must differ within the table: rows are dealt by name first, so that
    two of one name meet in a task and stop the job, as does a document without
    text (no valid response is empty). Several calls add up.
    """
    spark = df.sparkSession
    spark.dataSource.register(LandedDocuments)
    rows = df if valid_col is None else df.where(F.coalesce(F.col(valid_col), F.lit(False)))
    rows = rows.select(F.col(name_col).alias("name"), F.col(body_col).alias("body"))
    rows.repartition("name").write.format("landed_documents").mode("append").save(path)


def read_landed_documents(spark: SparkSession, path: str) -> DataFrame:
    """(name, body) of every document that a committed job landed; a file is one row."""
    path = path.rstrip("/")
    commits = spark.read.schema("folder string, count long").json(f"{path}/{_COMMITS}")
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").format("binaryFile").load(path)
    files = files.select(F.col("_metadata.file_name").alias("name"), F.col("content").cast("string").alias("body"),
                         F.element_at(F.split("path", "/"), -2).alias("folder"))
    return files.join(commits.select("folder"), "folder", "left_semi").select("name", "body")
