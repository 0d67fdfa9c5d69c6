"""JSON document sources: landed responses -> parsed documents -> selections.

Responses are landed as JSON lines ``{"url": ..., "body": "<raw text>"}``
(splittable, so a 100 TB landing zone spreads over all executors), or as
one whole file per response.  Bodies are parsed with a fixed schema;
malformed bodies become rejects instead of failing the job (the batch
equivalent of wrapping each request in an error guard).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import as_numeric, url_match_id
from ..operators import lookup_join, unnest_path
from .identity import body_name
from .manifest import url_endpoint


def read_nested_json(spark: SparkSession, path: str | list[str], schema: T.StructType,
                     multi_line: bool = True) -> DataFrame:
    """Nested JSON documents read with an explicit schema (no inference)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def landed_records(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines of landing files -> ``(url, body, landed_at, keep...)``.

    A record without a url is named by its text (``body:<SHA-256>``), so two of
    them are two documents and equal ones are one.  A line that is no landing
    record (broken JSON, or without a body) keeps its text as ``body`` and fails
    the parse later, so its text reaches the rejects.
    """
    record = F.from_json("value", S.LANDED_RESPONSE)
    rows = lines.where(F.trim("value") != "").withColumn("_r", record)
    return rows.select(F.coalesce("_r.url", body_name("_r.body")).alias("url"), F.coalesce("_r.body", "value").alias("body"),
                       F.col("_metadata.file_modification_time").alias("landed_at"),
                       F.col("_r.body").isNotNull().alias("is_record"), *keep)


def read_landed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landing records ``(url, body, landed_at, is_record)`` from JSON-lines
    files; ``snapshot_id=`` folders add that column."""
    lines = spark.read.text(path)
    return landed_records(lines, tuple(c for c in lines.columns if c != "value"))


def read_whole_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file ``(url = file path, body = file text)``: documents landed
    as they came, pretty-printed or not."""
    return (spark.read.text(path, wholetext=True)
                 .select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("body"),
                         F.col("_metadata.file_modification_time").alias("landed_at"), F.lit(True).alias("is_record")))


def parse_documents(df: DataFrame, schema: T.DataType | str, body_col: str = "body",
                    doc_col: str = "doc") -> DataFrame:
    """Parse ``body`` with a fixed schema; adds ``doc`` and ``is_valid``.

    Only broken JSON, or a root of the other kind (an error object where a
    list belongs), makes a document invalid.  A field whose value has an
    unexpected type becomes null and the rest of the document is kept (the
    feed's field is missing, not the response): Spark's from_json returns
    partial results for that.  Array-rooted bodies that do not parse give
    null; for object-rooted bodies syntax is checked with
    ``json_object_keys`` (null for malformed text or a non-object).
    ``schema`` may be a DataType or a DDL string.
    """
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    parsed = F.from_json(F.col(body_col), schema)
    if isinstance(schema, T.StructType):
        valid = F.json_object_keys(F.col(body_col)).isNotNull()
    else:
        # from_json wraps a lone object into a list: the root must be a list itself.
        valid = parsed.isNotNull() & F.col(body_col).rlike(r"^\s*\[")
    if "is_record" in df.columns:
        valid = valid & F.col("is_record")
    return (df.withColumn("is_valid", F.coalesce(valid, F.lit(False)))
              .withColumn(doc_col, F.when(F.col("is_valid"), parsed)))


def quarantine_split(df: DataFrame, valid_col: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """(good, rejects).  A bad source contributes nothing to ``good`` and
    lands in ``rejects`` with its raw text, the rest go on."""
    flag = F.coalesce(F.col(valid_col), F.lit(False))
    return df.filter(flag), df.filter(~flag)


def _origin(docs: DataFrame) -> list[F.Column]:
    """When a document was landed and the hash of its text, where they are known."""
    none = F.lit(None)
    return [(F.col("landed_at") if "landed_at" in docs.columns else none.cast("timestamp")).alias("landed_at"),
            (F.col("body_hash") if "body_hash" in docs.columns else F.xxhash64("body") if "body" in docs.columns
             else none.cast("bigint")).alias("body_hash")]


def _snapshot(snapshot_id) -> F.Column:
    return F.lit(snapshot_id) if isinstance(snapshot_id, str) else snapshot_id


def tab_selections(docs: DataFrame, agency: str = "TAB", snapshot_id: str | F.Column = "latest",
                   doc_col: str = "doc", url_col: str = "url") -> DataFrame:
    """TAB-style documents -> canonical selections.

    Two-level ordered flatten (match -> market -> proposition); empty lists
    give no row; positions are kept as the only total order.
    """
    flat = unnest_path(
        docs.select(F.col(url_col).alias("source_url"), _snapshot(snapshot_id).alias("snapshot_id"),
                    F.col(f"{doc_col}.matches").alias("matches"), *_origin(docs)),
        [
            ("matches", "match_pos", "_m",
             [("name", "match"), ("startTime", "start_time"), "markets"]),
            ("markets", "market_pos", "_k", [("betOption", "market_name"), "propositions"]),
            ("propositions", "prop_pos", "_p",
             [("id", "prop_id"), ("name", "prop_name"), ("returnWin", "price")]),
        ],
        keep=["source_url", "snapshot_id", "landed_at", "body_hash"],
    )
    return flat.select(
        F.lit(agency).alias("agency"),
        "snapshot_id",
        "match_pos", "market_pos", "prop_pos",
        F.lit(None).cast("bigint").alias("match_id"),
        "match", "start_time", "market_name",
        F.lit(None).cast("bigint").alias("market_id"),
        "prop_id", "prop_name",
        F.lit(None).cast("string").alias("result_type"),
        "price",
        F.lit(None).cast("double").alias("handicap"),
        "source_url",
        F.lit(None).cast("string").alias("endpoint"),
        "landed_at", "body_hash",
    )


def sportsbet_selections(docs: DataFrame, manifest: DataFrame | None = None,
                         agency: str = "Sportsbet", snapshot_id: str | F.Column = "latest",
                         doc_col: str = "doc", url_col: str = "url") -> DataFrame:
    """Sportsbet-style market documents (array of markets per URL) ->
    canonical selections.

    The match id and the endpoint come from the request manifest ``(url,
    match_id, endpoint)``, exact for ids of any length.  Without one the
    endpoint is told from the URL's path, and the id is the first run of 6-8
    digits in the URL, which fits such ids only.  A missing optional
    field (handicap, price) is null and the row is kept.
    """
    flat = unnest_path(
        docs.select(F.col(url_col).alias("source_url"), _snapshot(snapshot_id).alias("snapshot_id"),
                    F.col(doc_col).alias("markets"), *_origin(docs)),
        [
            ("markets", "market_pos", "_k",
             [("name", "market_name"), ("externalId", "market_id"), "selections"]),
            ("selections", "prop_pos", "_s",
             [("name", "prop_name"), ("resultType", "result_type"), ("externalId", "prop_id"),
              ("unformattedHandicap", "_handicap_text"), ("price.winPrice", "price")]),
        ],
        keep=["source_url", "snapshot_id", "landed_at", "body_hash"],
    )
    if manifest is not None:
        flat = lookup_join(flat, manifest.select(F.col("url").alias("source_url"), "match_id", "endpoint"),
                           on="source_url")
    else:
        flat = flat.withColumn("match_id", url_match_id("source_url")).withColumn(
            "endpoint", url_endpoint("source_url"))
    return flat.select(
        F.lit(agency).alias("agency"),
        "snapshot_id",
        F.lit(0).alias("match_pos"), "market_pos", "prop_pos",
        "match_id",
        F.lit(None).cast("string").alias("match"),
        F.lit(None).cast("string").alias("start_time"),
        "market_name", "market_id", "prop_id", "prop_name", "result_type", "price",
        as_numeric("_handicap_text").alias("handicap"),
        "source_url", "endpoint", "landed_at", "body_hash",
    )


def event_metadata(docs: DataFrame, manifest: DataFrame | None = None,
                   doc_col: str = "doc", url_col: str = "url") -> DataFrame:
    """Event-metadata documents -> ``(match_id, class_external_id,
    competition_external_id, event_external_id)``, led by ``snapshot_id`` where
    the documents have one: a row for each event document."""
    key = ["snapshot_id"] if "snapshot_id" in docs.columns else []
    out = docs.select(
        *key, F.col(url_col).alias("source_url"),
        F.col(f"{doc_col}.classExternalId").alias("class_external_id"),
        F.col(f"{doc_col}.competitionExternalId").alias("competition_external_id"),
        F.col(f"{doc_col}.externalId").alias("event_external_id"),
    )
    if manifest is not None:
        out = lookup_join(out, manifest.select(F.col("url").alias("source_url"), "match_id"),
                          on="source_url")
    else:
        out = out.withColumn("match_id", url_match_id("source_url"))
    return out.select(*key, "match_id", "class_external_id", "competition_external_id",
                      "event_external_id")
