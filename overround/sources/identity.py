"""Identity of landed responses: which one counts, and what became of each request.

A response is named by its url (or by its text, see ``landed_records``).  Which
of several responses for one url counts is decided on rows of a few bytes for
each document, never on the selections that a document is flattened to; texts
and selections are only read again, and moved where a document really goes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import natural_join
from ..session import scratch_path

#: What becomes of a request or of a landed response (fixed values).
ANSWERED, MISSING, UNEXPECTED, REJECTED = "answered", "missing", "unexpected", "rejected"


def body_name(body: Column | str) -> Column:
    """Name of a response that has no url: its text's SHA-256; null for a null text."""
    body = F.col(body) if isinstance(body, str) else body
    return F.concat(F.lit("body:"), F.sha2(body.cast("binary"), 256))


def _written(df: DataFrame, name: str) -> DataFrame:
    """A small table in shared storage, whose size the planner then knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def current_responses(docs: DataFrame) -> DataFrame:
    """One response for each (snapshot, url) of written documents: the one landed
    last (ties: the larger text hash, then any one of equal copies).

    ``docs`` is a Parquet table ``(url, landed_at, body_hash, ...)`` as read, so
    a row's place in its file names it.  The grouped maximum reads those columns
    only; the documents themselves lose the few rows that were superseded by an
    anti join, whose right side is a written table of known size.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    keys = [c for c in ("snapshot_id", "url") if c in docs.columns]
    rank = F.struct("landed_at", "body_hash", place.alias("place"))
    landed = docs.select(*keys, rank.alias("rank"))
    best = landed.groupBy(*keys).agg(F.max("rank").alias("best"), F.count("*").alias("n")).where("n > 1").drop("n")
    stale = _written(landed.join(best, keys).where("rank != best").select("rank.place.file", "rank.place.row"), "superseded")
    if stale.isEmpty():
        return docs
    placed = docs.select("*", place.alias("_place"))
    gone = (F.col("_place.file") == F.col("file")) & (F.col("_place.row") == F.col("row"))
    return placed.join(stale, gone, "left_anti").drop("_place")


def current_documents(selections: DataFrame) -> DataFrame:
    """Selections of one response for each (agency, snapshot, url): the one landed
    last (ties: the larger text hash); a response landed again replaces the
    earlier one as a whole, and equal copies count once.  Responses without a
    url are told apart by their text hash.

    For selections that were landed before their documents could be compared
    (streaming ingest).  Every document has propositions at position 0, so those
    rows alone, summed up before they move, give a row for each document; only
    then are selections touched: superseded documents go by an anti join, and
    just the documents that came in several equal copies lose repeated rows.
    """
    doc = [*S.SNAPSHOT_KEYS, "source_url", "landed_at", "body_hash"]
    heads = selections.where("prop_pos = 0").groupBy(*doc, "match_pos", "market_pos").count()
    named = heads.groupBy(*doc).agg(F.max("count").alias("copies")).withColumn(
        "_name", F.coalesce("source_url", F.col("body_hash").cast("string")))
    keys = [*S.SNAPSHOT_KEYS, "_name"]
    latest = named.groupBy(*keys).agg(F.max(F.struct("landed_at", "body_hash")).alias("_best"))
    told = natural_join(named, latest, keys, "inner").select(
        *doc, "copies", F.struct("landed_at", "body_hash").eqNullSafe(F.col("_best")).alias("current"))
    told = _written(told.where("copies > 1 or not current"), "documents")
    counts = told.agg(F.count_if(~F.col("current")), F.count_if("current")).first()
    rows = selections
    if counts[0]:
        rows = natural_join(rows, told.where("not current").select(*doc), doc, "left_anti")
    if counts[1]:
        twice = told.where("current").select(*doc)
        once = natural_join(rows, twice, doc, "left_anti")
        rows = once.unionByName(natural_join(rows, twice, doc, "left_semi").dropDuplicates([*doc, *S.ORD]))
    return rows


def response_ledger(docs: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """What became of every request and of every landed response.

    One row for each url that was asked for or landed: ``(snapshot_id if docs
    have it, url, match_id, endpoint, n_landed, n_valid, landed_at, body_hash,
    status)``, where ``landed_at`` and ``body_hash`` are of the response that
    counts.  ``answered``: a valid response landed; ``missing``: none landed;
    ``rejected``: what landed doesn't parse; ``unexpected``: a valid response
    that nobody asked for.  Without a manifest nothing is missing or unexpected.
    Lines that are no records are named by their text.

    ``docs`` has ``url, body or body_hash, landed_at, is_valid``.  Counts and
    the latest response are aggregated before they move, so a url landed many
    times stays even; manifest and landing meet in one full join on the url.
    """
    snapshot = [c for c in ("snapshot_id",) if c in docs.columns]
    text_hash = F.col("body_hash") if "body_hash" in docs.columns else F.xxhash64("body")
    name = F.col("url") if "body" not in docs.columns else F.coalesce("url", body_name("body"))
    valid = F.coalesce(F.col("is_valid"), F.lit(False))
    landed = docs.select(*snapshot, name.alias("url"), valid.alias("valid"), F.col("landed_at"), text_hash.alias("body_hash"))
    landed = landed.groupBy(*snapshot, "url").agg(
        F.count("*").alias("n_landed"), F.count_if("valid").alias("n_valid"),
        F.max(F.when(F.col("valid"), F.struct("landed_at", "body_hash"))).alias("_last"))
    answered = F.when(F.col("n_valid") > 0, F.lit(ANSWERED)).otherwise(F.lit(REJECTED))
    out = [*snapshot, "url", "match_id", "endpoint", "n_landed", "n_valid", "_last.landed_at", "_last.body_hash", "status"]
    if manifest is None:
        none = {"match_id": F.lit(None).cast("bigint"), "endpoint": F.lit(None).cast("string")}
        return landed.withColumns({**none, "status": answered}).select(*out)
    if set(snapshot) - set(manifest.columns):
        raise ValueError("documents of several snapshots need a manifest with snapshot_id")
    asked = manifest.select(*snapshot, "url", "match_id", "endpoint", F.lit(True).alias("_asked"))
    both = asked.join(landed, [*snapshot, "url"], "full_outer")
    status = (F.when(F.col("n_landed").isNull(), F.lit(MISSING))
               .when((F.col("n_valid") > 0) & F.col("_asked").isNull(), F.lit(UNEXPECTED)).otherwise(answered))
    return both.withColumns({"status": status, "n_landed": F.coalesce("n_landed", F.lit(0)),
                             "n_valid": F.coalesce("n_valid", F.lit(0))}).select(*out)
