"""End-to-end batch runs: landed responses -> selections -> market tables.

Each market table is written under ``<out>/<market>/snapshot_id=<id>`` so
snapshots accumulate side by side.  The canonical ``selections`` table is
written once (Parquet, partitioned by
agency and snapshot) to shared storage and every market is built from that
written table.  Writing it cuts the lineage, so a lost executor re-reads
files instead of re-parsing every response, and each market job prunes to
its snapshot through partition pruning.  Market tables are independent
jobs (``runs.MarketRun``); none is a driver-side loop over matches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources import (
    current_documents, current_responses, event_metadata, listing_cards, listing_rejects, parse_documents,
    quarantine_split, read_landed, read_pages, read_whole_files, replace_partitions, response_ledger,
    sportsbet_selections, tab_selections, url_manifest, write_csv, write_parquet,
)
from ..sources.identity import UNEXPECTED
from ..sources.manifest import DEFAULT_TEMPLATE
from . import markets as mk
from .runs import MarketRun

TAB_MARKETS: Mapping[str, Callable[..., DataFrame]] = {
    "tab_h2h": mk.h2h_nth,
    "tab_line": mk.line_opposite,
    "tab_totals": mk.totals_dedup,
    "tab_total_tries": partial(mk.totals_dedup, markets=("Total Tries Over/Under", "Pick Your Own Tries"),
                               label="Total Tries"),
    "tab_player_tries": mk.tab_player_lines,
    "tab_first_try_scorer": mk.tab_outright,
    "tab_time_of_first_try": mk.tab_time_threshold,
}


#: Endpoint whose responses each market is read from (fixed values).
SPORTSBET_ROUTES: Mapping[str, str] = {
    "sportsbet_line": "line",
    "sportsbet_total_points": "total_points",
    "sportsbet_total_tries": "total_tries",
    "sportsbet_player_tries": "player_tries",
    "sportsbet_first_try_scorer": "player_tries",
    "sportsbet_time_of_first_try": "time_of_first_try",
}


def land_selections(selections: DataFrame, path: str, agency: str, snapshot_id: str) -> None:
    """Write one snapshot's selections as the whole content of its partition
    (agency, snapshot_id), also when there are none; others stay."""
    rows = selections.select(*S.SELECTION_COLUMNS)
    replace_partitions(rows, path, S.SNAPSHOT_KEYS, [{"agency": agency, "snapshot_id": snapshot_id}])


def read_selections(spark: SparkSession, path: str, agency: str | None = None,
                    snapshot_id: str | None = None) -> DataFrame:
    """The persisted selections, pruned to one agency / snapshot when given
    (partition pruning: only those folders are listed and read)."""
    df = spark.read.schema(S.SELECTIONS).parquet(path)
    if agency is not None:
        df = df.filter(F.col("agency") == agency)
    if snapshot_id is not None:
        df = df.filter(F.col("snapshot_id") == snapshot_id)
    return df


def _landed(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Responses landed as JSON ``lines`` of (url, body), or as whole ``files``."""
    if layout not in ("lines", "files"):
        raise ValueError(f"landing layout {layout!r} is neither 'lines' nor 'files'")
    return read_landed(spark, path) if layout == "lines" else read_whole_files(spark, path)


def _parsed(spark: SparkSession, landing: str, layout: str, schema, rejects_path: str,
            work_path: str) -> tuple[DataFrame, DataFrame]:
    """(all documents, the valid ones that count), parsed once into shared storage;
    the rejects are written with their text."""
    docs = parse_documents(_landed(spark, landing, layout), schema)
    docs.drop("is_record").withColumn("body_hash", F.xxhash64("body")).write.mode("overwrite").parquet(work_path)
    landed = spark.read.parquet(work_path)
    good, rejects = quarantine_split(landed)
    _write(rejects.select("url", "body"), rejects_path, "parquet")
    return landed, current_responses(good)


def _write(df: DataFrame, path: str, fmt: str) -> None:
    if fmt == "csv":
        write_csv(df, path)
    else:
        write_parquet(df, path)


def run_tab(spark: SparkSession, landing: str, out_dir: str, snapshot_id: str = "latest",
            fmt: str = "parquet", layout: str = "lines") -> dict[str, str]:
    """TAB run: parse landed responses, quarantine bad ones, land the
    selections, then write every TAB market table.

    ``responses`` says of every landed response what became of it, ``run_ledger``
    of every market; a market that fails leaves its last table and doesn't stop
    the others.  Returns the paths of the markets that were written."""
    landed, good = _parsed(spark, landing, layout, S.TAB_RESPONSE, f"{out_dir}/rejects/tab/snapshot_id={snapshot_id}",
                           f"{out_dir}/documents/tab/snapshot_id={snapshot_id}")
    _write(response_ledger(landed), f"{out_dir}/responses/tab/snapshot_id={snapshot_id}", "parquet")
    land_selections(tab_selections(good, snapshot_id=snapshot_id), f"{out_dir}/selections", "TAB", snapshot_id)
    sel = read_selections(spark, f"{out_dir}/selections", "TAB", snapshot_id)
    run = MarketRun(spark, out_dir, "TAB", snapshot_id)
    for name, build in TAB_MARKETS.items():
        run.table(name, partial(build, sel), f"{out_dir}/{name}/snapshot_id={snapshot_id}", partial(_write, fmt=fmt))
    return run.close()


def sportsbet_teams(cards: DataFrame) -> DataFrame:
    """One teams row for each match (and snapshot) of the listing cards: the first
    card by page and position."""
    keep = [c for c in ("snapshot_id", "page_id", "card_pos") if c in cards.columns]
    named = cards.select(*keep, "match_id", F.get("participants", 0).alias("home_team"),
                         F.get("participants", 1).alias("away_team"))
    first = mk.one_per_match(named, ("page_id", "card_pos"))
    return mk.canonical_teams_dim(first)


def _metadata(good: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row of event ids for each match (and snapshot), in a stated order of ids."""
    ids = ("event_external_id", "class_external_id", "competition_external_id")
    found = event_metadata(good, manifest)
    ordered = found.withColumns({f"_{c}": F.col(c) for c in ids})
    return mk.one_per_match(ordered, tuple(f"_{c}" for c in ids))


def sportsbet_builders(sel: DataFrame, teams: DataFrame, meta: DataFrame,
                       with_keys: bool = False) -> Mapping[str, Callable[[], DataFrame]]:
    """Builders of the markets that come from responses, each over its endpoint's."""
    def rows(name: str, df: DataFrame) -> DataFrame:
        return mk.routed(df, SPORTSBET_ROUTES[name])

    def enriched(name: str) -> DataFrame:
        return mk.enrich_selections(rows(name, sel), teams, meta)

    return {
        "sportsbet_line": lambda: mk.line_balanced(rows("sportsbet_line", sel), teams, with_keys=with_keys),
        "sportsbet_total_points": lambda: mk.over_under(rows("sportsbet_total_points", sel), teams, with_keys=with_keys),
        "sportsbet_total_tries": lambda: mk.over_under(
            rows("sportsbet_total_tries", sel), teams, market_re="Total Match Tries", over_re="Over",
            under_re="Under", label="Total Tries", with_keys=with_keys),
        "sportsbet_player_tries": lambda: mk.sb_player_tries(enriched("sportsbet_player_tries"), with_keys=with_keys),
        "sportsbet_first_try_scorer": lambda: mk.sb_outright(enriched("sportsbet_first_try_scorer"), with_keys=with_keys),
        "sportsbet_time_of_first_try": lambda: mk.sb_time_threshold(
            enriched("sportsbet_time_of_first_try"), with_keys=with_keys),
    }


def run_sportsbet(spark: SparkSession, pages_path: str, landing: str, metadata_landing: str,
                  out_dir: str, snapshot_id: str = "latest", fmt: str = "parquet",
                  base: str = "https://api.example.com/sportsbook",
                  template: str = DEFAULT_TEMPLATE) -> dict[str, str]:
    """Sportsbet run: listing pages give the head-to-head table, the teams and
    the request manifest (``base`` and ``template`` as the fetcher used them);
    landed market responses give the selections, matched by the manifest.

    Teams and event ids are written once and read by every market; pages whose
    cards and links differ in number, responses that don't parse, and responses
    that the manifest didn't ask for, go to ``rejects``.  ``responses`` says of
    every request and response what became of it, ``run_ledger`` of every market;
    a market that fails leaves its last table and doesn't stop the others."""
    def part(name: str) -> str:
        return f"{out_dir}/{name}/snapshot_id={snapshot_id}"

    pages = read_pages(spark, pages_path)
    cards = listing_cards(pages)
    run, write = MarketRun(spark, out_dir, "Sportsbet", snapshot_id), partial(_write, fmt=fmt)
    _write(listing_rejects(pages), part("rejects/sportsbet_pages"), "parquet")
    run.table("sportsbet_h2h", lambda: mk.h2h_positional(cards), part("sportsbet_h2h"), write)
    _write(sportsbet_teams(cards), part("teams/sportsbet"), "parquet")
    teams = spark.read.parquet(part("teams/sportsbet"))
    manifest = url_manifest(teams.select("match_id").distinct(), base=base, template=template)

    landed, good = _parsed(spark, landing, "lines", S.SB_MARKETS_RESPONSE, part("rejects/sportsbet"),
                           part("documents/sportsbet"))
    _write(response_ledger(landed, manifest), part("responses/sportsbet"), "parquet")
    unasked = spark.read.parquet(part("responses/sportsbet")).where(F.col("status") == UNEXPECTED).select("url")
    _write(good.join(unasked, "url", "left_semi").select("url", "body"), part("rejects/sportsbet_unexpected"), "parquet")
    sel = sportsbet_selections(good, manifest, snapshot_id=snapshot_id)
    land_selections(sel, f"{out_dir}/selections", "Sportsbet", snapshot_id)
    sel = read_selections(spark, f"{out_dir}/selections", "Sportsbet", snapshot_id)
    _, events = _parsed(spark, metadata_landing, "lines", S.SB_EVENT_METADATA, part("rejects/sportsbet_metadata"),
                        part("documents/sportsbet_metadata"))
    _write(_metadata(events, manifest), part("event_meta/sportsbet"), "parquet")
    meta = spark.read.parquet(part("event_meta/sportsbet"))
    for name, build in sportsbet_builders(sel, teams, meta).items():
        run.table(name, build, part(name), write)
    return run.close()


def refresh_tab_markets(spark: SparkSession, selections_path: str, out_dir: str,
                        snapshot_ids: Sequence[str] | None = None) -> dict[str, str]:
    """Rebuild every TAB market for the given snapshots (all when None) in
    one job per market, keyed by (agency, snapshot_id).

    Market tables are written partitioned by (agency, snapshot_id) with
    dynamic overwrite, so refreshed snapshots are replaced and the others
    are untouched.  Partition pruning limits the scan to those snapshots.
    Pairs with ``streaming.start_selection_ingest``: ingest, then refresh.
    """
    sel = read_selections(spark, selections_path, "TAB")
    if snapshot_ids is not None:
        sel = sel.filter(F.col("snapshot_id").isin(list(snapshot_ids)))
    sel = current_documents(sel)
    replaced = _partitions("TAB", snapshot_ids)
    run = MarketRun(spark, out_dir, "TAB", ",".join(snapshot_ids) if snapshot_ids is not None else None)

    def keyed(build: Callable[..., DataFrame], **kwargs) -> DataFrame:
        out = build(sel, with_keys=True, **kwargs)
        return out if "agency" in out.columns else out.withColumn("agency", F.lit("TAB"))

    for name, build in TAB_MARKETS.items():
        kwargs = {"sort": False} if name in ("tab_totals", "tab_total_tries", "tab_player_tries",
                                             "tab_first_try_scorer") else {}
        run.partitions(name, partial(keyed, build, **kwargs), f"{out_dir}/{name}", S.SNAPSHOT_KEYS, replaced)
    return run.close()


def _partitions(agency: str, snapshot_ids: Sequence[str] | None) -> list[dict[str, str]] | None:
    return None if snapshot_ids is None else [{"agency": agency, "snapshot_id": s} for s in snapshot_ids]


def refresh_sportsbet_markets(spark: SparkSession, selections_path: str, pages_path: str,
                              metadata_landing: str, out_dir: str,
                              snapshot_ids: Sequence[str] | None = None,
                              base: str = "https://api.example.com/sportsbook",
                              template: str = DEFAULT_TEMPLATE) -> dict[str, str]:
    """Rebuild every Sportsbet market for the given snapshots (all when
    None), keyed by (agency, snapshot_id), without a driver-side loop.

    ``pages_path`` holds listing pages with a ``snapshot_id`` column, and so may
    the metadata landing (as folders).  Teams and event ids are one row for each
    snapshot and match; metadata without a snapshot serve all.  The selections
    carry match id and endpoint from the ingest's manifest.
    """
    pages = read_pages(spark, pages_path)
    if "snapshot_id" not in pages.columns:
        pages = pages.withColumn("snapshot_id", F.lit("latest"))
    sel = read_selections(spark, selections_path, "Sportsbet")
    if snapshot_ids is not None:
        wanted = list(snapshot_ids)
        pages = pages.filter(F.col("snapshot_id").isin(wanted))
        sel = sel.filter(F.col("snapshot_id").isin(wanted))
    sel = current_documents(sel)
    cards = listing_cards(pages, keep=("snapshot_id", "page_id"))
    teams = sportsbet_teams(cards)
    manifest = url_manifest(teams.select("match_id").distinct(), base=base, template=template)
    events, bad = quarantine_split(parse_documents(read_landed(spark, metadata_landing), S.SB_EVENT_METADATA))
    _write(bad.select("url", "body"), f"{out_dir}/rejects/sportsbet_metadata", "parquet")
    builders = {"sportsbet_h2h": lambda: mk.h2h_positional(cards, keep=("snapshot_id",)),
                **sportsbet_builders(sel, teams, _metadata(events, manifest), with_keys=True)}
    run = MarketRun(spark, out_dir, "Sportsbet", ",".join(snapshot_ids) if snapshot_ids is not None else None)
    for name, build in builders.items():
        run.partitions(name, build, f"{out_dir}/{name}", S.SNAPSHOT_KEYS, _partitions("Sportsbet", snapshot_ids))
    return run.close()


def read_market(spark: SparkSession, out_dir: str, name: str, keyed: bool = False) -> DataFrame:
    """Read a market table with its declared schema, so an empty market (no
    files written) still reads as an empty table.  ``keyed`` adds the
    ``snapshot_id`` partition column of the refresh layout."""
    from pyspark.sql import types as T

    schema = S.MARKET_TABLES[name]
    if keyed:
        schema = T.StructType([*schema.fields, T.StructField("snapshot_id", T.StringType())])
    return spark.read.schema(schema).parquet(f"{out_dir}/{name}")
