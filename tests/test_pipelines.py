import json

from overround.plans import pipelines as pl
from overround.streaming import start_selection_ingest

from .fixtures import LISTING_HTML, SB_EVENT_URL, TAB_DOC, landed_lines, sb_landed


def test_run_tab_writes_every_market(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "part-0.json").write_text(landed_lines([("tab://response", json.dumps(TAB_DOC)),
                                                       ("tab://broken", '{"matches": [')]))
    out = pl.run_tab(spark, str(landing), str(tmp_path / "out"), snapshot_id="s1")
    counts = {k: spark.read.parquet(v).count() for k, v in out.items()}
    assert counts == {"tab_h2h": 2, "tab_line": 2, "tab_totals": 3, "tab_total_tries": 0,
                      "tab_player_tries": 3, "tab_first_try_scorer": 2, "tab_time_of_first_try": 1}
    assert spark.read.parquet(str(tmp_path / "out" / "rejects" / "tab")).count() == 1
    # A second snapshot lands next to the first instead of replacing it.
    pl.run_tab(spark, str(landing), str(tmp_path / "out"), snapshot_id="s2")
    snaps = pl.read_selections(spark, str(tmp_path / "out" / "selections"), "TAB")
    assert sorted(r[0] for r in snaps.select("snapshot_id").distinct().collect()) == ["s1", "s2"]


def test_run_sportsbet_writes_every_market(spark, tmp_path):
    pages = tmp_path / "pages"
    spark.createDataFrame([(1, "https://example.com/league", LISTING_HTML)],
                          "page_id bigint, url string, html string").write.parquet(str(pages))
    landing, meta = tmp_path / "landing", tmp_path / "meta"
    landing.mkdir()
    meta.mkdir()
    (landing / "part-0.json").write_text(landed_lines(sb_landed(9123456, main=True)))
    (meta / "part-0.json").write_text(landed_lines([
        (SB_EVENT_URL.format(id=9123456).replace("MarketGroupings/313/Markets", "SportCard"),
         json.dumps({"classExternalId": 1, "competitionExternalId": 2, "externalId": 3}))]))
    out = pl.run_sportsbet(spark, str(pages), str(landing), str(meta), str(tmp_path / "out"))
    counts = {k: spark.read.parquet(v).count() for k, v in out.items()}
    assert counts == {"sportsbet_h2h": 2, "sportsbet_line": 3, "sportsbet_total_points": 1,
                      "sportsbet_total_tries": 2, "sportsbet_player_tries": 2,
                      "sportsbet_first_try_scorer": 2, "sportsbet_time_of_first_try": 1}


def test_streaming_ingest_matches_batch(spark, tmp_path):
    landing = tmp_path / "landing" / "snapshot_id=s1"
    landing.mkdir(parents=True)
    (landing / "a.json").write_text(landed_lines([("tab://a", json.dumps(TAB_DOC))]))
    (landing / "b.json").write_text(landed_lines([("tab://b", '{"matches": [')]))
    q = start_selection_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "sel"), "tab",
                               checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    sel = pl.read_selections(spark, str(tmp_path / "sel"), "TAB", "s1")
    assert sel.count() == 24
    assert sel.select("source_url").distinct().count() == 1
    from overround.streaming import start_reject_ingest
    r = start_reject_ingest(spark, str(tmp_path / "landing"), str(tmp_path / "rej"), "tab",
                            checkpoint=str(tmp_path / "ckpt-rej"))
    r.awaitTermination(120)
    rej = spark.read.parquet(str(tmp_path / "rej")).collect()
    assert [(x["snapshot_id"], x["url"]) for x in rej] == [("s1", "tab://b")]


def test_command_line_tab_run_writes_csv(spark, tmp_path):
    from overround.__main__ import main
    from overround.sources import read_market_csv

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "part-0.json").write_text(landed_lines([("tab://response", json.dumps(TAB_DOC))]))
    # main() reuses the running session and leaves it running.
    assert main(["tab", "--landing", str(landing), "--out", str(tmp_path / "out"), "--snapshot", "s9",
                 "--format", "csv"]) == 0
    h2h = read_market_csv(spark, str(tmp_path / "out" / "tab_h2h" / "snapshot_id=s9"), "tab_h2h")
    assert h2h.count() == 2


def test_ingest_then_refresh_keeps_snapshots_apart(spark, tmp_path):
    from overround.plans.pipelines import refresh_tab_markets

    root, sel_path, out = tmp_path / "landing", str(tmp_path / "sel"), str(tmp_path / "markets")
    for i, snap in enumerate(("s1", "s2")):
        d = root / f"snapshot_id={snap}"
        d.mkdir(parents=True)
        (d / "a.json").write_text(landed_lines([(f"tab://{snap}", json.dumps(TAB_DOC))]))
        # Run after each landing: the second run picks up only the new file.
        q = start_selection_ingest(spark, str(root), sel_path, "tab", checkpoint=str(tmp_path / "ckpt"))
        q.awaitTermination(120)
        assert pl.read_selections(spark, sel_path, "TAB").count() == 24 * (i + 1)
    refresh_tab_markets(spark, sel_path, out)
    h2h = spark.read.parquet(f"{out}/tab_h2h")
    assert sorted((r["snapshot_id"], r["n"]) for r in h2h.groupBy("snapshot_id").count()
                  .withColumnRenamed("count", "n").collect()) == [("s1", 2), ("s2", 2)]
    # Refreshing one snapshot leaves the other in place.
    refresh_tab_markets(spark, sel_path, out, snapshot_ids=["s2"])
    assert spark.read.parquet(f"{out}/tab_h2h").count() == 4


def test_sportsbet_ingest_then_refresh(spark, tmp_path):
    from overround.plans.pipelines import refresh_sportsbet_markets

    root, sel_path, out = tmp_path / "landing", str(tmp_path / "sel"), str(tmp_path / "markets")
    for snap in ("s1", "s2"):
        d = root / f"snapshot_id={snap}"
        d.mkdir(parents=True)
        lines = [x for x in sb_landed(9123456) if "/112/" not in x[0]]
        (d / "a.json").write_text(landed_lines(lines))
    q = start_selection_ingest(spark, str(root), sel_path, "sportsbet", checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    pages = str(tmp_path / "pages")
    spark.createDataFrame([(1, "u", LISTING_HTML, "s1"), (2, "u", LISTING_HTML, "s2")],
                          "page_id bigint, url string, html string, snapshot_id string").write.parquet(pages)
    meta = tmp_path / "meta"
    meta.mkdir()
    (meta / "a.json").write_text(landed_lines([(SB_EVENT_URL.format(id=9123456), "{}")]))
    paths = refresh_sportsbet_markets(spark, sel_path, pages, str(meta), out)
    checked = ("sportsbet_h2h", "sportsbet_line", "sportsbet_time_of_first_try")
    counts = {k: sorted((r[0], r[1]) for r in spark.read.parquet(paths[k]).groupBy("snapshot_id").count().collect())
              for k in checked}
    assert counts["sportsbet_h2h"] == [("s1", 2), ("s2", 2)]
    assert counts["sportsbet_line"] == [("s1", 3), ("s2", 3)]
    assert counts["sportsbet_time_of_first_try"] == [("s1", 1), ("s2", 1)]
    refresh_sportsbet_markets(spark, sel_path, pages, str(meta), out, snapshot_ids=["s1"])
    assert spark.read.parquet(paths["sportsbet_line"]).count() == 6
    # The fixture has no player-tries document: the empty market still reads, typed.
    empty = pl.read_market(spark, out, "sportsbet_player_tries", keyed=True)
    assert empty.count() == 0 and "player_id_unders" in empty.columns
    line = pl.read_market(spark, out, "sportsbet_line", keyed=True)
    assert line.count() == 6 and line.schema["home_line"].dataType.typeName() == "double"


def test_command_line_sportsbet_run(spark, tmp_path):
    from overround.__main__ import main

    pages = str(tmp_path / "pages")
    spark.createDataFrame([(1, "https://example.com/league", LISTING_HTML)],
                          "page_id bigint, url string, html string").write.parquet(pages)
    landing, meta = tmp_path / "landing", tmp_path / "meta"
    landing.mkdir()
    meta.mkdir()
    (landing / "a.json").write_text(landed_lines(sb_landed(9123456)))
    (meta / "a.json").write_text(landed_lines([(SB_EVENT_URL.format(id=9123456), "{}")]))
    assert main(["sportsbet", "--pages", pages, "--landing", str(landing), "--metadata", str(meta),
                 "--out", str(tmp_path / "out"), "--snapshot", "s3"]) == 0
    out = tmp_path / "out"
    assert pl.read_market(spark, str(out), "sportsbet_h2h").count() == 2
    assert spark.read.parquet(str(out / "sportsbet_line" / "snapshot_id=s3")).count() == 3
