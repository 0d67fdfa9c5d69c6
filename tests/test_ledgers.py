"""What became of each response and each market; failures leave what was there."""

import json
import os

import pytest
from pyspark.sql import functions as F

from overround import schemas as S
from overround.plans import pipelines as pl
from overround.plans.runs import MarketRun, read_run_ledger
from overround.sources import (
    current_documents, current_responses, parse_documents, read_landed, replace_partitions, response_ledger, sinks,
    tab_selections,
)

from .fixtures import LISTING_HTML, SB_EVENT_URL, TAB_DOC, sb_landed
from .test_identity import head_to_head, land, run_sportsbet


def landed(spark, tmp_path, records, name="a.json", at=None):
    land(tmp_path / "tab", records, name)
    if at:
        os.utime(tmp_path / "tab" / name, (at, at))
    return parse_documents(read_landed(spark, str(tmp_path / "tab")), S.TAB_RESPONSE)


def written(docs, path):
    docs.withColumn("body_hash", F.xxhash64("body")).write.mode("overwrite").parquet(path)
    return docs.sparkSession.read.parquet(path)


def test_responses_without_a_url_all_stay(spark, tmp_path):
    bodies = [head_to_head(1.0 + k, 2.5) for k in range(3)]
    docs = landed(spark, tmp_path, [(None, b) for b in [*bodies, bodies[0]]])
    for sel in (current_documents(tab_selections(docs)),
                tab_selections(current_responses(written(docs, str(tmp_path / "w")).where("is_valid")))):
        assert sorted(r["price"] for r in sel.collect()) == [1.0, 2.0, 2.5, 2.5, 2.5, 3.0]
        assert sel.select("source_url").distinct().count() == 3


def test_the_response_landed_last_counts(spark, tmp_path):
    landed(spark, tmp_path, [("u", head_to_head(1.5, 2.5, 9.0)), ("v", head_to_head(3.0, 4.0))], "old.json", 1_000_000)
    docs = landed(spark, tmp_path, [("u", head_to_head(1.6, 2.4)), ("u", head_to_head(1.6, 2.4))], "new.json")
    good = current_responses(written(docs, str(tmp_path / "w")).where("is_valid"))
    assert sorted(r["price"] for r in tab_selections(good).collect()) == [1.6, 2.4, 3.0, 4.0]
    assert sorted(r["price"] for r in current_documents(tab_selections(docs)).collect()) == [1.6, 2.4, 3.0, 4.0]


def test_selections_without_repeated_documents_are_not_moved(spark, tmp_path):
    docs = landed(spark, tmp_path, [("u", json.dumps(TAB_DOC)), ("v", head_to_head(3.0, 4.0))])
    plan = current_documents(tab_selections(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_every_request_and_response_has_a_status(spark, tmp_path):
    landed(spark, tmp_path, [("a", "{}"), ("b", "{"), ("x", "{}")], "old.json", 1_000_000)
    (tmp_path / "tab" / "junk.json").write_text("no record\n")
    docs = landed(spark, tmp_path, [("a", '{"matches": []}'), (None, "{}"), ("d", "["), ("d", "{}")], "new.json")
    asked = spark.createDataFrame([("a", 1, "line"), ("b", 1, "main"), ("c", 2, "line"), ("d", 2, "main")],
                                  "url string, match_id long, endpoint string")
    got = {r["url"]: r for r in response_ledger(docs, asked).collect()}
    status = {u if not u.startswith("body:") else "-": r["status"] for u, r in got.items() if r["n_valid"] or r["match_id"]}
    assert status == {"a": "answered", "b": "rejected", "c": "missing", "d": "answered", "x": "unexpected", "-": "unexpected"}
    assert (got["a"]["n_landed"], got["a"]["n_valid"], got["c"]["n_landed"], got["d"]["n_valid"]) == (2, 2, 0, 1)
    assert sum(r["n_landed"] for r in got.values()) == docs.count() == 8
    junk = [r for r in got.values() if r["status"] == "rejected" and r["match_id"] is None]
    assert len(junk) == 1 and junk[0]["n_landed"] == 1
    alone = {r["status"] for r in response_ledger(docs).collect()}
    assert alone == {"answered", "rejected"}
    with pytest.raises(ValueError, match="snapshot_id"):
        response_ledger(docs.withColumn("snapshot_id", F.lit("s")), asked)
    assert response_ledger(docs.limit(0), asked).where("status = 'missing'").count() == 4


def test_unexpected_responses_are_rejects(spark, tmp_path):
    stray = (SB_EVENT_URL.format(id=7654321), "[]")
    out = run_sportsbet(spark, tmp_path, responses=[*sb_landed(9123456), stray, ("nowhere", "{")])
    rejects = spark.read.parquet(str(tmp_path / "out" / "rejects" / "sportsbet_unexpected")).collect()
    assert [(r["url"], r["body"]) for r in rejects] == [stray]
    ledger = spark.read.parquet(str(tmp_path / "out" / "responses" / "sportsbet"))
    counts = {r["status"]: r["count"] for r in ledger.groupBy("status").count().collect()}
    assert counts["unexpected"] == 1 and counts["rejected"] == 1 and counts["missing"] > 0
    assert spark.read.parquet(out["sportsbet_line"]).count() == 3


def test_one_broken_market_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    def broken(sel, **_):
        return sel.select(F.raise_error(F.lit("no such market")).alias("x"))

    def unbuilt(sel, **_):
        raise KeyError("missing column")

    folder, out = land(tmp_path / "l", [("tab://a", json.dumps(TAB_DOC))]), str(tmp_path / "out")
    first = pl.run_tab(spark, folder, out, "s1")
    before = spark.read.parquet(first["tab_line"]).collect()
    markets = {**pl.TAB_MARKETS, "tab_line": broken, "tab_totals": unbuilt}
    monkeypatch.setattr(pl, "TAB_MARKETS", markets)
    second = pl.run_tab(spark, folder, out, "s1")
    assert set(first) - set(second) == {"tab_line", "tab_totals"}
    assert spark.read.parquet(first["tab_line"]).collect() == before
    ledger = read_run_ledger(spark, out).collect()
    assert len(ledger) == 14 and len({r["run_id"] for r in ledger}) == 2
    failed = {r["market"]: r["error"] for r in ledger if r["status"] == "failed"}
    assert set(failed) == {"tab_line", "tab_totals"} and "missing column" in failed["tab_totals"]
    rows = {r["market"]: r["n_rows"] for r in ledger if r["status"] == "written"}
    assert rows["tab_h2h"] == 2 and rows["tab_total_tries"] == 0 and rows["tab_player_tries"] == 3
    assert not os.listdir(f"{out}/_staging")
    pl.refresh_tab_markets(spark, f"{out}/selections", f"{out}/m")
    failed = {r["market"]: r["error"] for r in read_run_ledger(spark, f"{out}/m").where("status = 'failed'").collect()}
    assert set(failed) == {"tab_line", "tab_totals"}, failed.get("tab_total_tries")
    assert pl.read_market(spark, f"{out}/m", "tab_h2h", keyed=True).count() == 2


def test_command_line_tells_failed_markets(spark, tmp_path, monkeypatch, capsys):
    from overround.__main__ import main

    monkeypatch.setattr(pl, "TAB_MARKETS", {**pl.TAB_MARKETS, "tab_line": lambda sel: 1 / 0})
    folder = land(tmp_path / "l", [("tab://a", json.dumps(TAB_DOC))])
    assert main(["tab", "--landing", folder, "--out", str(tmp_path / "out")]) == 1
    assert "tab_line" in capsys.readouterr().err


KEYS = ("agency", "snapshot_id")


def table(spark, path):
    return sorted(map(tuple, spark.read.schema("x int, agency string, snapshot_id string").parquet(path).collect()))


def test_partitions_are_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "A", "s1"), (2, "A", "s2"), (3, "B", "s 3")], "x int, agency string, snapshot_id string")
    replace_partitions(df, path, KEYS, None)
    assert table(spark, path) == [(1, "A", "s1"), (2, "A", "s2"), (3, "B", "s 3")]
    new = spark.createDataFrame([(9, "A", "s1")], df.schema)
    replace_partitions(new, path, KEYS, [{"agency": "A", "snapshot_id": s} for s in ("s1", "s2")])
    assert table(spark, path) == [(3, "B", "s 3"), (9, "A", "s1")]
    replace_partitions(new.limit(0), path, KEYS, None)
    assert table(spark, path) == [] and not [f for f in os.listdir(path) if f.startswith(("_staging", "_old"))]


def test_a_failed_write_leaves_the_old_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "A", "s1")], "x int, agency string, snapshot_id string")
    replace_partitions(df, path, KEYS, None)
    bad = df.withColumn("x", F.when(F.col("x") > 0, F.raise_error(F.lit("boom")).cast("int")))
    with pytest.raises(Exception, match="boom"):
        replace_partitions(bad, path, KEYS, [{"agency": "A", "snapshot_id": "s1"}])
    assert table(spark, path) == [(1, "A", "s1")] and not [f for f in os.listdir(path) if f.startswith("_")]
    real = sinks._file_system

    class Refuses:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return "_staging" not in a.toString() and self.fs.rename(a, b)

    monkeypatch.setattr(sinks, "_file_system", lambda *a: (Refuses(real(*a)[0]), real(*a)[1]))
    with pytest.raises(OSError, match="can't move"):
        replace_partitions(df.withColumn("x", F.lit(7)), path, KEYS, [{"agency": "A", "snapshot_id": "s1"}])
    assert table(spark, path) == [(1, "A", "s1")]


def test_a_run_without_tables_closes(spark, tmp_path):
    assert MarketRun(spark, str(tmp_path), "TAB", None).close() == {}
    assert read_run_ledger(spark, str(tmp_path)).count() == 0


def test_listing_markets_are_in_the_ledger(spark, tmp_path):
    run_sportsbet(spark, tmp_path, html=LISTING_HTML)
    ledger = read_run_ledger(spark, str(tmp_path / "out"))
    assert ledger.where("status = 'written'").count() == 7 and ledger.where("market = 'sportsbet_h2h' and n_rows = 2").count() == 1
