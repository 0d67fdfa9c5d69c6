"""Documents keep their identity: ids of any length, several documents, endpoints and snapshots, reruns, rejects."""

import json

import pytest
from pyspark.sql import functions as F

from overround import functions as fx
from overround import operators as op
from overround import schemas as S
from overround.plans import markets as mk
from overround.plans import pipelines as pl
from overround.session import ensure_checkpoint_dir
from overround.sources import (
    card_teams, current_documents, hrefs, listing_cards, listing_rejects, parse_documents, quarantine_split, read_csv,
    read_landed, tab_selections, texts, elements_by_class, url_endpoint, write_csv,
)

from .conftest import rows
from .fixtures import LISTING_HTML, SB_EVENT_URL, TAB_DOC, landed_lines, sb_landed, sb_market_doc

LONG_ID = 1234567890


def land(path, records, name="a.json"):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(landed_lines(records))
    return str(path)


def run_sportsbet(spark, tmp_path, html=LISTING_HTML, responses=None, meta=None, pages_rows=None, out="out"):
    pages = str(tmp_path / f"pages-{out}")
    spark.createDataFrame(pages_rows or [(1, "u", html)], "page_id bigint, url string, html string").write.mode("overwrite").parquet(pages)
    landing = land(tmp_path / f"landing-{out}", responses if responses is not None else sb_landed(9123456))
    events = land(tmp_path / f"meta-{out}", meta or [(SB_EVENT_URL.format(id=9123456).replace("MarketGroupings/313/Markets", "SportCard"),
                                                      json.dumps({"classExternalId": 1, "competitionExternalId": 2, "externalId": 3}))])
    return pl.run_sportsbet(spark, pages, landing, events, str(tmp_path / out))


def test_ids_of_ten_digits_reach_the_line_market(spark, tmp_path):
    out = run_sportsbet(spark, tmp_path, LISTING_HTML.replace("9123456", str(LONG_ID)), sb_landed(LONG_ID, main=True))
    line = spark.read.parquet(out["sportsbet_line"])
    assert line.count() == 3 and {r["match"] for r in line.collect()} == {"Brisbane Broncos v Melbourne Storm"}


def test_two_endpoints_list_a_market_once(spark, tmp_path):
    one = {r["home_line"] for r in spark.read.parquet(run_sportsbet(spark, tmp_path)["sportsbet_line"]).collect()}
    out = run_sportsbet(spark, tmp_path, responses=sb_landed(9123456, main=True), out="both")
    both = spark.read.parquet(out["sportsbet_line"]).collect()
    assert len(both) == 3 and {r["home_line"] for r in both} == one


def test_duplicate_cards_and_metadata_do_not_multiply_rows(spark, tmp_path):
    url = SB_EVENT_URL.format(id=9123456).replace("MarketGroupings/313/Markets", "SportCard")
    meta = [(url, json.dumps({"classExternalId": k, "competitionExternalId": 2, "externalId": 3})) for k in (1, 5)]
    out = run_sportsbet(spark, tmp_path, meta=meta, pages_rows=[(1, "u", LISTING_HTML), (2, "v", LISTING_HTML.replace("Broncos", "BRONCOS"))])
    assert spark.read.parquet(out["sportsbet_line"]).count() == 3
    assert spark.read.parquet(out["sportsbet_player_tries"]).count() == 2
    assert {r["class_external_id"] for r in spark.read.parquet(out["sportsbet_player_tries"]).collect()} == {1}


def tab_docs(spark, tmp_path, records):
    return parse_documents(read_landed(spark, land(tmp_path / "tab", records)), S.TAB_RESPONSE)


def head_to_head(*prices):
    return json.dumps({"matches": [{"name": "A v B", "startTime": "t", "markets": [{"betOption": "Head To Head", "propositions": [
        {"id": k, "name": "x", "returnWin": p} for k, p in enumerate(prices)]}]}]})


def test_two_documents_keep_their_prices_apart(spark, tmp_path):
    docs = tab_docs(spark, tmp_path, [("tab://a", head_to_head(1.5, 2.5)), ("tab://b", head_to_head(1.6, 2.4))])
    out = rows(mk.h2h_nth(current_documents(tab_selections(docs)), rules=()), ["home_win"])
    assert [(r["home_win"], r["away_win"]) for r in out] == [(1.5, 2.5), (1.6, 2.4)]


def test_a_response_landed_again_replaces_the_earlier_one(spark, tmp_path):
    import os

    land(tmp_path / "tab", [("tab://a", head_to_head(1.5, 2.5, 9.0))], "old.json")
    land(tmp_path / "tab", [("tab://a", head_to_head(1.6, 2.4)), ("tab://a", head_to_head(1.6, 2.4))], "new.json")
    os.utime(tmp_path / "tab" / "old.json", (1_000_000, 1_000_000))
    docs = parse_documents(read_landed(spark, str(tmp_path / "tab")), S.TAB_RESPONSE)
    sel = current_documents(tab_selections(docs))
    assert sorted(r["price"] for r in sel.collect()) == [1.6, 2.4]


def test_player_prices_stay_in_their_snapshot(spark):
    base = {c: None for c in S.SELECTION_COLUMNS}
    recs = [dict(base, agency="Sportsbet", snapshot_id=s, match_id=1, market_name="Player Tries", market_id=4, prop_id=k, price=p + k,
                 prop_name=f"Ari Tane {side} 0.5") for s, p in (("s1", 1.0), ("s2", 5.0)) for k, side in enumerate(("Over", "Under"))]
    sel = spark.createDataFrame([tuple(r[c] for c in S.SELECTION_COLUMNS) for r in recs], S.SELECTIONS)
    enriched = mk.enrich_selections(sel, spark.createDataFrame([(1, "A", "B")], S.TEAMS))
    for with_keys in (False, True):
        out = mk.sb_player_over_under(enriched, with_keys=with_keys)
        assert ("snapshot_id" in out.columns) == with_keys
        assert sorted((r["over_price"], r["under_price"]) for r in out.collect()) == [(1.0, 2.0), (5.0, 6.0)]


def test_an_empty_rerun_replaces_the_snapshot(spark, tmp_path):
    landing = land(tmp_path / "l", [("tab://a", json.dumps(TAB_DOC))])
    out = str(tmp_path / "out")
    pl.run_tab(spark, landing, out, "s1")
    pl.run_tab(spark, landing, out, "s2")
    sel = f"{out}/selections"
    pl.refresh_tab_markets(spark, sel, f"{out}/m")
    land(tmp_path / "l", [("tab://a", "{")])
    pl.run_tab(spark, landing, out, "s1")
    assert pl.read_selections(spark, sel, "TAB", "s1").count() == 0 and pl.read_selections(spark, sel, "TAB", "s2").count() > 0
    pl.refresh_tab_markets(spark, sel, f"{out}/m", snapshot_ids=["s1"])
    left = pl.read_market(spark, f"{out}/m", "tab_h2h", keyed=True)
    assert {r["snapshot_id"] for r in left.select("snapshot_id").distinct().collect()} == {"s2"}


def test_one_pretty_printed_response_in_a_file(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "tab_response.json").write_text(json.dumps(TAB_DOC, indent=2))
    out = pl.run_tab(spark, str(folder), str(tmp_path / "out"), layout="files")
    assert spark.read.parquet(out["tab_h2h"]).count() == 2
    with pytest.raises(ValueError, match="layout"):
        pl.run_tab(spark, str(folder), str(tmp_path / "out"), layout="xml")


def test_rejects_keep_their_text(spark, tmp_path):
    folder = tmp_path / "l"
    land(folder, [("u1", '{"error": 1}'), ("u2", "[]"), ("u3", ' [{"name": "Line"}]')])
    (folder / "b.json").write_text('{"url": "u4", "body": \n{"other": 1}\n\n')
    good, bad = quarantine_split(parse_documents(read_landed(spark, str(folder)), S.SB_MARKETS_RESPONSE))
    assert sorted(r["url"] for r in good.collect()) == ["u2", "u3"]
    assert {(r["url"], r["body"]) for r in bad.collect()} == {("u1", '{"error": 1}'), (None, '{"url": "u4", "body": '), (None, '{"other": 1}')}


def test_metadata_and_page_rejects_are_written(spark, tmp_path):
    run_sportsbet(spark, tmp_path, meta=[("bad", "{")], pages_rows=[(1, "u", LISTING_HTML), (2, "v", LISTING_HTML.replace("</a>", "</a><a class='linkMultiMarket_fcmecz0' href='/x-1234567'>y</a>", 1))])
    out = tmp_path / "out" / "rejects"
    assert spark.read.parquet(str(out / "sportsbet_metadata")).count() == 1
    assert [r["page_id"] for r in spark.read.parquet(str(out / "sportsbet_pages")).collect()] == [2]


def test_csv_keeps_text(spark, tmp_path):
    data = [(1, " lead trail "), (2, 'He said "x"'), (3, None), (4, "a,b"), (5, "two\nlines"), (6, "back\\slash"), (7, "")]
    df = spark.createDataFrame(data, "k int, t string")
    write_csv(df, str(tmp_path / "c"))
    back = read_csv(spark, str(tmp_path / "c"), df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == data
    text = "".join(p.read_text() for p in (tmp_path / "c").glob("part-*"))
    assert '"He said ""x"""' in text and "NA" in text


def test_class_tokens_quotes_and_entities(spark):
    html = ("<div class=\"ad-slot\">no</div><div class='x ad'>one &#233;&#xE8;&amp;lt; &#0;</div><p class=ad>two</p><DIV data-class=\"ad\">no</DIV>"
            "<link href='/l'><a href='/a?x=1&amp;y=2' class='ad b'>t</a><a name='n'>t</a><a class=\"ad\" href=\"/c\">t</a>")
    row = spark.createDataFrame([(html,)], "html string").select(
        texts(elements_by_class("html", "ad")).alias("e"), hrefs("html").alias("h"), hrefs("html", "ad").alias("a")).first()
    assert row["e"] == ["one éè&lt; �", "two", "t", "t"]
    assert row["h"] == ["/a?x=1&y=2", "/c"] == row["a"]


def test_a_page_that_lacks_a_link_gives_no_cards(spark):
    page = LISTING_HTML.replace('<a class="linkMultiMarket_fcmecz0" href="/betting/rugby-league/premiership/broncos-v-storm-9123456">More</a>', "")
    pages = spark.createDataFrame([(1, "u", page), (2, "u", LISTING_HTML)], "page_id bigint, url string, html string")
    assert {r["page_id"] for r in listing_cards(pages).collect()} == {2}
    assert [(r["page_id"], r["n_cards"], r["n_links"]) for r in listing_rejects(pages).collect()] == [(1, 2, 1)]
    assert card_teams(listing_cards(pages)).count() == 2


def test_numbered_back_references_are_refused(spark):
    with pytest.raises(ValueError, match="back-reference"):
        fx.str_replace_first("x", r"(a)\1", "")
    got = spark.range(1).select(fx.str_replace_first(F.lit("xaab"), r"(?<c>a)\k<c>", "-")).first()[0]
    assert got == "x-b" and spark.range(1).select(fx.str_replace_first(F.lit("a\\1"), r"\\1", "-")).first()[0] == "a-"


def test_endpoints_are_told_from_urls(spark):
    url = SB_EVENT_URL.format(id=1)
    df = spark.createDataFrame([(url,), (url.replace("313", "112") + "?a=1",), ("x/SportCard",), ("x/y",), (None,)], "u string")
    assert [r[0] for r in df.select(url_endpoint("u")).collect()] == ["line", "player_tries", "event_card", None, None]


def test_rows_join_by_position_within_keys(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (2, 1, "c")], "k int, o int, x string")
    right = spark.createDataFrame([(1, 1, "p"), (1, 2, "q"), (1, 9, "r"), (3, 1, "s")], "k int, n int, y string")
    got = op.positional_join(left, right, ["k"], ["o"], ["n"]).select("k", "pos", "x", "y").collect()
    assert sorted(map(tuple, got)) == [(1, 0, "b", "p"), (1, 1, "a", "q")]
    full = op.positional_join(left, right, ["k"], ["o"], ["n"], how="full").select("k", "pos", "x", "y").collect()
    assert len(full) == 5 and (1, 2, None, "r") in {tuple(r) for r in full}
    with pytest.raises(ValueError, match="both sides"):
        op.positional_join(left, left, ["k"], ["o"], ["o"])


class _Conf:
    def __init__(self, master):
        self.master = master

    def get(self, key, default=None):
        return self.master if key == "spark.master" else default


class _Cluster:
    class sparkContext:
        @staticmethod
        def getCheckpointDir():
            return None

    conf = _Conf("yarn")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster())


def test_time_markets_hash_aggregate_all_but_one_pick(spark):
    sel = spark.createDataFrame([], S.SELECTIONS)
    for df in (mk.tab_time_threshold(sel), mk.sb_time_threshold(mk.enrich_selections(sel, spark.createDataFrame([], S.TEAMS)))):
        assert df.count() == 0
    priced, ord_ = mk._total(sel, S.ORD)
    plan = priced.groupBy("match").agg(op.first_by("price", ord_))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_no_plan_deals_rows_round_robin(spark):
    from overround.plans.catalog import QUERIES

    for name in ("margin", "market_line_balanced", "market_line_opposite", "market_player_tries", "market_totals_dedup", "json_field"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan, name


def test_market_documents_of_the_fixture_cover_all_endpoints():
    assert {m["name"] for m in sb_market_doc(1)} == {m["name"] for _, body in sb_landed(1) for m in json.loads(body)}
