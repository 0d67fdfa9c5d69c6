import json

import pytest

from overround import schemas as S
from overround.plans import markets as mk
from overround.sources import (
    card_teams, event_metadata, listing_cards, parse_documents, quarantine_split, read_landed,
    sportsbet_selections, url_manifest,
)

from .conftest import rows
from .fixtures import LISTING_HTML, SB_EVENT_URL, landed_lines, sb_market_doc


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, "https://example.com/league", LISTING_HTML)], "page_id bigint, url string, html string")


@pytest.fixture(scope="module")
def teams(pages):
    return mk.canonical_teams_dim(card_teams(listing_cards(pages)))


@pytest.fixture(scope="module")
def selections(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("sb")
    recs = [(SB_EVENT_URL.format(id=9123456), json.dumps(sb_market_doc(9123456))),
            (SB_EVENT_URL.format(id=9123457), '[{"name": "Line", "selections": [')]
    (d / "landed.json").write_text(landed_lines(recs))
    docs = parse_documents(read_landed(spark, str(d)), S.SB_MARKETS_RESPONSE)
    good, rejects = quarantine_split(docs)
    assert [r["url"] for r in rejects.collect()] == [recs[1][0]]
    return sportsbet_selections(good).cache()


def test_listing_cards_and_h2h(pages):
    cards = listing_cards(pages)
    r = rows(mk.h2h_positional(cards), ["match"])
    assert [(x["match"], x["home_win"], x["away_win"], x["start_time"], x["margin"]) for x in r] == [
        ("Brisbane Broncos v Melbourne Storm", 2.1, 1.75, "Thursday, 6 Mar 20:00", 1.048),
        ("South Sydney Rabbitohs v Cronulla Sharks", 1.6, 2.35, "Friday, 7 Mar 19:00", 1.051)]
    assert sorted(r["match_id"] for r in cards.collect()) == [9123456, 9123457]


def test_manifest(spark, teams):
    m = url_manifest(teams.select("match_id"))
    assert m.count() == 14
    assert m.filter("endpoint = 'line'").orderBy("match_id").first()["url"].endswith("/Events/9123456/MarketGroupings/313/Markets")


def test_selections_keep_rows_with_missing_fields(selections):
    r = rows(selections.filter("market_name = 'First Try Scorer'"), ["prop_pos"])
    assert [(x["prop_name"], x["price"], x["match_id"]) for x in r] == [("Ari Tane", 8.5, 9123456),
                                                                       ("Ben Ola", None, 9123456)]


def test_line_balanced_keeps_zero_pair(selections, teams):
    r = rows(mk.line_balanced(selections, teams), ["home_line"])
    assert [(x["home_line"], x["away_line"], x["margin"]) for x in r] == [
        (-4.5, 4.5, 1.068), (0.0, 0.0, 1.056), (2.5, -2.5, 1.053)]
    assert {x["match"] for x in r} == {"Brisbane Broncos v Melbourne Storm"}


def test_over_under_points_and_tries(selections, teams):
    pts = rows(mk.over_under(selections, teams), ["line"])
    assert [(x["line"], x["over_price"], x["under_price"]) for x in pts] == [(42.5, 1.9, 1.9)]
    tries = rows(mk.over_under(selections, teams, market_re="Total Match Tries", over_re="Over",
                               under_re="Under", label="Total Tries"), ["line"])
    assert [(x["line"], x["over_price"], x["under_price"]) for x in tries] == [(7.5, 1.85, 1.95), (9.5, 3.0, None)]


def test_player_markets_and_time_bands(spark, selections, teams):
    meta_doc = spark.createDataFrame(
        [(SB_EVENT_URL.format(id=9123456).replace("MarketGroupings/313/Markets", "SportCard"),
          json.dumps({"classExternalId": 1, "competitionExternalId": 2, "externalId": 3}))], "url string, body string")
    meta = event_metadata(parse_documents(meta_doc, S.SB_EVENT_METADATA))
    # Player markets come from the player-tries endpoint alone; the over/under
    # split looks only at selection names, so other endpoints must not be mixed in.
    player_doc = selections.filter("market_name IN ('To Score 2+ Tries', 'Player Tries Over/Under', "
                                   "'First Try Scorer', 'Time of First Try')")
    e = mk.enrich_selections(player_doc, teams, meta)
    alt = rows(mk.sb_player_lines(e))
    assert [(x["player_name"], x["line"], x["over_price"], x["event_external_id"]) for x in alt] == [
        ("Ari Tane", 1.5, 6.5, 3)]
    ou = rows(mk.sb_player_over_under(e))
    assert [(x["player_name"], x["line"], x["over_price"], x["under_price"]) for x in ou] == [
        ("Ari Tane", 0.5, 1.8, 1.95)]
    assert mk.sb_player_tries(e).count() == 2
    fts = rows(mk.sb_outright(e), ["player_name"])
    assert [(x["player_name"], x["over_price"]) for x in fts] == [("Ari Tane", 8.5), ("Ben Ola", None)]
    tb = rows(mk.sb_time_threshold(e))
    assert [(x["line"], x["over_price"], x["under_price"], x["margin"]) for x in tb] == [
        ("10:00", 2.5, 51.0, 0.42)]


def test_links_outside_cards_pair_by_position(spark):
    html = ("<div class=\"White_fqa53j6\"><div class=\"participantText_fivg86r\">Eels</div>"
            "<div class=\"participantText_fivg86r\">Titans</div></div>"
            "<div class=\"White_fqa53j6\"><div class=\"participantText_fivg86r\">Knights</div>"
            "<div class=\"participantText_fivg86r\">Dragons</div></div>"
            "<nav><a class=\"linkMultiMarket_fcmecz0\" href=\"/m/eels-v-titans-1111111\">x</a>"
            "<a class=\"linkMultiMarket_fcmecz0\" href=\"/m/knights-v-dragons-2222222\">y</a></nav>")
    pages = spark.createDataFrame([(7, "u", html)], "page_id bigint, url string, html string")
    teams = rows(mk.canonical_teams_dim(card_teams(listing_cards(pages))), ["match_id"])
    assert [(t["match_id"], t["home_team"], t["away_team"]) for t in teams] == [
        (1111111, "Parramatta Eels", "Gold Coast Titans"), (2222222, "Newcastle Knights", "St George Illawarra Dragons")]


def test_html_helpers(spark):
    from pyspark.sql import functions as F

    from overround.sources import hrefs, page_links, tag_text

    html = ('<html><head><title>Round 1 &amp; <b>odds</b></title></head><body>'
            '<a href="/a">A</a><a class="x linkMultiMarket_fcmecz0" href="/m/1234567">M</a>'
            '<a href="/b" class="other">B</a></body></html>')
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    row = df.select(tag_text("html", "title").alias("t"), hrefs("html").alias("all"),
                    hrefs("html", "linkMultiMarket_fcmecz0").alias("cls")).first()
    assert row["t"] == "Round 1 & odds"
    assert row["all"] == ["/a", "/m/1234567", "/b"]
    assert row["cls"] == ["/m/1234567"]
    links = [tuple(r) for r in page_links(df).orderBy("pos").collect()]
    assert links == [(1, 0, "/a"), (1, 1, "/m/1234567"), (1, 2, "/b")]
    none = spark.createDataFrame([(2, "<p>no title</p>")], "page_id bigint, html string")
    assert none.select(tag_text("html", "title")).first()[0] is None
    assert none.select(F.size(hrefs("html"))).first()[0] == 0


def test_manifest_custom_endpoints(spark):
    ids = spark.createDataFrame([(42,)], "match_id bigint")
    m = url_manifest(ids, endpoints={"line": "lines"}, base="https://h.example", template="{base}/e/{id}/{endpoint}")
    assert [tuple(r) for r in m.collect()] == [(42, "line", "https://h.example/e/42/lines")]


def test_player_tries_read_their_selections_once(spark):
    from overround.operators import union_distinct_by_name

    rows = [("s", "r", 1, "To Score 2+ Tries", 5, 1, "Ari Tane", 3.0, None), ("s", "r", 1, "To Score 2+ Tries", 5, 1, "Ari Tane", 3.0, None),
            ("s", "r", 1, "To Score First Try", 6, 2, "Ari Tane", 9.0, None), ("s", "r", 1, "Player Tries", 7, 3, "Ari Tane Over 0.5", 1.8, None),
            ("s", "r", 1, "Player Tries", 7, 4, "Ari Tane Under 0.5", 2.0, None), ("t", "r", 1, "Player Tries", 7, 5, "Bo Over", 1.5, 1.5),
            ("t", "r", 1, "To Score Over Under", 8, 6, "Cy Over 2.5", 4.0, None), (None, "r", 2, "To Score 3+ Tries", 9, 7, None, None, None)]
    sel = spark.createDataFrame(rows, "snapshot_id string, agency string, match_id long, market_name string, market_id long, prop_id long, "
                                      "prop_name string, price double, handicap double")
    teams = spark.createDataFrame([(1, "Home", "Away")], "match_id long, home_team string, away_team string")
    e = mk.enrich_selections(sel, teams)
    for with_keys in (False, True):
        got = mk.sb_player_tries(e, with_keys=with_keys)
        want = union_distinct_by_name(mk.sb_player_lines(e, with_keys=with_keys), mk.sb_player_over_under(e, with_keys=with_keys))
        assert set(got.columns) == set(want.columns)
        key = lambda r: str(tuple(r[c] for c in want.columns))
        assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and got.count() >= 5
    plan = mk.sb_player_tries(e)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2
