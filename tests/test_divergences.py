
from overround import schemas as S
from overround.plans import markets as mk

from .conftest import rows


def sel(spark, recs):
    base = {c: None for c in S.SELECTION_COLUMNS}
    base.update(agency="TAB", snapshot_id="s", match_pos=0, market_pos=0)
    out = []
    for i, r in enumerate(recs):
        row = dict(base, prop_pos=i)
        row.update(r)
        out.append(tuple(row[c] for c in S.SELECTION_COLUMNS))
    return spark.createDataFrame(out, S.SELECTIONS)


def teams(spark, recs):
    return spark.createDataFrame(recs, S.TEAMS)


def test_d1_unmatched_team_gives_null_match_label(spark):
    s = sel(spark, [dict(match_id=5, market_name="First Try Scorer", prop_name="Ari Tane", price=9.0)])
    out = rows(mk.sb_outright(mk.enrich_selections(s, teams(spark, [(6, "A", "B")]))))
    assert out[0]["match"] is None and out[0]["home_team"] is None


def test_d2_null_time_line_is_dropped_and_missing_under_kept(spark):
    s = sel(spark, [dict(match_id=1, market_name="Time of First Try", prop_name="No Try", price=40.0),
                    dict(match_id=2, market_name="Time of First Try", prop_name="0-10 Minutes", price=2.5)])
    e = mk.enrich_selections(s, teams(spark, [(1, "A", "B"), (2, "C", "D")]))
    out = rows(mk.sb_time_threshold(e))
    assert [(r["match"], r["line"], r["under_price"], r["margin"]) for r in out] == [("C v D", "10:00", None, None)]


def test_d3_null_lines_match_in_over_under_join(spark):
    url = "u/1234567"
    s = sel(spark, [dict(match_id=1, source_url=url, market_name="Total Match Points", prop_name="Over", price=1.9),
                    dict(match_id=1, source_url=url, market_name="Total Match Points", prop_name="Under", price=1.8)])
    out = rows(mk.over_under(s, teams(spark, [(1, "A", "B")])))
    assert [(r["line"], r["over_price"], r["under_price"]) for r in out] == [(None, 1.9, 1.8)]


def test_d4_zero_line_dropped_by_opposite_kept_by_balanced(spark):
    tab = sel(spark, [dict(match="A v B", market_name="Line", prop_name="A +0", price=2.0),
                      dict(match="A v B", market_name="Line", prop_name="B +0", price=1.8)])
    assert mk.line_opposite(tab, rules=()).count() == 0
    sb = sel(spark, [dict(match_id=1, market_name="Line", prop_name="A (0.0)", price=2.0),
                     dict(match_id=1, market_name="Line", prop_name="B (0.0)", price=1.8)])
    assert mk.line_balanced(sb, teams(spark, [(1, "A", "B")]), rules=()).count() == 1


def test_d6_conditional_side_zero_and_two_matches(spark):
    s = sel(spark, [
        dict(match="A v B", market_name="Time of First Try", prop_name="8:00 or Earlier", price=2.4),
        dict(match="A v B", market_name="Time of First Try", prop_name="8:00 or later", price=1.5),
        dict(match="A v B", market_name="Time of First Try", prop_name="9:00 or later", price=1.7),
        dict(match="C v D", market_name="Time of First Try", prop_name="8:00 or Earlier", price=2.0)])
    out = rows(mk.tab_time_threshold(s, rules=()))
    assert [(r["match"], r["line"], r["over_price"], r["under_price"]) for r in out] == [("A v B", "8:00", 2.4, 1.5)]


def test_d15_d17_over_under_duplicates_multiply_and_lone_unders_drop(spark):
    url = "u/1234567"
    s = sel(spark, [
        dict(match_id=1, source_url=url, market_name="Total Match Points", prop_name="Over", handicap=40.5, price=1.9),
        dict(match_id=1, source_url=url, market_name="Total Match Points", prop_name="Under", handicap=40.5, price=1.8),
        dict(match_id=1, source_url=url, market_name="Total Match Points", prop_name="Under", handicap=40.5, price=1.85),
        dict(match_id=1, source_url=url, market_name="Total Match Points", prop_name="Under", handicap=44.5, price=1.5)])
    out = rows(mk.over_under(s, teams(spark, [(1, "A", "B")])), ["under_price"])
    assert [(r["line"], r["under_price"]) for r in out] == [(40.5, 1.8), (40.5, 1.85)]


def test_d16_no_away_rows_gives_no_pairs(spark):
    s = sel(spark, [dict(match_id=1, market_name="Line", prop_name="A (+2.5)", price=1.9)])
    assert mk.line_balanced(s, teams(spark, [(1, "A", "B")]), rules=()).count() == 0


def test_h2h_with_one_proposition_keeps_null_away(spark):
    s = sel(spark, [dict(match="A v B", market_name="Head To Head", prop_name="A", price=1.5)])
    out = rows(mk.h2h_nth(s, rules=()))
    assert [(r["home_win"], r["away_win"], r["margin"]) for r in out] == [(1.5, None, None)]


def test_three_part_and_one_part_match_labels(spark):
    s = sel(spark, [dict(match="A v B v C", market_name="Head To Head", prop_name="A", price=1.5),
                    dict(match="A v B v C", market_name="Head To Head", prop_name="B", price=2.5),
                    dict(match="Solo", market_name="Head To Head", prop_name="A", price=1.5)])
    out = rows(mk.h2h_nth(s, rules=()), ["match"])
    assert [(r["match"], r["home_team"], r["away_team"]) for r in out] == [("A v B", "A", "B"), (None, "Solo", None)]


def test_d7_mistyped_field_is_null_and_document_kept(spark):
    import json

    from overround.sources import event_metadata, parse_documents, quarantine_split, tab_selections

    tab = {"matches": [{"name": "A v B", "startTime": "t", "markets": [{"betOption": "Head To Head",
           "propositions": [{"id": "abc", "name": "A", "returnWin": 1.9},
                            {"id": 2, "name": "B", "returnWin": 2.0}]}]}]}
    docs = spark.createDataFrame([("tab://1", json.dumps(tab)), ("tab://2", '{"matches": [')],
                                 "url string, body string")
    good, rejects = quarantine_split(parse_documents(docs, S.TAB_RESPONSE))
    assert [r["url"] for r in rejects.collect()] == ["tab://2"]
    out = rows(tab_selections(good), ["prop_pos"])
    assert [(r["prop_id"], r["prop_name"], r["price"]) for r in out] == [(None, "A", 1.9), (2, "B", 2.0)]
    meta = spark.createDataFrame([("u/1234567/SportCard", '{"classExternalId": "a", "competitionExternalId": 2, '
                                   '"externalId": 3}')], "url string, body string")
    m = rows(event_metadata(parse_documents(meta, S.SB_EVENT_METADATA)))
    assert [(r["match_id"], r["class_external_id"], r["competition_external_id"]) for r in m] == [(1234567, None, 2)]
