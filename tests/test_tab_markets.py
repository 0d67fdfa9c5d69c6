import json
import random

import pytest

from overround import schemas as S
from overround.plans import markets as mk
from overround.sources import parse_documents, quarantine_split, read_whole_files, tab_selections

from .conftest import rows
from .fixtures import TAB_DOC


@pytest.fixture(scope="module")
def selections(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tab")
    (d / "tab_response.json").write_text(json.dumps(TAB_DOC, indent=4))
    (d / "broken.json").write_text('{"matches": [{"name": "A v B", ')
    docs = parse_documents(read_whole_files(spark, str(d)), S.TAB_RESPONSE)
    good, rejects = quarantine_split(docs)
    assert rejects.count() == 1
    return tab_selections(good).cache()


def test_unnest_keeps_positions_and_drops_empty_lists(selections):
    assert selections.count() == 24
    r = rows(selections.filter("market_name = 'Head To Head'"), ["match_pos", "prop_pos"])
    assert [(x["match_pos"], x["prop_pos"], x["prop_name"]) for x in r] == [
        (0, 0, "Brisbane"), (0, 1, "Melbourne"), (1, 0, "Souths"), (1, 1, "Sharks")]


def test_h2h_nth(selections):
    r = rows(mk.h2h_nth(selections), ["match"])
    assert [(x["match"], x["home_win"], x["away_win"], x["margin"]) for x in r] == [
        ("Brisbane Broncos v Melbourne Storm", 2.1, 1.75, 1.048), ("Souths v Cronulla Sharks", 1.6, 2.35, 1.051)]
    assert all(x["agency"] == "TAB" and x["market_name"] == "Head To Head" for x in r)


def test_line_opposite(selections):
    r = rows(mk.line_opposite(selections), ["home_line", "market_name"])
    got = [(x["home_line"], x["home_win"], x["away_line"], x["away_win"]) for x in r]
    # +2.5 appears under two market names with the same price: kept once (first), paired once.
    # 0 / 0 pair is dropped (equal signed lines).
    assert got == [(2.5, 1.9, -2.5, 1.9), (6.5, 1.5, -6.5, 2.6)]
    assert all(x["home_line"] == -x["away_line"] and x["market_name"] == "Line" for x in r)


def test_totals_dedup_keeps_over_without_under(selections):
    r = [x.asDict() for x in mk.totals_dedup(selections).collect()]
    assert [(x["line"], x["over_price"], x["under_price"], x["margin"]) for x in r] == [
        (36.5, 1.45, 2.65, 1.067), (42.5, 1.9, 1.9, 1.053), (50.5, 3.1, None, None)]


def test_player_lines_and_outright(selections):
    r = [x.asDict() for x in mk.tab_player_lines(selections).collect()]
    assert [(x["player_name"], x["line"], x["over_price"]) for x in r] == [
        ("Ari Tane", 0.5, 1.8), ("Nasiah Wanganeen-Milera", 0.5, 2.2), ("Ari Tane", 1.5, 6.0)]
    o = [x.asDict() for x in mk.tab_outright(selections).collect()]
    assert [(x["player_name"], x["over_price"], x["prop_id"]) for x in o] == [("Ari Tane", 8.0, 51),
                                                                             ("Ben Ola", 8.0, 52)]


def test_time_threshold_drops_one_sided_match(selections):
    r = rows(mk.tab_time_threshold(selections), ["match"])
    assert [(x["match"], x["line"], x["over_price"], x["under_price"], x["margin"]) for x in r] == [
        ("Brisbane Broncos v Melbourne Storm", "8:00", 2.4, 1.55, 1.062)]


def test_results_do_not_depend_on_row_order(spark, selections):
    data = selections.collect()
    random.Random(3).shuffle(data)
    shuffled = spark.createDataFrame(data, selections.schema).repartition(5)
    for fn in (mk.h2h_nth, mk.line_opposite, mk.totals_dedup, mk.tab_time_threshold):
        assert sorted(map(tuple, fn(shuffled).collect()), key=str) == sorted(map(tuple, fn(selections).collect()), key=str)
