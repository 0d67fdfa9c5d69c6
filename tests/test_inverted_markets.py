"""Market tables turned back into feed documents: reading those documents gives the tables again.

The generator makes random market tables in the shape of the feed's outputs (our own names), writes the documents that
a bookmaker would have sent for them (positions, both sides of each pair, later duplicates that must lose, other
markets in between), and the pipeline's readers and markets run over the documents as text.
"""

import json
import random

import pytest

from overround import schemas as S
from overround.plans import markets as mk
from overround.sources import parse_documents, tab_selections

TEAMS = ["Ardent Otters", "Brisk Badgers", "Calm Cranes", "Deft Dingoes", "Eager Egrets", "Fleet Foxes"]
PLAYERS = ["Ari Tane", "Bo Nui", "Cy Oru", "Dee Pai", "El Qua"]


def margin(a, b):
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(1 / a + 1 / b)).quantize(Decimal("0.001"), ROUND_HALF_UP))


def price(rng):
    return rng.randint(101, 900) / 100


def matches(rng):
    teams = rng.sample(TEAMS, 6)
    return [(f"{h} v {a}", h, a, f"2025-03-0{k + 1}T08:50:00Z") for k, (h, a) in enumerate(zip(teams[::2], teams[1::2], strict=True))]


def document(rng, props):
    """One response for (match, start, market, label, price, id) in the given order, with a market nobody reads between."""
    feed = []
    for match, start in dict.fromkeys((p[0], p[1]) for p in props):
        own = [p for p in props if p[0] == match]
        markets = [{"betOption": m, "propositions": [{"id": p[5], "name": p[3], "returnWin": p[4]} for p in own if p[2] == m]}
                   for m in dict.fromkeys(p[2] for p in own)]
        markets.insert(rng.randint(0, len(markets)), {"betOption": "Half Time Double", "propositions": [{"id": 0, "name": "x +1.5", "returnWin": 2.0}]})
        feed.append({"name": match, "startTime": start, "markets": markets})
    return json.dumps({"matches": feed, "authentication": None})


def read(spark, text):
    docs = spark.createDataFrame([("tab://feed", text)], "url string, body string")
    return tab_selections(parse_documents(docs, S.TAB_RESPONSE).where("is_valid"))


def table(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.select(*columns).collect())


@pytest.mark.parametrize("seed", range(3))
def test_head_to_head(spark, seed):
    rng = random.Random(seed)
    rows = [(m, s, h, price(rng), a, price(rng)) for m, h, a, s in matches(rng)]
    props = [(m, s, "Head To Head", t, p, k) for m, s, h, hw, a, aw in rows for k, (t, p) in enumerate([(h, hw), (a, aw), ("Draw", 21.0)])]
    want = sorted((m, s, h, hw, a, aw, margin(hw, aw)) for m, s, h, hw, a, aw in rows)
    got = table(mk.h2h_nth(read(spark, document(rng, props)), rules=()), ["match", "start_time", "home_team", "home_win", "away_team", "away_win", "margin"])
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_lines(spark, seed):
    rng = random.Random(10 + seed)
    rows, props = [], []
    for m, h, a, s in matches(rng):
        for line in rng.sample([1.5, 2.5, 3.5, 4.5, 6.5], 3):
            sign, hw, aw = rng.choice([1, -1]), price(rng), price(rng)
            market = rng.choice(["Line", "Pick Your Own Line"])
            rows.append((m, s, h, sign * line, hw, a, -sign * line, aw, margin(hw, aw)))
            props += [(m, s, market, f"{h} {sign * line:+}", hw, len(props)), (m, s, market, f"{a} {-sign * line:+}", aw, len(props) + 1)]
            # Both sides at the same prices again, from the other market: the first ones stay.
            props += [(m, s, "Pick Your Own Line", f"{t} {x:+}", w, 900 + len(props)) for t, x, w in ((h, sign * line, hw), (a, -sign * line, aw))]
    got = table(mk.line_opposite(read(spark, document(rng, props)), rules=()),
                ["match", "start_time", "home_team", "home_line", "home_win", "away_team", "away_line", "away_win", "margin"])
    assert got == sorted(rows)


@pytest.mark.parametrize("seed", range(3))
def test_totals(spark, seed):
    rng = random.Random(20 + seed)
    for label, names in (("Total Points", ("Total Points Over/Under", "Pick Your Own Total")),
                         ("Total Tries", ("Total Tries Over/Under", "Pick Your Own Tries"))):
        rows, props = [], []
        for m, h, a, s in matches(rng):
            for line in rng.sample([30.5, 36.5, 40.5, 44.5], 3):
                market, over, under = rng.choice(names), price(rng), price(rng)
                rows.append((m, s, label, h, a, line, over, under, margin(over, under)))
                props += [(m, s, market, f"Over {line}", over, 1), (m, s, market, f"Under {line}", under, 2), (m, s, names[1], f"Over {line}", over, 3)]
        got = table(mk.totals_dedup(read(spark, document(rng, props)), markets=names, label=label, rules=()),
                    ["match", "start_time", "market_name", "home_team", "away_team", "line", "over_price", "under_price", "margin"])
        assert got == sorted(rows)


@pytest.mark.parametrize("seed", range(3))
def test_players(spark, seed):
    rng = random.Random(30 + seed)
    lines, first, props = [], [], []
    for m, h, a, s in matches(rng):
        for k, player in enumerate(PLAYERS):
            team = f"{player} ({rng.choice([h, a])[:3].upper()})"
            for market, line in (("To Score a Try", 0.5), ("To Score 2+ Tries", 1.5)):
                p = price(rng)
                lines.append((m, h, a, "Player Tries", player, line, p, 100 + k))
                props.append((m, s, market, team, p, 100 + k))
            p = price(rng)
            first.append((m, h, a, "First Try Scorer", player, p, 200 + k))
            props.append((m, s, "1st Try Scorer", team, p, 200 + k))
    sel = read(spark, document(rng, props))
    columns = ["match", "home_team", "away_team", "market_name", "player_name", "line", "over_price", "prop_id"]
    out = mk.tab_player_lines(sel, rules=())
    assert table(out, columns) == sorted(lines)
    prices = [r["over_price"] for r in out.collect()]
    assert prices == sorted(prices)
    assert table(mk.tab_outright(sel, rules=()), [c for c in columns if c != "line"]) == sorted(first)


@pytest.mark.parametrize("seed", range(3))
def test_times(spark, seed):
    rng = random.Random(40 + seed)
    rows, props = [], []
    for m, h, a, s in matches(rng):
        line, over, under = f"{rng.randint(2, 20)}:00", price(rng), price(rng)
        rows.append((m, s, "Time of First Try", h, a, line, over, under, margin(over, under)))
        props += [(m, s, "Time of First Try", f"{line} or Earlier", over, 1), (m, s, "Time of First Try", f"{line} or later", under, 2),
                  (m, s, "Time of First Try", "99:00 or later", 50.0, 3)]
    props.append((f"{TEAMS[0]} v Nobody", "2025-03-09T08:50:00Z", "Time of First Try", "5:00 or Earlier", 3.0, 4))  # one side only
    got = table(mk.tab_time_threshold(read(spark, document(rng, props)), rules=()),
                ["match", "start_time", "market_name", "home_team", "away_team", "line", "over_price", "under_price", "margin"])
    assert got == sorted(rows)
