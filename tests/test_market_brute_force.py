"""TAB market operators against plain-Python implementations of the
reference semantics on random selections (duplicates, shuffled order,
labels without a number)."""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from overround import schemas as S
from overround.plans import markets as mk


def margin(a, b):
    if a is None or b is None or a == 0 or b == 0:
        return None
    return float(Decimal(repr(1 / a + 1 / b)).quantize(Decimal("0.001"), rounding=ROUND_HALF_UP))


def frame(spark, recs):
    base = {c: None for c in S.SELECTION_COLUMNS}
    out = []
    for i, (m, market, label, price) in enumerate(recs):
        row = dict(base, agency="TAB", snapshot_id="s", match_pos=m, market_pos=0, prop_pos=i,
                   match=f"T{m} v U{m}", start_time=f"2025-0{m + 1}-01", market_name=market,
                   prop_name=label, price=price)
        out.append(tuple(row[c] for c in S.SELECTION_COLUMNS))
    return spark.createDataFrame(out or [tuple(base[c] for c in S.SELECTION_COLUMNS)], S.SELECTIONS)


rec = st.tuples(st.integers(0, 2),
                st.sampled_from(["Head To Head", "Total Points Over/Under", "Pick Your Own Total", "Other"]),
                st.sampled_from(["Over 40.5", "Under 40.5", "Over 44.5", "Under 44.5", "Over", "Under", "A"]),
                st.sampled_from([1.5, 1.9, 2.0, 0.0]))


@settings(max_examples=12, deadline=None)
@given(st.lists(rec, max_size=14))
def test_h2h_nth_matches_brute_force(spark, recs):
    got = sorted(tuple(r) for r in mk.h2h_nth(frame(spark, recs), rules=())
                 .select("match", "home_win", "away_win", "margin").collect())
    exp = []
    for m in sorted({m for m, market, _, _ in recs if market == "Head To Head"}):
        prices = [p for mm, market, _, p in recs if mm == m and market == "Head To Head"]
        home, away = prices[0], (prices[1] if len(prices) > 1 else None)
        exp.append((f"T{m} v U{m}", home, away, margin(home, away)))
    assert got == sorted(exp)


def _number(label):
    found = re.search(r"-?\d+\.?\d*", label)
    return float(found.group(0)) if found else None


@settings(max_examples=12, deadline=None)
@given(st.lists(rec, max_size=14))
def test_totals_dedup_matches_brute_force(spark, recs):
    markets = ("Total Points Over/Under", "Pick Your Own Total")
    got = sorted((tuple(r) for r in mk.totals_dedup(frame(spark, recs), rules=(), sort=False)
                  .select("match", "line", "over_price", "under_price", "margin").collect()), key=repr)

    def side(word):
        seen, kept = set(), []
        for m, market, label, price in recs:           # input order = document order here
            if market in markets and word in label:
                key = (m, _number(label), price)
                if key not in seen:
                    seen.add(key)
                    kept.append(key)
        return kept

    unders = side("Under")
    exp = []
    for m, line, over in side("Over"):
        matches = [u for um, ul, u in unders if um == m and ul == line]   # None == None matches too
        for under in matches or [None]:
            exp.append((f"T{m} v U{m}", line, over, under, margin(over, under)))
    assert got == sorted(exp, key=repr)


HOME, AWAY = "Home{}", "Away{}"
LETTERS = "ABC"


def line_frame(spark, recs):
    base = {c: None for c in S.SELECTION_COLUMNS}
    out = []
    for i, (m, market, side, line_text, price) in enumerate(recs):
        team = (HOME if side == "h" else AWAY).format(LETTERS[m])
        label = f"{team} {line_text}".strip()
        row = dict(base, agency="TAB", snapshot_id="s", match_pos=m, market_pos=0, prop_pos=i,
                   match=f"{HOME.format(LETTERS[m])} v {AWAY.format(LETTERS[m])}", start_time="t",
                   market_name=market, prop_name=label, price=price)
        out.append(tuple(row[c] for c in S.SELECTION_COLUMNS))
    return spark.createDataFrame(out or [tuple(base[c] for c in S.SELECTION_COLUMNS)], S.SELECTIONS)


line_rec = st.tuples(st.integers(0, 2), st.sampled_from(["Line", "Pick Your Own Line", "Other"]),
                     st.sampled_from(["h", "a"]), st.sampled_from(["+2.5", "-2.5", "+6.5", "-6.5", "+0", ""]),
                     st.sampled_from([1.5, 1.9, 2.6]))


@settings(max_examples=15, deadline=None)
@given(st.lists(line_rec, max_size=14))
def test_line_opposite_matches_brute_force(spark, recs):
    got = sorted((tuple(r) for r in mk.line_opposite(line_frame(spark, recs), rules=())
                  .select("match", "home_line", "home_win", "away_line", "away_win").collect()), key=repr)

    def side(which):
        seen, kept = set(), []
        for m, market, s, text, price in recs:
            if market in ("Line", "Pick Your Own Line") and s == which:
                line = _number(text) if text else None
                key = (m, line, price)
                if key not in seen:               # keep-first per (match, line, price)
                    seen.add(key)
                    kept.append((m, market, line, price))
        return kept

    exp = []
    for m, market, hl, hw in side("h"):
        for am, amarket, al, aw in side("a"):
            same_abs = (None if hl is None else abs(hl)) == (None if al is None else abs(al))
            if am == m and amarket == market and same_abs and hl is not None and al is not None and hl != al:
                exp.append((f"{HOME.format(LETTERS[m])} v {AWAY.format(LETTERS[m])}", hl, hw, al, aw))
    assert got == sorted(exp, key=repr)


sb_line_rec = st.tuples(st.integers(0, 2), st.sampled_from(["h", "a", "x"]),
                        st.sampled_from(["(+2.5)", "(-2.5)", "(+6.5)", "(-6.5)", "(0.0)", "(2)", ""]),
                        st.sampled_from([1.5, 1.9, 2.6]))


@settings(max_examples=15, deadline=None)
@given(st.lists(sb_line_rec, max_size=14))
def test_line_balanced_matches_brute_force(spark, recs):
    base = {c: None for c in S.SELECTION_COLUMNS}
    rows_ = []
    for i, (m, side, text, price) in enumerate(recs):
        team = {"h": HOME, "a": AWAY, "x": "Other{}"}[side].format(LETTERS[m])
        row = dict(base, agency="Sportsbet", snapshot_id="s", match_pos=0, market_pos=0, prop_pos=i,
                   match_id=m, market_name="Line", prop_name=f"{team} {text}".strip(), price=price)
        rows_.append(tuple(row[c] for c in S.SELECTION_COLUMNS))
    sel = spark.createDataFrame(rows_ or [tuple(base[c] for c in S.SELECTION_COLUMNS)], S.SELECTIONS)
    teams = spark.createDataFrame([(m, HOME.format(LETTERS[m]), AWAY.format(LETTERS[m])) for m in range(3)],
                                  S.TEAMS)
    got = sorted((tuple(r) for r in mk.line_balanced(sel, teams, rules=())
                  .select("match", "home_line", "home_win", "away_line", "away_win").collect()), key=repr)

    def parsed(text):
        found = re.search(r"-?\d+\.\d+", text)
        return float(found.group(0)) if found else None

    exp = []
    for m, s1, t1, p1 in recs:
        for m2, s2, t2, p2 in recs:
            h, a = parsed(t1), parsed(t2)
            if s1 == "h" and s2 == "a" and m == m2 and h is not None and a is not None and abs(h + a) < 0.1:
                exp.append((f"{HOME.format(LETTERS[m])} v {AWAY.format(LETTERS[m])}", h, p1, a, p2))
    assert got == sorted(exp, key=repr)


ou_rec = st.tuples(st.integers(0, 2), st.sampled_from(["Over", "Under"]),
                   st.sampled_from([("", 40.5), ("", None), (" 44.5", None), (" 40.5", None)]),
                   st.sampled_from([1.5, 1.9, 2.0]))


@settings(max_examples=15, deadline=None)
@given(st.lists(ou_rec, max_size=12))
def test_over_under_matches_brute_force(spark, recs):
    base = {c: None for c in S.SELECTION_COLUMNS}
    rows_ = []
    for i, (m, word, (suffix, handicap), price) in enumerate(recs):
        row = dict(base, agency="Sportsbet", snapshot_id="s", match_pos=0, market_pos=0, prop_pos=i,
                   match_id=m, source_url=f"u/{m}", market_name="Total Match Points",
                   prop_name=f"Points {word}{suffix}" if suffix else word, handicap=handicap, price=price)
        rows_.append(tuple(row[c] for c in S.SELECTION_COLUMNS))
    sel = spark.createDataFrame(rows_ or [tuple(base[c] for c in S.SELECTION_COLUMNS)], S.SELECTIONS)
    teams = spark.createDataFrame([(m, HOME.format(LETTERS[m]), AWAY.format(LETTERS[m])) for m in range(3)],
                                  S.TEAMS)
    got = sorted((tuple(r) for r in mk.over_under(sel, teams, over_re="Over", under_re="Under")
                  .select("match", "line", "over_price", "under_price").collect()), key=repr)

    def line(suffix, handicap):
        return handicap if handicap is not None else (float(suffix) if suffix else None)

    overs = [(m, line(sfx, hc), p) for m, w, (sfx, hc), p in recs if w == "Over"]
    unders = [(m, line(sfx, hc), p) for m, w, (sfx, hc), p in recs if w == "Under"]
    exp = []
    for m, ln, p in overs:
        partners = [u for um, ul, u in unders if um == m and ul == ln]     # None matches None
        for u in partners or [None]:
            exp.append((f"{HOME.format(LETTERS[m])} v {AWAY.format(LETTERS[m])}", ln, p, u))
    assert got == sorted(exp, key=repr)
