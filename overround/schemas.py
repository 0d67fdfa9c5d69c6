"""Fixed input schemas (no inference pass) and the canonical selections schema."""

from __future__ import annotations

from pyspark.sql import types as T

# TAB-style response: matches -> markets -> propositions.
TAB_PROPOSITION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("returnWin", T.DoubleType()),
])
TAB_MARKET = T.StructType([
    T.StructField("betOption", T.StringType()),
    T.StructField("propositions", T.ArrayType(TAB_PROPOSITION)),
])
TAB_MATCH = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("startTime", T.StringType()),
    T.StructField("markets", T.ArrayType(TAB_MARKET)),
])
TAB_RESPONSE = T.StructType([T.StructField("matches", T.ArrayType(TAB_MATCH))])

# Sportsbet-style market endpoint: a JSON array of markets per (match, endpoint).
SB_SELECTION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("resultType", T.StringType()),
    T.StructField("externalId", T.LongType()),
    T.StructField("unformattedHandicap", T.StringType()),
    T.StructField("price", T.StructType([T.StructField("winPrice", T.DoubleType())])),
])
SB_MARKET = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("externalId", T.LongType()),
    T.StructField("selections", T.ArrayType(SB_SELECTION)),
])
SB_MARKETS_RESPONSE = T.ArrayType(SB_MARKET)

# Sportsbet-style event metadata: one object per match.
SB_EVENT_METADATA = T.StructType([
    T.StructField("classExternalId", T.LongType()),
    T.StructField("competitionExternalId", T.LongType()),
    T.StructField("externalId", T.LongType()),
])

# Landing record: one JSON line per fetched response.
LANDED_RESPONSE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("body", T.StringType()),
])

# Canonical long table every market operator reads.
SELECTIONS = T.StructType([
    T.StructField("agency", T.StringType()),
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("match_pos", T.IntegerType()),
    T.StructField("market_pos", T.IntegerType()),
    T.StructField("prop_pos", T.IntegerType()),
    T.StructField("match_id", T.LongType()),
    T.StructField("match", T.StringType()),
    T.StructField("start_time", T.StringType()),
    T.StructField("market_name", T.StringType()),
    T.StructField("market_id", T.LongType()),
    T.StructField("prop_id", T.LongType()),
    T.StructField("prop_name", T.StringType()),
    T.StructField("result_type", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("handicap", T.DoubleType()),
    T.StructField("source_url", T.StringType()),
    # Which request of the manifest the response answers; when it was landed, and a hash of its
    # text: they tell a response landed again from the one before.
    T.StructField("endpoint", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("body_hash", T.LongType()),
])
SELECTION_COLUMNS = [f.name for f in SELECTIONS.fields]

# Order of a selection inside its document; every order-dependent operator uses it.
ORD = ("match_pos", "market_pos", "prop_pos")
# A match's identity inside a snapshot: the positions order all its selections.
DOC_KEYS = ("source_url", "match_pos")
# Order of all selections of a snapshot.
TOTAL_ORD = ("source_url", *ORD)
# A match's identity inside one feed snapshot.
SNAPSHOT_KEYS = ("agency", "snapshot_id")

# Teams dimension: match id -> home/away names.
TEAMS = T.StructType([
    T.StructField("match_id", T.LongType()),
    T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()),
])


# Market output tables: column order and types of the published CSV outputs.
_DOUBLES = {"home_win", "away_win", "margin", "line", "over_price", "under_price", "home_line",
            "away_line"}
_LONGS = {"prop_id", "player_id", "player_id_unders", "market_id", "class_external_id",
          "competition_external_id", "event_external_id"}


def _table(cols: str, string_line: bool = False) -> T.StructType:
    fields = []
    for c in cols.split():
        if c == "line" and string_line:
            t = T.StringType()
        elif c in _DOUBLES:
            t = T.DoubleType()
        elif c in _LONGS:
            t = T.LongType()
        else:
            t = T.StringType()
        fields.append(T.StructField(c, t))
    return T.StructType(fields)


_TAB_TOTALS = "match start_time market_name home_team away_team line over_price under_price margin agency"
_SB_TOTALS = "match market_name home_team away_team line over_price under_price margin agency"
_SB_PLAYER = ("match home_team away_team market_name player_name line over_price agency class_external_id "
              "competition_external_id event_external_id market_id player_id")

MARKET_TABLES: dict[str, T.StructType] = {
    "tab_h2h": _table("match start_time market_name home_team home_win away_team away_win margin agency"),
    "tab_line": _table("match start_time market_name home_team home_line home_win away_team away_line "
                       "away_win margin agency"),
    "tab_totals": _table(_TAB_TOTALS),
    "tab_total_tries": _table(_TAB_TOTALS),
    "tab_time_of_first_try": _table(_TAB_TOTALS, string_line=True),
    "tab_player_tries": _table("match home_team away_team market_name player_name line over_price prop_id"),
    "tab_first_try_scorer": _table("match home_team away_team market_name player_name over_price prop_id"),
    "sportsbet_h2h": _table("match market_name home_team home_win away_team away_win start_time margin agency"),
    "sportsbet_line": _table("match market_name home_team home_line home_win away_team away_line away_win "
                             "margin agency"),
    "sportsbet_total_points": _table(_SB_TOTALS),
    "sportsbet_total_tries": _table(_SB_TOTALS),
    "sportsbet_player_tries": _table(_SB_PLAYER + " under_price player_id_unders"),
    "sportsbet_first_try_scorer": _table("match home_team away_team market_name player_name over_price agency "
                                         "player_id market_id"),
    "sportsbet_time_of_first_try": _table(_SB_TOTALS, string_line=True),
}
