"""Market operators: canonical ``selections`` -> market tables.

Each function is ``DataFrame -> DataFrame`` and reads the long
``selections`` table (see ``overround.schemas.SELECTIONS``).  Work is keyed
by the snapshot keys plus the match, so shuffles spread over matches x
agencies x snapshots.  Pairing uses equi-joins or one-pass conditional
aggregation, never a per-match loop or a cross product.

TAB-style feeds name the match ``"Home v Away"`` and order propositions;
Sportsbet-style feeds carry a ``match_id`` that is looked up in a teams
dimension ``(match_id, home_team, away_team)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (
    CLOCK_TEXT, PLAYER_ALIASES, SIGNED_DECIMAL, SIGNED_NUMBER, TEAM_NAME_RULES, alt_line,
    apply_aliases, as_numeric, canonicalize, extract_number, margin, paste, paste0, separate,
    str_detect, str_extract, str_remove, str_replace_first,
)
from ..operators import (
    any_true, away_bucket, first_where, home_buckets, keep_first, labelled_sides, lookup_join,
    natural_join, nth_rows, pair_sides, sort_multi, sort_stable,
)
from ..schemas import DOC_KEYS, ORD, SNAPSHOT_KEYS, TOTAL_ORD

Keys = Sequence[str]
Rules = Sequence[tuple[str, str]]

MATCH_SEP = " v "


def _split_match(match: str = "match") -> list[Column]:
    return separate(match, MATCH_SEP, ["home_team", "away_team"])


def _canonical_teams(df: DataFrame, rules: Rules) -> DataFrame:
    """Canonicalise both team names, then rebuild the match label from them
    (sequential: the label sees the new names)."""
    return (df.withColumn("home_team", canonicalize("home_team", rules))
              .withColumn("away_team", canonicalize("away_team", rules))
              .withColumn("match", paste("home_team", F.lit("v"), "away_team")))


def _with_keys(cols: Sequence[str], keys: Keys, with_keys: bool) -> list[str]:
    """Output columns, led by the snapshot keys when asked for (a key that is
    already an output column, such as ``agency``, is not repeated)."""
    return [*[k for k in keys if k not in cols], *cols] if with_keys else list(cols)


def _merged(*names: Keys) -> list[str]:
    """Column names of several lists, each once, in order."""
    return list(dict.fromkeys(c for part in names for c in part))


def _total(df: DataFrame, ord: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The order as one column: positions inside a document are ints, so they fit
    side by side into a decimal, which hash aggregation can hold (a struct can't)."""
    if len(ord) < 2 or any(df.schema[c].dataType.typeName() != "integer" for c in ord):
        return df, list(ord)
    packed = F.lit(0).cast("decimal(38,0)")
    for c in ord:
        packed = (packed * F.lit(10**10).cast("decimal(11,0)")).cast("decimal(38,0)") + F.col(c)
    return df.withColumn("_ord", packed.cast("decimal(38,0)")), ["_ord"]


def routed(df: DataFrame, endpoint: str | None) -> DataFrame:
    """Selections of one endpoint's responses (all when None): a market that several
    endpoints list is read from its own only."""
    return df if endpoint is None else df.filter(F.col("endpoint") == endpoint)


def _match_keys(facts: DataFrame, dim: DataFrame) -> list[str]:
    """A dimension of several snapshots is looked up by snapshot and match."""
    both = "snapshot_id" in facts.columns and "snapshot_id" in dim.columns
    return ["snapshot_id", "match_id"] if both else ["match_id"]


def one_per_match(dim: DataFrame, ord: Sequence[str]) -> DataFrame:
    """One row for each match (and snapshot, if there is one), the first in ``ord``
    (``ord`` columns are dropped); rows without a match id are no dimension rows."""
    keys = [c for c in ("snapshot_id", "match_id") if c in dim.columns]
    return keep_first(dim.filter("match_id IS NOT NULL"), keys, ord).drop(*[c for c in ord if c not in keys])


def _key_head(keys: Keys, with_keys: bool) -> list[str]:
    """Leading key columns for outputs that carry their own ``agency``."""
    return [k for k in keys if k != "agency"] if with_keys else []


# ---------------------------------------------------------------- TAB-style

def h2h_nth(selections: DataFrame, market: str = "Head To Head", agency: str = "TAB",
            keys: Keys = SNAPSHOT_KEYS, ord: Sequence[str] = ORD, rules: Rules = TEAM_NAME_RULES,
            with_keys: bool = False, doc: Keys = DOC_KEYS) -> DataFrame:
    """Head-to-head from ordered propositions: the 1st proposition of a match
    is the home price, the 2nd the away price.

    ``row_number() <= 2`` (partial limit before the shuffle) and one
    grouping on the same partitioning replace the self-join of the two
    sides; groups without a first row are dropped like the left join does.
    """
    s = (selections.filter(F.col("market_name") == market)
                   .select(*_merged(keys, doc, ord), "match", *_split_match(), "start_time", "market_name", "price"))
    top = nth_rows(s, [*keys, *doc, "match"], ord, 2, "_rn")
    wide = (top.groupBy(*keys, *doc, "match", "home_team", "away_team", "start_time", "market_name")
               .agg(F.max(F.when(F.col("_rn") == 1, F.col("price"))).alias("home_win"),
                    F.max(F.when(F.col("_rn") == 2, F.col("price"))).alias("away_win"),
                    any_true(F.col("_rn") == 1).alias("_has_home"))
               .filter("_has_home"))
    out = (wide.withColumn("margin", margin("home_win", "away_win"))
               .withColumn("agency", F.lit(agency)))
    out = _canonical_teams(out, rules)
    return out.select(*_with_keys(["match", "start_time", "market_name", "home_team", "home_win",
                                   "away_team", "away_win", "margin", "agency"], keys, with_keys))


def line_opposite(selections: DataFrame, markets: Sequence[str] = ("Line", "Pick Your Own Line"),
                  label: str = "Line", agency: str = "TAB", keys: Keys = SNAPSHOT_KEYS,
                  ord: Sequence[str] = ORD, rules: Rules = TEAM_NAME_RULES,
                  with_keys: bool = False, doc: Keys = DOC_KEYS) -> DataFrame:
    """Handicap market from labels ``"Team +2.5"``: each side is the team
    before the sign; sides are kept first per (match, line, price), paired on
    ``|line|`` and kept when the signed lines differ (so a 0 line drops)."""
    base = (selections.filter(F.col("market_name").isin(*markets))
                      .select(*_merged(keys, doc, ord), "match", *_split_match(), "start_time",
                              "market_name", "prop_name", "price")
                      .withColumn("_team", str_remove("prop_name", r" [\+\-].*$"))
                      .withColumn("_line", extract_number("prop_name", SIGNED_NUMBER)))

    sides = labelled_sides(base, {"home": F.col("_team") == F.col("home_team"),
                                  "away": F.col("_team") == F.col("away_team")})
    sides = keep_first(sides, [*keys, *doc, "match", "_side", "_line", "price"], ord).withColumn(
        "line", F.abs("_line"))
    pair_keys = [*keys, *doc, "match", "home_team", "away_team", "start_time", "market_name", "line"]
    pairs = pair_sides(sides, pair_keys, F.col("_side") == "home", F.col("_side") == "away",
                       [F.col("_line").alias("home_line"), F.col("price").alias("home_win")],
                       [F.col("_line").alias("away_line"), F.col("price").alias("away_win")])
    pairs = pairs.filter(F.col("home_line") != F.col("away_line"))
    out = (pairs.withColumn("market_name", F.lit(label))
                .withColumn("margin", margin("home_win", "away_win"))
                .withColumn("agency", F.lit(agency)))
    out = _canonical_teams(out, rules)
    return out.select(*_with_keys(["match", "start_time", "market_name", "home_team", "home_line",
                                   "home_win", "away_team", "away_line", "away_win", "margin",
                                   "agency"], keys, with_keys))


def totals_dedup(selections: DataFrame,
                 markets: Sequence[str] = ("Total Points Over/Under", "Pick Your Own Total"),
                 label: str = "Total Points", over_re: str = "Over", under_re: str = "Under",
                 agency: str = "TAB", keys: Keys = SNAPSHOT_KEYS, ord: Sequence[str] = ORD,
                 rules: Rules = TEAM_NAME_RULES, sort: bool = True,
                 with_keys: bool = False, doc: Keys = DOC_KEYS) -> DataFrame:
    """Over/under market fed by several market names: line parsed from the
    label, each side kept first per (match, line, price), overs left-joined
    to unders on the shared columns (null lines match), sorted."""
    base = (selections.filter(F.col("market_name").isin(*markets))
                      .select(*_merged(keys, doc, ord), "match", *_split_match(), "start_time",
                              "prop_name", "price")
                      .withColumn("line", extract_number("prop_name", SIGNED_NUMBER))
                      .withColumn("market_name", F.lit(label)))
    common = ["match", "start_time", "market_name", "home_team", "away_team", "line"]

    sides = labelled_sides(base, {"over": str_detect("prop_name", over_re),
                                  "under": str_detect("prop_name", under_re)})
    sides = keep_first(sides, [*keys, *doc, "match", "_side", "line", "price"], ord)
    joined = pair_sides(sides, [*keys, *doc, *common], F.col("_side") == "over", F.col("_side") == "under",
                        [F.col("price").alias("over_price")], [F.col("price").alias("under_price")], how="left")
    out = _canonical_teams(joined, rules)
    out = (out.withColumn("margin", margin("over_price", "under_price"))
              .withColumn("agency", F.lit(agency))
              .select(*_with_keys([*common, "over_price", "under_price", "margin", "agency"],
                                  keys, with_keys)))
    return sort_multi(out, ["start_time", "match", "line"]) if sort else out


def tab_player_lines(selections: DataFrame, market_re: str = r"To Score a Try$|2\+ Tries$",
                     label: str = "Player Tries", keys: Keys = SNAPSHOT_KEYS,
                     ord: Sequence[str] = TOTAL_ORD, rules: Rules = TEAM_NAME_RULES,
                     aliases: Rules = PLAYER_ALIASES, sort: bool = True,
                     with_keys: bool = False) -> DataFrame:
    """Alternate player lines: "To Score a Try" -> 0.5, "2+ Tries" -> 1.5;
    player name is the label without its ``" (...)"`` suffix."""
    s = (selections.filter(str_detect("market_name", market_re))
                   .withColumn("market_name", str_replace_first("market_name", "a Try", "1+ Tries"))
                   .withColumn("player_name", str_remove("prop_name", r" \(.*\)"))
                   .withColumn("line", alt_line("market_name"))
                   .select(*keys, "match", F.lit(label).alias("market_name"), "player_name",
                           "line", F.col("price").alias("over_price"), "prop_id", *ord)
                   .select("*", *_split_match()))
    s = _canonical_teams(s, rules).withColumn("player_name", apply_aliases("player_name", aliases))
    cols = _with_keys(["match", "home_team", "away_team", "market_name", "player_name", "line",
                       "over_price", "prop_id"], keys, with_keys)
    if sort:
        return sort_stable(s, ["over_price"], ord).select(*cols)
    return s.select(*cols)


def tab_outright(selections: DataFrame, market_re: str = "1st Try Scorer$",
                 label: str = "First Try Scorer", keys: Keys = SNAPSHOT_KEYS,
                 ord: Sequence[str] = TOTAL_ORD, rules: Rules = TEAM_NAME_RULES,
                 aliases: Rules = PLAYER_ALIASES, sort: bool = True,
                 with_keys: bool = False) -> DataFrame:
    """Outright (one price per player, no line): first try scorer."""
    s = (selections.filter(str_detect("market_name", market_re))
                   .withColumn("player_name", str_remove("prop_name", r" \(.*\)"))
                   .select(*keys, "match", F.lit(label).alias("market_name"), "player_name",
                           F.col("price").alias("over_price"), "prop_id", *ord)
                   .select("*", *_split_match()))
    s = _canonical_teams(s, rules).withColumn("player_name", apply_aliases("player_name", aliases))
    cols = _with_keys(["match", "home_team", "away_team", "market_name", "player_name",
                       "over_price", "prop_id"], keys, with_keys)
    if sort:
        return sort_stable(s, ["over_price"], ord).select(*cols)
    return s.select(*cols)


def tab_time_threshold(selections: DataFrame, market_re: str = "Time of First Try",
                       label: str = "Time of First Try", over_re: str = "or Earlier",
                       under_re: str = "or later", agency: str = "TAB",
                       keys: Keys = SNAPSHOT_KEYS, ord: Sequence[str] = ORD,
                       rules: Rules = TEAM_NAME_RULES, with_keys: bool = False,
                       doc: Keys = DOC_KEYS) -> DataFrame:
    """Time-threshold market pivoted long -> wide in one aggregation: over =
    first "or Earlier" price, under = first "or later" price, line = the
    ``m:ss`` text of that "or later" label.  A match lacking either side is
    dropped.  ``line`` stays a string."""
    s = (selections.filter(str_detect("market_name", market_re))
                   .withColumn("market_name", F.lit(label))
                   .select("*", *_split_match()))
    s, ord = _total(_canonical_teams(s, rules), ord)
    is_over, is_under = str_detect("prop_name", over_re), str_detect("prop_name", under_re)
    # The label is made of both names, so they are part of the key.
    wide = (s.groupBy(*keys, *doc, "match", "home_team", "away_team", "start_time", "market_name")
              .agg(first_where(str_extract("prop_name", CLOCK_TEXT), is_under, ord).alias("line"),
                   first_where("price", is_over, ord).alias("over_price"),
                   first_where("price", is_under, ord).alias("under_price"),
                   any_true(is_over).alias("_has_over"), any_true(is_under).alias("_has_under"))
              .filter(F.col("_has_over") & F.col("_has_under")))
    out = (wide.withColumn("margin", margin("over_price", "under_price"))
               .withColumn("agency", F.lit(agency)))
    return out.select(*_with_keys(["match", "start_time", "market_name", "home_team", "away_team",
                                   "line", "over_price", "under_price", "margin", "agency"],
                                  keys, with_keys))


# ---------------------------------------------------------- Sportsbet-style

def h2h_positional(cards: DataFrame, agency: str = "Sportsbet", rules: Rules = TEAM_NAME_RULES,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Head-to-head from listing cards: parallel arrays of participant names
    and prices, 1st = home, 2nd = away (null when missing)."""
    out = cards.select(
        *keep,
        F.get("participants", 0).alias("home_team"), F.get("participants", 1).alias("away_team"),
        as_numeric(F.get("prices", 0)).alias("home_win"),
        as_numeric(F.get("prices", 1)).alias("away_win"),
        "start_time",
    )
    out = (_canonical_teams(out, rules)
           .withColumn("market_name", F.lit("Head To Head"))
           .withColumn("margin", margin("home_win", "away_win"))
           .withColumn("agency", F.lit(agency)))
    return out.select(*keep, "match", "market_name", "home_team", "home_win", "away_team",
                      "away_win", "start_time", "margin", "agency")


def canonical_teams_dim(teams: DataFrame, rules: Rules = TEAM_NAME_RULES) -> DataFrame:
    """Teams dimension with canonical names (and its snapshots, if it has them)."""
    key = ["snapshot_id"] if "snapshot_id" in teams.columns else []
    return teams.select(*key, "match_id", canonicalize("home_team", rules).alias("home_team"),
                        canonicalize("away_team", rules).alias("away_team"))


def line_balanced(selections: DataFrame, teams: DataFrame,
                  market_re: str = "Line|Pick Your Own Line", agency: str = "Sportsbet",
                  tol: float = 0.1, keys: Keys = SNAPSHOT_KEYS, rules: Rules = TEAM_NAME_RULES,
                  with_keys: bool = False, doc: Keys = ("source_url",)) -> DataFrame:
    """Handicap market from labels ``"Team (+2.5)"``: side decided by the
    teams dimension; every home x away pair of a match whose lines cancel
    (``|h + a| < tol``) is a market row (a 0/0 pair is kept).  The band join
    runs as a bucketed equi-join."""
    s = (selections.filter(str_detect("market_name", market_re))
                   .withColumn("team_name", canonicalize(str_remove("prop_name", r" \(.*\)$"), rules))
                   .withColumn("handicap_extracted", extract_number("prop_name", SIGNED_DECIMAL)))
    s = lookup_join(s, teams, _match_keys(s, teams))
    sides = labelled_sides(s, {"home": F.col("team_name") == F.col("home_team"),
                               "away": F.col("team_name") == F.col("away_team")})
    # The band as buckets: a home line goes to the one or two that its band touches.
    line = F.col("handicap_extracted")
    place = F.when(F.col("_side") == "home", home_buckets("handicap_extracted", tol)).otherwise(
        F.array(away_bucket("handicap_extracted", tol)))
    sides = sides.filter(line.isNotNull() & F.col("match_id").isNotNull()).withColumn("_bucket", F.explode(place))
    price = F.col("price")
    pairs = pair_sides(sides, [*_merged(keys, doc), "match_id", "_bucket"], F.col("_side") == "home",
                       F.col("_side") == "away",
                       [F.col("team_name").alias("home_team"), line.alias("home_line"), price.alias("home_win")],
                       [F.col("team_name").alias("away_team"), line.alias("away_line"), price.alias("away_win")])
    pairs = pairs.filter(F.abs(F.col("home_line") + F.col("away_line")) < F.lit(tol))
    out = (pairs.withColumn("match", paste("home_team", F.lit("v"), "away_team"))
                .withColumn("market_name", F.lit("Line"))
                .withColumn("margin", margin("home_win", "away_win"))
                .withColumn("agency", F.lit(agency)))
    return out.select(*_with_keys(["match", "market_name", "home_team", "home_line", "home_win",
                                   "away_team", "away_line", "away_win", "margin", "agency"],
                                  keys, with_keys))


def _sb_sides(df: DataFrame, over_re: str, under_re: str, more: Mapping[str, Column] = MappingProxyType({})) -> DataFrame:
    """Rows of both sides of an over/under, labelled, with ``line`` = explicit
    handicap, else the number after the side's word in the label; ``name_2`` =
    text before it.  ``more`` labels further rows."""
    sides = labelled_sides(df, {"over": str_detect("prop_name", over_re), "under": str_detect("prop_name", under_re), **more})
    parts = {side: separate("prop_name", word, ["name_2", "line_2"])
             for side, word in (("over", " Over "), ("under", " Under "))}
    is_over = F.col("_side") == "over"
    name_2, line_2 = (F.when(is_over, o).otherwise(u) for o, u in zip(parts["over"], parts["under"], strict=True))
    return sides.withColumns({"name_2": name_2, "line": F.coalesce(F.col("handicap"), as_numeric(line_2))})


def over_under(selections: DataFrame, teams: DataFrame, market_re: str = "Total Match Points",
               over_re: str = "Over$", under_re: str = "Under$", label: str = "Total Points",
               agency: str = "Sportsbet", keys: Keys = SNAPSHOT_KEYS,
               with_keys: bool = False) -> DataFrame:
    """Over/under pairing per response document: overs left-joined to unders
    on (document, line) with null lines matching; unders without an over
    drop; then the teams lookup names the match."""
    base = selections.filter(str_detect("market_name", market_re))
    sides = _sb_sides(base, over_re, under_re)
    # The key includes the response document, so one key's rows are bounded by
    # one response.
    joined = pair_sides(sides, [*keys, "source_url", "line"], F.col("_side") == "over", F.col("_side") == "under",
                        ["match_id", F.col("price").alias("over_price")], [F.col("price").alias("under_price")],
                        how="left")
    out = lookup_join(joined, teams, _match_keys(joined, teams))
    out = (out.withColumn("match", paste("home_team", F.lit("v"), "away_team"))
              .withColumn("market_name", F.lit(label))
              .withColumn("margin", margin("over_price", "under_price"))
              .withColumn("agency", F.lit(agency)))
    return out.select(*_with_keys(["match", "market_name", "home_team", "away_team", "line",
                                   "over_price", "under_price", "margin", "agency"],
                                  keys, with_keys))


def enrich_selections(selections: DataFrame, teams: DataFrame,
                      metadata: DataFrame | None = None) -> DataFrame:
    """Attach team names, the match label and (optionally) event metadata
    ids by ``match_id`` (null-safe natural join for the metadata)."""
    out = lookup_join(selections.drop("match"), teams, _match_keys(selections, teams))
    out = out.withColumn("match", paste("home_team", F.lit("v"), "away_team"))
    if metadata is not None:
        out = natural_join(out, metadata, on=_match_keys(out, metadata), how="left")
    return out


PLAYER_COLUMNS = ["match", "home_team", "away_team", "market_name", "player_name", "line"]
EVENT_ID_COLUMNS = ["class_external_id", "competition_external_id", "event_external_id"]


def _ensure(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = {c: F.lit(None).cast("bigint") for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def sb_player_lines(enriched: DataFrame, market_re: str = "To Score", exclude_re: str = "First",
                    label: str = "Player Tries", agency: str = "Sportsbet",
                    keys: Keys = SNAPSHOT_KEYS, with_keys: bool = False) -> DataFrame:
    """Alternate player lines from market names ("To Score 2+ Tries" -> 1.5)."""
    e = _ensure(enriched, EVENT_ID_COLUMNS)
    s = (e.filter(str_detect("market_name", market_re) & ~str_detect("market_name", exclude_re))
          .withColumn("line", alt_line("market_name")))
    return s.select(*_key_head(keys, with_keys), "match", "home_team", "away_team",
                    F.lit(label).alias("market_name"), F.col("prop_name").alias("player_name"),
                    "line", F.col("price").alias("over_price"), F.lit(agency).alias("agency"),
                    *EVENT_ID_COLUMNS, "market_id", F.col("prop_id").alias("player_id"))


def sb_player_over_under(enriched: DataFrame, over_re: str = "Over", under_re: str = "Under",
                         label: str = "Player Tries", agency: str = "Sportsbet",
                         keys: Keys = SNAPSHOT_KEYS, with_keys: bool = False) -> DataFrame:
    """Player over/under: player = label text before " Over "/" Under ",
    overs left-joined to unders on every shared column (null-safe)."""
    e = _ensure(enriched, EVENT_ID_COLUMNS)
    head = _key_head(keys, True)  # both sides are of one snapshot, whatever the output shows

    sides = _sb_sides(e, over_re, under_re).select(
        *head, "match", "home_team", "away_team", F.lit(label).alias("market_name"),
        F.col("name_2").alias("player_name"), "line", F.lit(agency).alias("agency"), *EVENT_ID_COLUMNS,
        "market_id", "_side", "price", "prop_id")
    # Keys include the per-document market id, so a key's rows are bounded by
    # one response document.
    shared = [c for c in sides.columns if c not in ("_side", "price", "prop_id")]
    pairs = pair_sides(sides, shared, F.col("_side") == "over", F.col("_side") == "under",
                       [F.col("price").alias("over_price"), F.col("prop_id").alias("player_id")],
                       [F.col("price").alias("under_price"), F.col("prop_id").alias("player_id_unders")], how="left")
    pairs = pairs.select(*head, *PLAYER_COLUMNS, "over_price", "agency", *EVENT_ID_COLUMNS, "market_id",
                         "player_id", "under_price", "player_id_unders")
    return pairs if with_keys else pairs.drop(*head)


def sb_player_tries(enriched: DataFrame, keys: Keys = SNAPSHOT_KEYS, with_keys: bool = False,
                    line_re: str = "To Score", exclude_re: str = "First", over_re: str = "Over",
                    under_re: str = "Under", label: str = "Player Tries", agency: str = "Sportsbet") -> DataFrame:
    """All player-try markets: alternate lines (``sb_player_lines``) and
    over/under (``sb_player_over_under``), union by name, distinct.

    The selections are read and enriched once: each row is labelled with the
    market and side that it belongs to (it may belong to several), and one
    exchange serves both markets.  An alternate line is an over without unders.
    """
    e = _ensure(enriched, EVENT_ID_COLUMNS)
    head = _key_head(keys, True)
    is_line = str_detect("market_name", line_re) & ~str_detect("market_name", exclude_re)
    sides = _sb_sides(e, over_re, under_re, {"line": is_line})
    line = F.col("_side") == "line"
    sides = sides.select(
        *head, "match", "home_team", "away_team", F.lit(label).alias("market_name"),
        F.when(line, F.col("prop_name")).otherwise(F.col("name_2")).alias("player_name"),
        F.when(line, alt_line("market_name")).otherwise(F.col("line")).alias("line"),
        F.lit(agency).alias("agency"), *EVENT_ID_COLUMNS, "market_id", line.alias("_alternate"), "_side", "price", "prop_id")
    shared = [c for c in sides.columns if c not in ("_side", "price", "prop_id")]
    pairs = pair_sides(sides, shared, F.col("_side") != "under", F.col("_side") == "under",
                       [F.col("price").alias("over_price"), F.col("prop_id").alias("player_id")],
                       [F.col("price").alias("under_price"), F.col("prop_id").alias("player_id_unders")], how="left")
    return pairs.select(*_key_head(keys, with_keys), *PLAYER_COLUMNS, "over_price", "agency", *EVENT_ID_COLUMNS, "market_id",
                        "player_id", "under_price", "player_id_unders").distinct()


def sb_outright(enriched: DataFrame, market_re: str = "First Try Scorer",
                label: str = "First Try Scorer", agency: str = "Sportsbet",
                keys: Keys = SNAPSHOT_KEYS, with_keys: bool = False) -> DataFrame:
    """Outright (first try scorer) with player and market ids."""
    s = enriched.filter(str_detect("market_name", market_re))
    return s.select(*_key_head(keys, with_keys), "match", "home_team", "away_team",
                    F.lit(label).alias("market_name"), F.col("prop_name").alias("player_name"),
                    F.col("price").alias("over_price"), F.lit(agency).alias("agency"),
                    F.col("prop_id").alias("player_id"), "market_id")


def sb_time_threshold(enriched: DataFrame, market_re: str = "Time of First Try",
                      label: str = "Time of First Try", over_re: str = "0-",
                      under_re: str = "No Try", agency: str = "Sportsbet",
                      keys: Keys = SNAPSHOT_KEYS, ord: Sequence[str] = ORD,
                      with_keys: bool = False, doc: Keys = DOC_KEYS) -> DataFrame:
    """Time band market: over = first "0-NN" band price, under = first
    "No Try" price, line = ``"NN:00"``; rows without a line are dropped
    (a missing under price is kept as null)."""
    s, ord = _total(enriched.filter(str_detect("market_name", market_re)), ord)
    is_over, is_under = str_detect("prop_name", over_re), str_detect("prop_name", under_re)
    wide = (s.groupBy(*keys, *doc, "match", "match_id", "home_team", "away_team", "market_name")
              .agg(first_where(str_extract("prop_name", r"0-\d+"), is_over, ord).alias("line"),
                   first_where("price", is_over, ord).alias("over_price"),
                   first_where("price", is_under, ord).alias("under_price")))
    out = (wide.withColumn("line", paste0(str_replace_first("line", "0-", ""), F.lit(":00")))
               .filter(F.col("line").isNotNull())
               .withColumn("market_name", F.lit(label))
               .withColumn("margin", margin("over_price", "under_price"))
               .withColumn("agency", F.lit(agency)))
    return out.select(*_with_keys(["match", "market_name", "home_team", "away_team", "line",
                                   "over_price", "under_price", "margin", "agency"],
                                  keys, with_keys))
