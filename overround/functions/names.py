"""Name canonicalisation by ordered rules (rules are data, not code).

A rule set is an ordered list of ``(pattern, canonical)`` pairs.  The first
pattern that is *found* in the name wins; no match leaves the name as it is;
null stays null.  The rules fold into one ``CASE WHEN`` expression, so they
run inside whole-stage codegen with no Python in the hot path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col

Rule = tuple[str, str]

# Rugby-league team-name rules, in priority order
# (pattern searched in the raw name -> canonical team name).
TEAM_NAME_RULES: tuple[Rule, ...] = (
    ("(^Brisbane)|(Broncos)", "Brisbane Broncos"),
    ("(^Canberra)|(Raiders)", "Canberra Raiders"),
    ("(^Canterbury)|(Bulldogs)", "Canterbury-Bankstown Bulldogs"),
    ("(^Cronulla)|(Sharks)", "Cronulla Sharks"),
    ("(^Dolphins)", "Dolphins"),
    ("(^Gold Coast)|(Titans)", "Gold Coast Titans"),
    ("(^Manly)|(Sea Eagles)", "Manly Warringah Sea Eagles"),
    ("(^Melbourne)|(Storm)", "Melbourne Storm"),
    ("(^Newcastle)|(Knights)", "Newcastle Knights"),
    ("(^New Zealand Warriors)|(Warriors)", "New Zealand Warriors"),
    ("(^North Queensland)|(Cowboys)", "North Queensland Cowboys"),
    ("(^Parramatta)|(Eels)", "Parramatta Eels"),
    ("(^Penrith)|(Panthers)", "Penrith Panthers"),
    ("(^South Sydney)|(Rabbitohs)", "South Sydney Rabbitohs"),
    ("(^St George Illawarra)|(Dragons)", "St George Illawarra Dragons"),
    ("(^Sydney Roosters)|(Roosters)", "Sydney Roosters"),
    ("(^Wests Tigers)|(Tigers)", "Wests Tigers"),
)

# Exact player-name aliases (feed spelling -> canonical).
PLAYER_ALIASES: tuple[Rule, ...] = (
    ("Nasiah W-Milera", "Nasiah Wanganeen-Milera"),
)


def canonicalize(c: ColumnOrName, rules: Sequence[Rule] = TEAM_NAME_RULES) -> Column:
    """First matching regex rule wins; otherwise the input is returned."""
    name = _col(c)
    if not rules:
        return name
    expr = None
    for pattern, canonical in rules:
        cond = name.rlike(pattern)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    return expr.otherwise(name)


def apply_aliases(c: ColumnOrName, aliases: Sequence[Rule] = PLAYER_ALIASES) -> Column:
    """Exact-match replacement (``case_when(x == a ~ b, .default = x)``)."""
    name = _col(c)
    if not aliases:
        return name
    expr = None
    for alias, canonical in aliases:
        cond = name == F.lit(alias)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    return expr.otherwise(name)
