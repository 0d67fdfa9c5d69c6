"""String and parsing expressions (Column -> Column), all JVM-side.

R/stringr semantics kept on purpose:
* ``str_extract`` gives null (not ``''``) when nothing matches;
* ``str_remove`` / ``str_replace`` touch only the *first* match;
* ``separate`` drops extra pieces and fills missing ones with null;
* ``as_numeric`` turns bad text into null instead of failing under ANSI mode.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def str_detect(c: ColumnOrName, pattern: str) -> Column:
    """Un-anchored, case-sensitive regex find (``rlike``); null stays null."""
    return _col(c).rlike(pattern)


def str_extract(c: ColumnOrName, pattern: str) -> Column:
    """First match of ``pattern``, or null when there is none."""
    return F.regexp_substr(_col(c), F.lit(pattern))


def _literal_replacement(text: str) -> str:
    # Java replacement strings treat '\' and '$' specially.
    return text.replace("\\", "\\\\").replace("$", "\\$")


def str_replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """Replace the first match of ``pattern`` with the literal ``replacement``.

    The lazy prefix finds the leftmost match, exactly like a regex *find*;
    only the prefix may span line breaks (``pattern`` keeps its own ``.``
    semantics); a named group avoids ``$1``-followed-by-digit ambiguity.  That
    group shifts the numbers of the pattern's own, so a pattern with numbered
    back-references is refused; named ones (``\\k<name>``) work.
    """
    if re.search(r"(?<!\\)(?:\\\\)*\\[1-9]", pattern):
        raise ValueError(f"numbered back-reference in {pattern!r}: name the group and use \\k<name>")
    first = f"^(?<orPrefix>(?s:.*?))(?:{pattern})"
    return F.regexp_replace(_col(c), first, "${orPrefix}" + _literal_replacement(replacement))


def _end_anchored(pattern: str) -> bool:
    """True when every non-empty match must end at the end of the text, so a
    pattern can match (non-emptily) at most once: ends in an unescaped ``$``,
    no alternation, no multi-line flag."""
    if not pattern.endswith("$") or "|" in pattern or "(?m" in pattern:
        return False
    backslashes = len(pattern[:-1]) - len(pattern[:-1].rstrip("\\"))
    return backslashes % 2 == 0


def str_remove(c: ColumnOrName, pattern: str) -> Column:
    """Remove the first match of ``pattern``.  An end-anchored pattern has at
    most one non-empty match, so a plain ``regexp_replace`` is exact and
    cheaper than the first-match form."""
    if _end_anchored(pattern):
        return F.regexp_replace(_col(c), pattern, "")
    return str_replace_first(c, pattern, "")


def as_numeric(c: ColumnOrName) -> Column:
    """Text -> double; malformed text gives null (never an ANSI error)."""
    return _col(c).try_cast("double")


def as_long(c: ColumnOrName) -> Column:
    """Text -> bigint; malformed text gives null."""
    return _col(c).try_cast("bigint")


def separate(c: ColumnOrName, sep: str, into: list[str]) -> list[Column]:
    """Split on the regex ``sep`` into ``len(into)`` named columns.

    Pieces beyond ``len(into)`` are dropped, missing ones are null.
    """
    parts = F.split(_col(c), sep)
    return [F.get(parts, i).alias(name) for i, name in enumerate(into)]


def paste(*parts: ColumnOrName, sep: str = " ") -> Column:
    """Join parts with ``sep``; a null part makes the result null."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_col(p))
    return F.concat(*cols)


def paste0(*parts: ColumnOrName) -> Column:
    """Concatenate without a separator; a null part makes the result null."""
    return F.concat(*[_col(p) for p in parts])


# Number and id patterns used by the bookmaker feeds.
SIGNED_NUMBER = r"-?\d+\.?\d*"          # "+2.5" -> "2.5", "-2" -> "-2"
SIGNED_DECIMAL = r"-?\d+\.\d+"          # needs a decimal point: "-2" -> null
URL_MATCH_ID = r"[0-9]{6,8}"            # first run of 6-8 digits in a URL
LINK_ID_TAIL = r"\d{4,10}$"             # 4-10 trailing digits of a link
CLOCK_TEXT = r"\d+:\d+"                 # "8:00"
FIRST_INTEGER = r"\d+"


def extract_number(c: ColumnOrName, pattern: str = SIGNED_NUMBER) -> Column:
    """First number matching ``pattern`` as a double; null when there is none."""
    return as_numeric(str_extract(c, pattern))


def url_match_id(c: ColumnOrName, pattern: str = URL_MATCH_ID) -> Column:
    """Numeric id inside a URL (first run of 6-8 digits by default)."""
    return as_long(str_extract(c, pattern))


def link_id_tail(c: ColumnOrName, pattern: str = LINK_ID_TAIL) -> Column:
    """Numeric id at the end of a link (4-10 trailing digits by default)."""
    return as_long(str_extract(c, pattern))


def alt_line(market_name: ColumnOrName) -> Column:
    """"2+ Tries" style markets: first integer in the name minus a half."""
    return extract_number(market_name, FIRST_INTEGER) - F.lit(0.5)


def decode_entities(c: ColumnOrName) -> Column:
    """Decode the predefined XML entities, ``&nbsp;`` and all numeric ones
    (``&#233;``, ``&#xE9;``); ``&amp;`` last, so nothing is decoded twice."""
    out = _col(c)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    # Each distinct number of the text is replaced everywhere; texts without any skip this.
    for prefix, digits, base in (("&#", "[0-9]{1,7}", 10), ("&#[xX]", "[0-9a-fA-F]{1,6}", 16)):
        found = F.array_distinct(F.regexp_extract_all(out, F.lit(f"({prefix}{digits};)"), F.lit(1)))
        decoded = F.aggregate(found, out, _replace_entity(base))
        out = F.when(out.contains("&#"), decoded).otherwise(out)
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def _replace_entity(base: int) -> Callable[[Column, Column], Column]:
    return lambda text, entity: F.replace(text, entity, _code_point(entity, base))


def _code_point(entity: Column, base: int) -> Column:
    """Character of a numeric entity; numbers that are no character give U+FFFD."""
    number = F.conv(F.regexp_replace(entity, "[^0-9a-fA-F]", ""), base, 10).cast("long")
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    wide = F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(F.lit(0xFFFD))), 8, "0"))
    return F.decode(wide, "UTF-32")


def strip_tags(c: ColumnOrName) -> Column:
    """Remove every markup tag, keeping the text between them."""
    return F.regexp_replace(_col(c), r"<[^>]*>", "")
