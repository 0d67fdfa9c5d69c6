"""Column expressions: text parsing, name rules, price arithmetic."""

from .names import PLAYER_ALIASES, TEAM_NAME_RULES, apply_aliases, canonicalize
from .pricing import implied_probability, margin
from .rule_table import apply_alias_table, canonicalize_by_table, rule_index
from .text import (
    CLOCK_TEXT, FIRST_INTEGER, LINK_ID_TAIL, SIGNED_DECIMAL, SIGNED_NUMBER, URL_MATCH_ID,
    alt_line, as_long, as_numeric, decode_entities, extract_number, link_id_tail, paste, paste0,
    separate, str_detect, str_extract, str_remove, str_replace_first, strip_tags, url_match_id,
)

__all__ = [
    "PLAYER_ALIASES", "TEAM_NAME_RULES", "apply_aliases", "canonicalize", "implied_probability",
    "margin", "CLOCK_TEXT", "FIRST_INTEGER", "LINK_ID_TAIL", "SIGNED_DECIMAL", "SIGNED_NUMBER",
    "URL_MATCH_ID", "alt_line", "as_long", "as_numeric", "decode_entities", "extract_number",
    "link_id_tail", "paste", "paste0", "separate", "str_detect", "str_extract", "str_remove",
    "str_replace_first", "strip_tags", "url_match_id", "apply_alias_table", "canonicalize_by_table",
    "rule_index",
]
