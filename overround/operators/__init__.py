"""DataFrame -> DataFrame operators (nested data, joins, ordered grouping)."""

from .groups import (
    any_true, distinct_values, first_by, first_where, keep_first, nth_row, nth_rows, order_key,
    row_number_within, sort_multi, sort_stable, union_by_name, union_distinct_by_name,
)
from .joins import (
    away_bucket, balanced_pairs, home_buckets, labelled_sides, lookup_join, natural_join,
    opposite_sign_pairs, pair_sides, positional_join, shared_columns,
)
from .nested import array_get, positional_zip, select_any_of, unnest, unnest_path
from .ordinals import with_ordinal

__all__ = [
    "any_true", "distinct_values", "first_by", "first_where", "keep_first", "nth_row", "nth_rows",
    "order_key", "row_number_within", "sort_multi", "sort_stable", "union_by_name",
    "union_distinct_by_name", "balanced_pairs", "lookup_join", "natural_join",
    "away_bucket", "home_buckets", "labelled_sides", "pair_sides",
    "opposite_sign_pairs", "positional_join", "shared_columns", "array_get", "positional_zip", "select_any_of",
    "unnest", "unnest_path", "with_ordinal",
]
