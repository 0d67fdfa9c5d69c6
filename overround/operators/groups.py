"""Order-aware grouping operators: keep-first, n-th row, first/conditional
picks, stable sorts and by-name unions.

Input order is never assumed: callers pass explicit ordering columns
(``ord``), so results do not depend on partitioning or shuffle order.

Scale notes
* ``row_number() <= k`` plans as a partial ``WindowGroupLimit`` *before*
  the shuffle and a final one after, so a hot key is cut to ``k`` rows per
  input partition before it moves.
* ``min_by``/``max_by``/``bool_or`` are partial aggregates: every map task
  pre-aggregates, so a key holding a third of the rows ships one buffer per
  task, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_key(ord_cols: Sequence[ColumnOrName]) -> Column:
    """A single orderable value for a composite order (struct compares
    field by field)."""
    cols = [_c(c) for c in ord_cols]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def row_number_within(partition: Sequence[str], ord_cols: Sequence[ColumnOrName]) -> Column:
    """1-based position of a row inside its group in ``ord`` order (nulls last)."""
    w = Window.partitionBy(*partition).orderBy(*[_c(c).asc_nulls_last() for c in ord_cols])
    return F.row_number().over(w)


def nth_rows(df: DataFrame, partition: Sequence[str], ord_cols: Sequence[ColumnOrName],
             n_max: int, rn_name: str = "rn") -> DataFrame:
    """Rows 1..n_max of every group in ``ord`` order, with their rank."""
    return (df.withColumn(rn_name, row_number_within(partition, ord_cols))
              .filter(F.col(rn_name) <= n_max))


def nth_row(df: DataFrame, partition: Sequence[str], ord_cols: Sequence[ColumnOrName],
            n: int) -> DataFrame:
    """``group_by(...) |> filter(row_number() == n)``."""
    return nth_rows(df, partition, ord_cols, n, "_rn").filter(F.col("_rn") == n).drop("_rn")


def keep_first(df: DataFrame, keys: Sequence[str], ord_cols: Sequence[ColumnOrName]) -> DataFrame:
    """``distinct(keys, .keep_all = TRUE)``: the first row per key in ``ord``
    order, all columns kept (unlike ``dropDuplicates``, which keeps an
    arbitrary row)."""
    return nth_row(df, keys, ord_cols, 1)


def first_by(value: ColumnOrName, ord_cols: Sequence[ColumnOrName]) -> Column:
    """Aggregate: value of the first row in ``ord`` order."""
    return F.min_by(_c(value), order_key(ord_cols))


def first_where(value: ColumnOrName, predicate: Column, ord_cols: Sequence[ColumnOrName]) -> Column:
    """Aggregate: value of the first row (in ``ord`` order) where
    ``predicate`` holds; null if no row does.

    ``min_by`` skips rows whose ordering is null, so masking the ordering
    with the predicate is the SQL ``min_by(v, o) FILTER (WHERE p)``.
    """
    return F.min_by(_c(value), F.when(predicate, order_key(ord_cols)))


def any_true(predicate: Column) -> Column:
    """Aggregate: true if the predicate holds on some row of the group."""
    return F.bool_or(predicate)


def sort_multi(df: DataFrame, cols: Sequence[ColumnOrName]) -> DataFrame:
    """Ascending sort, nulls last (R's ``arrange``)."""
    return df.orderBy(*[_c(c).asc_nulls_last() for c in cols])


def sort_stable(df: DataFrame, cols: Sequence[ColumnOrName],
                ord_cols: Sequence[ColumnOrName]) -> DataFrame:
    """Sort whose ties keep input order: ``ord`` is the final tie-break.
    A distributed sort is not stable on its own."""
    return df.orderBy(*[_c(c).asc_nulls_last() for c in [*cols, *ord_cols]])


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """``bind_rows``: union by column name, missing columns filled with null."""
    out = dfs[0]
    for other in dfs[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def union_distinct_by_name(*dfs: DataFrame) -> DataFrame:
    """``bind_rows() |> distinct()``."""
    return union_by_name(*dfs).distinct()


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct combinations of ``cols`` (``unique``); partial aggregation before the shuffle."""
    return df.select(*cols).distinct()
