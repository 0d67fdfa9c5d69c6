"""Join operators used to pair the two sides of a market.

All joins are equi-joins on hashable keys, so Spark can choose sort-merge
or shuffled-hash joins, AQE can split skewed partitions, and a side is
broadcast only when Spark's own size check (static statistics or AQE's
measured shuffle size) says it is small.  No join here emits all pairs of
a group: the band join is turned into an equi-join on line buckets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .groups import row_number_within
from .ordinals import with_ordinal


def _q(alias: str, name: str) -> Column:
    return F.col(f"`{alias}`.`{name}`")


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Column names present on both sides, in the left's order (natural-join keys)."""
    right_cols = set(right.columns)
    return [c for c in left.columns if c in right_cols]


def natural_join(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None,
                 how: str = "left", null_safe: bool = True, skew_safe: bool = False) -> DataFrame:
    """dplyr-style natural join: keys default to all shared columns and a
    null key matches a null key (``<=>``).

    Output: the left columns, then the right's non-key columns.  ``<=>``
    keys are planned as ``(coalesce(k), isnull(k))`` hash keys, so this is
    still a partitioned equi-join.  ``null_safe=False`` gives plain ``=``.

    ``skew_safe=True`` (left joins): AQE can split a skewed key only on the
    preserved (left) side of an outer join, so a hot key on the right would
    stay in one task.  The left join is then computed as the inner join
    (both sides splittable) plus the left rows without a match (anti join
    against the *distinct* right keys, so a hot key collapses map-side).
    The result is the same rows; the left side is read twice.
    """
    keys = list(on) if on is not None else shared_columns(left, right)
    if not keys:
        raise ValueError("natural_join needs at least one shared column")
    if skew_safe and how == "left":
        matched = natural_join(left, right, keys, "inner", null_safe)
        unmatched = natural_join(left, right.select(*keys).distinct(), keys, "left_anti", null_safe)
        return matched.unionByName(unmatched, allowMissingColumns=True)
    lhs, rhs = left.alias("_l"), right.alias("_r")
    cond = None
    for k in keys:
        lk, rk = _q("_l", k), _q("_r", k)
        term = lk.eqNullSafe(rk) if null_safe else lk == rk
        cond = term if cond is None else cond & term
    right_extra = [c for c in right.columns if c not in set(keys)]
    if how in ("left_semi", "left_anti", "semi", "anti"):
        return lhs.join(rhs, cond, how).select(*[_q("_l", c).alias(c) for c in left.columns])
    return lhs.join(rhs, cond, how).select(
        *[_q("_l", c).alias(c) for c in left.columns],
        *[_q("_r", c).alias(c) for c in right_extra],
    )


def lookup_join(facts: DataFrame, dim: DataFrame, on: Sequence[str] | str,
                how: str = "left") -> DataFrame:
    """Dimension lookup (plain equi-join, unmatched keys -> nulls).

    No broadcast hint: a dimension such as the match/team table grows with
    the number of matches, so the choice is left to the size-checked
    planner (``autoBroadcastJoinThreshold`` / AQE).
    """
    return facts.join(dim, on=on, how=how)


def labelled_sides(df: DataFrame, sides: Mapping[str, Column], name: str = "_side") -> DataFrame:
    """One row for each side whose condition a row meets (usually one, so it is
    parsed and moved once), with the side's label."""
    labels = F.array_compact(F.array(*[F.when(cond, F.lit(label)) for label, cond in sides.items()]))
    return df.withColumn(name, F.explode(labels))


def pair_sides(df: DataFrame, keys: Sequence[str], left: Column, right: Column,
               left_cols: Sequence[Column | str], right_cols: Sequence[Column | str],
               how: str = "inner", hot_rows: int | None = None) -> DataFrame:
    """Rows where ``left`` holds beside rows of the same keys where ``right`` does,
    as a null-safe join of the two sides would give them, but in one pass: the
    input is read and shuffled once, not once for each side.

    A key's rows are gathered, so the keys must bound them; those of the markets
    include the response document.  Where nothing bounds them, ``hot_rows`` does:
    sides are counted by key first, and keys with more rows on a side are paired
    in a grid.  Each side of such a key is dealt over chunks of that size and
    repeated to the other side's chunks, so a task gathers two chunks at a time.
    ``how`` is ``inner`` or ``left``.  Output: keys, then the columns of both
    sides.
    """
    rows = df.filter(left | right).select(*keys, F.when(left, F.struct(*left_cols)).alias("_l"),
                                          F.when(right, F.struct(*right_cols)).alias("_r"))
    if hot_rows is None:
        return _gathered(rows, keys, how)
    sizes = rows.groupBy(*keys).agg(F.count("_l").alias("_nl"), F.count("_r").alias("_nr"))
    hot = _kept(sizes.where(F.greatest("_nl", "_nr") > hot_rows), "hot-keys")  # at most rows / hot_rows keys
    if hot.isEmpty():
        return _gathered(rows, keys, how)
    cold = _gathered(natural_join(rows, hot.select(*keys), keys, "left_anti"), keys, how)
    # Rows are dealt by number, so that copies of a row spread too; written, so that a lost task deals them the same way.
    dealt = _kept(natural_join(rows, hot, keys, "inner").withColumn("_deal", F.monotonically_increasing_id()), "hot-rows")
    chunks = {s: F.greatest(F.lit(1), F.ceil(F.col(f"_n{s}") / hot_rows)).cast("long") for s in "lr"}
    own = {s: F.pmod(F.xxhash64("_deal"), chunks[s]) for s in "lr"}
    everywhere = {s: F.sequence(F.lit(0).cast("long"), chunks[s] - 1) for s in "lr"}
    # A row of both sides goes each way; ``_i`` is the chunk of the left side, ``_j`` that of the right one.
    lefts = dealt.where("_l is not null").select(*keys, "_nr", "_l", F.lit(None).cast(dealt.schema["_r"].dataType).alias("_r"),
                                                 own["l"].alias("_i"), F.explode(everywhere["r"]).alias("_j"))
    rights = dealt.where("_r is not null").select(*keys, "_nr", F.lit(None).cast(dealt.schema["_l"].dataType).alias("_l"), "_r",
                                                  F.explode(everywhere["l"]).alias("_i"), own["r"].alias("_j"))
    grid = _gathered(lefts.union(rights), [*keys, "_nr", "_i", "_j"], "inner" if how == "inner" else "present")
    return cold.unionByName(grid.drop("_nr", "_i", "_j"))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to shared storage and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _gathered(rows: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Pairs of the ``_l`` and ``_r`` of each key; ``left`` keeps an ``_l`` that has no ``_r``, ``present`` does so only
    for keys that have none anywhere (``_nr`` is 0)."""
    lists = rows.groupBy(*keys).agg(F.collect_list("_l").alias("_l"), F.collect_list("_r").alias("_r"))
    if how == "inner":
        other = F.explode("_r")
    elif how == "left":
        other = F.explode_outer("_r")
    else:
        none = F.array(F.lit(None).cast(rows.schema["_r"].dataType))
        other = F.explode(F.when((F.col("_nr") == 0), none).otherwise(F.col("_r")))
    return (lists.select(*keys, F.explode("_l").alias("_l"), "_r")
                 .select(*keys, "_l", other.alias("_r")).select(*keys, "_l.*", "_r.*"))


def positional_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ord: Sequence[str],
                    right_ord: Sequence[str], pos_name: str = "pos", how: str = "inner") -> DataFrame:
    """Row i of one table beside row i of another (``bind_cols``), within ``keys``.

    Rows are numbered by an explicit order on each side and joined on ``keys``
    and the number, an equi-join.  ``inner`` keeps as many rows as the shorter
    side has, ``full`` pads the shorter side with nulls.  Without keys the
    positions count over the whole tables (``with_ordinal``), in as many tasks
    as the tables need.  Output: keys, position (from 0), then the other columns
    of both sides.
    """
    def numbered(df: DataFrame, ord_cols: Sequence[str]) -> DataFrame:
        if not keys:
            return with_ordinal(df, ord_cols, pos_name)
        return df.withColumn(pos_name, row_number_within(keys, ord_cols) - 1)

    return natural_join_columns(numbered(left, left_ord), numbered(right, right_ord), [*keys, pos_name], how)


def natural_join_columns(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equal key names; other names must differ."""
    twice = set(left.columns) & set(right.columns) - set(keys)
    if twice:
        raise ValueError(f"columns on both sides: {sorted(twice)}")
    joined = left.join(right, on=list(keys), how=how)
    return joined.select(*keys, *[c for c in joined.columns if c not in set(keys)])


def opposite_sign_pairs(home: DataFrame, away: DataFrame, keys: Sequence[str],
                        home_line: str = "home_line", away_line: str = "away_line") -> DataFrame:
    """Many-to-many natural join on ``keys`` (which include ``|line|``), then
    keep the pairs whose signed lines differ.

    Equal lines (same sign, or both zero) and unmatched rows drop out, so the
    left join followed by the ``<>`` filter is an inner join.
    """
    joined = natural_join(home, away, on=keys, how="inner")
    return joined.filter(F.col(home_line) != F.col(away_line))


def home_buckets(line: str, tol: float) -> Column:
    """Buckets that the band of lines cancelling ``line`` touches (see ``balanced_pairs``)."""
    width, slack = 4.0 * tol, 1e-9
    lo = F.floor((-F.col(line) - F.lit(tol)) / F.lit(width) - F.lit(slack))
    hi = F.floor((-F.col(line) + F.lit(tol)) / F.lit(width) + F.lit(slack))
    return F.sequence(lo, hi)


def away_bucket(line: str, tol: float) -> Column:
    return F.floor(F.col(line) / F.lit(4.0 * tol))


def balanced_pairs(home: DataFrame, away: DataFrame, keys: Sequence[str],
                   home_line: str = "home_line", away_line: str = "away_line",
                   tol: float = 0.1) -> DataFrame:
    """All (home, away) pairs within ``keys`` whose lines cancel:
    ``abs(home_line + away_line) < tol``.

    Band join as an equi-join: lines are bucketed with width ``4 * tol``.  A
    matching away line lies in the open interval ``(-home - tol, -home + tol)``,
    which is half a bucket wide, so it touches at most two buckets; the home
    side is exploded over exactly those (1.5 rows per home line on average)
    and joined to the away side on ``keys + bucket``.  Every pair is found
    once, no per-match cross product is formed, and the residual predicate
    keeps the result exact.  The interval is widened by 1e-9 of a bucket so
    rounding in the division can never drop a boundary pair.
    """
    h = home.withColumn("_bucket", F.explode(home_buckets(home_line, tol)))
    a = away.withColumn("_bucket", away_bucket(away_line, tol))
    joined = natural_join(h, a, on=[*keys, "_bucket"], how="inner", null_safe=False)
    return (joined.filter(F.abs(F.col(home_line) + F.col(away_line)) < F.lit(tol))
                  .drop("_bucket"))
