"""Nested-data operators: ordered unnesting, positional picks and zips.

Document order carries meaning in bookmaker feeds (first proposition = home
side), so every unnest keeps the element position next to the element.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array_col: str, pos_name: str, alias: str,
           keep: Sequence[str] | None = None) -> DataFrame:
    """One row per array element with its 0-based position.

    Rows whose array is null or empty produce no output (``posexplode``,
    not ``posexplode_outer``), like ``unnest`` of an empty list.  ``keep``
    lists the parent columns repeated onto each child row (all by default).
    """
    parents = [c for c in (df.columns if keep is None else keep) if c != array_col]
    return df.select(*parents, F.posexplode(array_col).alias(pos_name, alias))


def unnest_path(df: DataFrame,
                levels: Sequence[tuple[str, str, str, Sequence[str | tuple[str, str]]]],
                keep: Sequence[str] = ()) -> DataFrame:
    """Multi-level ordered flatten.

    ``levels`` is a list of ``(array_expr, pos_name, alias, fields)``: the
    array to explode, the name of its position column, the alias of the
    element and the element fields to lift into columns (a field is a name
    or a ``(name, new_name)`` pair).  Each level may refer to fields lifted
    by the previous one; the exploded array itself is not carried on.

    The first array is often a parsed text.  ``posexplode`` would make Spark
    infer filters on it and push them below the parse, which then runs again in
    each of them; so its rows without elements go after the generator.
    """
    out = df
    carried = list(keep)
    for level, (array_expr, pos_name, alias, fields) in enumerate(levels):
        carried = [c for c in carried if c != array_expr]
        if level:
            out = out.select(*carried, F.posexplode(F.col(array_expr)).alias(pos_name, alias))
        else:
            out = out.select(*carried, F.posexplode_outer(F.col(array_expr)).alias(pos_name, alias)).where(
                F.col(pos_name).isNotNull())
        pairs = [(f, f) if isinstance(f, str) else f for f in fields]
        out = out.select(*carried, pos_name, *[F.col(f"{alias}.{src}").alias(dst) for src, dst in pairs])
        carried = carried + [pos_name] + [dst for _, dst in pairs]
    return out


def array_get(c: Column | str, index: int) -> Column:
    """0-based element pick; null when out of range (never an ANSI error)."""
    return F.get(F.col(c) if isinstance(c, str) else c, index)


def positional_zip(df: DataFrame, arrays: dict[str, str], pos_name: str = "pos",
                   keep: Sequence[str] = ()) -> DataFrame:
    """Row i of each parallel array side by side (``bind_cols`` within a row).

    ``arrays`` maps output name -> array column.  Shorter arrays are padded
    with nulls, as ``arrays_zip`` does.
    """
    names = list(arrays)
    zipped = F.arrays_zip(*[F.col(arrays[n]).alias(n) for n in names])
    return (df.select(*keep, F.posexplode(zipped).alias(pos_name, "_z"))
              .select(*keep, pos_name, *[F.col(f"_z.{n}").alias(n) for n in names]))


def select_any_of(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])
