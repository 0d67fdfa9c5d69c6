"""Price arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _col


def implied_probability(price: ColumnOrName) -> Column:
    """1 / decimal price; a zero price gives null instead of an ANSI error."""
    return F.try_divide(F.lit(1.0), _col(price))


def margin(*prices: ColumnOrName, digits: int = 3) -> Column:
    """Bookmaker margin (overround) = sum of implied probabilities, rounded.

    Null if any price is null or zero.  ``round`` is HALF_UP on the decimal
    value, which reproduces every published margin.
    """
    total = None
    for p in prices:
        term = implied_probability(p)
        total = term if total is None else total + term
    return F.round(total, digits)
