"""overround: odds-market tables on Spark DataFrames.

Raw bookmaker responses (nested JSON, HTML listing pages, CSV) are
flattened into one canonical ``selections`` table; market operators pair
the sides of each market and compute the bookmaker's margin (the
"overround").  Every operator is a ``DataFrame -> DataFrame`` function
built from Spark SQL expressions, so it composes with ``df.transform``
and is optimised by Catalyst.
"""

__version__ = "0.1.0"
