"""Request manifest: which response documents belong to which match."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Market groupings of the bookmaker's event API.
EVENT_ENDPOINTS: Mapping[str, str] = {
    "event_card": "SportCard",
    "main": "MarketGroupings/101/Markets",
    "line": "MarketGroupings/313/Markets",
    "total_points": "MarketGroupings/108/Markets",
    "total_tries": "MarketGroupings/110/Markets",
    "player_tries": "MarketGroupings/112/Markets",
    "time_of_first_try": "MarketGroupings/205/Markets",
}

DEFAULT_TEMPLATE = "{base}/Events/{id}/{endpoint}"


def url_endpoint(url: Column | str, endpoints: Mapping[str, str] = EVENT_ENDPOINTS) -> Column:
    """Name of the endpoint whose path the URL ends with (before any query), else null."""
    path = F.regexp_replace(F.col(url) if isinstance(url, str) else url, r"[?#].*$", "")
    return F.coalesce(*(F.when(path.endswith("/" + p), F.lit(name)) for name, p in endpoints.items()))


def url_manifest(ids: DataFrame, id_col: str = "match_id",
                 endpoints: Mapping[str, str] = EVENT_ENDPOINTS,
                 base: str = "https://api.example.com/sportsbook",
                 template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """One row per (id, endpoint) with the request URL.

    The endpoint list is a small fixed set, so it is generated per row with
    ``explode`` over a literal array rather than joined.
    """
    pairs = F.array(*[F.struct(F.lit(name).alias("endpoint"), F.lit(path).alias("path"))
                      for name, path in endpoints.items()])
    url = F.lit(template.replace("{base}", base))
    url = F.replace(url, F.lit("{id}"), F.col(id_col).cast("string"))
    url = F.replace(url, F.lit("{endpoint}"), F.col("_e.path"))
    return (ids.select(id_col, F.explode(pairs).alias("_e"))
               .select(id_col, F.col("_e.endpoint").alias("endpoint"), url.alias("url")))
