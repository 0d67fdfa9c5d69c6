"""Registered queries over the driver's test tables.

The test tables are TPC-H-like, not odds feeds, so each query maps them
onto the shape the operator expects (orders = matches, lineitems =
propositions, events = selections of a user-day, pages = listing pages)
and runs the *library* operator on the whole table.  Every query has an
independent DuckDB formulation in ``ORACLE_SQL`` written from the operator's
semantics, not from our implementation.

Order of lineitems inside an order: ``(l_linenumber, l_partkey,
l_suppkey)`` (unique with ``l_orderkey``).  Order of events: ``event_id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fx
from .. import operators as op
from . import markets as mk

# Total order of lineitems inside an order: key columns first, then every
# other column as a tie-break (the key alone repeats in the smallest tables).
LINE_ORD = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
LINE_ORD_SQL = ", ".join(LINE_ORD)
T_K = "struct<k:bigint>"
KEYS = ("agency", "snapshot_id")

# Test parameters: name rules over order priorities ("1-URGENT" ...).
PRIORITY_RULES = (
    ("(^1)|(URGENT)", "Urgent"),
    ("(^2)|(HIGH)", "High"),
    ("(^5)|(LOW)", "Low"),
)
PRIORITY_RULES_SQL = """CASE WHEN regexp_matches({x}, '(^1)|(URGENT)') THEN 'Urgent'
     WHEN regexp_matches({x}, '(^2)|(HIGH)') THEN 'High'
     WHEN regexp_matches({x}, '(^5)|(LOW)') THEN 'Low' ELSE {x} END"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    """Add a query (and its DuckDB oracle, if SQL can express it)."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _canon_sql(x: str) -> str:
    return PRIORITY_RULES_SQL.format(x=x)


def _day_text(c: str) -> F.Column:
    """``yyyy-MM-dd`` of a timestamp_ntz without any time-zone conversion."""
    return F.to_date(F.col(c)).cast("string")


def _two(x: F.Column) -> F.Column:
    return F.lpad(x.cast("string"), 2, "0")


def _iso_text(c: str) -> F.Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` of a timestamp_ntz, zone-free."""
    return F.concat(_day_text(c), F.lit("T"), _two(F.hour(c)), F.lit(":"), _two(F.minute(c)), F.lit(":"),
                    _two(F.second(c)), F.lit("Z"))


def _clock_text(c: str) -> F.Column:
    """``H:mm`` of a timestamp_ntz, zone-free."""
    return F.concat(F.hour(c).cast("string"), F.lit(":"), _two(F.minute(c)))


def lineitem_selections(spark: SparkSession, d: str, market_name=None, prop_name=None,
                        price=None) -> DataFrame:
    """Lineitems as propositions of their order ("match ``Order k v
    <priority>``"), with the order date as start time."""
    li = _t(spark, d, "lineitem")
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    s = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return s.select(
        F.lit("TPCH").alias("agency"), F.lit("sf").alias("snapshot_id"),
        "l_orderkey", *LINE_ORD,
        F.concat(F.lit("Order "), F.col("l_orderkey").cast("string"), F.lit(" v "),
                 F.col("o_orderpriority")).alias("match"),
        _day_text("o_orderdate").alias("start_time"),
        (market_name if market_name is not None else F.lit(None).cast("string")).alias("market_name"),
        (prop_name if prop_name is not None else F.lit(None).cast("string")).alias("prop_name"),
        (price if price is not None else F.col("l_quantity")).alias("price"),
        F.col("l_partkey").alias("prop_id"),
    )


LINEITEM_SELECTIONS_SQL = """
  SELECT l.*, o.o_orderdate, o.o_orderpriority,
         'Order ' || CAST(l.l_orderkey AS VARCHAR) || ' v ' || o.o_orderpriority AS match,
         strftime(o.o_orderdate, '%Y-%m-%d') AS start_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


# ------------------------------------------------------------------ markets

def q_market_h2h_nth(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    sel = lineitem_selections(
        spark, d,
        market_name=F.when(flag == "R", "Head To Head").when(flag == "A", "Line").otherwise("Other"))
    return mk.h2h_nth(sel, agency="TPCH", keys=KEYS, ord=LINE_ORD, rules=PRIORITY_RULES, doc=())


SQL_MARKET_H2H_NTH = f"""
WITH s AS ({LINEITEM_SELECTIONS_SQL} WHERE l.l_returnflag = 'R'),
r AS (SELECT *, string_split(match, ' v ')[1] AS home_team, string_split(match, ' v ')[2] AS away_team,
             row_number() OVER (PARTITION BY match ORDER BY {LINE_ORD_SQL}) AS rn
      FROM s),
h AS (SELECT match, home_team, away_team, start_time, l_quantity AS home_win FROM r WHERE rn = 1),
a AS (SELECT match, home_team, away_team, start_time, l_quantity AS away_win FROM r WHERE rn = 2),
j AS (SELECT h.*, a.away_win FROM h LEFT JOIN a
        ON h.match IS NOT DISTINCT FROM a.match AND h.home_team IS NOT DISTINCT FROM a.home_team
       AND h.away_team IS NOT DISTINCT FROM a.away_team AND h.start_time IS NOT DISTINCT FROM a.start_time),
c AS (SELECT *, {_canon_sql('home_team')} AS home_c, {_canon_sql('away_team')} AS away_c FROM j)
SELECT home_c || ' v ' || away_c AS match, start_time, 'Head To Head' AS market_name,
       home_c AS home_team, home_win, away_c AS away_team, away_win,
       round(1.0 / nullif(home_win, 0) + 1.0 / nullif(away_win, 0), 3) AS margin, 'TPCH' AS agency
FROM c"""


register("market_h2h_nth", SQL_MARKET_H2H_NTH)(q_market_h2h_nth)


# ------------------------------------------------------- helpers (letters)

def _letters(c) -> F.Column:
    """Digits -> letters, so generated names never contain numbers that a
    line/price regex could pick up."""
    return F.translate(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                       "0123456789", "abcdefghij")


def _letters_sql(x: str) -> str:
    return f"translate(CAST({x} AS VARCHAR), '0123456789', 'abcdefghij')"


# Test parameters: order status -> team name.
STATUS_RULES = (("^O$", "Open"), ("^F$", "Filled"))


def _status_sql(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, '^O$') THEN 'Open' "
            f"WHEN regexp_matches({x}, '^F$') THEN 'Filled' ELSE {x} END")


def tab_lineitem_selections(spark: SparkSession, d: str, market_name, prop_name,
                            price=None, with_part: bool = False) -> DataFrame:
    """Lineitems as TAB-style propositions of match ``Order <letters> v
    <status>`` (digit-free names)."""
    li = _t(spark, d, "lineitem")
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    s = li.join(orders, li.l_orderkey == orders.o_orderkey)
    if with_part:
        part = _t(spark, d, "part").select("p_partkey", "p_name", "p_brand")
        s = s.join(part, s.l_partkey == part.p_partkey)
    home = F.concat(F.lit("Order "), _letters("l_orderkey"))
    s = s.select("*", home.alias("_home"), F.col("o_orderstatus").alias("_away"))
    return s.select(
        F.lit("TPCH").alias("agency"), F.lit("sf").alias("snapshot_id"), "*",
        F.concat(F.col("_home"), F.lit(" v "), F.col("_away")).alias("match"),
        _day_text("o_orderdate").alias("start_time"),
        market_name.alias("market_name"), prop_name.alias("prop_name"),
        (price if price is not None else F.col("l_quantity")).alias("price"),
        F.col("l_partkey").alias("prop_id"),
    )


def tab_base_sql(with_part: bool = False) -> str:
    part = " JOIN part p ON l.l_partkey = p.p_partkey" if with_part else ""
    return f"""
  SELECT l.*, o.o_orderstatus{', p.p_name, p.p_brand' if with_part else ''},
         'Order ' || {_letters_sql('l.l_orderkey')} AS home_raw, o.o_orderstatus AS away_raw,
         'Order ' || {_letters_sql('l.l_orderkey')} || ' v ' || o.o_orderstatus AS match,
         strftime(o.o_orderdate, '%Y-%m-%d') AS start_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey{part}"""


def _signed_text(x) -> F.Column:
    """``+2.0`` / ``-3.0`` / ``+0.0`` label text of a double."""
    return F.concat(F.when(x >= 0, F.lit("+")).otherwise(F.lit("")), x.cast("string"))


def _line_x():
    return (F.col("l_linenumber") - 4).cast("double")


# ------------------------------------------------- scans, documents, sinks


def _tab_match(spark: SparkSession, d: str) -> DataFrame:
    """One TAB-shaped match per lineitem, as the column ``match``."""
    li = _t(spark, d, "lineitem")
    prop = lambda i, n, w: F.struct(F.col(i).cast("bigint").alias("id"), n.alias("name"),
                                    F.col(w).alias("returnWin"))
    markets = F.array(
        F.struct(F.lit("Quantity").alias("betOption"),
                 F.array(prop("l_partkey", F.concat(F.lit("Part "), _letters("l_partkey")), "l_quantity"),
                         prop("l_suppkey", F.concat(F.lit("Supplier "), _letters("l_suppkey")),
                              "l_extendedprice")).alias("propositions")),
        F.struct(F.lit("Charges").alias("betOption"),
                 F.array(prop("l_linenumber", F.lit("Discount"), "l_discount"),
                         prop("l_linenumber", F.lit("Tax"), "l_tax")).alias("propositions")),
        F.struct(F.lit("Closed").alias("betOption"),
                 F.array().cast("array<struct<id:bigint,name:string,returnWin:double>>")
                  .alias("propositions")),
    )
    match = F.struct(
        F.concat(F.lit("Order "), F.col("l_orderkey").cast("string"), F.lit(" v Line "),
                 F.col("l_linenumber").cast("string")).alias("name"),
        _iso_text("l_shipdate").alias("startTime"),
        markets.alias("markets"))
    return li.select(match.alias("match"))


def _land_json(documents: DataFrame, path: str) -> None:
    """Append documents as JSON lines, compressed. Such files aren't split, so each holds a bounded number of documents."""
    (documents.write.mode("append").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
              .option("maxRecordsPerFile", 250_000).json(path))


def _tab_documents(spark: SparkSession, d: str) -> str:
    """Land one TAB-shaped document per lineitem as JSON lines; returns path."""
    from ..session import scratch_path
    path = scratch_path(spark, "tab-docs")
    _land_json(_tab_match(spark, d).select(F.array("match").alias("matches")), path)
    return path


def _read_tab_documents(spark: SparkSession, d: str) -> DataFrame:
    from .. import schemas as S
    from ..sources import read_nested_json
    docs = read_nested_json(spark, _tab_documents(spark, d), S.TAB_RESPONSE, multi_line=False)
    return docs.select(F.lit("landed").alias("url"), F.struct("matches").alias("doc"))


_TAB_DOC_SQL = """
  SELECT 'Order ' || CAST(l_orderkey AS VARCHAR) || ' v Line ' || CAST(l_linenumber AS VARCHAR) AS match,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS start_time, *
  FROM lineitem"""


@register("src_json_nested", f"""
WITH d AS ({_TAB_DOC_SQL})
SELECT match, start_time, CAST(3 AS INTEGER) AS n_markets FROM d""")
def q_src_json_nested(spark: SparkSession, d: str) -> DataFrame:
    docs = _read_tab_documents(spark, d)
    m = op.unnest(docs.select(F.col("doc.matches").alias("matches")), "matches", "match_pos", "m")
    return m.select(F.col("m.name").alias("match"), F.col("m.startTime").alias("start_time"),
                    F.size("m.markets").alias("n_markets"))


@register("json_unnest", f"""
WITH d AS ({_TAB_DOC_SQL})
SELECT match, start_time, 0 AS match_pos, 0 AS market_pos, 'Quantity' AS market_name, 0 AS prop_pos,
       l_partkey AS prop_id, 'Part ' || {_letters_sql('l_partkey')} AS prop_name, l_quantity AS price FROM d
UNION ALL
SELECT match, start_time, 0, 0, 'Quantity', 1, l_suppkey, 'Supplier ' || {_letters_sql('l_suppkey')},
       l_extendedprice FROM d
UNION ALL
SELECT match, start_time, 0, 1, 'Charges', 0, CAST(l_linenumber AS BIGINT), 'Discount', l_discount FROM d
UNION ALL
SELECT match, start_time, 0, 1, 'Charges', 1, CAST(l_linenumber AS BIGINT), 'Tax', l_tax FROM d""")
def q_json_unnest(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import tab_selections
    sel = tab_selections(_read_tab_documents(spark, d), agency="TPCH")
    return sel.select("match", "start_time", "match_pos", "market_pos", "market_name", "prop_pos",
                      "prop_id", "prop_name", "price")


def _events_k(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    return ev.withColumn("k", F.from_json("props", "struct<k:bigint>")["k"])


_K_SQL = "CAST(json_extract(props, '$.k') AS BIGINT)"
_EVENT_URL = "https://feed.example.com/events/"


def _event_market_docs(spark: SparkSession, d: str) -> str:
    """Land one Sportsbet-shaped market document per event; returns path."""
    from ..session import scratch_path
    ev = _events_k(spark, d)
    handicap = F.when(F.col("k") % 5 != 0, F.col("k").cast("string"))
    sel = F.struct(
        F.concat(F.col("event_type"), F.lit(" Over")).alias("name"),
        F.lit("O").alias("resultType"), F.col("user_id").alias("externalId"),
        handicap.alias("unformattedHandicap"),
        F.struct(F.col("value").alias("winPrice")).alias("price"))
    body = F.to_json(F.array(F.struct(F.col("event_type").alias("name"),
                                      F.col("event_id").alias("externalId"),
                                      F.array(sel).alias("selections"))))
    url = F.concat(F.lit(_EVENT_URL), (F.col("event_id") + 1000000).cast("string"), F.lit("/markets"))
    path = scratch_path(spark, "event-docs")
    ev.select(url.alias("url"), body.alias("body")).write.mode("overwrite").json(path)
    return path


@register("src_json_events", f"""
SELECT event_id + 1000000 AS match_id, CAST(0 AS INTEGER) AS market_pos, event_type AS market_name,
       event_id AS market_id, CAST(0 AS INTEGER) AS prop_pos, user_id AS prop_id,
       event_type || ' Over' AS prop_name, 'O' AS result_type, value AS price,
       CASE WHEN {_K_SQL} % 5 <> 0 THEN CAST({_K_SQL} AS DOUBLE) END AS handicap
FROM events""")
def q_src_json_events(spark: SparkSession, d: str) -> DataFrame:
    from .. import schemas as S
    from ..sources import parse_documents, read_landed, sportsbet_selections
    docs = parse_documents(read_landed(spark, _event_market_docs(spark, d)), S.SB_MARKETS_RESPONSE)
    sel = sportsbet_selections(docs)
    return sel.select("match_id", "market_pos", "market_name", "market_id", "prop_pos", "prop_id",
                      "prop_name", "result_type", "price", "handicap")


@register("src_event_metadata", f"""
SELECT event_id + 1000000 AS match_id, user_id AS class_external_id,
       {_K_SQL} AS competition_external_id, event_id AS event_external_id FROM events""")
def q_src_event_metadata(spark: SparkSession, d: str) -> DataFrame:
    from .. import schemas as S
    from ..session import scratch_path
    from ..sources import event_metadata, parse_documents, read_landed

    def write() -> str:
        ev = _events_k(spark, d)
        body = F.to_json(F.struct(F.col("user_id").alias("classExternalId"),
                                  F.col("k").alias("competitionExternalId"),
                                  F.col("event_id").alias("externalId")))
        url = F.concat(F.lit(_EVENT_URL), (F.col("event_id") + 1000000).cast("string"), F.lit("/SportCard"))
        path = scratch_path(spark, "event-meta")
        ev.select(url.alias("url"), body.alias("body")).write.mode("overwrite").json(path)
        return path

    docs = parse_documents(read_landed(spark, write()),
                           S.SB_EVENT_METADATA)
    return event_metadata(docs)


@register("json_field", f"SELECT event_id, {_K_SQL} AS k FROM events")
def q_json_field(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    doc = F.from_json("props", "struct<k:bigint>")
    return ev.select("event_id", doc["k"].alias("k"))


@register("json_optional_field", f"""
SELECT event_id, {_K_SQL} AS k, TRY_CAST(json_extract_string(props, '$.h') AS DOUBLE) AS handicap
FROM events""")
def q_json_optional_field(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    doc = F.from_json("props", "struct<k:bigint,h:string>")
    return ev.select("event_id", doc["k"].alias("k"), fx.as_numeric(doc["h"]).alias("handicap"))


@register("sink_csv_roundtrip", """
SELECT p_partkey, p_name, nullif(p_size % 7, 0) AS size_mod, p_retailprice FROM part""")
def q_sink_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    from ..session import scratch_path
    from ..sources import read_csv, write_csv
    part = _t(spark, d, "part")
    out = part.select("p_partkey", "p_name", F.nullif(F.col("p_size") % 7, F.lit(0)).alias("size_mod"),
                      "p_retailprice")
    path = scratch_path(spark, "csv")
    write_csv(out, path)
    return read_csv(spark, path, out.schema)


def _landing_bodies(spark: SparkSession, d: str) -> DataFrame:
    """Event bodies; error events carry a malformed body (``=`` for ``:``)."""
    ev = _t(spark, d, "events")
    body = (F.when(F.col("event_type") == "error", F.replace(F.col("props"), F.lit(":"), F.lit("=")))
             .otherwise(F.col("props")))
    url = F.concat(F.lit(_EVENT_URL), F.col("event_id").cast("string"))
    return ev.select(url.alias("url"), body.alias("body"))


_LANDING_SQL = f"""
  SELECT '{_EVENT_URL}' || CAST(event_id AS VARCHAR) AS url,
         CASE WHEN event_type = 'error' THEN replace(props, ':', '=') ELSE props END AS body
  FROM events"""


@register("sink_json_landing", f"WITH b AS ({_LANDING_SQL}) SELECT url, body FROM b WHERE json_valid(body)")
def q_sink_json_landing(spark: SparkSession, d: str) -> DataFrame:
    from ..session import scratch_path
    from ..sources import parse_documents, read_landed, write_landing
    parsed = parse_documents(_landing_bodies(spark, d), T_K)
    path = scratch_path(spark, "landing")
    write_landing(parsed, path, mode="overwrite")
    return read_landed(spark, path).select("url", "body")


@register("quarantine_split", f"""
WITH b AS ({_LANDING_SQL}) SELECT url, body FROM b WHERE NOT json_valid(body)""")
def q_quarantine_split(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import parse_documents, quarantine_split
    _good, rejects = quarantine_split(parse_documents(_landing_bodies(spark, d), T_K))
    return rejects.select("url", "body")


@register("url_manifest", """
SELECT p_partkey AS match_id, e.endpoint,
       'https://api.example.com/sportsbook/Events/' || CAST(p_partkey AS VARCHAR) || '/' || e.path AS url
FROM part, (VALUES ('event_card', 'SportCard'), ('main', 'MarketGroupings/101/Markets'),
                   ('line', 'MarketGroupings/313/Markets'), ('total_points', 'MarketGroupings/108/Markets'),
                   ('total_tries', 'MarketGroupings/110/Markets'),
                   ('player_tries', 'MarketGroupings/112/Markets'),
                   ('time_of_first_try', 'MarketGroupings/205/Markets')) e(endpoint, path)""")
def q_url_manifest(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import url_manifest
    ids = _t(spark, d, "part").select(F.col("p_partkey").alias("match_id"))
    return url_manifest(ids)


# ---------------------------------------------------------------- arrays

@register("array_posexplode", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
       unnest(embedding) AS value FROM embeddings""")
def q_array_posexplode(spark: SparkSession, d: str) -> DataFrame:
    emb = _t(spark, d, "embeddings")
    return op.unnest(emb.select("vec_id", "embedding"), "embedding", "pos", "value")


@register("array_get", """
SELECT vec_id, embedding[1] AS first, embedding[2] AS second, embedding[65] AS past_end, label
FROM embeddings""")
def q_array_get(spark: SparkSession, d: str) -> DataFrame:
    emb = _t(spark, d, "embeddings")
    return emb.select("vec_id", op.array_get("embedding", 0).alias("first"),
                      op.array_get("embedding", 1).alias("second"),
                      op.array_get("embedding", 64).alias("past_end"), "label")


# ------------------------------------------------------------------ HTML

_HREF_SQL = """regexp_extract_all(html, 'href="([^"]*)"', 1)"""
_ANCHOR_TEXT_SQL = """regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)"""


@register("positional_zip", f"""
WITH a AS (SELECT page_id, {_HREF_SQL} AS h, {_ANCHOR_TEXT_SQL} AS t FROM pages)
SELECT page_id, CAST(generate_subscripts(CASE WHEN len(h) >= len(t) THEN h ELSE t END, 1) - 1 AS INTEGER) AS pos,
       unnest(h) AS href, unnest(t) AS text
FROM a WHERE len(h) > 0 OR len(t) > 0""")
def q_positional_zip(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import hrefs
    pages = _t(spark, d, "pages")
    arrays = pages.select("page_id", hrefs("html").alias("h"),
                          F.regexp_extract_all("html", F.lit(r'<a href="[^"]*">([^<]*)</a>'), 1).alias("t"))
    return op.positional_zip(arrays, {"href": "h", "text": "t"}, keep=["page_id"])


@register("html_links", f"""
SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href
FROM (SELECT page_id, {_HREF_SQL} AS h FROM pages)""")
def q_html_links(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import page_links
    return page_links(_t(spark, d, "pages"))


def _decode_sql(x: str) -> str:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


@register("html_text", f"""
SELECT page_id,
       {_decode_sql("regexp_replace(nullif(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), ''), '<[^>]*>', '', 'g')")}
         AS title
FROM pages""")
def q_html_text(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import tag_text
    pages = _t(spark, d, "pages")
    return pages.select("page_id", tag_text("html", "title").alias("title"))


@register("html_class_text", f"""
WITH a AS (SELECT page_id,
                  regexp_extract_all(html, '(?s)<div[^>]*class="[^"]*\\bad\\b[^"]*"[^>]*>(.*?)</div>', 1) AS e
           FROM pages)
SELECT page_id, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS pos,
       {_decode_sql("regexp_replace(unnest(e), '<[^>]*>', '', 'g')")} AS text
FROM a""")
def q_html_class_text(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import elements_by_class, texts
    pages = _t(spark, d, "pages")
    return pages.select("page_id", F.posexplode(texts(elements_by_class("html", "ad")))
                        .alias("pos", "text"))


@register("html_class_text_parsed", ORACLE_SQL["html_class_text"])
def q_html_class_text_parsed(spark: SparkSession, d: str) -> DataFrame:
    """H1 by the depth of tags; on elements that hold no others it gives what the first closing tag gives."""
    from ..sources import nested_texts
    return _t(spark, d, "pages").select("page_id", F.posexplode(nested_texts("html", "ad")).alias("pos", "text"))


_NESTED_SQL = """replace(replace(replace(html, '<div class="ad">', '<div class="ad">Ad <div><b>1</b> &amp; <br></div>'),
  '<article>', '<div class="x ad"><article>'), '</article>', '</article>end</div>')"""
_VOID_SQL = "'area', 'base', 'br', 'col', 'embed', 'hr', 'img', 'input', 'link', 'meta', 'source', 'track', 'wbr'"


@register("html_nested_text", f"""
WITH p AS (SELECT page_id, regexp_replace({_NESTED_SQL},
    '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', '', 'g') AS h FROM pages),
x AS (SELECT page_id, regexp_extract_all(h, '<[^<]*|^[^<]+') AS t FROM p),
t AS (SELECT page_id, unnest(t) AS piece, generate_subscripts(t, 1) AS place FROM x),
n AS (SELECT *, lower(regexp_extract(piece, '^</?([A-Za-z][A-Za-z0-9-]*)', 1)) AS name, regexp_replace(piece, '(?s)^</?[A-Za-z][^>]*>', '') AS tail
      FROM t),
k AS (SELECT *, CASE WHEN name = '' OR name IN ({_VOID_SQL}) OR regexp_matches(piece, '^<[^>]*/>') THEN 0
                     WHEN starts_with(piece, '</') THEN -1 ELSE 1 END AS step FROM n),
deep AS (SELECT *, sum(step) OVER (PARTITION BY page_id, name ORDER BY place) AS depth FROM k WHERE step <> 0),
m AS (SELECT *, lead(place) OVER (PARTITION BY page_id, name, CASE WHEN step = 1 THEN depth ELSE depth + 1 END ORDER BY place) AS stop FROM deep),
s AS (SELECT page_id, place, stop, CAST(row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS INTEGER) AS pos FROM m
      WHERE step = 1 AND regexp_matches(piece, '^<[^>]*\\sclass="([^"]*\\s)?ad(\\s[^"]*)?"')),
e AS (SELECT s.page_id, s.pos, string_agg(k.tail, '' ORDER BY k.place) AS text FROM s JOIN k ON k.page_id = s.page_id
        AND k.place >= s.place AND k.place < coalesce(s.stop, 1000000000) GROUP BY s.page_id, s.pos)
SELECT page_id, pos, {_decode_sql('text')} AS text FROM e""".replace("\\\\", "\\"))
def q_html_nested_text(spark: SparkSession, d: str) -> DataFrame:
    """Elements that hold elements of their own tag and class: each ends where its depth returns."""
    from ..sources import nested_texts
    pages = _t(spark, d, "pages")
    return pages.select("page_id", F.posexplode(nested_texts(F.expr(_NESTED_SQL), "ad")).alias("pos", "text"))


@register("url_id_first", """
SELECT page_id, TRY_CAST(nullif(regexp_extract(url || '/events/' || CAST(page_id * 7919 + 100000 AS VARCHAR),
                                               '[0-9]{6,8}', 0), '') AS BIGINT) AS match_id
FROM pages""")
def q_url_id_first(spark: SparkSession, d: str) -> DataFrame:
    pages = _t(spark, d, "pages")
    link = F.concat("url", F.lit("/events/"), (F.col("page_id") * 7919 + 100000).cast("string"))
    return pages.select("page_id", fx.url_match_id(link).alias("match_id"))


@register("url_id_tail", """
SELECT page_id, TRY_CAST(nullif(regexp_extract(url || CAST(page_id AS VARCHAR), '\\d{4,10}$', 0), '')
                         AS BIGINT) AS match_id
FROM pages""")
def q_url_id_tail(spark: SparkSession, d: str) -> DataFrame:
    pages = _t(spark, d, "pages")
    return pages.select("page_id",
                        fx.link_id_tail(F.concat("url", F.col("page_id").cast("string"))).alias("match_id"))


# ---------------------------------------------------- projections/filters

@register("select_any_of", "SELECT o_orderkey, o_orderdate, o_custkey FROM orders")
def q_select_any_of(spark: SparkSession, d: str) -> DataFrame:
    return op.select_any_of(_t(spark, d, "orders"),
                            ["o_orderkey", "round", "o_orderdate", "o_custkey", "missing_column"])


@register("project_rename", """
SELECT o_orderkey AS match_id, o_custkey AS customer, o_totalprice AS price,
       o_orderpriority AS priority FROM orders""")
def q_project_rename(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    o = o.withColumnsRenamed({"o_orderkey": "match_id", "o_custkey": "customer"})
    return o.select("match_id", "customer", F.col("o_totalprice").alias("price"),
                    F.col("o_orderpriority").alias("priority"))


@register("project_drop", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""")
def q_project_drop(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "orders").drop("o_orderpriority", "o_orderstatus")


@register("computed_columns", """
SELECT o_orderkey, (o_totalprice / 1000) * 2 AS price_k, 'TPCH' AS agency,
       CAST(o_orderkey AS VARCHAR) AS key_text, o_orderstatus = 'F' AS is_filled FROM orders""")
def q_computed_columns(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    # Sequential: the second price_k reads the first one.
    o = (o.withColumn("price_k", F.col("o_totalprice") / 1000)
          .withColumn("price_k", F.col("price_k") * 2)
          .withColumn("agency", F.lit("TPCH"))
          .withColumn("key_text", F.col("o_orderkey").cast("string"))
          .withColumn("is_filled", F.col("o_orderstatus") == "F"))
    return o.select("o_orderkey", "price_k", "agency", "key_text", "is_filled")


@register("filter_eq", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax FROM lineitem
WHERE l_returnflag = 'R' AND l_tax = l_discount""")
def q_filter_eq(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return (li.filter((F.col("l_returnflag") == "R") & (F.col("l_tax") == F.col("l_discount")))
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_tax"))


@register("filter_in", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
WHERE l_returnflag = 'R' OR l_returnflag = 'A'""")
def q_filter_in(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return (li.filter(F.col("l_returnflag").isin("R", "A"))
              .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"))


@register("filter_flag", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, true AS is_open FROM lineitem WHERE l_linestatus = 'O'""")
def q_filter_flag(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem").withColumn("is_open", F.col("l_linestatus") == "O")
    return li.filter("is_open").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_open")


@register("filter_not_null", """
SELECT p_partkey, nullif(p_type, 'SMALL') AS part_type FROM part WHERE nullif(p_type, 'SMALL') IS NOT NULL""")
def q_filter_not_null(spark: SparkSession, d: str) -> DataFrame:
    """Drop rows whose (nullable) column is null; the test tables hold no
    nulls, so one type value is mapped to null first."""
    p = _t(spark, d, "part").select("p_partkey", F.nullif(F.col("p_type"), F.lit("SMALL")).alias("part_type"))
    return p.filter(F.col("part_type").isNotNull())


@register("filter_regex", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'ring$|rod$')")
def q_filter_regex(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "part").filter(fx.str_detect("p_name", "ring$|rod$")).select("p_partkey", "p_name")


@register("filter_regex_not", """
SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'plate') AND NOT regexp_matches(p_name, 'hot')""")
def q_filter_regex_not(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    return (p.filter(fx.str_detect("p_name", "plate"))
             .filter(~fx.str_detect("p_name", "hot")).select("p_partkey", "p_name"))


# ------------------------------------------------------------------- joins

@register("join_left_equi", """
SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def q_join_left_equi(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("nationkey"))
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return op.lookup_join(c, n, "nationkey").select("c_custkey", "c_name", "n_name")


def _event_sides(spark: SparkSession, d: str):
    ev = _events_k(spark, d).withColumn("day", F.to_date("ts"))
    bucket = F.nullif(F.col("k") % 10, F.lit(0)).alias("bucket")
    clicks = ev.filter(F.col("event_type") == "click").select(
        "user_id", "day", bucket, F.col("value").alias("click_value"))
    views = ev.filter(F.col("event_type") == "view").select(
        "user_id", "day", bucket, F.col("value").alias("view_value")).distinct()
    return clicks, views


_EVENT_SIDES_SQL = f"""
  c AS (SELECT user_id, CAST(ts AS DATE) AS day, nullif({_K_SQL} % 10, 0) AS bucket, value AS click_value
        FROM events WHERE event_type = 'click'),
  v AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, nullif({_K_SQL} % 10, 0) AS bucket, value AS view_value
        FROM events WHERE event_type = 'view')"""


@register("join_natural_null_safe", f"""
WITH {_EVENT_SIDES_SQL}
SELECT c.user_id, c.day, c.bucket, c.click_value, v.view_value FROM c LEFT JOIN v
  ON c.user_id IS NOT DISTINCT FROM v.user_id AND c.day IS NOT DISTINCT FROM v.day
 AND c.bucket IS NOT DISTINCT FROM v.bucket""")
def q_join_natural_null_safe(spark: SparkSession, d: str) -> DataFrame:
    clicks, views = _event_sides(spark, d)
    return op.natural_join(clicks, views, how="left", skew_safe=True)


def _line_sides(spark: SparkSession, d: str):
    li = _t(spark, d, "lineitem")
    x = _line_x()
    home = li.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", x.alias("home_line"), F.col("l_quantity").alias("home_win"),
        F.abs(x).alias("line"))
    away = li.filter(F.col("l_returnflag") == "A").select(
        "l_orderkey", x.alias("away_line"), F.col("l_quantity").alias("away_win"),
        F.abs(x).alias("line"))
    return home, away


_LINE_SIDES_SQL = """
  h AS (SELECT l_orderkey, CAST(l_linenumber - 4 AS DOUBLE) AS home_line, l_quantity AS home_win
        FROM lineitem WHERE l_returnflag = 'R'),
  a AS (SELECT l_orderkey, CAST(l_linenumber - 4 AS DOUBLE) AS away_line, l_quantity AS away_win
        FROM lineitem WHERE l_returnflag = 'A')"""


@register("join_many_to_many_opposite", f"""
WITH {_LINE_SIDES_SQL}
SELECT h.l_orderkey, abs(h.home_line) AS line, h.home_line, h.home_win, a.away_line, a.away_win
FROM h JOIN a ON h.l_orderkey = a.l_orderkey AND abs(h.home_line) = abs(a.away_line)
WHERE h.home_line <> a.away_line""")
def q_join_many_to_many_opposite(spark: SparkSession, d: str) -> DataFrame:
    home, away = _line_sides(spark, d)
    return op.opposite_sign_pairs(home, away, ["l_orderkey", "line"])


@register("join_balanced_pair", f"""
WITH {_LINE_SIDES_SQL}
SELECT h.l_orderkey, h.home_line, h.home_win, a.away_line, a.away_win
FROM h JOIN a ON h.l_orderkey = a.l_orderkey AND abs(h.home_line + a.away_line) < 0.1""")
def q_join_balanced_pair(spark: SparkSession, d: str) -> DataFrame:
    home, away = _line_sides(spark, d)
    return op.balanced_pairs(home.drop("line"), away.drop("line"), ["l_orderkey"])


# ------------------------------------------------ aggregation and windows

def _events_day(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "events").withColumn("day", F.to_date("ts"))


@register("agg_first", """
SELECT user_id, CAST(ts AS DATE) AS day, arg_min(event_type, event_id) AS first_type,
       arg_min(value, event_id) AS first_value FROM events GROUP BY ALL""")
def q_agg_first(spark: SparkSession, d: str) -> DataFrame:
    ev = _events_day(spark, d)
    return ev.groupBy("user_id", "day").agg(op.first_by("event_type", ["event_id"]).alias("first_type"),
                                            op.first_by("value", ["event_id"]).alias("first_value"))


@register("agg_conditional_pivot", """
SELECT user_id, CAST(ts AS DATE) AS day,
       arg_min(value, event_id) FILTER (WHERE event_type = 'click') AS over_price,
       arg_min(value, event_id) FILTER (WHERE event_type = 'purchase') AS under_price
FROM events GROUP BY ALL""")
def q_agg_conditional_pivot(spark: SparkSession, d: str) -> DataFrame:
    ev = _events_day(spark, d)
    t = F.col("event_type")
    return ev.groupBy("user_id", "day").agg(
        op.first_where("value", t == "click", ["event_id"]).alias("over_price"),
        op.first_where("value", t == "purchase", ["event_id"]).alias("under_price"))


@register("agg_any", """
SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS has_error
FROM events GROUP BY ALL""")
def q_agg_any(spark: SparkSession, d: str) -> DataFrame:
    ev = _events_day(spark, d)
    return ev.groupBy("user_id", "day").agg(op.any_true(F.col("event_type") == "error").alias("has_error"))


@register("distinct_values", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def q_distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return op.distinct_values(_t(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@register("distinct_keep_first", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORD_SQL}) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_distinct_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return op.keep_first(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORD)


@register("window_nth_row", f"""
SELECT l_orderkey, CAST(rn AS INTEGER) AS rn, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORD_SQL}) AS rn
  FROM lineitem) WHERE rn <= 2""")
def q_window_nth_row(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return op.nth_rows(li, ["l_orderkey"], LINE_ORD, 2).select(
        "l_orderkey", "rn", "l_partkey", "l_suppkey", "l_quantity")


@register("sort_multi", """
SELECT o_orderkey, o_orderpriority, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderpriority, o_orderdate, o_totalprice""")
def q_sort_multi(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    return op.sort_multi(o, ["o_orderpriority", "o_orderdate", "o_totalprice"])


@register("sort_stable", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
ORDER BY l_quantity, l_orderkey, {LINE_ORD_SQL}""")
def q_sort_stable(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "l_quantity")
    return op.sort_stable(li, ["l_quantity"], ["l_orderkey", *LINE_ORD])


@register("union_by_name", """
SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier""")
def q_union_by_name(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
                                        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = _t(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
                                        F.col("s_acctbal").alias("acctbal"))
    return op.union_by_name(c, s)


@register("union_distinct_by_name", """
SELECT c_nationkey AS nationkey, c_mktsegment AS segment FROM customer
UNION BY NAME
SELECT s_nationkey AS nationkey FROM supplier""")
def q_union_distinct_by_name(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer").select(F.col("c_nationkey").alias("nationkey"),
                                        F.col("c_mktsegment").alias("segment"))
    s = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    return op.union_distinct_by_name(c, s)


# ----------------------------------------------------------------- scalars

_PART_LABEL_SQL = "p_name || ' ' || CAST(CAST(p_size - 25 AS DOUBLE) / 2 AS VARCHAR)"


def _part_label() -> F.Column:
    return F.concat(F.col("p_name"), F.lit(" "), ((F.col("p_size") - 25).cast("double") / 2).cast("string"))


@register("str_extract_number", f"""
SELECT p_partkey, TRY_CAST(nullif(regexp_extract({_PART_LABEL_SQL}, '-?\\d+\\.?\\d*', 0), '') AS DOUBLE) AS num_any,
       TRY_CAST(nullif(regexp_extract({_PART_LABEL_SQL}, '-?\\d+\\.\\d+', 0), '') AS DOUBLE) AS num_decimal,
       TRY_CAST(nullif(regexp_extract(p_name, '-?\\d+\\.?\\d*', 0), '') AS DOUBLE) AS num_none
FROM part""")
def q_str_extract_number(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part").withColumn("label", _part_label())
    return p.select("p_partkey", fx.extract_number("label", fx.SIGNED_NUMBER).alias("num_any"),
                    fx.extract_number("label", fx.SIGNED_DECIMAL).alias("num_decimal"),
                    fx.extract_number("p_name", fx.SIGNED_NUMBER).alias("num_none"))


@register("str_remove", """
SELECT p_partkey, regexp_replace(p_name || ' (' || p_brand || ')', ' \\(.*\\)', '') AS player_name,
       regexp_replace(p_name, 'a', '') AS first_a_removed FROM part""")
def q_str_remove(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    return p.select("p_partkey",
                    fx.str_remove(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")), r" \(.*\)")
                    .alias("player_name"),
                    fx.str_remove("p_name", "a").alias("first_a_removed"))


@register("str_replace_first", """
SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '$1*') AS replaced,
       regexp_replace(p_name || ' a Try', 'a Try', '1+ Tries') AS market_name FROM part""")
def q_str_replace_first(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    return p.select("p_partkey", fx.str_replace_first("p_name", "[aeiou]", "$1*").alias("replaced"),
                    fx.str_replace_first(F.concat("p_name", F.lit(" a Try")), "a Try", "1+ Tries")
                    .alias("market_name"))


_CUST_LABEL_SQL = """CASE c_custkey % 3 WHEN 0 THEN c_name
     WHEN 1 THEN c_name || ' v ' || c_mktsegment
     ELSE c_name || ' v ' || c_mktsegment || ' v ' || CAST(c_nationkey AS VARCHAR) END"""


@register("str_separate", f"""
SELECT c_custkey, {_CUST_LABEL_SQL} AS match,
       string_split({_CUST_LABEL_SQL}, ' v ')[1] AS home_team,
       string_split({_CUST_LABEL_SQL}, ' v ')[2] AS away_team FROM customer""")
def q_str_separate(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    k = F.col("c_custkey") % 3
    label = (F.when(k == 0, F.col("c_name"))
              .when(k == 1, F.concat("c_name", F.lit(" v "), "c_mktsegment"))
              .otherwise(F.concat("c_name", F.lit(" v "), "c_mktsegment", F.lit(" v "),
                                  F.col("c_nationkey").cast("string"))))
    c = c.select("c_custkey", label.alias("match"))
    return c.select("c_custkey", "match", *fx.separate("match", " v ", ["home_team", "away_team"]))


@register("str_paste", """
SELECT n_nationkey, n_name || ' v ' || nullif(r_name, 'ASIA') AS match,
       nullif(r_name, 'ASIA') || ':00' AS line
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""")
def q_str_paste(spark: SparkSession, d: str) -> DataFrame:
    n = _t(spark, d, "nation")
    r = _t(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                      F.nullif(F.col("r_name"), F.lit("ASIA")).alias("r_name"))
    j = op.lookup_join(n, r, "n_regionkey")
    return j.select("n_nationkey", fx.paste("n_name", F.lit("v"), "r_name").alias("match"),
                    fx.paste0("r_name", F.lit(":00")).alias("line"))


_MIX_SQL = """CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN CAST(p_size AS VARCHAR)
     ELSE CAST(p_retailprice AS VARCHAR) END"""


@register("safe_numeric", f"""
SELECT p_partkey, {_MIX_SQL} AS raw, TRY_CAST({_MIX_SQL} AS DOUBLE) AS value FROM part""")
def q_safe_numeric(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    k = F.col("p_partkey") % 3
    raw = (F.when(k == 0, F.col("p_name")).when(k == 1, F.col("p_size").cast("string"))
            .otherwise(F.col("p_retailprice").cast("string")))
    return p.select("p_partkey", raw.alias("raw")).withColumn("value", fx.as_numeric("raw"))


@register("coalesce_line", f"""
SELECT event_id, coalesce(CAST(nullif({_K_SQL} % 5, 0) AS DOUBLE),
                          TRY_CAST(string_split(event_type || ' Over ' || CAST(value AS VARCHAR), ' Over ')[2] AS DOUBLE))
       AS line FROM events""")
def q_coalesce_line(spark: SparkSession, d: str) -> DataFrame:
    ev = _events_k(spark, d)
    label = F.concat("event_type", F.lit(" Over "), F.col("value").cast("string"))
    _, line_2 = fx.separate(label, " Over ", ["name_2", "line_2"])
    handicap = F.nullif(F.col("k") % 5, F.lit(0)).cast("double")
    return ev.select("event_id", F.coalesce(handicap, fx.as_numeric(line_2)).alias("line"))


@register("case_when_alias", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS segment
FROM customer""")
def q_case_when_alias(spark: SparkSession, d: str) -> DataFrame:
    c = _t(spark, d, "customer")
    return c.select("c_custkey", fx.apply_aliases("c_mktsegment", [("BUILDING", "CONSTRUCTION")]).alias("segment"))


# Test parameters: ordered rules over part names.
PART_RULES = (
    ("(^small)|(ring)", "Small Ring"),
    ("(^hot)|(plate)", "Hot Plate"),
    ("(^red)", "Red"),
    ("widget$", "Widget"),
)


@register("canonicalize_names", """
SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(^small)|(ring)') THEN 'Small Ring'
                       WHEN regexp_matches(p_name, '(^hot)|(plate)') THEN 'Hot Plate'
                       WHEN regexp_matches(p_name, '(^red)') THEN 'Red'
                       WHEN regexp_matches(p_name, 'widget$') THEN 'Widget' ELSE p_name END AS team
FROM part""")
def q_canonicalize_names(spark: SparkSession, d: str) -> DataFrame:
    p = _t(spark, d, "part")
    return p.select("p_partkey", fx.canonicalize("p_name", PART_RULES).alias("team"))


@register("margin", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(1.0 / nullif(l_quantity, 0) + 1.0 / nullif(l_discount * 100, 0), 3) AS margin FROM lineitem""")
def q_margin(spark: SparkSession, d: str) -> DataFrame:
    li = _t(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     fx.margin("l_quantity", F.col("l_discount") * 100).alias("margin"))


@register("alt_line", """
SELECT o_orderkey, TRY_CAST(nullif(regexp_extract(o_orderpriority, '\\d+', 0), '') AS DOUBLE) - 0.5 AS line
FROM orders""")
def q_alt_line(spark: SparkSession, d: str) -> DataFrame:
    o = _t(spark, d, "orders")
    return o.select("o_orderkey", fx.alt_line("o_orderpriority").alias("line"))


# ----------------------------------------------------------- TAB markets

def _line_market_name() -> F.Column:
    return F.when(F.col("l_linestatus") == "O", "Line").otherwise("Pick Your Own Line")


@register("market_line_opposite", f"""
WITH b AS ({tab_base_sql()}),
s AS (SELECT *, CASE WHEN l_linestatus = 'O' THEN 'Line' ELSE 'Pick Your Own Line' END AS market_name,
             CAST(l_linenumber - 4 AS DOUBLE) AS x FROM b),
h AS (SELECT * FROM (SELECT match, home_raw, away_raw, start_time, market_name, x AS home_line,
                            l_quantity AS home_win, abs(x) AS line,
                            row_number() OVER (PARTITION BY match, x, l_quantity
                                               ORDER BY {LINE_ORD_SQL}) AS rn
                     FROM s WHERE l_returnflag = 'R') WHERE rn = 1),
a AS (SELECT * FROM (SELECT match, home_raw, away_raw, start_time, market_name, x AS away_line,
                            l_quantity AS away_win, abs(x) AS line,
                            row_number() OVER (PARTITION BY match, x, l_quantity
                                               ORDER BY {LINE_ORD_SQL}) AS rn
                     FROM s WHERE l_returnflag = 'A') WHERE rn = 1),
p AS (SELECT h.*, a.away_line, a.away_win FROM h JOIN a
        ON h.match IS NOT DISTINCT FROM a.match AND h.home_raw IS NOT DISTINCT FROM a.home_raw
       AND h.away_raw IS NOT DISTINCT FROM a.away_raw AND h.start_time IS NOT DISTINCT FROM a.start_time
       AND h.market_name IS NOT DISTINCT FROM a.market_name AND h.line IS NOT DISTINCT FROM a.line
      WHERE h.home_line <> a.away_line)
SELECT {_status_sql('home_raw')} || ' v ' || {_status_sql('away_raw')} AS match, start_time,
       'Line' AS market_name, {_status_sql('home_raw')} AS home_team, home_line, home_win, {_status_sql('away_raw')} AS away_team, away_line, away_win,
       round(1.0 / nullif(home_win, 0) + 1.0 / nullif(away_win, 0), 3) AS margin, 'TPCH' AS agency
FROM p""")
def q_market_line_opposite(spark: SparkSession, d: str) -> DataFrame:
    """TAB line market: R lineitems are home-team labels ``"<home> +2.0"``,
    A lineitems away-team labels, line = linenumber - 4."""
    flag, x = F.col("l_returnflag"), _line_x()
    team = F.when(flag == "R", F.col("_home")).when(flag == "A", F.col("_away"))
    sel = tab_lineitem_selections(
        spark, d,
        market_name=F.when(flag.isin("R", "A"), _line_market_name()).otherwise("Other"),
        prop_name=F.concat(team, F.lit(" "), _signed_text(x)))
    return mk.line_opposite(sel, agency="TPCH", keys=KEYS, ord=LINE_ORD, rules=STATUS_RULES, doc=())


def _totals_selections(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    text = F.col("l_linenumber").cast("double").cast("string")
    prop = (F.when(flag == "R", F.concat(F.lit("Over "), text))
             .when(flag == "A", F.concat(F.lit("Under "), text)).otherwise(F.lit("Void")))
    market = (F.when(F.col("l_linestatus") == "O", "Total Points Over/Under")
               .otherwise("Pick Your Own Total"))
    return tab_lineitem_selections(spark, d, market_name=market, prop_name=prop)


@register("market_totals_dedup", f"""
WITH b AS ({tab_base_sql()}),
s AS (SELECT *, CAST(l_linenumber AS DOUBLE) AS line,
             string_split(match, ' v ')[1] AS home_team, string_split(match, ' v ')[2] AS away_team FROM b),
o AS (SELECT * FROM (SELECT match, start_time, home_team, away_team, line, l_quantity AS over_price,
                            row_number() OVER (PARTITION BY match, line, l_quantity
                                               ORDER BY {LINE_ORD_SQL}) AS rn
                     FROM s WHERE l_returnflag = 'R') WHERE rn = 1),
u AS (SELECT * FROM (SELECT match, start_time, home_team, away_team, line, l_quantity AS under_price,
                            row_number() OVER (PARTITION BY match, line, l_quantity
                                               ORDER BY {LINE_ORD_SQL}) AS rn
                     FROM s WHERE l_returnflag = 'A') WHERE rn = 1),
j AS (SELECT o.*, u.under_price FROM o LEFT JOIN u
        ON o.match IS NOT DISTINCT FROM u.match AND o.start_time IS NOT DISTINCT FROM u.start_time
       AND o.home_team IS NOT DISTINCT FROM u.home_team AND o.away_team IS NOT DISTINCT FROM u.away_team
       AND o.line IS NOT DISTINCT FROM u.line)
SELECT {_status_sql('home_team')} || ' v ' || {_status_sql('away_team')} AS match, start_time,
       'Total Points' AS market_name, {_status_sql('home_team')} AS home_team, {_status_sql('away_team')} AS away_team, line, over_price, under_price,
       round(1.0 / nullif(over_price, 0) + 1.0 / nullif(under_price, 0), 3) AS margin, 'TPCH' AS agency
FROM j ORDER BY start_time, match, line""")
def q_market_totals_dedup(spark: SparkSession, d: str) -> DataFrame:
    """TAB totals: R = "Over n", A = "Under n" (n = linenumber), two market
    names feeding one market."""
    return mk.totals_dedup(_totals_selections(spark, d), agency="TPCH", keys=KEYS, ord=LINE_ORD,
                           rules=STATUS_RULES, doc=())


def _player_selections(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    market = (F.when(flag == "R", "Player To Score a Try").when(flag == "A", "Player 2+ Tries")
               .otherwise("Player 1st Try Scorer"))
    prop = F.concat(F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")"))
    return tab_lineitem_selections(spark, d, market_name=market, prop_name=prop, with_part=True)


# Test parameters: player alias over part names.
PART_ALIASES = (("small ring", "Small Ring"),)


@register("market_alt_lines", f"""
WITH b AS ({tab_base_sql(with_part=True)})
SELECT {_status_sql('home_raw')} || ' v ' || {_status_sql('away_raw')} AS match,
       {_status_sql('home_raw')} AS home_team,
       {_status_sql('away_raw')} AS away_team, 'Player Tries' AS market_name,
       CASE WHEN p_name = 'small ring' THEN 'Small Ring' ELSE p_name END AS player_name,
       CAST(CASE WHEN l_returnflag = 'R' THEN 0.5 ELSE 1.5 END AS DOUBLE) AS line, l_quantity AS over_price,
       l_partkey AS prop_id
FROM b WHERE l_returnflag IN ('R', 'A') ORDER BY over_price""")
def q_market_alt_lines(spark: SparkSession, d: str) -> DataFrame:
    """TAB alternate player lines: part names as players of their order."""
    return mk.tab_player_lines(_player_selections(spark, d), keys=KEYS, ord=LINE_ORD,
                               rules=STATUS_RULES, aliases=PART_ALIASES)


@register("market_outright", f"""
WITH b AS ({tab_base_sql(with_part=True)})
SELECT {_status_sql('home_raw')} || ' v ' || {_status_sql('away_raw')} AS match,
       {_status_sql('home_raw')} AS home_team,
       {_status_sql('away_raw')} AS away_team, 'First Try Scorer' AS market_name,
       CASE WHEN p_name = 'small ring' THEN 'Small Ring' ELSE p_name END AS player_name,
       l_quantity AS over_price, l_partkey AS prop_id
FROM b WHERE l_returnflag NOT IN ('R', 'A') ORDER BY over_price""")
def q_market_outright(spark: SparkSession, d: str) -> DataFrame:
    """TAB first-try-scorer outright: N lineitems' parts as players."""
    return mk.tab_outright(_player_selections(spark, d), keys=KEYS, ord=("l_orderkey", *LINE_ORD),
                           rules=STATUS_RULES, aliases=PART_ALIASES)


def _event_selections(spark: SparkSession, d: str) -> DataFrame:
    """Events as TAB-style time propositions of match ``User <u> v Day <d>``."""
    ev = _t(spark, d, "events")
    t = F.col("event_type")
    clock = _clock_text("ts")
    prop = (F.when(t == "click", F.concat(clock, F.lit(" or Earlier")))
             .when(t == "purchase", F.concat(clock, F.lit(" or later"))).otherwise(F.lit("Any time")))
    match = F.concat(F.lit("User "), _letters("user_id"), F.lit(" v Day "),
                     _letters(F.dayofmonth("ts")))
    market = F.when(t.isin("click", "purchase", "view"), "Time of First Try").otherwise("Other")
    return ev.select(F.lit("TPCH").alias("agency"), F.lit("sf").alias("snapshot_id"), "event_id",
                     match.alias("match"), _day_text("ts").alias("start_time"),
                     market.alias("market_name"), prop.alias("prop_name"), F.col("value").alias("price"))


_EVENT_MATCH_SQL = (f"'User ' || {_letters_sql('user_id')} || ' v Day ' || "
                    f"{_letters_sql('dayofmonth(ts)')}")


@register("market_time_threshold", f"""
WITH s AS (SELECT *, {_EVENT_MATCH_SQL} AS match, strftime(ts, '%Y-%m-%d') AS start_time,
                  strftime(ts, '%-H:%M') AS clock FROM events WHERE event_type IN ('click', 'purchase', 'view')),
g AS (SELECT match, start_time,
             arg_min(clock, event_id) FILTER (WHERE event_type = 'purchase') AS line,
             arg_min(value, event_id) FILTER (WHERE event_type = 'click') AS over_price,
             arg_min(value, event_id) FILTER (WHERE event_type = 'purchase') AS under_price,
             bool_or(event_type = 'click') AS has_over, bool_or(event_type = 'purchase') AS has_under
      FROM s GROUP BY match, start_time)
SELECT match, start_time, 'Time of First Try' AS market_name, string_split(match, ' v ')[1] AS home_team,
       string_split(match, ' v ')[2] AS away_team, line, over_price, under_price,
       round(1.0 / nullif(over_price, 0) + 1.0 / nullif(under_price, 0), 3) AS margin, 'TPCH' AS agency
FROM g WHERE has_over AND has_under""")
def q_market_time_threshold(spark: SparkSession, d: str) -> DataFrame:
    """TAB time of first try: clicks = "H:mm or Earlier", purchases =
    "H:mm or later" per user-day."""
    return mk.tab_time_threshold(_event_selections(spark, d), agency="TPCH", keys=KEYS,
                                 ord=("event_id",), rules=(), doc=())


# ----------------------------------------------------- Sportsbet markets

# Test parameters: return flag / line status -> participant names.
FLAG_RULES = (("^R$", "Returned"), ("^A$", "Accepted"), ("^N$", "None"), ("^O$", "Open"),
              ("^F$", "Filled"))


def _flag_sql(x: str) -> str:
    return ("CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{c}'" for p, c in FLAG_RULES)
            + f" ELSE {x} END")


@register("market_h2h_positional", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       {_flag_sql('l_returnflag')} || ' v ' || {_flag_sql('l_linestatus')} AS match, 'Head To Head' AS market_name,
       {_flag_sql('l_returnflag')} AS home_team, l_quantity AS home_win,
       {_flag_sql('l_linestatus')} AS away_team, l_discount * 100 AS away_win,
       strftime(l_shipdate, '%Y-%m-%d') AS start_time,
       round(1.0 / nullif(l_quantity, 0) + 1.0 / nullif(l_discount * 100, 0), 3) AS margin,
       'TPCH' AS agency
FROM lineitem""")
def q_market_h2h_positional(spark: SparkSession, d: str) -> DataFrame:
    """Listing-card head-to-head: each lineitem is a card with parallel
    participant and price-text arrays."""
    li = _t(spark, d, "lineitem")
    cards = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array("l_returnflag", "l_linestatus").alias("participants"),
        F.array(F.col("l_quantity").cast("string"), (F.col("l_discount") * 100).cast("string"))
         .alias("prices"),
        _day_text("l_shipdate").alias("start_time"))
    return mk.h2h_positional(cards, agency="TPCH", rules=FLAG_RULES,
                             keep=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


def _orders_teams(spark: SparkSession, d: str) -> DataFrame:
    """Teams dimension: one row per order (match)."""
    o = _t(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("match_id"),
                    F.concat(F.lit("Order "), _letters("o_orderkey")).alias("home_team"),
                    F.col("o_orderstatus").alias("away_team"))


def _sb_lineitem_selections(spark: SparkSession, d: str, market_name, prop_name,
                            handicap=None, with_status: bool = False) -> DataFrame:
    li = _t(spark, d, "lineitem")
    if with_status:  # labels that name the away side need the order status
        o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
        li = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    url = F.concat(F.lit(_EVENT_URL), (F.col("l_orderkey") + 1000000).cast("string"), F.lit("/markets"))
    return li.select(
        F.lit("TPCH").alias("agency"), F.lit("sf").alias("snapshot_id"), "*",
        F.col("l_orderkey").alias("match_id"), url.alias("source_url"),
        market_name.alias("market_name"), prop_name.alias("prop_name"),
        F.col("l_quantity").alias("price"),
        (handicap if handicap is not None else F.lit(None).cast("double")).alias("handicap"),
        F.col("l_partkey").alias("prop_id"), F.col("l_suppkey").alias("market_id"))


@register("market_line_balanced", f"""
WITH t AS (SELECT o_orderkey, 'Order ' || {_letters_sql('o_orderkey')} AS home_team,
                  {_status_sql('o_orderstatus')} AS away_team FROM orders),
{_LINE_SIDES_SQL}
SELECT t.home_team || ' v ' || t.away_team AS match, 'Line' AS market_name, t.home_team, h.home_line,
       h.home_win, t.away_team, a.away_line, a.away_win,
       round(1.0 / nullif(h.home_win, 0) + 1.0 / nullif(a.away_win, 0), 3) AS margin, 'TPCH' AS agency
FROM h JOIN a ON h.l_orderkey = a.l_orderkey AND abs(h.home_line + a.away_line) < 0.1
       JOIN t ON t.o_orderkey = h.l_orderkey""")
def q_market_line_balanced(spark: SparkSession, d: str) -> DataFrame:
    """Sportsbet line market: labels ``"<team> (+2.0)"``; side from the
    teams dimension; pairs whose handicaps cancel."""
    flag, x = F.col("l_returnflag"), _line_x()
    teams = mk.canonical_teams_dim(_orders_teams(spark, d), STATUS_RULES)
    team = (F.when(flag == "R", F.concat(F.lit("Order "), _letters("l_orderkey")))
             .when(flag == "A", F.col("o_orderstatus")))
    sel = _sb_lineitem_selections(
        spark, d, market_name=F.when(flag.isin("R", "A"), "Line").otherwise("Other"),
        prop_name=F.concat(team, F.lit(" ("), _signed_text(x), F.lit(")")), with_status=True)
    return mk.line_balanced(sel, teams, agency="TPCH", keys=KEYS, rules=STATUS_RULES, doc=())


@register("market_over_under", f"""
WITH t AS (SELECT o_orderkey, 'Order ' || {_letters_sql('o_orderkey')} AS home_team,
                  o_orderstatus AS away_team FROM orders),
o AS (SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS line, l_quantity AS over_price FROM lineitem
      WHERE l_returnflag = 'R'),
u AS (SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS line, l_quantity AS under_price FROM lineitem
      WHERE l_returnflag = 'A'),
j AS (SELECT o.*, u.under_price FROM o LEFT JOIN u
        ON o.l_orderkey = u.l_orderkey AND o.line IS NOT DISTINCT FROM u.line)
SELECT t.home_team || ' v ' || t.away_team AS match, 'Total Tries' AS market_name, t.home_team, t.away_team,
       line, over_price, under_price,
       round(1.0 / nullif(over_price, 0) + 1.0 / nullif(under_price, 0), 3) AS margin, 'TPCH' AS agency
FROM j LEFT JOIN t ON t.o_orderkey = j.l_orderkey""")
def q_market_over_under(spark: SparkSession, d: str) -> DataFrame:
    """Sportsbet total-tries over/under per order document: R = over,
    A = under, line = linenumber, given either as a handicap field or in
    the label (``"Tries Over 3.0"``)."""
    flag = F.col("l_returnflag")
    has_handicap = F.col("l_linestatus") == "O"
    text = F.col("l_linenumber").cast("double").cast("string")

    def label(side: str) -> F.Column:
        return F.when(has_handicap, F.lit(side)).otherwise(F.concat(F.lit(f"Tries {side} "), text))

    sel = _sb_lineitem_selections(
        spark, d, market_name=F.when(flag.isin("R", "A"), "Total Match Tries").otherwise("Other"),
        prop_name=F.when(flag == "R", label("Over")).when(flag == "A", label("Under")).otherwise("Void"),
        handicap=F.when(has_handicap, F.col("l_linenumber").cast("double")))
    return mk.over_under(sel, _orders_teams(spark, d), market_re="Total Match Tries", over_re="Over",
                         under_re="Under", label="Total Tries", agency="TPCH", keys=KEYS)


# Events as player markets of match (user, day).
def _player_event_selections(spark: SparkSession, d: str) -> DataFrame:
    ev = _events_k(spark, d)
    t = F.col("event_type")
    player = F.concat(F.lit("Player "), _letters("event_id"))
    line_v = (F.col("k") % 4).cast("double") + 0.5
    handicap = F.when(F.col("k") % 3 != 0, line_v)

    def ou(side: str, side_no: int, price) -> F.Column:
        name = F.when(handicap.isNull(), F.concat(player, F.lit(f" {side} "), line_v.cast("string"))) \
                .otherwise(F.concat(player, F.lit(f" {side}")))
        return F.struct(name.alias("prop_name"), price.alias("price"), handicap.alias("handicap"),
                        (F.col("event_id") * 2 + side_no).alias("prop_id"))

    single = F.struct(player.alias("prop_name"), F.col("value").alias("price"),
                      F.lit(None).cast("double").alias("handicap"), (F.col("event_id") * 2).alias("prop_id"))
    sides = (F.when(t == "click", F.array(ou("Over", 0, F.col("value")), ou("Under", 1, F.col("value") + 1)))
              .when(t == "purchase", F.array(ou("Over", 0, F.col("value"))))
              .otherwise(F.array(single)))
    market = (F.when(t.isin("click", "purchase"), "Player Tries Over/Under")
               .when(t == "view", "To Score 2+ Tries").when(t == "signup", "First Try Scorer")
               .otherwise("To Score First Try"))
    match_id = F.col("user_id") * 100 + F.dayofmonth("ts")
    s = ev.select(F.lit("TPCH").alias("agency"), F.lit("sf").alias("snapshot_id"), "event_id", "ts",
                  "user_id", match_id.alias("match_id"), market.alias("market_name"),
                  F.col("event_id").alias("market_id"), F.explode(sides).alias("_s"))
    return s.select("*", "_s.*").drop("_s")


def _event_teams(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events")
    return ev.select((F.col("user_id") * 100 + F.dayofmonth("ts")).alias("match_id"),
                     F.concat(F.lit("Home "), _letters("user_id")).alias("home_team"),
                     F.concat(F.lit("Away "), _letters(F.dayofmonth("ts"))).alias("away_team")).distinct()


def _event_metadata(spark: SparkSession, d: str) -> DataFrame:
    ev = _t(spark, d, "events").withColumn("match_id", F.col("user_id") * 100 + F.dayofmonth("ts"))
    return ev.groupBy("match_id").agg(F.min("event_id").alias("class_external_id"),
                                      F.count(F.lit(1)).alias("competition_external_id"),
                                      F.max("event_id").alias("event_external_id"))


def _enriched_events(spark: SparkSession, d: str) -> DataFrame:
    return mk.enrich_selections(_player_event_selections(spark, d), _event_teams(spark, d),
                                _event_metadata(spark, d))


_PLAYER_EVENTS_SQL = f"""
  b AS (SELECT *, user_id * 100 + dayofmonth(ts) AS match_id, 'Player ' || {_letters_sql('event_id')} AS player,
               CAST({_K_SQL} % 4 AS DOUBLE) + 0.5 AS line,
               'Home ' || {_letters_sql('user_id')} || ' v ' || 'Away ' || {_letters_sql('dayofmonth(ts)')} AS match,
               'Home ' || {_letters_sql('user_id')} AS home_team, 'Away ' || {_letters_sql('dayofmonth(ts)')} AS away_team
        FROM events),
  m AS (SELECT match_id, min(event_id) AS class_external_id, count(*) AS competition_external_id,
               max(event_id) AS event_external_id FROM b GROUP BY match_id),
  e AS (SELECT b.*, m.class_external_id, m.competition_external_id, m.event_external_id
        FROM b JOIN m USING (match_id)),
  m6 AS (SELECT match, home_team, away_team, 'Player Tries' AS market_name, player AS player_name,
                CAST(1.5 AS DOUBLE) AS line, value AS over_price, 'TPCH' AS agency, class_external_id,
                competition_external_id, event_external_id, event_id AS market_id, event_id * 2 AS player_id
         FROM e WHERE event_type = 'view'),
  m7 AS (SELECT match, home_team, away_team, 'Player Tries' AS market_name,
                -- a label without a number after " Over " is not split: the whole label is the name,
                -- so such overs find no under
                CASE WHEN {_K_SQL} % 3 = 0 THEN player ELSE player || ' Over' END AS player_name, line,
                value AS over_price, 'TPCH' AS agency, class_external_id, competition_external_id,
                event_external_id, event_id AS market_id, event_id * 2 AS player_id,
                CASE WHEN event_type = 'click' AND {_K_SQL} % 3 = 0 THEN value + 1 END AS under_price,
                CASE WHEN event_type = 'click' AND {_K_SQL} % 3 = 0 THEN event_id * 2 + 1 END AS player_id_unders
         FROM e WHERE event_type IN ('click', 'purchase'))"""


@register("enrich_selections", f"""
WITH {_PLAYER_EVENTS_SQL},
s AS (SELECT e.*, 0 AS side, value AS price, event_id * 2 AS prop_id FROM e
      UNION ALL SELECT e.*, 1, value + 1, event_id * 2 + 1 FROM e WHERE event_type = 'click')
SELECT match_id, match, home_team, away_team,
       CASE WHEN event_type IN ('click', 'purchase') THEN 'Player Tries Over/Under'
            WHEN event_type = 'view' THEN 'To Score 2+ Tries' WHEN event_type = 'signup' THEN 'First Try Scorer'
            ELSE 'To Score First Try' END AS market_name,
       price, prop_id, event_id AS market_id, class_external_id, competition_external_id, event_external_id
FROM s""")
def q_enrich_selections(spark: SparkSession, d: str) -> DataFrame:
    e = _enriched_events(spark, d)
    return e.select("match_id", "match", "home_team", "away_team", "market_name", "price", "prop_id",
                    "market_id", "class_external_id", "competition_external_id", "event_external_id")


@register("market_alt_lines_sb", f"WITH {_PLAYER_EVENTS_SQL} SELECT * FROM m6")
def q_market_alt_lines_sb(spark: SparkSession, d: str) -> DataFrame:
    return mk.sb_player_lines(_enriched_events(spark, d), agency="TPCH", keys=KEYS)


@register("market_player_over_under", f"WITH {_PLAYER_EVENTS_SQL} SELECT * FROM m7")
def q_market_player_over_under(spark: SparkSession, d: str) -> DataFrame:
    return mk.sb_player_over_under(_enriched_events(spark, d), agency="TPCH", keys=KEYS)


@register("market_player_tries", f"""
WITH {_PLAYER_EVENTS_SQL} SELECT * FROM m6 UNION BY NAME SELECT * FROM m7""")
def q_market_player_tries(spark: SparkSession, d: str) -> DataFrame:
    return mk.sb_player_tries(_enriched_events(spark, d), agency="TPCH", keys=KEYS)


@register("market_outright_sb", f"""
WITH {_PLAYER_EVENTS_SQL}
SELECT match, home_team, away_team, 'First Try Scorer' AS market_name, player AS player_name,
       value AS over_price, 'TPCH' AS agency, event_id * 2 AS player_id, event_id AS market_id
FROM e WHERE event_type = 'signup'""")
def q_market_outright_sb(spark: SparkSession, d: str) -> DataFrame:
    return mk.sb_outright(_enriched_events(spark, d), agency="TPCH", keys=KEYS)


@register("market_time_bands", f"""
WITH {_PLAYER_EVENTS_SQL},
g AS (SELECT match, match_id, arg_min(home_team, event_id) AS home_team, arg_min(away_team, event_id) AS away_team,
             arg_min(CAST(minute(ts) + 1 AS VARCHAR) || ':00', event_id) FILTER (WHERE event_type = 'click') AS line,
             arg_min(value, event_id) FILTER (WHERE event_type = 'click') AS over_price,
             arg_min(value, event_id) FILTER (WHERE event_type = 'purchase') AS under_price
      FROM b GROUP BY match, match_id)
SELECT match, 'Time of First Try' AS market_name, home_team, away_team, line, over_price, under_price,
       round(1.0 / nullif(over_price, 0) + 1.0 / nullif(under_price, 0), 3) AS margin, 'TPCH' AS agency
FROM g WHERE line IS NOT NULL""")
def q_market_time_bands(spark: SparkSession, d: str) -> DataFrame:
    """Sportsbet time of first try: clicks are ``"0-<minute+1> Minutes"``
    bands (over), purchases ``"No Try"`` (under), per user-day match."""
    ev = _t(spark, d, "events")
    t = F.col("event_type")
    prop = (F.when(t == "click", F.concat(F.lit("0-"), (F.minute("ts") + 1).cast("string"), F.lit(" Minutes")))
             .when(t == "purchase", F.lit("No Try")).otherwise(F.lit("Anytime")))
    sel = ev.select(F.lit("TPCH").alias("agency"), F.lit("sf").alias("snapshot_id"), "event_id",
                    (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("match_id"),
                    F.lit("Time of First Try").alias("market_name"), prop.alias("prop_name"),
                    F.col("value").alias("price"))
    e = mk.enrich_selections(sel, _event_teams(spark, d))
    return mk.sb_time_threshold(e, agency="TPCH", keys=KEYS, ord=("event_id",), doc=())


@register("market_total_points", f"""
WITH t AS (SELECT o_orderkey, 'Order ' || {_letters_sql('o_orderkey')} AS home_team,
                  o_orderstatus AS away_team FROM orders),
o AS (SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS line, l_quantity AS over_price FROM lineitem
      WHERE l_returnflag = 'R' AND l_linestatus = 'O'),
u AS (SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS line, l_quantity AS under_price FROM lineitem
      WHERE l_returnflag = 'A' AND l_linestatus = 'O'),
j AS (SELECT o.*, u.under_price FROM o LEFT JOIN u
        ON o.l_orderkey = u.l_orderkey AND o.line IS NOT DISTINCT FROM u.line)
SELECT t.home_team || ' v ' || t.away_team AS match, 'Total Points' AS market_name, t.home_team, t.away_team,
       line, over_price, under_price,
       round(1.0 / nullif(over_price, 0) + 1.0 / nullif(under_price, 0), 3) AS margin, 'TPCH' AS agency
FROM j LEFT JOIN t ON t.o_orderkey = j.l_orderkey""")
def q_market_total_points(spark: SparkSession, d: str) -> DataFrame:
    """Sportsbet total points (anchored ``Over$``/``Under$``): labels with a
    number after the side (status F lineitems) do not belong to the market."""
    flag = F.col("l_returnflag")
    has_handicap = F.col("l_linestatus") == "O"
    text = F.col("l_linenumber").cast("double").cast("string")

    def label(side: str) -> F.Column:
        return F.when(has_handicap, F.lit(f"Points {side}")).otherwise(F.concat(F.lit(f"Points {side} "), text))

    sel = _sb_lineitem_selections(
        spark, d, market_name=F.when(flag.isin("R", "A"), "Total Match Points").otherwise("Other"),
        prop_name=F.when(flag == "R", label("Over")).when(flag == "A", label("Under")).otherwise("Void"),
        handicap=F.when(has_handicap, F.col("l_linenumber").cast("double")))
    return mk.over_under(sel, _orders_teams(spark, d), agency="TPCH", keys=KEYS)


@register("market_total_tries_tab", f"""
WITH b AS ({tab_base_sql()}),
s AS (SELECT *, CAST(l_linenumber AS DOUBLE) AS line,
             string_split(match, ' v ')[1] AS home_team, string_split(match, ' v ')[2] AS away_team FROM b
      WHERE l_linestatus = 'F'),
o AS (SELECT * FROM (SELECT match, start_time, home_team, away_team, line, l_quantity AS over_price,
                            row_number() OVER (PARTITION BY match, line, l_quantity ORDER BY {LINE_ORD_SQL}) AS rn
                     FROM s WHERE l_returnflag = 'R') WHERE rn = 1),
u AS (SELECT * FROM (SELECT match, start_time, home_team, away_team, line, l_quantity AS under_price,
                            row_number() OVER (PARTITION BY match, line, l_quantity ORDER BY {LINE_ORD_SQL}) AS rn
                     FROM s WHERE l_returnflag = 'A') WHERE rn = 1),
j AS (SELECT o.*, u.under_price FROM o LEFT JOIN u
        ON o.match IS NOT DISTINCT FROM u.match AND o.start_time IS NOT DISTINCT FROM u.start_time
       AND o.home_team IS NOT DISTINCT FROM u.home_team AND o.away_team IS NOT DISTINCT FROM u.away_team
       AND o.line IS NOT DISTINCT FROM u.line)
SELECT {_status_sql('home_team')} || ' v ' || {_status_sql('away_team')} AS match, start_time,
       'Total Tries' AS market_name, {_status_sql('home_team')} AS home_team, {_status_sql('away_team')} AS away_team,
       line, over_price, under_price,
       round(1.0 / nullif(over_price, 0) + 1.0 / nullif(under_price, 0), 3) AS margin, 'TPCH' AS agency
FROM j ORDER BY start_time, match, line""")
def q_market_total_tries_tab(spark: SparkSession, d: str) -> DataFrame:
    """TAB total tries: only the two tries market names feed the market
    (status F lineitems); points markets (status O) are ignored."""
    flag = F.col("l_returnflag")
    text = F.col("l_linenumber").cast("double").cast("string")
    prop = (F.when(flag == "R", F.concat(F.lit("Over "), text))
             .when(flag == "A", F.concat(F.lit("Under "), text)).otherwise(F.lit("Void")))
    market = (F.when(F.col("l_linestatus") == "F",
                     F.when(F.col("l_tax") < 0.04, "Total Tries Over/Under").otherwise("Pick Your Own Tries"))
               .otherwise("Total Points Over/Under"))
    sel = tab_lineitem_selections(spark, d, market_name=market, prop_name=prop)
    return mk.totals_dedup(sel, markets=("Total Tries Over/Under", "Pick Your Own Tries"),
                           label="Total Tries", agency="TPCH", keys=KEYS, ord=LINE_ORD,
                           rules=STATUS_RULES, doc=())


# ------------------------------ identity, endpoints, snapshots, real nesting

@register("positional_join", """
WITH n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) - 1 AS pos
           FROM conversations)
SELECT u.conv_id, u.pos, u.text AS asked, a.text AS answered
FROM n u JOIN n a ON u.conv_id = a.conv_id AND u.pos = a.pos WHERE u.role = 'user' AND a.role = 'assistant'""")
def q_positional_join(spark: SparkSession, d: str) -> DataFrame:
    """The i-th question of a conversation beside its i-th answer."""
    turns = _t(spark, d, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", F.col("turn").alias("u"), F.col("text").alias("asked"))
    said = turns.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("a"), F.col("text").alias("answered"))
    return op.positional_join(asked, said, ["conv_id"], ["u", "asked"], ["a", "answered"]).drop("u", "a")


_LONG_ID_SQL = """CASE event_id % 4 WHEN 0 THEN 10000 + event_id % 90000 WHEN 1 THEN 1000000 + event_id
  WHEN 2 THEN 100000000 + event_id ELSE 1000000000 + event_id END"""


@register("src_json_events_long_ids", f"""
SELECT {_LONG_ID_SQL} AS match_id, 'line' AS endpoint, event_type AS market_name, event_id AS market_id,
       n.prop_pos, event_type || ' ' || CAST(n.prop_pos AS VARCHAR) AS prop_name, value + n.prop_pos AS price
FROM events, (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS prop_pos) n""")
def q_src_json_events_long_ids(spark: SparkSession, d: str) -> DataFrame:
    """Responses for ids of 5, 7, 9 and 10 digits: match and endpoint come from
    the request manifest."""
    from .. import schemas as S
    from ..session import scratch_path
    from ..sources import parse_documents, read_landed, sportsbet_selections, url_manifest
    ev = _t(spark, d, "events")
    e = F.col("event_id")
    match_id = (F.when(e % 4 == 0, 10000 + e % 90000).when(e % 4 == 1, 1000000 + e)
                 .when(e % 4 == 2, 100000000 + e).otherwise(1000000000 + e))
    price = lambda i: F.struct((F.col("value") + i).alias("winPrice"))
    sels = F.array(*[F.struct(F.concat(F.col("event_type"), F.lit(f" {i}")).alias("name"), price(i).alias("price"))
                     for i in range(3)])
    body = F.to_json(F.array(F.struct(F.col("event_type").alias("name"), e.alias("externalId"), sels.alias("selections"))))
    rows = ev.select(match_id.alias("match_id"), body.alias("body"))
    manifest = url_manifest(rows.select("match_id").distinct())
    path = scratch_path(spark, "long-ids")
    rows.join(manifest.filter("endpoint = 'line'"), "match_id").select("url", "body").write.json(path)
    docs = parse_documents(read_landed(spark, path), S.SB_MARKETS_RESPONSE)
    sel = sportsbet_selections(docs, manifest)
    return sel.select("match_id", "endpoint", "market_name", "market_id", "prop_pos", "prop_name", "price")


@register("market_h2h_two_documents", f"""
WITH s AS ({LINEITEM_SELECTIONS_SQL}),
r AS (SELECT s.*, row_number() OVER (PARTITION BY l_orderkey, l_linestatus, o_orderpriority, start_time ORDER BY {LINE_ORD_SQL}) AS rn
      FROM s WHERE l_returnflag = 'R'),
p AS (SELECT l_orderkey, l_linestatus, o_orderpriority, start_time, max(CASE WHEN rn = 1 THEN l_quantity END) AS home_win,
             max(CASE WHEN rn = 2 THEN l_quantity END) AS away_win FROM r WHERE rn <= 2
      GROUP BY l_orderkey, l_linestatus, o_orderpriority, start_time),
c AS (SELECT *, 'Order ' || CAST(l_orderkey AS VARCHAR) AS home_team, {_canon_sql('o_orderpriority')} AS away_team FROM p)
SELECT home_team || ' v ' || away_team AS match, start_time, 'Head To Head' AS market_name, home_team, home_win,
       away_team, away_win, round(1.0 / nullif(home_win, 0) + 1.0 / nullif(away_win, 0), 3) AS margin, 'TPCH' AS agency FROM c""")
def q_market_h2h_two_documents(spark: SparkSession, d: str) -> DataFrame:
    """Two documents of one snapshot name the same match (lines by status): each
    gives its own row, prices never mix."""
    market = F.when(F.col("l_returnflag") == "R", "Head To Head").otherwise("Other")
    sel = lineitem_selections(spark, d, market_name=market).withColumn("source_url", F.col("l_linestatus"))
    return mk.h2h_nth(sel, agency="TPCH", keys=KEYS, ord=LINE_ORD, rules=PRIORITY_RULES, doc=("source_url",))


@register("market_line_two_endpoints", ORACLE_SQL["market_line_balanced"])
def q_market_line_two_endpoints(spark: SparkSession, d: str) -> DataFrame:
    """Every line is listed by two endpoints; the market reads its own."""
    flag, x = F.col("l_returnflag"), _line_x()
    teams = mk.canonical_teams_dim(_orders_teams(spark, d), STATUS_RULES)
    team = (F.when(flag == "R", F.concat(F.lit("Order "), _letters("l_orderkey")))
             .when(flag == "A", F.col("o_orderstatus")))
    sel = _sb_lineitem_selections(
        spark, d, market_name=F.when(flag.isin("R", "A"), "Line").otherwise("Other"),
        prop_name=F.concat(team, F.lit(" ("), _signed_text(x), F.lit(")")), with_status=True)
    both = sel.withColumn("endpoint", F.explode(F.array(F.lit("main"), F.lit("line"))))
    return mk.line_balanced(mk.routed(both, "line"), teams, agency="TPCH", keys=KEYS, rules=STATUS_RULES, doc=())


@register("market_player_two_snapshots", f"""
WITH {_PLAYER_EVENTS_SQL}
SELECT s.snapshot_id, m7.* FROM m7, (VALUES ('s1'), ('s2')) s(snapshot_id)""")
def q_market_player_two_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """The same overs and unders in two snapshots: each is priced within its own."""
    e = _enriched_events(spark, d).withColumn("snapshot_id", F.explode(F.array(F.lit("s1"), F.lit("s2"))))
    return mk.sb_player_over_under(e, agency="TPCH", keys=KEYS, with_keys=True)


@register("teams_one_per_match", """
SELECT l_orderkey AS match_id, arg_min(l_shipmode_team, pos) AS home_team FROM (
  SELECT l_orderkey, 'Part ' || CAST(l_partkey AS VARCHAR) AS l_shipmode_team,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos FROM lineitem)
GROUP BY l_orderkey""")
def q_teams_one_per_match(spark: SparkSession, d: str) -> DataFrame:
    """Several listing cards of a match give one teams row, the first in order."""
    li = _t(spark, d, "lineitem")
    cards = li.select(F.col("l_orderkey").alias("match_id"), "l_linenumber", "l_partkey", "l_suppkey",
                      F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("home_team"))
    return mk.one_per_match(cards, ("l_linenumber", "l_partkey", "l_suppkey"))


_LISTING_SQL = """
  SELECT o_orderkey, o_orderkey % 3 = 0 AS bad, o_orderkey + 10000 AS first_id, o_orderkey + 20000000 AS second_id,
         o_orderpriority AS home, 'A & ' || o_orderstatus AS away, CAST(o_custkey AS VARCHAR) AS price FROM orders"""


@register("listing_cards", f"""
WITH p AS ({_LISTING_SQL})
SELECT o_orderkey AS page_id, c.card_pos, CASE WHEN c.card_pos = 0 THEN first_id ELSE second_id END AS match_id,
       CASE WHEN c.card_pos = 0 THEN home ELSE away END AS home_team,
       CASE WHEN c.card_pos = 0 THEN away ELSE home END AS away_team,
       CAST(price AS DOUBLE) + c.card_pos AS home_win
FROM p, (SELECT CAST(unnest([0, 1]) AS INTEGER) AS card_pos) c WHERE NOT bad""")
def q_listing_cards(spark: SparkSession, d: str) -> DataFrame:
    """Listing pages of two cards each, built from orders: classes among others and
    look-alike classes, both kinds of quotes, entities, nested markup; pages that
    lack a link give no cards."""
    from ..sources import card_prices, listing_cards
    cards = listing_cards(_listing_pages(spark, d), keep=("page_id",))
    priced = card_prices(cards)
    return priced.select("page_id", "card_pos", "match_id", F.get("participants", 0).alias("home_team"),
                         F.get("participants", 1).alias("away_team"), "home_win")


@register("listing_rejects", f"""
WITH p AS ({_LISTING_SQL}) SELECT o_orderkey AS page_id, CAST(2 AS INTEGER) AS n_cards, CAST(1 AS INTEGER) AS n_links FROM p WHERE bad""")
def q_listing_rejects(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import listing_rejects
    return listing_rejects(_listing_pages(spark, d)).select("page_id", "n_cards", "n_links")


def _listing_pages(spark: SparkSession, d: str) -> DataFrame:
    from ..sources import pages as pg
    o = _t(spark, d, "orders")
    key = F.col("o_orderkey")

    def card(home, away, price, link) -> F.Column:
        return F.concat(
            F.lit(f"<div id='x' class='row {pg.CARD_CLASS} wide'><p class='{pg.CARD_CLASS}-note'>no card</p>"
                  f"<span class=\"{pg.PARTICIPANT_CLASS}\">"), home, F.lit(f"</span><span class='a {pg.PARTICIPANT_CLASS}'>"),
            away, F.lit(f"</span><i class='{pg.PRICE_CLASS}'><b>"), price.cast("string"), F.lit("</b></i>"), link, F.lit("</div>"))

    def link(number) -> F.Column:
        return F.concat(F.lit(f"<a data-x='1' class='{pg.MATCH_LINK_CLASS} b' href='/m?a=1&amp;b=v-"), number.cast("string"), F.lit("'>x</a>"))

    away = F.concat(F.lit("A &#38; "), F.col("o_orderstatus"))
    second = F.when(key % 3 == 0, F.lit("")).otherwise(link(key + 20000000))
    html = F.concat(F.lit("<html><link href='/no-link'>"),
                    card(F.col("o_orderpriority"), away, F.col("o_custkey"), link(key + 10000)),
                    card(away, F.col("o_orderpriority"), F.col("o_custkey") + 1, second), F.lit("</html>"))
    return o.select(key.alias("page_id"), F.lit("u").alias("url"), html.alias("html"))


@register("quarantine_landing", f"""
SELECT CASE WHEN event_type = 'view' THEN NULL ELSE '{_EVENT_URL}' || CAST(event_id AS VARCHAR) END AS url,
       CASE event_type WHEN 'error' THEN props WHEN 'view' THEN 'broken line ' || CAST(event_id AS VARCHAR) END AS body
FROM events WHERE event_type IN ('error', 'view')""")
def q_quarantine_landing(spark: SparkSession, d: str) -> DataFrame:
    """Landing lines that are no records, and error objects where a list belongs,
    go to the rejects with their text."""
    from .. import schemas as S
    from ..session import scratch_path
    from ..sources import parse_documents, quarantine_split, read_landed
    ev, kind = _t(spark, d, "events"), F.col("event_type")
    url = F.concat(F.lit(_EVENT_URL), F.col("event_id").cast("string"))
    body = F.when(kind == "error", F.col("props")).otherwise(F.concat(F.lit("["), F.col("props"), F.lit("]")))
    line = F.when(kind == "view", F.concat(F.lit("broken line "), F.col("event_id").cast("string"))).otherwise(
        F.to_json(F.struct(url.alias("url"), body.alias("body"))))
    path = scratch_path(spark, "landing-lines")
    ev.select(line.alias("value")).write.text(path)
    _good, rejects = quarantine_split(parse_documents(read_landed(spark, path), S.SB_MARKETS_RESPONSE))
    return rejects.select("url", "body")


@register("json_orders_nested", f"""
WITH r AS (SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) - 1 AS market_pos,
                  row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY {LINE_ORD_SQL}) - 1 AS prop_pos FROM lineitem)
SELECT 'Order ' || CAST(l_orderkey AS VARCHAR) AS match, CAST(market_pos AS INTEGER) AS market_pos, l_returnflag AS market_name,
       CAST(prop_pos AS INTEGER) AS prop_pos, l_partkey AS prop_id, l_quantity AS price FROM r""")
def q_json_orders_nested(spark: SparkSession, d: str) -> DataFrame:
    """A document for each order: a market for each return flag, its lines as
    propositions; all positions take values above 0."""
    from .. import schemas as S
    from ..session import scratch_path
    from ..sources import current_documents, parse_documents, read_landed, tab_selections
    # One exchange serves both groupings.
    li = _t(spark, d, "lineitem").select("l_orderkey", *LINE_ORD).repartition("l_orderkey")
    prop = F.struct(*LINE_ORD, F.struct(F.col("l_partkey").alias("id"), F.lit("p").alias("name"),
                                        F.col("l_quantity").alias("returnWin")).alias("prop"))
    markets = li.groupBy("l_orderkey", "l_returnflag").agg(F.transform(
        F.sort_array(F.collect_list(prop)), lambda r: r["prop"]).alias("propositions"))
    one = F.struct(F.col("l_returnflag").alias("betOption"), "propositions")
    orders = markets.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(one)).alias("markets"))
    match = F.struct(F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("name"), "markets")
    path = scratch_path(spark, "order-docs")
    landed = orders.select(F.concat(F.lit("o/"), F.col("l_orderkey").cast("string")).alias("url"),
                           F.to_json(F.struct(F.array(match).alias("matches"))).alias("body"))
    _land_json(landed, path)
    again = spark.read.schema(landed.schema).json(path)  # the documents of the first landing, not built anew
    _land_json(again, path)  # landed twice: counts once
    # Selections are written once: current_documents reads a few of their columns first, then the rows that count.
    selections = tab_selections(parse_documents(read_landed(spark, path), S.TAB_RESPONSE))
    selections.write.parquet(flat := scratch_path(spark, "order-selections"))
    sel = current_documents(spark.read.schema(selections.schema).parquet(flat))
    return sel.select("match", "market_pos", "market_name", "prop_pos", "prop_id", "price")


_L_ALL = ("l_orderkey", *LINE_ORD)


@register("positional_join_global", f"""
WITH l AS (SELECT *, row_number() OVER (ORDER BY {", ".join(_L_ALL)}) - 1 AS pos FROM lineitem),
e AS (SELECT *, row_number() OVER (ORDER BY event_type, value, event_id) - 1 AS pos FROM events)
SELECT pos, l_orderkey, l_linenumber, l_partkey, event_id, event_type FROM l JOIN e USING (pos)""")
def q_positional_join_global(spark: SparkSession, d: str) -> DataFrame:
    """Two tables side by side without keys: the i-th line beside the i-th event."""
    lines = _t(spark, d, "lineitem").select(*_L_ALL)
    events = _t(spark, d, "events").select("event_type", "value", "event_id")
    joined = op.positional_join(lines, events, [], _L_ALL, ["event_type", "value", "event_id"])
    return joined.select("pos", "l_orderkey", "l_linenumber", "l_partkey", "event_id", "event_type")


@register("response_ledger", f"""
WITH b AS (SELECT *, '[' || CASE WHEN event_type = 'error' THEN replace(props, ':', '=') ELSE props END || ']' AS body FROM events),
landed AS (
  SELECT CASE WHEN event_type = 'signup' THEN 'body:' || sha256(body) ELSE '{_EVENT_URL}' || CAST(event_id AS VARCHAR) END AS url,
         event_type <> 'error' AS valid
  FROM b, (SELECT unnest([1, 2]) AS time) WHERE event_type <> 'click' AND (time = 1 OR event_type = 'view')
), counted AS (
  SELECT url, count(*) AS n_landed, count(*) FILTER (WHERE valid) AS n_valid FROM landed GROUP BY url
), asked AS (
  SELECT '{_EVENT_URL}' || CAST(event_id AS VARCHAR) AS url, event_id AS match_id, 'main' AS endpoint FROM events WHERE event_type <> 'purchase'
)
SELECT url, match_id, endpoint, coalesce(n_landed, 0) AS n_landed, coalesce(n_valid, 0) AS n_valid,
       CASE WHEN n_landed IS NULL THEN 'missing' WHEN n_valid = 0 THEN 'rejected' WHEN match_id IS NULL THEN 'unexpected'
            ELSE 'answered' END AS status
FROM asked FULL JOIN counted USING (url)""")
def q_response_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Requests for all events but purchases; clicks aren't answered, errors don't parse, sign-ups land without
    a url, views land twice."""
    from .. import schemas as S
    from ..session import scratch_path
    from ..sources import parse_documents, read_landed, response_ledger
    ev, kind = _t(spark, d, "events"), F.col("event_type")
    url = F.concat(F.lit(_EVENT_URL), F.col("event_id").cast("string"))
    props = F.when(kind == "error", F.replace("props", F.lit(":"), F.lit("="))).otherwise(F.col("props"))
    path = scratch_path(spark, "ledger-landing")
    landed = ev.where(kind != "click").select(F.when(kind != "signup", url).alias("url"), F.concat(
        F.lit("["), props, F.lit("]")).alias("body"), F.explode(F.when(kind == "view", F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1)))).alias("_time"))
    landed.drop("_time").write.json(path)
    asked = ev.where(kind != "purchase").select(url.alias("url"), F.col("event_id").alias("match_id"), F.lit("main").alias("endpoint"))
    out = response_ledger(parse_documents(read_landed(spark, path), S.SB_MARKETS_RESPONSE), asked)
    return out.select("url", "match_id", "endpoint", "n_landed", "n_valid", "status")


@register("run_ledger", f"""
SELECT 'head_to_head' AS market, 'written' AS status, (SELECT count(*) FROM ({SQL_MARKET_H2H_NTH})) AS n_rows
UNION ALL SELECT 'outright', 'written', (SELECT count(*) FROM ({ORACLE_SQL["market_outright"]}))
UNION ALL SELECT 'broken', 'failed', NULL""")
def q_run_ledger(spark: SparkSession, d: str) -> DataFrame:
    """A run of three markets whose second breaks on its rows; the others are written."""
    from ..session import scratch_path
    from .runs import MarketRun
    out = scratch_path(spark, "run")
    run = MarketRun(spark, out, "TPCH", "sf")

    def broken() -> DataFrame:
        return _t(spark, d, "orders").select(F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("bad price"))).alias("x"))

    builders = {"head_to_head": lambda: q_market_h2h_nth(spark, d), "broken": broken, "outright": lambda: q_market_outright(spark, d)}
    for name, build in builders.items():
        run.table(name, build, f"{out}/{name}", lambda df, path: df.write.parquet(path))
    return run.ledger().select("market", "status", "n_rows")


_RULE_NAME = "'From ' || {letters} || ' ' || l_linestatus || CASE WHEN l_returnflag = 'N' THEN ' new stock' ELSE ' stock' END"


@register("canonicalize_rule_table", f"""
WITH rules AS (
  SELECT '(^From ' || {_letters_sql('s_suppkey')} || ' O)|(' || {_letters_sql('s_suppkey')} || ' F new)' AS pattern, s_name AS canonical,
         s_suppkey AS priority FROM supplier
  UNION ALL SELECT '^From ' || {_letters_sql('s_suppkey')} || ' ', 'Depot ' || CAST(s_nationkey AS VARCHAR), 1000000 + s_suppkey FROM supplier
  UNION ALL SELECT '^From [a-e]+ F', 'Finished', 0
), names AS (
  SELECT DISTINCT {_RULE_NAME.format(letters=_letters_sql('l_suppkey'))} AS name FROM lineitem
), hits AS (
  SELECT name, arg_min(canonical, priority) AS canonical FROM names JOIN rules ON regexp_matches(name, pattern) GROUP BY name
)
SELECT l_orderkey, l_linenumber, coalesce(canonical, name) AS name
FROM (SELECT *, {_RULE_NAME.format(letters=_letters_sql('l_suppkey'))} AS name FROM lineitem) JOIN names USING (name) LEFT JOIN hits USING (name)""")
def q_canonicalize_rule_table(spark: SparkSession, d: str) -> DataFrame:
    """Two rules for each supplier, from the table, and one that can't be filed under a plain text."""
    s = _t(spark, d, "supplier").withColumn("w", _letters("s_suppkey"))
    first = s.select(F.concat(F.lit("(^From "), "w", F.lit(" O)|("), "w", F.lit(" F new)")).alias("pattern"),
                     F.col("s_name").alias("canonical"), F.col("s_suppkey").cast("bigint").alias("priority"))
    second = s.select(F.concat(F.lit("^From "), "w", F.lit(" ")), F.concat(F.lit("Depot "), F.col("s_nationkey").cast("string")),
                      F.col("s_suppkey").cast("bigint") + 1000000)
    third = spark.createDataFrame([("^From [a-e]+ F", "Finished", 0)], first.schema)
    li = _t(spark, d, "lineitem").withColumn("w", _letters("l_suppkey"))
    named = li.select("l_orderkey", "l_linenumber", F.expr(_RULE_NAME.format(letters="w")).alias("name"))
    return fx.canonicalize_by_table(named, "name", first.union(second).union(third))


@register("pair_sides_hot", """
WITH r AS (SELECT l_returnflag, l_linestatus AS other_status, min(l_extendedprice) AS least FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice AS price, other_status, least FROM lineitem JOIN r USING (l_returnflag)""")
def q_pair_sides_hot(spark: SparkSession, d: str) -> DataFrame:
    """Every line beside the cheapest line of each status of its return flag: three keys, each with a third of the rows."""
    li = _t(spark, d, "lineitem")
    lines = li.select("l_returnflag", F.lit("line").alias("_side"), "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"),
                      F.col("l_linestatus").alias("other_status"), F.lit(None).cast("double").alias("least"))
    cheap = li.groupBy("l_returnflag", "l_linestatus").agg(F.min("l_extendedprice").alias("least")).select(
        "l_returnflag", F.lit("cheap").alias("_side"), F.col("l_linestatus").alias("other_status"), "least")
    both = lines.unionByName(cheap, allowMissingColumns=True)
    return op.pair_sides(both, ["l_returnflag"], F.col("_side") == "line", F.col("_side") == "cheap",
                         ["l_orderkey", "l_linenumber", "price"], ["other_status", "least"], hot_rows=1_000)


@register("sink_csv_ordered", """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos, o_orderkey,
       CASE WHEN o_totalprice = floor(o_totalprice) THEN CAST(CAST(o_totalprice AS BIGINT) AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END
         AS price, o_orderstatus FROM orders""")
def q_sink_csv_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Orders by falling price, written in order and read back with their positions and number texts."""
    from ..session import scratch_path
    from ..sources import read_csv_ordered, write_csv_ordered
    path = scratch_path(spark, "ordered-csv")
    table = _t(spark, d, "orders").select((-F.col("o_totalprice")).alias("falling"), "o_orderkey", F.col("o_totalprice").alias("price"),
                                          "o_orderstatus")
    write_csv_ordered(table, path, ["falling", "o_orderkey"])
    from pyspark.sql import types as T
    back = T.StructType([T.StructField("falling", T.DoubleType()), T.StructField("o_orderkey", T.LongType()),
                         T.StructField("price", T.StringType()), T.StructField("o_orderstatus", T.StringType())])
    return read_csv_ordered(spark, path, back).drop("falling")


@register("json_unnest_sql", ORACLE_SQL["json_unnest"])
def q_json_unnest_sql(spark: SparkSession, d: str) -> DataFrame:
    """The documents of ``json_unnest``, read in SQL by a lateral join over a table function."""
    from ..functions.sql_functions import register_sql_functions
    register_sql_functions(spark)
    docs = _tab_match(spark, d).select(F.to_json(F.struct(F.array("match").alias("matches"))).alias("body"))
    return spark.sql("""SELECT p.match, p.start_time, p.match_pos, p.market_pos, p.market_name, p.prop_pos, p.prop_id, p.prop_name, p.price
        FROM {docs}, LATERAL tab_propositions(body) AS p""", docs=docs)


@register("sink_landing_documents", """
SELECT 'page-' || CAST(page_id AS VARCHAR) || '.html' AS name, html AS body FROM pages WHERE html LIKE '%<h1>%'""")
def q_sink_landing_documents(spark: SparkSession, d: str) -> DataFrame:
    """Every page with a headline as a file of its own, read back."""
    from ..session import scratch_path
    from ..sources import land_documents, read_landed_documents
    path = scratch_path(spark, "landed-pages")
    pages = _t(spark, d, "pages").select(F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".html")).alias("name"),
                                         F.col("html").alias("body"), F.col("html").contains("<h1>").alias("is_valid"))
    land_documents(pages, path, valid_col="is_valid")
    return read_landed_documents(spark, path)
