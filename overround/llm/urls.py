"""URL filters: block decisions follow redirects and canonical links, explicit permissions hold.

Only DataFrame operations are used. A page's own rule decides first. Pages without a rule take part
in *redirect equivalence*: addresses that redirect to, or name as canonical, one another form a
connected component; a block of any address of the component falls on its aliases, unless an address
of the component is explicitly allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from overround.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query fields that name a visitor's origin, not another page (fixed values).
TRACKING = ("utm_[a-z]+", "gclid", "fbclid", "msclkid")


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for ``host``, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_name(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Name of the longest rule that fits, else null (equal lengths: allow first, then by name).

    The rules are a parameter, so they become one expression inside the scan's stage.
    """
    out = F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.verdict, r.name))
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, rule.name).otherwise(out)
    return out


def rule_verdict(rule: Column, rules: list[Rule]) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.name, r.verdict).otherwise(out)
    return out


def address(url: Column) -> Column:
    """The address that servers answer after their usual redirects; null without ``://``.

    Scheme, fragment, tracking fields and one closing slash make no other page: http goes to https,
    ``/a/`` to ``/a``. Other query fields do.
    """
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fields = F.filter(F.split(query, "&"), lambda f: (f != "") & ~f.rlike("^(" + "|".join(TRACKING) + ")(=|$)"))
    kept = F.array_join(fields, "&")
    path = F.regexp_replace(url_path(url), "/$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(
        url_host(url), path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def _attribute(tag: Column, name: str) -> Column:
    return F.regexp_extract(tag, r"(?is)\s" + name + r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", 0)


def _value(attribute: Column) -> Column:
    value = F.regexp_replace(attribute, r"(?s)^\s*[^=]*=\s*", "")
    return F.replace(F.regexp_replace(value, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&"))


def link_targets(html: Column) -> Column:
    """Targets of canonical links and of ``refresh`` redirects, as they stand in the page."""
    none = F.array().cast("array<string>")
    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)),
                     lambda t: _value(_attribute(t, "rel")).rlike(r"(?i)(^|\s)canonical(\s|$)"))
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), F.lit(0)),
                     lambda t: F.lower(_value(_attribute(t, "http-equiv"))) == "refresh")
    return F.concat(
        F.when(html.rlike("(?i)canonical"), F.transform(links, lambda t: _value(_attribute(t, "href")))).otherwise(none),
        F.when(html.rlike("(?i)http-equiv"), F.transform(metas, lambda t: F.regexp_replace(F.regexp_extract(
            _value(_attribute(t, "content")), r"(?i)url\s*=\s*(.*)$", 1), r"""^["']|["']$""", ""))).otherwise(none))


def _without_dots(path: Column) -> Column:
    """A path from the root without its ``.`` and ``..`` segments."""
    def step(kept: Column, segment: Column) -> Column:
        up = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(segment == ".", kept).when(segment == "..", up).otherwise(F.array_append(kept, segment))

    return F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")


def absolute(target: Column, url: Column) -> Column:
    """A link's full address as seen from ``url``, whose path relative links extend; null for empty links and other
    schemes."""
    target = F.trim(target)
    scheme = F.concat(F.regexp_extract(url, r"^([^:/?#]+)://", 1), F.lit(":"))
    own = F.regexp_extract(target, r"^[^?#]*", 0)
    folder = F.regexp_replace(url_path(url), r"[^/]*$", "")
    path = (F.when(own == "", url_path(url)).when(own.startswith("/"), own)
             .otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), own)))
    query = F.regexp_extract(target, r"\?[^#]*", 0)
    return (F.when((target == "") | target.startswith("#"), F.lit(None))
            .when(target.rlike(r"(?i)^https?://"), target)
            .when(target.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), F.lit(None))
            .when(target.startswith("//"), F.concat(scheme, target))
            .otherwise(F.concat(scheme, F.lit("//"), url_host(url), _without_dots(path), query)))


def base_address(html: Column, url: Column) -> Column:
    """What the relative links of a page extend: its ``<base href>``, else its own url."""
    tag = F.regexp_extract(html, r"(?is)<base\b[^>]*>", 0)
    return F.when(html.rlike(r"(?i)<base\b"), F.coalesce(absolute(_value(_attribute(tag, "href")), url), url)).otherwise(url)


def filter_urls(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None, *, id_col: str = "page_id",
                url_col: str = "url", html_col: str | None = "html") -> DataFrame:
    """(id, host, path, rule, verdict, address, component) for every row of ``pages``.

    ``edges`` (from_url, to_url) adds redirects known from a crawl to those in the pages' own markup.
    A null url, or one without ``://``, has an empty host and path, no rule, no address and no alias, and
    is allowed. Rows without an id and repeated rows are judged like any other. Columns beyond the named
    ones are ignored, whatever their names. An empty table gives an empty result. Verdicts are gathered by
    address before the join, so one address on a third of all rows shuffles as one row for each task.
    """
    url = F.col("url")
    host, path = url_host(url), url_path(url)
    known = F.col(html_col) if html_col else F.lit(None).cast("string")
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), known.alias("html"))
    judged = base.select("id", "url", host.alias("host"), path.alias("path"), address(url).alias("address"),
                         rule_name(host, path, rules).alias("rule"))
    judged = judged.withColumn("own", rule_verdict(F.col("rule"), rules))

    # Targets are resolved as elements of an array and then exploded: what is used several times is computed once. The
    # outer form isn't guarded by a filter on the array, which would compute it twice.
    html = F.col("html")
    targets = F.flatten(F.transform(F.array(base_address(html, url)), lambda page: F.transform(
        link_targets(html), lambda target: absolute(target, page))))
    links = base.where(html.isNotNull() & url.isNotNull()).select(address(url).alias("a"), F.explode_outer(targets).alias("to"))
    links = links.where("to is not null").select("a", address(F.col("to")).alias("b"))
    if edges is not None:
        links = links.union(edges.select(address(F.col("from_url")).alias("a"), address(F.col("to_url")).alias("b")))
    found = connected_components(links.where("a != b"), "a", "b")

    by_address = judged.where("address is not null").groupBy("address").agg(
        F.max(F.when(F.col("own") == "block", 1).otherwise(0)).alias("blocked"),
        F.max(F.when(F.col("own") == "allow", 1).otherwise(0)).alias("allowed"))
    placed = by_address.join(found, F.col("address") == F.col("node"), "left").select(
        "address", F.coalesce("component", "address").alias("component"), "blocked", "allowed")
    decided = placed.groupBy("component").agg(
        F.max("blocked").alias("blocked"), F.max("allowed").alias("allowed")).where("blocked = 1 and allowed = 0")
    aliases = placed.join(decided.select(F.col("component").alias("bad")), F.col("component") == F.col("bad"), "left")
    aliases = aliases.select(F.col("address").alias("known_address"), "component", F.col("bad").isNotNull().alias("bad"))
    out = judged.join(aliases, F.col("address") == F.col("known_address"), "left")
    return out.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("own", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"), "address", "component")
