"""HTML listing pages as a table ``(page_id, url, html)``.

Element extraction is done with Java regular expressions in SQL
(``regexp_extract_all``), one page per row, so it parallelises over pages
with no Python.  It targets flat markup such as link lists, titles and
price cards; it is not a general HTML parser.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_numeric, decode_entities, link_id_tail, strip_tags

# CSS classes of the bookmaker's listing page.
CARD_CLASS = "White_fqa53j6"
PARTICIPANT_CLASS = "participantText_fivg86r"
PRICE_CLASS = "priceTextSize_frw9zm9"
START_TIME_CLASS = "oneLine_f15ay66x"
MATCH_LINK_CLASS = "linkMultiMarket_fcmecz0"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages stored as Parquet ``(page_id, url, html)``."""
    return spark.read.parquet(path)


def read_html_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw ``.html`` files, one row per file (url = file path)."""
    return (spark.read.text(path, wholetext=True)
                 .select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html")))


def _class_attr(cls: str) -> str:
    """A ``class`` attribute, in either kind of quotes or none, that holds ``cls``
    as one of its space-separated tokens."""
    token = re.escape(cls)
    return (r"""\sclass\s*=\s*(?:"(?:[^"]*\s)?""" + token + r"""(?:\s[^"]*)?"|'(?:[^']*\s)?""" + token
            + r"""(?:\s[^']*)?'|""" + token + r"""(?=[\s>]))""")


def _href_value(tag: Column) -> Column:
    """Value of a start tag's ``href``, entities decoded."""
    attr = F.regexp_substr(tag, F.lit(r"""(?is)\shref\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""))
    value = F.regexp_replace(attr, r"(?is)^\shref\s*=\s*", "")
    return decode_entities(F.regexp_replace(value, r"""^["']|["']$""", ""))


def hrefs(html: Column | str, cls: str | None = None) -> Column:
    """``href`` of every ``<a>`` that has one, in page order; optionally only
    links with the class ``cls``."""
    html = F.col(html) if isinstance(html, str) else html
    wanted = r"(?=[^>]*" + _class_attr(cls) + ")" if cls else ""
    tags = F.regexp_extract_all(html, F.lit(rf"(?is)<a\b(?=[^>]*\shref\s*=){wanted}[^>]*>"), F.lit(0))
    return F.transform(tags, _href_value)


def elements_by_class(html: Column | str, cls: str) -> Column:
    """Inner markup of every element that has the class ``cls``
    (to the first closing tag of the same name)."""
    html = F.col(html) if isinstance(html, str) else html
    pattern = r"(?s)<(\w+)\b(?=[^>]*" + _class_attr(cls) + r")[^>]*>(.*?)</\1>"
    return F.regexp_extract_all(html, F.lit(pattern), 2)


#: Elements that have no content and no closing tag (fixed values of the HTML standard).
VOID_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_TAG = r"""(?s)^<(/?)([A-Za-z][A-Za-z0-9-]*)((?:[^>"']|"[^"]*"|'[^']*')*)>(.*)$"""


def _page_tags(html: Column, cls: str) -> Column:
    """The tags of a page in order: (at, name, step, found, tail).

    ``step`` is 1 for a tag that opens an element, -1 for one that closes, 0
    for what has no content; ``found`` marks opening tags with the class; ``tail``
    is the text up to the next tag.  Comments, scripts and styles are no tags.
    """
    clean = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")
    pieces = F.split(clean, "(?=<)")

    def tag(piece: Column, at: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, _TAG, 2))
        attributes = F.regexp_extract(piece, _TAG, 3)
        step = (F.when((name == "") | name.isin(*VOID_ELEMENTS) | attributes.endswith("/"), 0)
                 .when(F.regexp_extract(piece, _TAG, 1) == "/", -1).otherwise(1))
        found = (step >= 0) & (name != "") & F.concat(attributes, F.lit(">")).rlike("(?s)" + _class_attr(cls))
        return F.struct(at.alias("at"), name.alias("name"), step.alias("step"), found.alias("found"),
                        F.when(name == "", piece).otherwise(F.regexp_extract(piece, _TAG, 4)).alias("tail"))

    return F.transform(pieces, tag)


def nested_texts(html: Column | str, cls: str) -> Column:
    """Text of every element that has the class ``cls``, in page order, elements
    inside such elements included.

    An element ends where the running depth of tags of its own name returns to
    what it was before it; one that is never closed runs to the end of the page.
    All is done by array expressions in the page's row: the tags are listed once,
    and the depth is folded over the list for each element found.
    """
    html = F.col(html) if isinstance(html, str) else html

    def stop(tags: Column, start: Column) -> Column:
        """Place of the tag that closes the element opened at ``start``."""
        def fold(state: Column, tag: Column) -> Column:
            counts = (tag["at"] > start["at"]) & (tag["name"] == start["name"]) & (state["depth"] > 0)
            depth = F.when(counts, state["depth"] + tag["step"]).otherwise(state["depth"])
            return F.struct(depth.alias("depth"), F.when(counts & (depth == 0), tag["at"]).otherwise(state["stop"]).alias("stop"))

        return F.aggregate(tags, F.struct(F.lit(1).alias("depth"), F.size(tags).alias("stop")), fold)["stop"]

    def text(tags: Column, start: Column) -> Column:
        length = F.when(start["step"] == 0, F.lit(0)).otherwise(stop(tags, start) - start["at"])
        inside = F.slice(tags, start["at"] + 1, length)
        return decode_entities(F.array_join(F.transform(inside, lambda t: t["tail"]), ""))

    return _bound(_page_tags(html, cls), lambda tags: F.transform(
        F.filter(tags, lambda t: t["found"]), lambda start: text(tags, start)))


def tag_text(html: Column | str, tag: str) -> Column:
    """Text of the first ``<tag>`` element, tags stripped and entities
    decoded; null if there is none."""
    html = F.col(html) if isinstance(html, str) else html
    inner = F.regexp_substr(html, F.lit(rf"(?s)<{tag}\b[^>]*>.*?</{tag}>"))
    inner = F.regexp_replace(inner, rf"(?s)^<{tag}\b[^>]*>|</{tag}>$", "")
    return element_text(inner)


def element_text(markup: Column | str) -> Column:
    """``html_text``: strip tags, decode entities (no trimming)."""
    markup = F.col(markup) if isinstance(markup, str) else markup
    return decode_entities(strip_tags(markup))


def texts(elements: Column) -> Column:
    """Element text of every entry of an array of inner markup."""
    return F.transform(elements, lambda e: element_text(e))


def page_links(pages: DataFrame, cls: str | None = None, html_col: str = "html",
               keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per link: ``(keep..., pos, href)`` in page order."""
    return pages.select(*keep, F.posexplode(hrefs(html_col, cls)).alias("pos", "href"))


def _card_parts(card_class: str, html_col: str) -> Column:
    """A page cut at each element that has the card class; what stands before the first is dropped."""
    attr = _class_attr(card_class)
    pieces = F.split(F.col(html_col), r"(?=<\w+\b[^>]*" + attr + r")")
    # Only the first piece can begin with anything else.
    return F.filter(pieces, lambda piece, i: (i > 0) | piece.rlike(r"(?s)^<\w+\b[^>]*" + attr))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def listing_rejects(pages: DataFrame, html_col: str = "html", card_class: str = CARD_CLASS,
                    link_class: str = MATCH_LINK_CLASS) -> DataFrame:
    """Pages whose match links and cards differ in number, with both numbers:
    which link belongs to which card can't be told, so they give no cards."""
    sizes = F.struct(F.size(_card_parts(card_class, html_col)).alias("n_cards"),
                     F.size(hrefs(html_col, link_class)).alias("n_links"))
    # Behind a generator the numbers are columns, which the filter doesn't compute again.
    counted = pages.select("*", F.explode_outer(F.array(sizes)).alias("_n"))
    return counted.where("_n.n_cards != _n.n_links").select(*pages.columns, "_n.n_cards", "_n.n_links")


def listing_cards(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id",),
                  card_class: str = CARD_CLASS, participant_class: str = PARTICIPANT_CLASS,
                  price_class: str = PRICE_CLASS, start_class: str = START_TIME_CLASS,
                  link_class: str = MATCH_LINK_CLASS) -> DataFrame:
    """Listing page -> one row per match card with parallel arrays.

    Cards are cut at each element carrying ``card_class`` (each piece runs to
    the next card), so nested markup inside a card is fine.  Match links are
    collected over the whole page and paired with the cards by position
    (i-th link = i-th card), as the page lists them.  A page where their
    numbers differ gives no cards (``listing_rejects`` has it).  Output:
    ``(keep..., card_pos, participants array<string>, prices array<string>,
    start_time string, link string, match_id bigint)``.

    A page's cards are made as one array of structs and then exploded: a
    generator parts expressions from their uses, so each is computed once.
    """
    def card(page: Column) -> Callable[[Column, Column], Column]:
        def one(piece: Column, i: Column) -> Column:
            link = F.get(page["links"], i)
            return F.struct(
                texts(elements_by_class(piece, participant_class)).alias("participants"),
                texts(elements_by_class(piece, price_class)).alias("prices"),
                F.get(texts(elements_by_class(piece, start_class)), 0).alias("start_time"),
                link.alias("link"), link_id_tail(link).alias("match_id"))
        return one

    def cards(page: Column) -> Column:
        return F.when(F.size(page["parts"]) == F.size(page["links"]), F.transform(page["parts"], card(page)))

    page = F.struct(_card_parts(card_class, html_col).alias("parts"), hrefs(html_col, link_class).alias("links"))
    # The outer form isn't guarded by a filter on the array, which would compute it twice.
    rows = pages.select(*keep, F.posexplode_outer(_bound(page, cards)).alias("card_pos", "_card"))
    return rows.where("_card.participants is not null").select(*keep, "card_pos", "_card.*")


def card_teams(cards: DataFrame) -> DataFrame:
    """Teams dimension from listing cards: ``(match_id, home_team, away_team)``
    by position (first participant = home)."""
    return cards.select(
        "match_id",
        F.get("participants", 0).alias("home_team"),
        F.get("participants", 1).alias("away_team"),
    )


def card_prices(cards: DataFrame) -> DataFrame:
    """Home / away decimal prices of listing cards by position (malformed text -> null)."""
    return cards.withColumns({
        "home_win": as_numeric(F.get("prices", 0)),
        "away_win": as_numeric(F.get("prices", 1)),
    })
