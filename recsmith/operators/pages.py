"""Page extraction as DataFrame jobs over a ``pages(page_id, url, html)``
table (J1-J5, K1).

A page is read tag by tag (``functions.markup``): elements by class
or id with all that is nested in them, attributes in any order and quoting,
texts without tags and with their entities decoded. Built-in expressions, one
pass, no HTML library per row. Texts of several matches are joined by a blank.
Class names and ids are those of the collection, profile, comment and
user-home pages; all are parameters. Pages of other markup can be cut at a
marker instead (``extract_marked_items``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import markup as H, text as X

# Markup of the crawled pages. ``(?s).*?`` is used rather
# than ``[\s\S]*?``: same matches, several times faster in Java's engine.
ITEM_MARKER = r'<div class="(?:[^"]*\s)?item(?:\s[^"]*)?">'
ITEM_TITLE = r'(?s)<div class="info">.*?<em>(.*?)</em>'
ITEM_LINK = r'(?s)<div class="info">.*?<a href="([^"]*)"'
ITEM_SUMMARY = r'(?s)<li class="intro">(.*?)</li>'
COMMENT_MARKER = r'<div class="(?:[^"]*\s)?comment-item(?:\s[^"]*)?">'
ITEM, INFO, INTRO = "item", "info", "intro"
SIDE, PAGINATOR = "side-info-txt", "paginator"
COMMENT, COMMENTER = "comment-item", "comment-info"
SECTION, COUNT = "movie", "pl"
COLLECT_WORD = "collect"
HEAVY_MIN = 900
PLAIN = "_plain"
ATTR_CLASS = "nbg"
ATTR_NAME = "title"


def blocks(pages: DataFrame, marker: str, keep=("page_id",), html_col: str = "html") -> DataFrame:
    """One row per block that follows the regular expression ``marker``:
    (keep..., pos, block). ``pos`` counts from 0 in page order.
    """
    parts = F.split(F.col(html_col), marker)
    tail = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    return pages.select(*keep, F.posexplode(tail).alias("pos", "block"))


def _field(block: Column, pattern: str, group: int = 1) -> Column:
    return F.trim(F.regexp_extract(block, pattern, group))


def shown(pages: DataFrame, keep) -> DataFrame:
    """(keep..., shown, PLAIN): the pages without comments, scripts and styles, and whether they are plain.

    The markup comes out of a generator, and so do the elements taken from it: the optimiser would copy a plain
    column's expression into each of its uses, filters included, and compute it again there.
    """
    return pages.select(*keep, F.inline_outer(F.transform(F.array(H.shown(F.col("html"))), lambda x: F.struct(
        x.alias("shown"), H.is_plain(x).alias(PLAIN)))))


def each(rows: DataFrame, found: Column, keep) -> DataFrame:
    """(keep..., pos, element): one row per element in ``found``."""
    return rows.select(*keep, F.posexplode_outer(found).alias("pos", "element")).where("pos IS NOT NULL")


def extract_items(pages: DataFrame, item: str = ITEM, info: str = INFO, intro: str = INTRO,
                  keep=("page_id",)) -> DataFrame:
    """Collection page -> one row per element of class ``item``: (title, item_url, summary, score).

    The title is the text of the ``em`` elements, the address that of the
    first link, both of class ``info`` inside the item. The score is the first
    ``rating<d>-t`` inside the item, 0 when it carries none (seen but unrated).
    """
    plain = F.col(PLAIN)
    b = each(shown(pages, keep), H.of_class(F.col("shown"), item, plain), [*keep, PLAIN])
    b = b.select(*keep, PLAIN, "pos", F.explode_outer(F.array(H.inner(F.col("element")))).alias("inside"))
    b = b.select(*keep, "pos", "inside", F.array_join(H.of_class(F.col("inside"), info, plain), "").alias("info"),
                 H.of_class(F.col("inside"), intro, plain).alias("intro"))
    return b.select(
        *keep, "pos",
        F.array_join(H.texts(F.col("info"), "em"), " ").alias("title"),
        F.coalesce(F.trim(H.attribute(H.first_tag(F.col("info"), "a"), "href")), F.lit("")).alias("item_url"),
        F.array_join(F.transform("intro", H.text_of), " ").alias("summary"),
        X.extract_score(F.col("inside")).alias("score"),
    )


def extract_marked_items(pages: DataFrame, item_marker: str = ITEM_MARKER, title_pattern: str = ITEM_TITLE,
                         link_pattern: str = ITEM_LINK, summary_pattern: str = ITEM_SUMMARY,
                         keep=("page_id",)) -> DataFrame:
    """The columns of ``extract_items`` by patterns over the raw markup behind each marker, not decoded."""
    b = blocks(pages, item_marker, keep)
    return b.select(
        *keep, "pos",
        _field(F.col("block"), title_pattern).alias("title"),
        _field(F.col("block"), link_pattern).alias("item_url"),
        _field(F.col("block"), summary_pattern).alias("summary"),
        X.extract_score(F.col("block")).alias("score"),
    )


def extract_profile(pages: DataFrame, name_pattern: str | None = None,
                    heading_pattern: str | None = None, keep=("page_id",)) -> DataFrame:
    """Profile page -> (user_name, declared_total, page_count).

    The name is the ``h3`` of the side text, the total the first number in
    brackets of the ``h1`` of class ``info``; a pattern over the raw markup
    replaces either. ``page_count`` is 1 on a page without a paginator.
    """
    html = F.col("html")
    part = lambda cls: F.array_join(H.of_class(F.col("shown"), cls, F.col(PLAIN)), "")
    b = shown(pages, [*keep, "html"]).select(
        *keep,
        (_field(html, name_pattern) if name_pattern else
         F.array_join(H.texts(part(SIDE), "h3"), " ")).alias("user_name"),
        (F.regexp_extract(html, heading_pattern, 1) if heading_pattern else
         F.array_join(H.texts(part(INFO), "h1"), " ")).alias("heading"),
        F.transform(H.links(part(PAGINATOR)), lambda x: x["text"]).alias("pages"))
    last_but_one = F.when(F.size("pages") >= 2, F.element_at("pages", -2)).try_cast("int")
    return b.select(*keep, "user_name", X.extract_total("heading").alias("declared_total"),
                    F.coalesce(last_but_one, F.lit(1)).alias("page_count"))


def extract_commenters(pages: DataFrame, comment: str = COMMENT, commenter: str = COMMENTER,
                       keep=("page_id",)) -> DataFrame:
    """Comment page -> one row per comment: (user_url, user_name).

    The display name is normalised (blanks -> '-'). Comments without a
    user link are dropped.
    """
    plain = F.col(PLAIN)
    b = each(shown(pages, keep), H.of_class(F.col("shown"), comment, plain), [*keep, PLAIN])
    b = b.select(*keep, "pos", F.explode_outer(F.array(
        H.links(F.array_join(H.of_class(F.col("element"), commenter, plain), "")))).alias("a"))
    out = b.select(
        *keep, "pos", F.get("a", F.lit(0))["href"].alias("user_url"),
        X.normalise_name(F.array_join(F.transform("a", lambda x: x["text"]), " ")).alias("user_name"))
    return out.filter(F.col("user_url") != "")


def home_links(pages: DataFrame, section: str = SECTION, count: str = COUNT, keep=("page_id",)) -> DataFrame:
    """(keep..., links): the links, as (href, text), of the elements of class ``count`` below the section."""
    plain = F.col(PLAIN)
    b = each(shown(pages, keep), F.slice(H.of_id(F.col("shown"), section, plain), 1, 1), [*keep, PLAIN])
    return b.select(*keep, F.explode_outer(F.array(
        H.links(F.array_join(H.of_class(F.col("element"), count, plain), "")))).alias("links"))


def extract_collection_link(pages: DataFrame, section: str = SECTION, count: str = COUNT,
                            must_contain: str = COLLECT_WORD, min_count: int = HEAVY_MIN,
                            keep=("page_id",)) -> DataFrame:
    """User home -> the first link whose href contains ``must_contain``
    and whose text holds a first number above ``min_count`` (B3, B4, G10).

    Pages without the section, or without such a link, give no row. The
    result is the seed form of the link (href + '?', G15).
    """
    hits = F.filter("links", lambda p: p["href"].contains(must_contain)
                    & (F.coalesce(X.extract_first_number(p["text"]), F.lit(-1)) > min_count))
    found = home_links(pages, section, count, keep).select(*keep, F.explode_outer(F.slice(hits, 1, 1)).alias("hit"))
    return found.where("hit IS NOT NULL").select(
        *keep, X.seed_url(F.col("hit.href")).alias("collect_url"),
        X.extract_first_number(F.col("hit.text")).alias("n_collected"))


def extract_attr(pages: DataFrame, item: str = ITEM, class_name: str = ATTR_CLASS,
                 attr: str = ATTR_NAME, keep=("page_id",)) -> DataFrame:
    """Per item, an attribute of its first element of class ``class_name`` (the title of the poster link)."""
    b = each(shown(pages, keep), H.of_class(F.col("shown"), item, F.col(PLAIN)), keep)
    tag = F.regexp_extract(H.inner(F.col("element")), H.with_class(class_name), 0)
    b = b.select(*keep, "pos", F.explode_outer(F.array(tag)).alias("tag"))
    return b.select(*keep, "pos", H.attribute(F.col("tag"), attr).alias(attr)).filter(F.col(attr) != "")


def ingest_pages(pages: DataFrame, n_partitions: int | None = None, name_pattern: str | None = None,
                 heading_pattern: str | None = None, keep=("page_id", "url")) -> DataFrame:
    """K1: profile extraction with a per-page ``status`` instead of a
    swallowed exception: 'ok', 'no_name' or 'no_total'.

    ``n_partitions`` spreads very large pages over more tasks; by default
    the scan's own splits are kept (no shuffle).
    """
    src = pages.repartition(n_partitions) if n_partitions else pages
    prof = extract_profile(src, name_pattern, heading_pattern, keep)
    status = (F.when(F.col("user_name") == "", F.lit("no_name"))
              .when(F.col("declared_total").isNull(), F.lit("no_total"))
              .otherwise(F.lit("ok")))
    return prof.withColumn("status", status)
