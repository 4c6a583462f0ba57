"""Pages rendered from the driver tables in the markup of the crawled site.

The driver's ``pages`` table carries no rating classes, paginators or
collection links, so the extraction operators are also checked on pages
built here from the rating facts. Every builder is a map-side Spark job
over the given tables (its size grows with them): one page per line item,
so no group of rows is ever gathered into one page.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources import tables as T


PAGE_LINKS = 9
TASK_LINES = 100_000  # line items a task renders and reads, about


def _lineitem(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The line items, dealt evenly over tasks: a page is some hundred times its line, so the splits of the scan, sized
    by the bytes of the lines, hold too many pages each and are too few for the cores."""
    li = T.table(spark, sf_dir, "lineitem")
    n = max(spark.sparkContext.defaultParallelism, math.ceil(li.count() / TASK_LINES))
    return li.select(*columns).repartition(n)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _lineitem(spark, sf_dir, "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    od = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def _item_block(rating, css: str = "item"):
    return F.concat(
        F.lit(f'<div class="{css}"><div class="pic"><a class="nbg" title="'), F.col("name"),
        F.lit('" href="'), F.col("item_url"), F.lit('"></a></div><div class="info"><a href="'),
        F.col("item_url"), F.lit('"><em>'), F.col("name"), F.lit('</em></a><ul><li class="intro">'),
        F.col("summary"), F.lit("</li><li>"), rating, F.lit("</li></ul></div></div>"))


def collection_pages(spark: SparkSession, sf_dir: str, owner: bool = False) -> DataFrame:
    """One collection page per line item (page_id = order key, so an
    order's lines share an id); with ``owner`` also the ``user_name`` of the
    order's customer. Each page holds two item blocks: the line's item with
    its rating class, then the same item again without one (seen but
    unrated), in a block of two classes."""
    items = T.items_table(spark, sf_dir).select(F.col("item_id"), F.col("name"), F.col("summary"),
                                                F.col("item_url"))
    lines = _lines(spark, sf_dir) if owner else _lineitem(
        spark, sf_dir, "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    rows = lines.join(items, F.col("l_partkey") == F.col("item_id"))
    if owner:
        c = T.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
        rows = rows.join(c, F.col("o_custkey") == F.col("c_custkey"))
    score = T.score_expr()
    rating = F.when(score > 0, F.concat(F.lit('<span class="rating'), score.cast("string"),
                                        F.lit('-t"></span>'))).otherwise(F.lit(""))
    html = F.concat(F.lit('<div class="article">'), _item_block(rating),
                    _item_block(F.lit(""), "item odd"), F.lit("</div>"))
    return rows.select(F.col("l_orderkey").alias("page_id"), html.alias("html"),
                       *([F.col("c_name").alias("user_name")] if owner else []))


def comment_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One comment page per line item (page_id = order key): a comment by
    the line's supplier, then one without a user link."""
    sup = T.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = _lines(spark, sf_dir).join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    html = F.concat(
        F.lit('<div class="first comment-item"><span class="comment-info"><a href="'), F.lit(T.USER_URL_PREFIX),
        F.col("s_suppkey").cast("string"), F.lit('/">'), F.translate(F.col("s_name"), "#", " "),
        F.lit("</a></span><p>"), F.col("l_quantity").cast("string"),
        F.lit('</p></div><div class="comment-item"><p>no link</p></div>'))
    return rows.select(F.col("l_orderkey").alias("page_id"), html.alias("html"))


def _user_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = T.rating_events(spark, sf_dir)
    return ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_all"),
                                     F.count_if(F.col("score") > 0).alias("n_rated"))


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile page per customer with ratings: heading with the total,
    side name, and a paginator when there is more than one page: links to
    the first pages, then to the last, as many at most on any page."""
    c = T.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    u = _user_counts(spark, sf_dir)
    n_pages = F.ceil(F.col("n_all") / 15).cast("int")
    shown = F.concat(F.sequence(F.lit(1), F.greatest(F.least(n_pages - 1, F.lit(PAGE_LINKS)), F.lit(1))),
                     F.array(n_pages))
    links = F.array_join(F.transform(shown, lambda i: F.concat(
        F.lit('<a href="?start='), ((i - 1) * 15).cast("string"), F.lit('">'), i.cast("string"),
        F.lit("</a>"))), "")
    pag = F.when(n_pages >= 2, F.concat(F.lit('<div class="paginator">'), links,
                                        F.lit('<a href="#">next</a></div>'))).otherwise(F.lit(""))
    html = F.concat(F.lit('<div class="info"><h1>'), F.col("c_name"), F.lit(" watched ("),
                    F.col("n_all").cast("string"), F.lit(')</h1></div><div class="side-info-txt"><h3>'),
                    F.col("c_name"), F.lit("</h3></div>"), pag)
    home = F.concat(F.lit(T.USER_URL_PREFIX), F.col("c_custkey").cast("string"), F.lit("/collect?"))
    return c.join(u, F.col("c_custkey") == F.col("user_id")).select(F.col("c_custkey").alias("page_id"),
                                                                   html.alias("html"), home.alias("url"))


def home_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One home page per customer; customers with a negative balance have
    no collection section."""
    c = T.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    u = _user_counts(spark, sf_dir)
    base = F.concat(F.lit(T.USER_URL_PREFIX), F.col("c_custkey").cast("string"), F.lit("/"))
    section = F.concat(
        F.lit('<div id="movie"><div class="hd"></div><span class="pl"><a href="'), base, F.lit('wish">'),
        (F.col("n_all") * 30).cast("string"), F.lit(' wished</a></span><span class="pl"><a href="'), base,
        F.lit('collect">'), (F.col("n_rated") * 30).cast("string"), F.lit(' watched</a></span></div><div id="book"></div>'))
    html = F.when(F.col("c_acctbal") >= 0, section).otherwise(F.lit("<div id=\"book\"></div>"))
    return c.join(u, F.col("c_custkey") == F.col("user_id")).select(F.col("c_custkey").alias("page_id"),
                                                                   html.alias("html"))


def supplier_home_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One home page per supplier (the commenters of ``comment_pages``),
    addressed by the commenter link; suppliers with a negative balance
    have no collection section."""
    s = T.table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    n = T.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_lines"))
    url = F.concat(F.lit(T.USER_URL_PREFIX), F.col("s_suppkey").cast("string"), F.lit("/"))
    section = F.concat(
        F.lit('<div id="movie"><div class="hd"></div><span class="pl"><a href="'), url, F.lit('wish">'),
        (F.col("n_lines") * 20).cast("string"), F.lit(' wished</a></span><span class="pl"><a href="'), url,
        F.lit('collect">'), ((F.col("n_lines") * 3) / 2).cast("long").cast("string"), F.lit(" watched</a></span></div>"))
    html = F.when(F.col("s_acctbal") >= 0, section).otherwise(F.lit('<div id="book"></div>'))
    return s.join(n, F.col("s_suppkey") == F.col("l_suppkey")).select(
        F.col("s_suppkey").alias("page_id"), url.alias("url"), html.alias("html"))
