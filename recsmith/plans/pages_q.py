"""Registered queries: page extraction and text functions (J1-J5, K1, K2,
G8-G16, B3, B4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import ingest as I, pages as P
from ..sources import markup as M, tables as T
from . import markup_variants as V
from .oracle import with_
from .registry import query

UP = T.USER_URL_PREFIX
IP = T.ITEM_URL_PREFIX

LINES = """lines AS (SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

ITEM_BLOCK = """'<div class="{css}"><div class="pic"><a class="nbg" title="' || name || '" href="' || item_url
    || '"></a></div><div class="info"><a href="' || item_url || '"><em>' || name
    || '</em></a><ul><li class="intro">' || summary || '</li><li>' || {rating} || '</li></ul></div></div>'"""

RATING_CLASS = """CASE WHEN l_returnflag <> 'R' AND CAST(ceil(l_quantity / 10) AS INT) > 0
            THEN '<span class="rating' || CAST(CAST(ceil(l_quantity / 10) AS INT) AS VARCHAR) || '-t"></span>'
            ELSE '' END"""

COLLECTION = LINES + f""",
cat AS (SELECT CAST(p_partkey AS INT) AS item_id, p_name AS name, p_type AS summary,
               '{IP}' || CAST(p_partkey AS VARCHAR) || '/' AS item_url FROM part),
cpages AS (
  SELECT l_orderkey AS page_id, '<div class="article">' || {ITEM_BLOCK.format(rating=RATING_CLASS, css="item")}
         || {ITEM_BLOCK.format(rating="''", css="item odd")} || '</div>' AS html
  FROM lines JOIN cat ON l_partkey = item_id)"""

COMMENTS = LINES + f""",
mpages AS (
  SELECT l_orderkey AS page_id,
    '<div class="first comment-item"><span class="comment-info"><a href="{UP}' || CAST(s_suppkey AS VARCHAR)
    || '/">' || replace(s_name, '#', ' ') || '</a></span><p>' || CAST(l_quantity AS VARCHAR)
    || '</p></div><div class="comment-item"><p>no link</p></div>' AS html
  FROM lines JOIN supplier ON l_suppkey = s_suppkey)"""

USER_COUNTS = """ucnt AS (
  SELECT o_custkey AS user_id, count(*) AS n_all,
         count(*) FILTER (WHERE CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(ceil(l_quantity / 10) AS INT) END > 0)
           AS n_rated
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)"""

PROFILES = USER_COUNTS + f""",
ppages AS (
  SELECT c_custkey AS page_id,
    '<div class="info"><h1>' || c_name || ' watched (' || CAST(n_all AS VARCHAR)
    || ')</h1></div><div class="side-info-txt"><h3>' || c_name || '</h3></div>'
    || CASE WHEN CAST(ceil(n_all / 15) AS INT) >= 2 THEN '<div class="paginator">'
         || array_to_string(list_transform(list_append(range(1, greatest(least(CAST(ceil(n_all / 15) AS INT) - 1, {M.PAGE_LINKS}), 1) + 1),
                                                       CAST(ceil(n_all / 15) AS BIGINT)),
              lambda i: '<a href="?start=' || CAST((i - 1) * 15 AS VARCHAR) || '">' || CAST(i AS VARCHAR) || '</a>'), '')
         || '<a href="#">next</a></div>' ELSE '' END AS html
  FROM customer JOIN ucnt ON c_custkey = user_id)"""

HOMES = USER_COUNTS + f""",
hpages AS (
  SELECT c_custkey AS page_id,
    CASE WHEN c_acctbal >= 0 THEN
      '<div id="movie"><div class="hd"></div><span class="pl"><a href="{UP}' || CAST(c_custkey AS VARCHAR) || '/wish">'
      || CAST(n_all * 30 AS VARCHAR) || ' wished</a></span><span class="pl"><a href="{UP}'
      || CAST(c_custkey AS VARCHAR) || '/collect">' || CAST(n_rated * 30 AS VARCHAR) || ' watched</a></span></div><div id="book"></div>'
    ELSE '<div id="book"></div>' END AS html
  FROM customer JOIN ucnt ON c_custkey = user_id)"""


def _blocks_sql(src: str, marker: str) -> str:
    return f"""blk AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, block FROM (
  SELECT page_id, unnest(range(len(parts) - 1)) AS pos, unnest(parts[2:]) AS block
  FROM (SELECT page_id, string_split_regex(html, '{marker}') AS parts FROM {src})))"""


# --- J1 ---------------------------------------------------------------------------------

ORACLE_EXTRACT_ITEMS = with_(COLLECTION, _blocks_sql("cpages", P.ITEM_MARKER)) + r"""
SELECT page_id, pos,
  trim(regexp_extract(block, '<div class="info">[\s\S]*?<em>([\s\S]*?)</em>', 1)) AS title,
  trim(regexp_extract(block, '<div class="info">[\s\S]*?<a href="([^"]*)"', 1)) AS item_url,
  trim(regexp_extract(block, '<li class="intro">([\s\S]*?)</li>', 1)) AS summary,
  coalesce(TRY_CAST(nullif(regexp_extract(block, 'rating(\d+)-t', 1), '') AS INT), 0) AS score
FROM blk"""


@query("extract_items", ORACLE_EXTRACT_ITEMS)
def q_extract_items(spark, d):
    return P.extract_items(M.collection_pages(spark, d))


@query("extract_items_pages", with_(_blocks_sql("pages", "<li>")) + r"""
SELECT page_id, pos,
  trim(regexp_extract(block, '<a href="[^"]*">([^<]*)</a>', 1)) AS title,
  trim(regexp_extract(block, 'href="([^"]*)"', 1)) AS item_url,
  trim(regexp_extract(block, '<li class="intro">([\s\S]*?)</li>', 1)) AS summary,
  coalesce(TRY_CAST(nullif(regexp_extract(block, 'rating(\d+)-t', 1), '') AS INT), 0) AS score
FROM blk""")
def q_extract_items_pages(spark, d):
    # The nav list items of the real pages, read as item blocks.
    return P.extract_marked_items(T.table(spark, d, "pages"), item_marker="<li>",
                                  title_pattern=r'<a href="[^"]*">([^<]*)</a>', link_pattern=r'href="([^"]*)"')


@query("extract_items_variants", V.ITEMS_SQL)
def q_extract_items_variants(spark, d):
    """J1 over markup of many forms; the expected rows come from the facts, not from the markup."""
    return P.extract_items(V.collection_pages(spark, d))


@query("extract_attr_variants", V.ATTR_SQL)
def q_extract_attr_variants(spark, d):
    return P.extract_attr(V.collection_pages(spark, d))


@query("extract_commenters_variants", V.COMMENTERS_SQL)
def q_extract_commenters_variants(spark, d):
    return P.extract_commenters(V.comment_pages(spark, d))


@query("extract_profile_variants", with_(USER_COUNTS) + V.PROFILE_SQL)
def q_extract_profile_variants(spark, d):
    return P.extract_profile(V.profile_pages(spark, d))


@query("extract_collection_link_variants", with_(USER_COUNTS) + V.LINK_SQL)
def q_extract_collection_link_variants(spark, d):
    return P.extract_collection_link(V.home_pages(spark, d))


# --- J2, K1, G9, G11 ------------------------------------------------------------------------

PROFILE_SQL = r"""
SELECT page_id,
  trim(regexp_extract(html, '<div class="side-info-txt">\s*<h3>([\s\S]*?)</h3>', 1)) AS user_name,
  TRY_CAST(nullif(regexp_extract(regexp_extract(html, '<div class="info">\s*<h1>([\s\S]*?)</h1>', 1),
      '\((\d+)\)', 1), '') AS INT) AS declared_total,
  coalesce(TRY_CAST(trim(CASE WHEN len(pl) >= 2 THEN pl[-2] END) AS INT), 1) AS page_count
FROM (SELECT page_id, html, regexp_extract_all(regexp_extract(html,
        '<div class="paginator">([\s\S]*?)</div>', 1), '<a[^>]*>([^<]*)</a>', 1) AS pl FROM ppages)"""


@query("extract_profile", with_(PROFILES) + PROFILE_SQL)
def q_extract_profile(spark, d):
    return P.extract_profile(M.profile_pages(spark, d))


@query("ingest_pages", with_(r"""prof AS (
  SELECT page_id, url,
    trim(regexp_extract(html, '<title>([\s\S]*?)</title>', 1)) AS user_name,
    TRY_CAST(nullif(regexp_extract(regexp_extract(html, '<body>([\s\S]*)', 1), '\((\d+)\)', 1), '') AS INT)
      AS declared_total
  FROM pages)""") + """
SELECT CASE WHEN user_name = '' THEN 'no_name' WHEN declared_total IS NULL THEN 'no_total' ELSE 'ok' END
         AS status, count(*) AS n_pages
FROM prof GROUP BY 1""")
def q_ingest_pages(spark, d):
    got = P.ingest_pages(T.table(spark, d, "pages"), name_pattern=r"(?s)<title>(.*?)</title>",
                         heading_pattern=r"(?s)<body>(.*)")
    return got.groupBy("status").agg(F.count(F.lit(1)).alias("n_pages"))


@query("extract_total", r"""
SELECT page_id, TRY_CAST(nullif(regexp_extract(html, '\((\d+)\)', 1), '') AS INT) AS total FROM pages""")
def q_extract_total(spark, d):
    return T.table(spark, d, "pages").select("page_id", X.extract_total("html").alias("total"))


@query("extract_page_count", with_(PROFILES) + r"""
SELECT page_id, coalesce(TRY_CAST(trim(CASE WHEN len(pl) >= 2 THEN pl[-2] END) AS INT), 1) AS page_count
FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '<div class="paginator">([\s\S]*?)</div>', 1),
        '<a[^>]*>([^<]*)</a>', 1) AS pl FROM ppages)""")
def q_extract_page_count(spark, d):
    return M.profile_pages(spark, d).select("page_id", X.extract_page_count("html").alias("page_count"))


# --- J3, G14 ---------------------------------------------------------------------------------

@query("extract_commenters", with_(COMMENTS, _blocks_sql("mpages", P.COMMENT_MARKER)) + r"""
SELECT page_id, pos, user_url, user_name FROM (
  SELECT page_id, pos,
    regexp_extract(block, '<span class="comment-info">[\s\S]*?<a href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS user_url,
    replace(trim(regexp_extract(block, '<span class="comment-info">[\s\S]*?<a href="([^"]*)"[^>]*>([^<]*)</a>', 2)),
            ' ', '-') AS user_name
  FROM blk) WHERE user_url <> ''""")
def q_extract_commenters(spark, d):
    return P.extract_commenters(M.comment_pages(spark, d))


@query("normalise_name", """
SELECT c_custkey, replace(replace(c_name, '#', ' '), ' ', '-') AS name FROM customer""")
def q_normalise_name(spark, d):
    c = T.table(spark, d, "customer")
    return c.select("c_custkey", X.normalise_name(F.translate("c_name", "#", " ")).alias("name"))


# --- J4, B3, B4, G10, G15 --------------------------------------------------------------------------

HOME_LINKS = r"""hl AS (
  SELECT page_id, unnest(range(len(hrefs))) AS pos, unnest(hrefs) AS href, unnest(texts) AS txt FROM (
    SELECT page_id,
      regexp_extract_all(sec, '<span class="pl">\s*<a href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS hrefs,
      regexp_extract_all(sec, '<span class="pl">\s*<a href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS texts
    FROM (SELECT page_id, regexp_extract(html, '<div id="movie">([\s\S]*?)(?:<div id="|\z)', 1) AS sec FROM hpages)))"""


@query("extract_collection_link", with_(HOMES, HOME_LINKS) + r"""
SELECT page_id, href || '?' AS collect_url, TRY_CAST(nullif(regexp_extract(txt, '(\d+)', 1), '') AS INT) AS n_collected
FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM hl
      WHERE contains(href, 'collect')
        AND coalesce(TRY_CAST(nullif(regexp_extract(txt, '(\d+)', 1), '') AS INT), -1) > 900)
WHERE rn = 1""")
def q_extract_collection_link(spark, d):
    return P.extract_collection_link(M.home_pages(spark, d))


@query("filter_heavy_users", with_(HOMES, HOME_LINKS) + r"""
SELECT page_id, href, TRY_CAST(nullif(regexp_extract(txt, '(\d+)', 1), '') AS INT) AS n
FROM hl WHERE coalesce(TRY_CAST(nullif(regexp_extract(txt, '(\d+)', 1), '') AS INT), -1) > 900""")
def q_filter_heavy_users(spark, d):
    links = P.home_links(M.home_pages(spark, d)).select("page_id", F.explode("links").alias("p"))
    got = links.select("page_id", F.col("p.href").alias("href"), X.extract_first_number("p.text").alias("n"))
    return I.filter_heavy_users(got, P.HEAVY_MIN)


@query("filter_link_contains", r"""
SELECT page_id, href FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href FROM pages)
WHERE contains(href, 'the')""")
def q_filter_link_contains(spark, d):
    links = T.table(spark, d, "pages").select(
        "page_id", F.explode(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)">'), F.lit(1))).alias("href"))
    return I.filter_link_contains(links, "the")


@query("extract_first_number", r"""
SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '(\d+)', 1), '') AS INT) AS n FROM pages""")
def q_extract_first_number(spark, d):
    return T.table(spark, d, "pages").select("page_id", X.extract_first_number("url").alias("n"))


# --- J5, G8, G16 -------------------------------------------------------------------------------------

@query("extract_attr", with_(COLLECTION, _blocks_sql("cpages", P.ITEM_MARKER)) + r"""
SELECT page_id, pos, title FROM (
  SELECT page_id, pos, coalesce(
    nullif(regexp_extract(block, '<[a-z]+[^>]*class="nbg"[^>]*title="([^"]*)"', 1), ''),
    nullif(regexp_extract(block, '<[a-z]+[^>]*title="([^"]*)"[^>]*class="nbg"', 1), '')) AS title
  FROM blk) WHERE title IS NOT NULL""")
def q_extract_attr(spark, d):
    return P.extract_attr(M.collection_pages(spark, d))


@query("extract_score", with_(LINES) + f""",
cat AS (SELECT CAST(p_partkey AS INT) AS item_id, p_name AS name, p_type AS summary,
               '{IP}' || CAST(p_partkey AS VARCHAR) || '/' AS item_url FROM part),
snip AS (SELECT l_orderkey AS page_id, {ITEM_BLOCK.format(rating=RATING_CLASS, css="item")} AS s
         FROM lines JOIN cat ON l_partkey = item_id)
SELECT page_id, s, coalesce(TRY_CAST(nullif(regexp_extract(s, 'rating(\\d+)-t', 1), '') AS INT), 0) AS score
FROM snip""")
def q_extract_score(spark, d):
    # One item block per rating line; the rating class is absent for score 0.
    items = T.items_table(spark, d)
    li = T.table(spark, d, "lineitem").join(items, F.col("l_partkey") == F.col("item_id"))
    score = T.score_expr()
    rating = F.when(score > 0, F.concat(F.lit('<span class="rating'), score.cast("string"),
                                        F.lit('-t"></span>'))).otherwise(F.lit(""))
    return li.select(F.col("l_orderkey").alias("page_id"), M._item_block(rating).alias("s")).select(
        "page_id", "s", X.extract_score("s").alias("score"))


@query("strip_label", r"""
SELECT page_id, trim(replace(regexp_extract(html, '<h1>([\s\S]*?)</h1>', 1), '&amp;', '')) AS heading FROM pages""")
def q_strip_label(spark, d):
    h1 = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    return T.table(spark, d, "pages").select("page_id", X.strip_label(h1, "&amp;").alias("heading"))


# --- G12, G13, K2 ---------------------------------------------------------------------------------------

@query("page_url", with_(PROFILES) + f"""
SELECT page_id, '{UP}' || CAST(page_id AS VARCHAR) || '/collect?start=' || CAST(15 * i AS VARCHAR)
       || '&sort=time&ratind=all&filter=all&mode=gird' AS url
FROM (SELECT page_id, unnest(range(CAST(ceil(n_all / 15) AS INT))) AS i FROM ppages
      JOIN ucnt ON page_id = user_id)""")
def q_page_url(spark, d):
    prof = P.extract_profile(M.profile_pages(spark, d))
    base = F.concat(F.lit(UP), F.col("page_id").cast("string"), F.lit("/collect?"))
    todo = prof.select("page_id", base.alias("base"), "page_count")
    return I.page_worklist(todo, key_col="page_id", base_col="base").select("page_id", "url")
