"""Registered queries: dedup against stored data, crawl decisions, work
lists, id assignment, appends and upserts (A2, A5, A6, A9, C4-C6, C8,
D2-D4, D13, E8, K2, K3).

Stand-in split: facts of orders before 1997 are 'stored', later ones are
the new batch; the item catalogue holds the items rated before April 1995.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest as I, pages as P
from ..session import scratch_path
from ..sources import markup as M, store as S, tables as T, text as TX
from .oracle import ITEMS, RATINGS_FACTS, STORED, USERS, with_
from .pages_q import PROFILES, PROFILE_SQL
from .registry import query

QUOTA = 30
CATALOGUE_BEFORE = "1995-04-01"
PAGES_FROM = "1996-01-01"


def _stored_name(c):
    """A name as stored, with a blank; pages give it with the blank as '-'."""
    return F.translate(c, "#", " ")


def _page_name(c):
    return F.translate(c, "#", "-")


def _facts(spark, d):
    return T.ratings_facts(spark, d)


def _split(spark, d):
    f = _facts(spark, d)
    return f.filter(T.stored_before()), f.filter(~T.stored_before())


CANDIDATES = f"""cand AS (SELECT DISTINCT replace(c.c_name, '#', '-') AS user_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                    WHERE NOT ({STORED})),
known AS (SELECT DISTINCT replace(c.c_name, '#', ' ') AS name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
          WHERE {STORED})"""


def _candidates(spark, d):
    o = T.table(spark, d, "orders")
    c = T.table(spark, d, "customer").select("c_custkey", "c_name")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    cand = oc.filter(~T.stored_before()).select(_page_name("c_name").alias("user_name")).distinct()
    known = oc.filter(T.stored_before()).select(_stored_name("c_name").alias("name")).distinct()
    return cand, known


@query("new_users", with_(CANDIDATES) + """
SELECT user_name FROM cand WHERE replace(user_name, ' ', '-') NOT IN (SELECT replace(name, ' ', '-') FROM known)""")
def q_new_users(spark, d):
    cand, known = _candidates(spark, d)
    return I.new_users(cand, known)


@query("new_user_count", with_(CANDIDATES) + """
SELECT count(*) AS n_new FROM cand
WHERE replace(user_name, ' ', '-') NOT IN (SELECT replace(name, ' ', '-') FROM known)""")
def q_new_user_count(spark, d):
    cand, known = _candidates(spark, d)
    return I.new_user_count(cand, known)


@query("new_ratings", with_(RATINGS_FACTS) + f"""
SELECT item_url, user_id, score, item_name FROM (
  SELECT item_url, user_id, score, item_name,
         row_number() OVER (PARTITION BY item_url, user_id ORDER BY score, item_name) AS rn
  FROM ratings_facts WHERE NOT ({STORED})) b
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM ratings_facts s WHERE {STORED.replace('o_orderdate', 's.o_orderdate')}
                             AND s.item_url = b.item_url AND s.user_id = b.user_id)""")
def q_new_ratings(spark, d):
    stored, batch = _split(spark, d)
    cols = ["item_url", "user_id", "score", "item_name"]
    return I.new_ratings(batch.select(*cols), stored.select(*cols), order_cols=["score"])


@query("new_items", with_(RATINGS_FACTS) + f"""
SELECT item_url, name, summary FROM (
  SELECT item_url, item_name AS name, summary,
         row_number() OVER (PARTITION BY item_url ORDER BY item_name, summary) AS rn
  FROM ratings_facts WHERE o_orderdate >= TIMESTAMP '{CATALOGUE_BEFORE}') b
WHERE rn = 1 AND item_url NOT IN (SELECT item_url FROM ratings_facts WHERE o_orderdate < TIMESTAMP '{CATALOGUE_BEFORE}')""")
def q_new_items(spark, d):
    f = _facts(spark, d)
    cut = F.col("o_orderdate") < F.lit(CATALOGUE_BEFORE).cast("timestamp_ntz")
    return I.new_items(f.filter(~cut), f.filter(cut).select("item_url"))


@query("assign_item_ids", with_(RATINGS_FACTS) + f"""
, cat AS (SELECT DISTINCT i.item_id, i.item_url FROM ratings_facts f JOIN items i ON f.item_url = i.item_url
          WHERE f.o_orderdate < TIMESTAMP '{CATALOGUE_BEFORE}'),
fresh AS (SELECT DISTINCT item_url FROM ratings_facts WHERE item_url NOT IN (SELECT item_url FROM cat))
SELECT item_url, CAST((SELECT max(item_id) FROM cat) + row_number() OVER (ORDER BY item_url) AS BIGINT) AS item_id
FROM fresh""")
def q_assign_item_ids(spark, d):
    f = _facts(spark, d)
    cut = F.col("o_orderdate") < F.lit(CATALOGUE_BEFORE).cast("timestamp_ntz")
    cat = f.filter(cut).select("item_url").distinct().join(T.items_table(spark, d), "item_url")
    fresh = f.select("item_url").distinct().join(cat.select("item_url"), "item_url", "left_anti")
    return I.assign_item_ids(fresh, cat).select("item_url", F.col("item_id").cast("bigint"))


@query("attach_user_ids", with_(RATINGS_FACTS, USERS) + """
SELECT f.item_url, replace(f.user_name, '#', '-') AS user_name, f.score, u.user_id
FROM ratings_facts f JOIN (SELECT name, min(user_id) AS user_id FROM users GROUP BY name) u ON f.user_name = u.name""")
def q_attach_user_ids(spark, d):
    rows = _facts(spark, d).select("item_url", _page_name("user_name").alias("user_name"), "score")
    return I.attach_user_ids(rows, T.users_table(spark, d).withColumn("name", _stored_name("name")))


CRAWL_STATUS = with_(RATINGS_FACTS, USERS) + f"""
, cnt AS (SELECT user_name AS name, count(*) AS n_all, count(*) FILTER (WHERE score > 0) AS n_rated
          FROM ratings_facts GROUP BY user_name),
st AS (SELECT k.name, k.declared_total, coalesce(c.n_all, 0) AS n_all, coalesce(c.n_rated, 0) AS n_rated
       FROM (SELECT name, min(declared_total) AS declared_total FROM users GROUP BY name) k
       LEFT JOIN cnt c ON k.name = c.name)
SELECT name, declared_total, n_all, n_rated, n_rated > {QUOTA} AS quota_reached,
       n_all >= declared_total AS complete, (n_all >= declared_total) OR (n_rated > {QUOTA}) AS skip
FROM st"""


@query("crawl_status", CRAWL_STATUS)
def q_crawl_status(spark, d):
    return I.crawl_status(_facts(spark, d), T.users_table(spark, d), quota=QUOTA)


@query("rated_quota_reached", with_(RATINGS_FACTS) + f"""
SELECT user_name, count(*) FILTER (WHERE score > 0) > {QUOTA} AS quota_reached
FROM ratings_facts GROUP BY user_name""")
def q_rated_quota_reached(spark, d):
    got = I.rated_quota_reached(_facts(spark, d), T.users_table(spark, d), quota=QUOTA)
    return got.join(_facts(spark, d).select(F.col("user_name").alias("name")).distinct(), "name", "left_semi") \
        .select(F.col("name").alias("user_name"), "quota_reached")


@query("collection_complete", with_(RATINGS_FACTS, USERS) + """
SELECT u.name, count(f.user_name) >= min(u.declared_total) AS complete
FROM users u LEFT JOIN ratings_facts f ON f.user_name = u.name GROUP BY u.name""")
def q_collection_complete(spark, d):
    return I.collection_complete(_facts(spark, d), T.users_table(spark, d)).select("name", "complete")


@query("quota_pages", f"""
WITH ev AS (SELECT o_custkey AS user_id, o_orderkey AS page, o_orderdate,
                   CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(ceil(l_quantity / 10) AS INT) END AS score
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
pc AS (SELECT user_id, page, count(*) FILTER (WHERE score > 0) AS n_rated FROM ev
       WHERE o_orderdate >= TIMESTAMP '{PAGES_FROM}' GROUP BY user_id, page),
st AS (SELECT user_id, count(*) FILTER (WHERE score > 0) AS n_stored FROM ev
       WHERE o_orderdate < TIMESTAMP '{PAGES_FROM}' GROUP BY user_id),
run AS (SELECT pc.*, coalesce(sum(n_rated) OVER (PARTITION BY user_id ORDER BY page
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pc)
SELECT run.user_id, run.page, run.n_rated FROM run LEFT JOIN st ON run.user_id = st.user_id
WHERE coalesce(st.n_stored, 0) + run.before <= {QUOTA}""")
def q_quota_pages(spark, d):
    li = T.table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    od = T.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ev = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("page"), "o_orderdate",
        T.score_expr().alias("score"))
    cut = F.col("o_orderdate") < F.lit(PAGES_FROM).cast("timestamp_ntz")
    pc = ev.filter(~cut).groupBy("user_id", "page").agg(F.count_if(F.col("score") > 0).alias("n_rated"))
    st = ev.filter(cut).groupBy("user_id").agg(F.count_if(F.col("score") > 0).alias("n_stored"))
    return I.quota_pages(pc, st, quota=QUOTA).select("user_id", "page", "n_rated")


STATUS_CTES = f"""cnt AS (SELECT user_name AS name, count(*) AS n_all, count(*) FILTER (WHERE score > 0) AS n_rated
          FROM ratings_facts GROUP BY user_name),
sk AS (SELECT k.name, (coalesce(c.n_all, 0) >= k.declared_total) OR (coalesce(c.n_rated, 0) > {QUOTA}) AS skip
       FROM (SELECT name, min(declared_total) AS declared_total FROM users GROUP BY name) k
       LEFT JOIN cnt c ON k.name = c.name)"""


@query("page_worklist", with_(RATINGS_FACTS, USERS, PROFILES) + f"""
, prof AS ({PROFILE_SQL.strip()}),
{STATUS_CTES}
SELECT name, CAST(page AS INTEGER) AS page, CAST(15 * page AS INTEGER) AS start,
       home_url || 'start=' || CAST(15 * page AS VARCHAR) || '&sort=time&ratind=all&filter=all&mode=gird' AS url
FROM (SELECT p.user_name AS name, u.home_url, unnest(range(p.page_count)) AS page
      FROM prof p JOIN users u ON p.user_name = u.name
      WHERE p.user_name NOT IN (SELECT name FROM sk WHERE skip))""")
def q_page_worklist(spark, d):
    prof = P.extract_profile(M.profile_pages(spark, d))
    users = T.users_table(spark, d).select("name", "home_url")
    todo = prof.join(users, prof.user_name == users.name).select("name", "home_url", "page_count")
    status = I.crawl_status(_facts(spark, d), T.users_table(spark, d), quota=QUOTA)
    return I.page_worklist(todo, status)


@query("upsert_user_totals", with_(USERS, PROFILES) + f"""
, prof AS ({PROFILE_SQL.strip()}),
old AS (SELECT * REPLACE (replace(name, '#', ' ') AS name) FROM users
        WHERE user_id IN (SELECT o_custkey FROM orders WHERE {STORED})),
p1 AS (SELECT replace(user_name, '#', '-') AS n,
              min(struct_pack(nm := replace(user_name, '#', '-'), t := declared_total,
                              h := '{T.USER_URL_PREFIX}' || CAST(page_id AS VARCHAR) || '/collect?')) AS b
       FROM prof GROUP BY 1),
kept AS (SELECT o.user_id, o.name, CAST(coalesce(p1.b.t, o.declared_total) AS INT) AS declared_total, o.home_url
         FROM old o LEFT JOIN p1 ON replace(o.name, ' ', '-') = p1.n),
fresh AS (SELECT * FROM p1 WHERE n NOT IN (SELECT replace(name, ' ', '-') FROM old))
SELECT * FROM kept UNION ALL
SELECT CAST((SELECT max(user_id) FROM old) + row_number() OVER (ORDER BY n) AS INT) AS user_id, b.nm AS name,
       CAST(b.t AS INT) AS declared_total, b.h AS home_url FROM fresh""")
def q_upsert_user_totals(spark, d):
    users = T.users_table(spark, d)
    o = T.table(spark, d, "orders").filter(T.stored_before()).select(F.col("o_custkey").cast("int").alias("user_id"))
    old = users.join(o.distinct(), "user_id", "left_semi")
    prof = P.extract_profile(M.profile_pages(spark, d), keep=("url",)).select(
        _page_name("user_name").alias("user_name"), "declared_total", F.col("url").alias("home_url"))
    return S.upsert_user_totals(old.withColumn("name", _stored_name("name")), prof)


@query("append_new_rows", with_(RATINGS_FACTS) + f"""
, s AS (SELECT item_url, user_id, score FROM ratings_facts WHERE {STORED}),
b AS (SELECT item_url, user_id, min(score) AS score FROM ratings_facts WHERE NOT ({STORED}) GROUP BY 1, 2)
SELECT * FROM s UNION ALL
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.item_url = b.item_url AND s.user_id = b.user_id)""")
def q_append_new_rows(spark, d):
    stored, batch = _split(spark, d)
    cols = ["item_url", "user_id", "score"]
    return S.append_new_rows(stored.select(*cols), batch.select(*cols), ["item_url", "user_id"])


def _seed_rows(spark, d):
    return T.users_table(spark, d).select(F.concat("home_url", F.lit("?")).alias("collect_url"),
                                          _page_name("name").alias("user_name"))


@query("format_seed_list", with_(USERS) + f"""
SELECT home_url || '?' || ' ' || replace(name, '#', '-') AS value FROM users""")
def q_format_seed_list(spark, d):
    # Written by A5's sink and read back as plain lines.
    path = scratch_path(spark, "seed-lines")
    TX.format_seed_list(_seed_rows(spark, d), path)
    return spark.read.text(path)


@query("parse_seed_list", with_(USERS) + """
SELECT url, min(name) AS name FROM (
  SELECT home_url || '?' AS url, replace(name, '#', '-') AS name FROM users
  UNION ALL SELECT home_url || '?' AS url, replace(name, '#', '-') AS name FROM users) GROUP BY url""")
def q_parse_seed_list(spark, d):
    # Files written by A5 (every user twice, once with extra blanks), scanned by A2.
    path, lines = scratch_path(spark, "seed-list"), TX.format_seed_lines(_seed_rows(spark, d))
    TX.write_lines(lines, path)
    TX.write_lines(lines.select(F.concat(F.lit("  "), F.regexp_replace("value", " ", "   "), F.lit(" ")).alias("value")),
                   path)
    return TX.parse_seed_list(spark, path)


@query("seed_page_worklist", with_(ITEMS) + """
SELECT item_id, CAST(page AS INTEGER) AS page,
       item_url || 'comments?start=' || CAST(20 * page AS VARCHAR) || '&limit=20&sort=new_score&status=P' AS url
FROM (SELECT item_id, item_url, unnest(range(10)) AS page FROM items)""")
def q_seed_page_worklist(spark, d):
    return I.seed_page_worklist(T.items_table(spark, d))
