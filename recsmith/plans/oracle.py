"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string reads the driver's pre-registered views and must return the
same columns (by name), rows and values as the Spark query of that key.
"""

from __future__ import annotations

from ..sources.tables import ITEM_URL_PREFIX, STORED_BEFORE, USER_URL_PREFIX

RATINGS_BASE = """ratings_base AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         max(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(ceil(l_quantity / 10) AS INT) END) AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""

RATING_EVENTS = """rating_events AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(ceil(l_quantity / 10) AS INT) END AS score,
         o_orderdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ITEMS = f"""items AS (
  SELECT CAST(p_partkey AS INT) AS item_id, p_name AS name, p_type AS summary,
         '{ITEM_URL_PREFIX}' || CAST(p_partkey AS VARCHAR) || '/' AS item_url
  FROM part)"""

USERS = f"""users AS (
  SELECT CAST(c_custkey AS INT) AS user_id, c_name AS name,
         CAST(c_custkey % 80 AS INT) AS declared_total,
         '{USER_URL_PREFIX}' || CAST(c_custkey AS VARCHAR) || '/collect?' AS home_url
  FROM customer)"""

RATINGS_FACTS = RATING_EVENTS + ",\n" + ITEMS + """,
ratings_facts AS (
  SELECT i.name AS item_name, i.summary, CAST(e.user_id AS INT) AS user_id, c.c_name AS user_name,
         e.score, i.item_url, e.o_orderdate
  FROM rating_events e JOIN items i ON e.item_id = i.item_id
  JOIN customer c ON e.user_id = c.c_custkey)"""

STORED = f"o_orderdate < TIMESTAMP '{STORED_BEFORE}'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


