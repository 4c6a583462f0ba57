"""Registered queries: scans, rating facts, activity and export."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ratings as R
from ..sources import tables as T
from .oracle import ITEMS, RATINGS_BASE, RATINGS_FACTS, with_
from .registry import query

# Driver thresholds: the reference's 500 / 200 select nothing at the test
# scales, so the driver queries pass smaller ones (see SURVEY 1.3).
MIN_ROWS = 30
PER_USER = 50
MAX_USERS = 300


@query("load_tables", """
SELECT 'region' AS table_name, count(*) AS n_rows FROM region UNION ALL
SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL
SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part UNION ALL
SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL
SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL
SELECT 'embeddings', count(*) FROM embeddings UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL
SELECT 'benchmark', count(*) FROM benchmark UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL
SELECT 'conversations', count(*) FROM conversations""")
def q_load_tables(spark, d):
    return T.table_row_counts(spark, d)


@query("ratings_base", with_(RATINGS_BASE) + "SELECT * FROM ratings_base")
def q_ratings_base(spark, d):
    return T.ratings_base(spark, d)


@query("to_als_ratings", with_(RATINGS_BASE) + """
SELECT CAST(user_id AS INT) AS userId, CAST(item_id AS INT) AS movieId, CAST(score AS INT) AS rating
FROM ratings_base""")
def q_to_als_ratings(spark, d):
    return R.to_als_ratings(T.ratings_base(spark, d))


@query("rated_only", with_(RATINGS_BASE) + "SELECT * FROM ratings_base WHERE score > 0")
def q_rated_only(spark, d):
    return R.rated_only(T.ratings_base(spark, d))


@query("active_users", with_(RATINGS_BASE) + f"""
SELECT user_id, count(*) AS n_rows FROM ratings_base GROUP BY user_id HAVING count(*) > {MIN_ROWS}""")
def q_active_users(spark, d):
    return R.active_users(T.ratings_base(spark, d), MIN_ROWS)


@query("limit_users", with_(RATINGS_BASE) + f"""
SELECT user_id FROM (SELECT user_id FROM ratings_base GROUP BY user_id HAVING count(*) > {MIN_ROWS})
ORDER BY user_id LIMIT {MAX_USERS // 2}""")
def q_limit_users(spark, d):
    active = R.active_users(T.ratings_base(spark, d), MIN_ROWS).select("user_id")
    return R.limit_users(active, MAX_USERS // 2)


EXPORT_SQL = with_(RATINGS_BASE) + f"""
SELECT user_id, item_id, score FROM (
  SELECT r.*, row_number() OVER (PARTITION BY r.user_id ORDER BY r.item_id) AS rn
  FROM ratings_base r
  WHERE r.score > 0 AND r.user_id IN (
      SELECT user_id FROM ratings_base GROUP BY user_id HAVING count(*) > {MIN_ROWS}))
WHERE rn <= {PER_USER}"""


@query("export_ratings", EXPORT_SQL)
def q_export_ratings(spark, d):
    return R.export_ratings(T.ratings_base(spark, d), MIN_ROWS, PER_USER)


@query("export_ratings_limited", with_(RATINGS_BASE) + f"""
SELECT user_id, item_id, score FROM (
  SELECT r.*, row_number() OVER (PARTITION BY r.user_id ORDER BY r.item_id) AS rn
  FROM ratings_base r
  WHERE r.score > 0 AND r.user_id IN (
      SELECT user_id FROM ratings_base GROUP BY user_id HAVING count(*) > {MIN_ROWS}
      ORDER BY user_id LIMIT {MAX_USERS}))
WHERE rn <= {PER_USER}""")
def q_export_ratings_limited(spark, d):
    return R.export_ratings(T.ratings_base(spark, d), MIN_ROWS, PER_USER, max_users=MAX_USERS)


@query("export_ratings_by_url", with_(RATINGS_FACTS) + f"""
, rf AS (SELECT user_id, item_url, max(score) AS score FROM ratings_facts GROUP BY user_id, item_url)
SELECT user_id, item_id, score FROM (
  SELECT rf.user_id, i.item_id, rf.score,
         row_number() OVER (PARTITION BY rf.user_id ORDER BY i.item_id) AS rn
  FROM rf JOIN items i ON rf.item_url = i.item_url
  WHERE rf.score > 0 AND rf.user_id IN (
      SELECT user_id FROM rf GROUP BY user_id HAVING count(*) > {MIN_ROWS}))
WHERE rn <= {PER_USER}""")
def q_export_ratings_by_url(spark, d):
    facts = T.ratings_facts(spark, d).groupBy("user_id", "item_url").agg(F.max("score").alias("score"))
    return R.export_ratings(facts, MIN_ROWS, PER_USER, items=T.items_table(spark, d))


@query("attach_item_ids", with_(RATINGS_FACTS) + """
SELECT f.user_id, f.item_url, f.score, i.item_id FROM ratings_facts f JOIN items i ON f.item_url = i.item_url""")
def q_attach_item_ids(spark, d):
    facts = T.ratings_facts(spark, d).select("user_id", "item_url", "score")
    return R.attach_item_ids(facts, T.items_table(spark, d))


@query("drop_unknown_items", with_(RATINGS_FACTS) + """
, known AS (SELECT * FROM items WHERE item_id IN (SELECT DISTINCT l_partkey FROM lineitem l
     JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE o.o_orderdate < TIMESTAMP '1997-01-01'))
SELECT f.user_id, f.item_url, k.item_id FROM ratings_facts f LEFT JOIN known k ON f.item_url = k.item_url
WHERE k.item_id IS NOT NULL""")
def q_drop_unknown_items(spark, d):
    # Catalogue = items seen before the cut; later-only items stay unresolved.
    ev = T.rating_events(spark, d)
    known_ids = ev.filter(T.stored_before()).select(F.col("item_id").cast("int").alias("item_id")).distinct()
    known = T.items_table(spark, d).join(known_ids, "item_id", "left_semi").select("item_url", "item_id")
    facts = T.ratings_facts(spark, d).select("user_id", "item_url")
    return R.drop_unknown_items(facts.join(known, "item_url", "left"))


@query("lookup_by_key", """
SELECT p_partkey AS item_id, p_name AS name, p_type AS summary FROM part WHERE p_partkey = 7""")
def q_lookup_by_key(spark, d):
    # By a stored column, so the parquet scan gets the filter.
    stored = T.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
                                              F.col("p_type").alias("summary"))
    return R.lookup_by_key(stored, item_id=7)


@query("distinct_items", with_(RATINGS_FACTS) + """
SELECT item_url, name, summary FROM (
  SELECT item_url, item_name AS name, summary,
         row_number() OVER (PARTITION BY item_url ORDER BY item_name, summary) AS rn
  FROM ratings_facts) WHERE rn = 1""")
def q_distinct_items(spark, d):
    return R.distinct_items(T.ratings_facts(spark, d))


@query("first_match", with_(RATINGS_FACTS) + """
SELECT user_name, item_url, score FROM (
  SELECT user_name, item_url, score,
         row_number() OVER (PARTITION BY user_name ORDER BY item_url, score) AS rn
  FROM ratings_facts) WHERE rn = 1""")
def q_first_match(spark, d):
    return R.first_match(T.ratings_facts(spark, d), "user_name", "item_url", ["score"])


@query("split_ratings", with_(RATINGS_BASE) + """
SELECT CASE WHEN (user_id * 31 + item_id * 17) % 10 < 8 THEN 'train' ELSE 'test' END AS part,
       count(*) AS n_rows, CAST(sum(score) AS BIGINT) AS sum_score
FROM ratings_base GROUP BY 1""")
def q_split_ratings(spark, d):
    # One pass: tag each row with its part, aggregate per part.
    tagged = R.tag_split(T.ratings_base(spark, d))
    return tagged.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.sum("score").cast("bigint").alias("sum_score"))


@query("validate_schema", with_(RATINGS_FACTS) + """
SELECT count(*) FILTER (WHERE item_name IS NULL) AS item_name_nulls,
       count(*) FILTER (WHERE summary IS NULL) AS summary_nulls,
       count(*) FILTER (WHERE user_id IS NULL) AS user_id_nulls,
       count(*) FILTER (WHERE user_name IS NULL) AS user_name_nulls,
       count(*) FILTER (WHERE score IS NULL) AS score_nulls,
       count(*) FILTER (WHERE item_url IS NULL) AS item_url_nulls,
       count(*) AS n_rows
FROM ratings_facts""")
def q_validate_schema(spark, d):
    from ..schemas import RATINGS, validate_schema
    return validate_schema(T.ratings_facts(spark, d), RATINGS)
