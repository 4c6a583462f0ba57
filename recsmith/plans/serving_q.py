"""Registered queries: stored lists, codecs, upserts and serving (A1, A4,
A7, A8, C2, C3, E6, G6, G7, G18, H5, H7).

Stand-in lists, as long as the stored ones: a user's list is the first 20
items (by id) they rated, an item's list the first 10 users (by id) who
rated it; 'old' lists come from orders before 1997, 'new' ones from the
later orders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codec as C, text as X
from ..operators import ratings as R, serve as V, similarity as S
from ..operators.model import ITEM_RECS, USER_RECS
from ..session import scratch_path
from ..sources import store as ST, tables as T, text as TX
from .oracle import ITEMS, RATING_EVENTS, STORED, USERS, with_
from .registry import query
from .similarity_q import TOPN

N_LIST = {"user_id": USER_RECS, "item_id": ITEM_RECS}


def _lists(spark, d, key, other, part=None):
    ev = T.rating_events(spark, d)
    if part == "old":
        ev = ev.filter(T.stored_before())
    elif part == "new":
        ev = ev.filter(~T.stored_before())
    pairs = ev.select(F.col(key).cast("int").alias("k"), F.col(other).cast("int").alias("o")).distinct()
    first = R.per_key_first_n(pairs, ["k"], [F.col("o")], N_LIST[key])
    return first.groupBy("k").agg(F.array_sort(F.collect_list("o")).alias("ids"))


def user_lists(spark, d, part=None):
    return _lists(spark, d, "user_id", "item_id", part).select(F.col("k").alias("user_id"),
                                                               F.col("ids").alias("item_ids"))


def item_lists(spark, d, part=None):
    return _lists(spark, d, "item_id", "user_id", part).select(F.col("k").alias("item_id"),
                                                               F.col("ids").alias("neighbour_ids"))


def lists_sql(name, key, other, where) -> str:
    return f"""{name} AS (SELECT CAST({key} AS INT) AS {key}, list(CAST({other} AS INT) ORDER BY {other}) AS ids
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {other}) AS rn
        FROM (SELECT DISTINCT {key}, {other} FROM rating_events WHERE {where}))
  WHERE rn <= {N_LIST[key]} GROUP BY {key})"""


NEW_U = lists_sql("new_u", "user_id", "item_id", f"NOT ({STORED})")
OLD_U = lists_sql("old_u", "user_id", "item_id", STORED)
NEW_I = lists_sql("new_i", "item_id", "user_id", f"NOT ({STORED})")
OLD_I = lists_sql("old_i", "item_id", "user_id", STORED)


@query("encode_id_list", with_(RATING_EVENTS, NEW_U) + """
SELECT user_id, '[' || array_to_string(ids, ', ') || ']' AS item_ids FROM new_u""")
def q_encode_id_list(spark, d):
    return user_lists(spark, d, "new").select("user_id", C.encode_id_list("item_ids").alias("item_ids"))


@query("decode_id_list", with_(RATING_EVENTS, NEW_U) + """
SELECT user_id, ids AS item_ids, CAST(len(ids) AS INTEGER) AS n FROM new_u
UNION ALL SELECT -1 AS user_id, CAST([] AS INTEGER[]) AS item_ids, CAST(0 AS INTEGER) AS n""")
def q_decode_id_list(spark, d):
    text = user_lists(spark, d, "new").select("user_id", C.encode_id_list("item_ids").alias("t"))
    empty = spark.range(1).select(F.lit(-1).alias("user_id"), F.lit("[]").alias("t"))
    got = text.unionByName(empty).select("user_id", C.decode_id_list("t").alias("item_ids"))
    return got.select("user_id", "item_ids", F.size("item_ids").alias("n"))


@query("upsert_user_recs", with_(RATING_EVENTS, NEW_U, OLD_U) + """
SELECT user_id, ids AS item_ids FROM new_u
UNION ALL SELECT user_id, ids FROM old_u WHERE user_id NOT IN (SELECT user_id FROM new_u)""")
def q_upsert_user_recs(spark, d):
    return ST.upsert_user_recs(user_lists(spark, d, "old"), user_lists(spark, d, "new"))


@query("upsert_item_recs", with_(RATING_EVENTS, NEW_I, OLD_I) + """
SELECT item_id, ids AS neighbour_ids FROM new_i
UNION ALL SELECT item_id, ids FROM old_i WHERE item_id NOT IN (SELECT item_id FROM new_i)""")
def q_upsert_item_recs(spark, d):
    return ST.upsert_item_recs(item_lists(spark, d, "old"), item_lists(spark, d, "new"))


@query("rec_titles", with_(RATING_EVENTS, NEW_U, ITEMS) + """
SELECT user_id, CAST(pos AS INT) AS pos, item_id, name AS title FROM (
  SELECT user_id, unnest(range(len(ids))) AS pos, unnest(ids) AS item_id FROM new_u) x
LEFT JOIN items USING (item_id)""")
def q_rec_titles(spark, d):
    return V.rec_titles(user_lists(spark, d, "new"), T.items_table(spark, d))


@query("attach_user_names", with_(RATING_EVENTS, NEW_U, USERS) + """
SELECT n.user_id, n.ids AS item_ids, u.name AS user_name FROM new_u n LEFT JOIN users u ON n.user_id = u.user_id""")
def q_attach_user_names(spark, d):
    return V.attach_user_names(user_lists(spark, d, "new"), T.users_table(spark, d))


@query("take_first_n", with_(RATING_EVENTS, NEW_I) + """
SELECT item_id, ids[1:3] AS neighbour_ids FROM new_i""")
def q_take_first_n(spark, d):
    return item_lists(spark, d, "new").select("item_id", V.take_first_n("neighbour_ids", 3).alias("neighbour_ids"))


@query("serve_message", f"""
SELECT p_partkey, '{V.USER_TEMPLATE.replace('%s', '')}' || p_name AS message FROM part""")
def q_serve_message(spark, d):
    return T.table(spark, d, "part").select("p_partkey", X.serve_message(V.USER_TEMPLATE, "p_name").alias("message"))


@query("serve_similar", "WITH " + TOPN + ",\n" + ITEMS + f""",
lst AS (SELECT CAST(item_id AS INT) AS item_id, list(CAST(neighbour_id AS INT) ORDER BY rank) AS ids
        FROM topn GROUP BY item_id),
x AS (SELECT item_id AS aim_id, unnest(range(len(ids[1:3]))) AS pos, unnest(ids[1:3]) AS nid FROM lst)
SELECT x.aim_id AS item_id, CAST(x.pos AS INT) AS pos, x.nid AS neighbour_id, n.name AS title,
       '{V.ITEM_TEMPLATE.split('%s')[0]}' || a.name || '{V.ITEM_TEMPLATE.split('%s')[1]}' || n.name AS message
FROM x LEFT JOIN items n ON x.nid = n.item_id LEFT JOIN items a ON x.aim_id = a.item_id""")
def q_serve_similar(spark, d):
    emb = T.table(spark, d, "embeddings")
    lists = S.neighbour_lists(S.similar_items(emb, 10, id_col="vec_id", vec_col="embedding"))
    requests = emb.select(F.col("vec_id").cast("int").alias("item_id"))
    return V.serve_similar(requests, lists, T.items_table(spark, d), n=3)


ALL_U = lists_sql("all_u", "user_id", "item_id", "TRUE")
SEED = 7
MIX = f"CAST('0x' || substr(md5(concat_ws('|', CAST(user_id AS VARCHAR), CAST({{d}} AS VARCHAR), '{SEED}')), 1, 8) AS BIGINT)"


@query("sample_user_recs", with_(RATING_EVENTS, ALL_U) + f"""
SELECT user_id, CAST(draw AS INT) AS draw, ids[1 + CAST({MIX.format(d='draw')} % len(ids) AS INT)] AS item_id
FROM (SELECT user_id, ids, unnest(range(1, 4)) AS draw FROM all_u WHERE len(ids) >= 3)""")
def q_sample_user_recs(spark, d):
    lists = user_lists(spark, d)
    requests = lists.select("user_id", F.lit(3).alias("n"))
    return V.sample_user_recs(requests, lists, seed=SEED)


@query("sample_user_recs_distinct", with_(RATING_EVENTS, ALL_U) + f"""
SELECT user_id, CAST(draw AS INT) AS draw, item_id FROM (
  SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY {MIX.format(d='i')}, i) AS draw
  FROM (SELECT user_id, unnest(ids) AS item_id, unnest(range(1, len(ids) + 1)) AS i FROM all_u WHERE len(ids) >= 3))
WHERE draw <= 3""")
def q_sample_user_recs_distinct(spark, d):
    lists = user_lists(spark, d)
    requests = lists.select("user_id", F.lit(3).alias("n"))
    return V.sample_user_recs(requests, lists, seed=SEED, replace=False)


@query("format_ratings_text", with_(RATING_EVENTS) + """
SELECT concat_ws('::', CAST(user_id AS VARCHAR), CAST(item_id AS VARCHAR), CAST(score AS VARCHAR)) AS value
FROM rating_events WHERE score > 0""")
def q_format_ratings_text(spark, d):
    path = scratch_path(spark, "rating-text")
    TX.format_ratings_text(R.rated_only(T.rating_events(spark, d)), path, user_col="user_id", item_col="item_id",
                           rating_col="score")
    return spark.read.text(path)


@query("parse_ratings_text", with_(RATING_EVENTS) + """
SELECT CAST(e.user_id AS INT) AS userId, CAST(e.item_id AS INT) AS movieId, e.score AS rating
FROM rating_events e WHERE e.score > 0 AND e.item_id IN (
  SELECT DISTINCT item_id FROM rating_events WHERE o_orderdate < TIMESTAMP '1995-04-01')""")
def q_parse_ratings_text(spark, d):
    # Lines written as the export does, with 'None' for items missing from
    # the catalogue (items first rated from April 1995 on), read back.
    ev = R.rated_only(T.rating_events(spark, d))
    cat = (T.rating_events(spark, d).filter(F.col("o_orderdate") < F.lit("1995-04-01").cast("timestamp_ntz"))
           .select(F.col("item_id").alias("known")).distinct())
    lines = ev.join(cat, ev.item_id == cat.known, "left").select(
        F.concat_ws("::", F.col("user_id").cast("string"),
                    F.coalesce(F.col("known").cast("string"), F.lit("None")),
                    F.col("score").cast("string")).alias("value"))
    path = scratch_path(spark, "rating-lines")
    TX.write_lines(lines, path, mode="errorifexists")
    return TX.parse_ratings_text(spark, path)


@query("serve_user", with_(RATING_EVENTS, ALL_U, ITEMS) + f"""
, s AS (SELECT user_id, CAST(draw AS INT) AS draw, ids[1 + CAST({MIX.format(d='draw')} % len(ids) AS INT)] AS item_id
        FROM (SELECT user_id, ids, unnest(range(1, 4)) AS draw FROM all_u WHERE len(ids) >= 3))
SELECT s.user_id, s.draw, s.item_id, '{V.USER_TEMPLATE.replace('%s', '')}' || i.name AS message
FROM s LEFT JOIN items i ON s.item_id = i.item_id""")
def q_serve_user(spark, d):
    lists = user_lists(spark, d)
    requests = lists.select("user_id", F.lit(3).alias("n"))
    return V.serve_user(requests, lists, T.items_table(spark, d), seed=SEED)
