"""Registered queries: cosine neighbours on the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import similarity as S
from ..sources import tables as T
from .registry import query

N = 10

UNIT = """u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v,
       sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS nrm
FROM embeddings)"""

PAIRS = UNIT + """,
pairs AS (SELECT a.vec_id AS item_id, b.vec_id AS neighbour_id,
  CASE WHEN a.nrm = 0 OR b.nrm = 0 THEN 0.0
       ELSE list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) / (a.nrm * b.nrm) END AS sim
  FROM u a JOIN u b ON a.vec_id <> b.vec_id)"""

TOPN = PAIRS + f""",
topn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, neighbour_id) AS rank
                        FROM pairs) WHERE rank <= {N})"""


def _similar(spark, d, n=N):
    emb = T.table(spark, d, "embeddings")
    return S.similar_items(emb, n, id_col="vec_id", vec_col="embedding")


@query("similar_items", "WITH " + TOPN + """
SELECT item_id, neighbour_id, round(sim, 6) AS sim, CAST(rank AS INT) AS rank FROM topn""")
def q_similar_items(spark, d):
    return _similar(spark, d).select("item_id", "neighbour_id", F.round("sim", 6).alias("sim"),
                                     F.col("rank").cast("int"))


@query("remove_self", "WITH " + TOPN + """
SELECT CAST(item_id AS INT) AS item_id, list(CAST(neighbour_id AS INT) ORDER BY rank) AS neighbour_ids
FROM topn GROUP BY item_id""")
def q_remove_self(spark, d):
    # The stored list form (A8): the item put in front of its own list, as
    # a top-(n+1) would hold it, is removed again.
    lists = S.neighbour_lists(_similar(spark, d))
    with_self = lists.withColumn("neighbour_ids", F.concat(F.array(F.col("item_id")), F.col("neighbour_ids")))
    return S.remove_self(with_self)


@query("cosine_pairs", "WITH " + UNIT + """
SELECT a.vec_id AS item_id, b.vec_id AS other_id,
  round(CASE WHEN a.nrm = 0 OR b.nrm = 0 THEN 0.0
        ELSE list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) / (a.nrm * b.nrm) END, 6) AS sim
FROM u a JOIN u b ON b.vec_id = a.vec_id + 1""")
def q_cosine_pairs(spark, d):
    # G17 on consecutive ids (an equi-join, not all pairs).
    e = T.table(spark, d, "embeddings")
    a = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("va"))
    b = e.select((F.col("vec_id") - 1).alias("item_id"), F.col("vec_id").alias("other_id"),
                 F.col("embedding").alias("vb"))
    got = S.cosine_pairs(a.join(b, "item_id"), "va", "vb")
    return got.select("item_id", "other_id", F.round("sim", 6).alias("sim"))
