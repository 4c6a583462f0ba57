"""Centroid clustering of integer vectors by a LAESA pivot table.

A vector component x becomes the integer floor(256 * x). The distances of
every vector to a few fixed pivots are stored once, beside the vector. By
the triangle inequality the largest difference between a vector's and a
centroid's pivot distances bounds their distance from below, so each round
visits a vector's centroids in the order of that bound and stops at the
first bound above the best exact distance. Only the centroids visited get
exact 64-bit integer distances; all results are exact.

A round reads the stored vectors, sums them per centroid inside each task
and adds the tasks' sums up in Spark; the driver sees one row per centroid.

Kept are vectors of exactly ``DIM`` components, none null or non-finite;
other rows are left out. Components beyond +-2**27 (x beyond +-524288) are
held there, so that squared distances fit 64 bits. The first centroids are
the vectors with the least hash of their id, equal hashes (repeated ids) in
the order of the vectors; a null id comes last. Fewer vectors than centroids
give fewer centroids, an empty table gives no rows. Repeated rows are
clustered each by itself. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import query, stored, table

DIM, CENTROIDS, ROUNDS = 64, 40, 5
PIVOTS = 12
SCALE = 256
HOLD = 1 << 27
SLACK = 1e-9  # relative error allowed to the floating-point roots of the bounds


def integer_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, q): the kept vectors in integers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = lambda x: F.least(F.greatest(F.floor(x.cast("double") * SCALE), F.lit(-HOLD)),
                              F.lit(HOLD)).cast("int")
    return vectors.where((F.size("embedding") == dim) & F.forall("embedding", finite)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("q"))


def start_order(vec_id: Column) -> Column:
    return F.sha2(F.concat(F.lit("2:"), vec_id.cast("string")), 256)


def chosen_pivots(points: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Points far from each other: each next one has the greatest least distance to those taken."""
    taken = [0]
    least = squared(points, points[0])
    while len(taken) < min(n, len(points)) and least.max() > 0:
        taken.append(int(least.argmax()))
        least = np.minimum(least, squared(points, points[taken[-1]]))
    return points[taken]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return np.einsum("...i,...i->...", d, d)


def nearest(q: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """(cluster, squared distance, exact distances taken) of each row of ``q``; ties go to the smaller number."""
    own = np.sqrt(squared(centroids[:, None], pivots[None]).astype(np.float64))
    bound = np.zeros((len(q), len(centroids)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - own[None, :, p]), out=bound)
    bound *= 1 - SLACK
    bound -= SLACK * (1 + to_pivots.max(axis=1, initial=0))[:, None]  # the roots' own rounding
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(q), np.iinfo(np.int64).max)
    cluster = np.full(len(q), len(centroids))
    alive, taken = np.arange(len(q)), 0
    for r in range(len(centroids)):
        c = order[alive, r]
        open_ = bound[alive, c] <= np.sqrt(best[alive].astype(np.float64)) * (1 + SLACK)
        alive, c = alive[open_], c[open_]
        if not len(alive):
            break
        taken += len(alive)
        d = squared(q[alive], centroids[c])
        better = (d < best[alive]) | ((d == best[alive]) & (c < cluster[alive]))
        best[alive[better]], cluster[alive[better]] = d[better], c[better]
    return cluster, best, taken


def _matrix(col: pa.Array, dtype) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(col), -1)


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, q, to_pivots): the vectors with their distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            q = _matrix(batch.column(1), np.int64)
            d = np.stack([np.sqrt(squared(q, p).astype(np.float64)) for p in pivots], axis=1)
            at = pa.array(np.arange(len(q) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(at, pa.array(d.reshape(-1)))],
                ["vec_id", "q", "to_pivots"])

    return vectors.mapInArrow(run, "vec_id long, q array<int>, to_pivots array<double>")


def moved(points: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of their vectors, empty ones unchanged."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centroids.shape, np.int64)
        count = np.zeros(len(centroids), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            q = _matrix(batch.column(0), np.int64)
            cluster, _, _ = nearest(q, _matrix(batch.column(1), np.float64), centroids, pivots)
            order = np.argsort(cluster, kind="stable")
            kinds, first = np.unique(cluster[order], return_index=True)
            total[kinds] += np.add.reduceat(q[order], first, axis=0)
            count += np.bincount(cluster, minlength=len(centroids))
        at = np.flatnonzero(count)
        offs = pa.array(np.arange(len(at) + 1, dtype=np.int32) * dim)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(count[at]), pa.ListArray.from_arrays(offs, pa.array(total[at].reshape(-1)))],
            ["cluster", "n", "total"])

    sums = (points.select("q", "to_pivots").mapInArrow(run, "cluster long, n long, total array<long>")
            .groupBy("cluster").agg(F.sum("n").alias("n"),
                                    F.array(*[F.sum(F.col("total")[i]) for i in range(dim)]).alias("total")))
    out = centroids.copy()
    for r in sums.collect():  # one row per centroid
        out[r.cluster] = [t // r.n for t in r.total]
    return out


def cluster(vectors: DataFrame, n_centroids: int = CENTROIDS, rounds: int = ROUNDS,
            n_pivots: int = PIVOTS, dim: int = DIM) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row per kept vector."""
    kept = integer_vectors(vectors, dim)
    start = kept.orderBy(start_order(F.col("vec_id")).asc_nulls_last(), "q").limit(n_centroids).collect()
    schema = "vec_id long, cluster int, distance long"
    spark = vectors.sparkSession
    if not start:
        return spark.createDataFrame(
            [], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r.q for r in start], np.int64)
    pivots = chosen_pivots(centroids, n_pivots)
    points = stored(pivot_table(kept, pivots), "pivot-table")
    for _ in range(rounds):
        new = moved(points, centroids, pivots)
        if (new == centroids).all():
            break  # all later rounds would give the same
        centroids = new

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            c, d, _ = nearest(_matrix(batch.column(1), np.int64), _matrix(batch.column(2), np.float64),
                              centroids, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(c.astype(np.int32)), pa.array(d)], ["vec_id", "cluster", "distance"])

    assigned = stored(points.mapInArrow(assign, schema), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # one row per centroid
    total = sum(r.s for r in sums)
    facts = [(r.cluster, r.s, total, hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode())
              .hexdigest()) for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds one after the other, every distance computed."""
    nearest_of = """SELECT vec_id, any_value(q) AS q, min({{'d': d, 'c': c}}) AS m FROM (
        SELECT k.vec_id, k.q, c.cluster AS c, CAST(list_sum([(z[1] - z[2]) * (z[1] - z[2])
               for z in list_zip(k.q, c.q)]) AS BIGINT) AS d FROM kept k CROSS JOIN {c} c) GROUP BY vec_id"""
    parts = [f"""kept AS (SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
        FROM embeddings WHERE len(embedding) = {DIM}
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)""",
             f"""c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, q FROM (
        SELECT q, sha256('2:' || vec_id) AS h FROM kept ORDER BY h LIMIT {CENTROIDS}))"""]
    for r in range(ROUNDS):
        parts.append(f"a{r} AS ({nearest_of.format(c=f'c{r}')})")
        parts.append(f"""c{r + 1} AS (SELECT c.cluster, coalesce(n.q, c.q) AS q FROM c{r} c LEFT JOIN (
            SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY p) AS q FROM (
                SELECT cluster, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
                    SELECT m.c AS cluster, unnest(q) AS x, unnest(range({DIM})) AS p FROM a{r}) GROUP BY cluster, p)
            GROUP BY cluster) n USING (cluster))""")
    parts.append(f"a{ROUNDS} AS ({nearest_of.format(c=f'c{ROUNDS}')})")
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, m.d AS distance,
       CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN c{ROUNDS} c ON c.cluster = m.c"""


SQL = _sql()


@query("op11_centroids", SQL)
def op11(spark, sf_dir):
    return cluster(table(spark, sf_dir, "embeddings"))
