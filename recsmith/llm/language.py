"""Language identification by nearest centroids of byte trigrams.

A document is the L2-normalised TF-IDF vector of its trigrams of letters
(other characters count as one blank), hashed to ``DIMS``. Each language has
up to ``CENTROIDS`` centroids, found by spherical k-means over a bounded
sample of the rows to learn from (``SAMPLE`` in all, shared evenly between
the languages). A document gets the language of its nearest centroid by
cosine, which is also its score. It is marked ``rejected`` when it is
farther off than all but ``REJECT`` of that language's learning rows.

A text that is null or has no letter is ``und`` with score 0 and rejected.
So is every text when there is nothing to learn from. Rows with a null
``lang`` are only scored. Other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fitted, held_out, query, table
from .words import LETTERS, chunks

DIMS = 4096
SAMPLE = 6000  # rows to learn from, at most
CENTROIDS, ROUNDS = 4, 12
REJECT = 0.01
UNKNOWN = "und"


def trigram_counts(col: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, rows x DIMS counts) for runs of rows of an Arrow column."""
    for row, buf, offs in chunks(col):
        n = len(offs) - 1
        b = np.where(LETTERS[buf], buf, 32).astype(np.uint32)
        doc = np.repeat(np.arange(n), np.diff(offs))
        h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA77)) ^ (b[2:] * np.uint32(0xC2B2AE3D))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        keep = (doc[:-2] == doc[2:]) & (b[1:-1] != 32)
        key = doc[:-2][keep] * DIMS + (h[keep] >> np.uint32(20)).astype(np.int64)
        yield row, np.bincount(key, minlength=n * DIMS).reshape(n, DIMS).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(langs: list[str], counts: np.ndarray) -> dict | None:
    """idf, centroids, the language of each and the cosine below which it rejects."""
    if not langs:
        return None
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(1)
    x, lang = unit(np.log1p(counts) * idf), np.array(langs)
    centroids, names, floors = [], [], []
    for name in sorted(set(langs)):
        own = x[lang == name]
        centre = unit(own.mean(axis=0, keepdims=True))
        while len(centre) < min(CENTROIDS, len(own)):  # farthest first
            centre = np.vstack([centre, own[[np.argmin((own @ centre.T).max(axis=1))]]])
        for _ in range(ROUNDS):
            at = np.argmax(own @ centre.T, axis=1)
            centre = unit(np.vstack([own[at == k].mean(axis=0) if (at == k).any() else centre[k]
                                     for k in range(len(centre))]))
        near = (own @ centre.T).max(axis=1)
        centroids.append(centre)
        names += [name] * len(centre)
        floors += [float(np.quantile(near, REJECT))] * len(centre)
    return {"idf": idf, "centroids": np.vstack(centroids), "names": names, "floors": np.array(floors)}


def train(docs: DataFrame, mod: int = 3, remainder: int = 1) -> dict | None:
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id"), mod, remainder))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, min(1 << 30, ((SAMPLE // len(counts)) << 30) // n)).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(mod)), F.lit(1 << 30)) < share).select("lang", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x in trigram_counts(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(row, len(x)), pa.array([r.tobytes() for r in x], pa.binary())],
                    ["lang", "counts"])

    def learn(rows: pd.DataFrame) -> dict | None:
        counts = [np.frombuffer(v, np.float32) for v in rows["counts"]]
        return fit(rows["lang"].tolist(), np.vstack(counts) if counts else np.empty((0, DIMS)))

    return fitted(sample.mapInArrow(read, "lang string, counts binary"), learn)


def identify(docs: DataFrame, model: dict | None, mod: int = 3, remainder: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected: one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            pred, cos = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            for row, x in trigram_counts(batch.column("text")) if m else ():
                near = unit(np.log1p(x) * m["idf"]) @ m["centroids"].T
                pred[row:row + len(x)] = near.argmax(axis=1)
                cos[row:row + len(x)] = near.max(axis=1)
            known = batch.column("lettered").to_numpy(zero_copy_only=False).astype(bool) & (pred >= 0)
            names = np.array([*(m["names"] if m else []), UNKNOWN], object)[np.where(known, pred, -1)]
            cos = np.where(known, np.clip(cos, 0, 1), 0)
            floor = np.append(m["floors"] if m else [], 2.0)[np.where(known, pred, -1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(cos),
                 pa.array(cos < floor)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id"), mod, remainder).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


@query("op7_language_id")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
