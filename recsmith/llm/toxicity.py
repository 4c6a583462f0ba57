"""Toxicity by a factorization machine over hashed terms.

Terms are words (runs of letters, A-Z lower-cased) and the beginnings of
words, hashed to ``BUCKETS``, with marks for those that repeat; a document is
the set of its buckets. The model
is fitted on a bounded sample of the labelled rows, ``SAMPLE`` of each label
at most, by the ``FEATURES`` buckets that tell the labels apart best
(chi-squared, over ``CHI``): a bias, a weight per bucket and ``FACTORS`` interaction
factors per bucket, whose products score pairs of terms that no sum of
single weights can. Each sampled row counts as 1 / the sampling rate of its
label, so the prior and the class weight are those of all labelled rows, however
many there are. Scoring reads whole texts, one pass, no shuffle.

Null or empty text scores by the bias. Rows without a label, or whose
labels are null, are only scored; of several labels for one ``doc_id`` the
highest counts. Without any labelled row of both kinds the score is the
share of label 1 among the labelled rows, 0 if there are none. Other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fitted, held_out, query, table
from .words import LETTERS, chunks, hashes, list_array, spans

BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6, 7)  # bytes
REPEATS = (2, 4)
SAMPLE = 10_000  # labelled rows of each label, at most
FEATURES = 4096
FACTORS = 4
CHI = 6.6  # least chi-squared of a bucket the model takes: one chance in a hundred
EPOCHS, BATCH, RATE, DECAY = 40, 128, 0.02, 1e-5


def terms(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, row within them, bucket) of all terms, for runs of rows."""
    for row, buf, offs in chunks(col):
        starts, ends, first = spans(buf, offs, LETTERS)
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
        docs, found = [doc], [hashes(buf, starts, ends)]
        for n in BEGINNINGS:
            longer = ends - starts > n
            docs.append(doc[longer])
            found.append(hashes(buf, starts[longer], starts[longer] + n) + np.uint64(n))
        yield row, len(offs) - 1, np.concatenate(docs), (np.concatenate(found) % np.uint64(BUCKETS)).astype(np.int64)


def present(n: int, doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket), sorted and distinct; a bucket that a row has twice or four times has marks of its own for that."""
    key = np.sort(doc * BUCKETS + bucket)
    first = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
    out = [key[first]]
    for times in REPEATS:
        m = max(0, len(key) - times + 1)
        again = key[:m][first[:m] & (key[:m] == key[times - 1:])]
        out.append(again - again % BUCKETS + (again % BUCKETS * 31 + times) % BUCKETS)
    key = np.unique(np.concatenate(out))
    return key // BUCKETS, key % BUCKETS


def labelled_sample(labels: DataFrame, label: str, mod: int, remainder: int, per_label: int) -> tuple[DataFrame, dict]:
    """(doc_id, label): the rows to learn from, about ``per_label`` of each label at most, chosen by the id's hash.

    With it the share of its rows that each label has in the sample.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = rows.where(~held_out(F.col("doc_id"), mod, remainder))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = {k: min(1 << 30, (per_label << 30) // n) for k, n in counts.items()}
    share = F.lit(0)
    for k, bound in bounds.items():
        share = F.when(F.col("label") == k, F.lit(bound)).otherwise(share)
    return (rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share),
            {k: bound / (1 << 30) for k, bound in bounds.items()})


def fit(y: np.ndarray, docs: list[np.ndarray], seed: int = 7, rates: dict | None = None) -> dict:
    """The machine's parameters; ``docs`` are the documents' distinct buckets, ``rates`` the labels' sampling rates."""
    rates = rates or {}
    stands_for = np.where(y == 1, 1 / rates.get(1, 1.0), 1 / rates.get(0, 1.0))  # labelled rows per sampled row
    share = float(stands_for[y == 1].sum() / stands_for.sum()) if len(y) else 0.0
    model = {"slot": np.full(BUCKETS, -1, np.int32), "w0": np.log(max(share, 1e-9) / max(1 - share, 1e-9)),
             "w": np.zeros(0), "v": np.zeros((0, FACTORS))}
    if share in (0.0, 1.0):
        return model
    df, hit = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for at in range(0, len(docs), BATCH):
        own = docs[at:at + BATCH]
        flat, of = np.concatenate(own), np.repeat(y[at:at + BATCH], [len(d) for d in own])
        df += np.bincount(flat, minlength=BUCKETS)
        hit += np.bincount(flat, weights=of, minlength=BUCKETS)
    n, pos = len(y), y.sum()
    with np.errstate(all="ignore"):
        chi = n * (hit * n - df * pos) ** 2 / (df * (n - df) * pos * (n - pos))
    chi[(df < 3) | (df >= n)] = 0
    best = np.argsort(-chi, kind="stable")[:FEATURES]
    best = best[chi[best] > CHI]
    model["slot"][best] = np.arange(len(best))
    slots = [s[s >= 0] for s in (model["slot"][d] for d in docs)]
    rng = np.random.default_rng(seed)
    weight = np.where(y == 1, np.sqrt((1 - share) / share), 1.0) * stands_for / stands_for.mean()
    params = [np.array([model["w0"]]), np.zeros(len(best)), rng.normal(0, 0.05, (len(best), FACTORS))]
    m, s, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at:at + BATCH]
            j = np.concatenate([slots[k] for k in rows])
            r = np.repeat(np.arange(len(rows)), [len(slots[k]) for k in rows])
            w0, w, v = params
            total = np.zeros((len(rows), FACTORS))
            np.add.at(total, r, v[j])
            z = w0[0] + _raw(w, v, r, j, len(rows), total)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) * weight[rows] / len(rows)
            grads = [np.array([g.sum()]), np.bincount(j, g[r], len(w)) + DECAY * w, DECAY * v]
            np.add.at(grads[2], j, g[r][:, None] * (total[r] - v[j]))
            step += 1
            for p, d, a, b in zip(params, grads, m, s):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    model["w0"], model["w"], model["v"] = float(params[0][0]), params[1], params[2]
    return model


def _raw(w, v, r, j, n, total=None) -> np.ndarray:
    """Linear and pairwise part: half of (sum of factors) squared less the sum of their squares."""
    out = np.bincount(r, w[j], n)
    for f in range(v.shape[1]):
        s = np.bincount(r, v[j, f], n) if total is None else total[:, f]
        out = out + 0.5 * (s ** 2 - np.bincount(r, v[j, f] ** 2, n))
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 5, remainder: int = 0) -> dict:
    """Fit on the sample in one task; the model of FEATURES * (FACTORS + 1) numbers comes back."""
    sample, rates = labelled_sample(labels, label, mod, remainder, SAMPLE)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for _, n, doc, bucket in terms(batch.column(1)):
                doc, bucket = present(n, doc, bucket)
                own += np.split(bucket.astype(np.int32), np.searchsorted(doc, np.arange(1, n)))
            yield pa.RecordBatch.from_arrays([batch.column(0), list_array(own, pa.int32())], ["label", "buckets"])

    def learn(rows: pd.DataFrame) -> dict:
        return fit(rows["label"].to_numpy(float), [np.asarray(x) for x in rows["buckets"]], rates=rates)

    # Broadcast: 2 * SAMPLE rows at most.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("label", "text")
    return fitted(rows.mapInArrow(read, "label int, buckets array<int>"), learn)


def score(docs: DataFrame, model: dict, mod: int = 5, remainder: int = 0, carry: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``; with ``carry`` also ``row``, that row itself."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    extra = ["row"] if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            z = np.full(batch.num_rows, m["w0"])
            text = batch.column("row").field("text") if carry else batch.column("text")
            for row, n, doc, bucket in terms(text):
                doc, bucket = present(n, doc, bucket)
                slot = m["slot"][bucket]
                hit = slot >= 0
                if hit.any():
                    key = np.unique(doc[hit] * FEATURES + slot[hit])
                    z[row:row + n] += _raw(m["w"], m["v"], key // FEATURES, key % FEATURES, n)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                 *(batch.column(c) for c in extra)], ["doc_id", "held_out", "score", "predicted", *extra])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       held_out(F.col("doc_id"), mod, remainder).alias("held_out"),
                       F.struct("*").alias("row") if carry else F.col("text"))
    schema = "doc_id long, held_out boolean, score double, predicted int"
    return rows.mapInArrow(run, schema + (f", row {rows.schema['row'].dataType.simpleString()}" if carry else ""))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that a model fitted on them and ``labels`` does not predict as toxic."""
    return score(docs, train(docs, labels), carry=True).where("predicted = 0").select("row.*")


@query("op2_toxicity")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
