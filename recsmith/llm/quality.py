"""Quality by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained on the two labels of a bounded sample,
``SAMPLE`` documents of each label at most, whole texts; if those are over
``TRAIN_BYTES`` a label, their blocks are drawn by hash, from all places in a
text alike. A text is cut into blocks of
``BLOCK`` bytes, and each block is compressed by itself with either
dictionary, so that a long text is judged by the dictionaries all through
and not by its own beginning. The difference of the two compressed sizes, as
a share of the text's size, becomes a probability by a logistic curve, fitted on
the half of the sample that the dictionaries have not seen. The whole text
is scored in one pass without a shuffle.

Null or empty text: a size difference of zero on that curve. With fewer than
``LEAST`` sample rows of either label there are no dictionaries, and the
score is the share of label 1 among the labelled rows, 0 if there are none.
Of several labels for one ``doc_id`` the highest counts. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import fitted, held_out, query, table
from .toxicity import labelled_sample

SAMPLE = 3000  # labelled rows of each label, at most
LEAST = 8
BLOCK = 1024
TRAIN_BYTES = 96 << 20  # of blocks a dictionary is trained on, about, at most
DICTIONARY = 112 << 10  # bytes
LEVEL = 3


def blocks(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]


def drawn(texts: list[str]) -> list[bytes]:
    """All blocks of ``texts``, or about TRAIN_BYTES of them, by the hash of their bytes and place."""
    total = sum(len((t or "").encode()) for t in texts)
    keep = min(1 << 32, (TRAIN_BYTES << 32) // max(total, 1))
    return [b for t in texts for i, b in enumerate(blocks(t)) if zlib.crc32(b, i) < keep]


class Sizes:
    """Compressed sizes of texts by one dictionary each for bad (0) and good (1) text."""

    def __init__(self, dictionaries: list[bytes]):
        self.by = [zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
            write_checksum=False, write_dict_id=False) for d in dictionaries]

    def difference(self, text: str | None) -> float:
        own = blocks(text)
        bad, good = (sum([len(c.compress(b)) for b in own]) for c in self.by)
        return (bad - good) / sum(map(len, own)) if own else 0.0


def fit(y: np.ndarray, texts: list[str]) -> dict:
    share = float(y.mean()) if len(y) else 0.0
    groups = [[t for t, k in zip(texts, y) if k == v] for v in (0, 1)]
    if min(map(len, groups)) < LEAST:
        return {"dictionaries": None, "share": share}
    dictionaries = []
    for own in groups:
        seen = drawn(own[::2])
        try:
            dictionaries.append(zstandard.train_dictionary(DICTIONARY, seen).as_bytes())
        except zstandard.ZstdError:  # too little text to train on: the text itself
            dictionaries.append(b"".join(seen)[-DICTIONARY:])
    sizes = Sizes(dictionaries)
    x = np.array([sizes.difference(t) for own in groups for t in own[1::2]])
    z = np.repeat([0.0, 1.0], [len(own[1::2]) for own in groups])
    a, b = logistic(x, z)
    return {"dictionaries": dictionaries, "a": a, "b": b, "share": share}


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with both labels of equal weight and a small penalty."""
    scale = float(x.std()) or 1.0
    u = np.column_stack([x / scale, np.ones(len(x))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    t = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(u @ t, -30, 30)))
        grad = u.T @ (weight * (y - p)) - 1e-3 * t
        hess = (u * (weight * p * (1 - p))[:, None]).T @ u + 1e-3 * np.eye(2)
        t = t + np.linalg.solve(hess, grad)
    return float(t[0] / scale), float(t[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 3, remainder: int = 1) -> dict:
    sample, _ = labelled_sample(labels, label, mod, remainder, SAMPLE)

    def learn(rows: pd.DataFrame) -> dict:
        rows = rows.sort_values("doc_id")
        return fit(rows["label"].to_numpy(float), rows["text"].tolist())

    # Broadcast: 2 * SAMPLE rows at most.
    return fitted(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), learn)


def score(docs: DataFrame, model: dict, mod: int = 3, remainder: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted, size_difference: one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        sizes = Sizes(m["dictionaries"]) if m["dictionaries"] else None
        for pdf in batches:
            x = np.array([sizes.difference(t) if sizes else 0.0 for t in pdf["text"]])
            p = 1 / (1 + np.exp(-np.clip(m["a"] * x + m["b"], -30, 30))) if sizes else np.full(len(x), m["share"])
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": p,
                                "predicted": (p >= 0.5).astype("int32"), "size_difference": x})

    # The id goes through pandas as text: a column with nulls would become floating point.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       held_out(F.col("doc_id"), mod, remainder).alias("held_out"), "text")
    return rows.mapInPandas(
        run, "doc_id string, held_out boolean, score double, predicted int, size_difference double").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


@query("op10_quality")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
