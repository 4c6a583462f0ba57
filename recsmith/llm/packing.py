"""Cost-balanced packing of token ids into sequences of fixed capacity.

The cost of a sequence is estimated as ``linear * n + quadratic * n ** 2``
summed over its pieces (attention runs within a piece). Documents longer
than a sequence give full sequences first; what remains is assigned in
descending length to the lowest-cost sequence that has room for it. When
none has, the piece is cut over the lowest-cost sequences with any room, so
a packing group of T remaining tokens fills ceil(T / capacity) sequences and
wastes less than one of them.

Groups are runs of rows of one input partition, bounded by ``GROUP_TOKENS``:
nothing is shuffled, no task holds more than one group, and a lost task
gives the same pieces again.

Null text: empty, which is the single end id. A null ``doc_id`` stays null.
Repeated rows are packed once each. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import query, table
from .pretokens import BYTE_RANKS, default_path, token_ids

CAPACITY = 1024
GROUP_TOKENS = 1 << 21
LINEAR, QUADRATIC = 1.0, 1.0 / CAPACITY  # relative cost of the dense layers and of attention
SCHEMA = ("doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_cost double")


def assign(lengths: np.ndarray, capacity: int, linear: float = LINEAR, quadratic: float = QUADRATIC):
    """(item, start in item, length, sequence, offset) of each piece, and the cost of each sequence."""
    pieces: list[tuple[int, int, int, int, int]] = []
    full = lengths // capacity
    n_full = int(full.sum())
    rest = lengths - full * capacity
    n_seq = n_full + -(-int(rest.sum()) // capacity)
    cost = np.zeros(n_seq)
    cost[:n_full] = linear * capacity + quadratic * capacity ** 2
    seq = 0
    for i in np.flatnonzero(full):
        for k in range(int(full[i])):
            pieces.append((int(i), k * capacity, capacity, seq, 0))
            seq += 1
    used = np.zeros(n_seq - n_full, np.int64)
    own = np.zeros(n_seq - n_full)
    order = np.argsort(-rest, kind="stable")
    for i in order[: int(np.count_nonzero(rest))]:
        start, left = int(full[i]) * capacity, int(rest[i])
        while left:
            fits = capacity - used >= left
            room = fits if fits.any() else used < capacity
            s = int(np.argmin(np.where(room, own, np.inf)))
            n = min(left, capacity - int(used[s]))
            pieces.append((int(i), start, n, n_full + s, int(used[s])))
            used[s] += n
            own[s] += linear * n + quadratic * n ** 2
            start, left = start + n, left - n
    cost[n_full:] = own
    return pieces, cost


def pack(docs: DataFrame, ranks_path: str, capacity: int = CAPACITY,
         group_tokens: int = GROUP_TOKENS, end_id: int = 0) -> DataFrame:
    """One row per piece, with the columns of ``SCHEMA``."""

    def pieces_of(ids: list, tokens: list[np.ndarray], first_seq: int) -> tuple[pd.DataFrame, int]:
        lengths = np.array([len(t) for t in tokens])
        found, cost = assign(lengths, capacity)
        item, start, length, seq, offset = (np.array(x) for x in zip(*found))
        crc = [zlib.crc32(tokens[i][s:s + n].tobytes()) for i, s, n, _, _ in found]
        return pd.DataFrame({
            "doc_id": pd.Series(ids, dtype=object).take(item).to_numpy(), "start": start, "length": length, "ids_crc32": crc,
            "doc_tokens": lengths[item], "sequence_id": first_seq + seq, "offset": offset,
            "sequence_cost": cost[seq]}), first_seq + len(cost)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seq, ids, tokens, size = TaskContext.get().partitionId() << 32, [], [], 0
        end = np.array([end_id], "<u4")
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids.append(doc_id)
                tokens.append(np.concatenate([token_ids(ranks_path, text or ""), end]))
                size += len(tokens[-1])
                if size >= group_tokens:
                    out, seq = pieces_of(ids, tokens, seq)
                    yield out
                    ids, tokens, size = [], [], 0
        if ids:
            yield pieces_of(ids, tokens, seq)[0]

    # The id goes through pandas as text: a column with nulls would become floating point.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, SCHEMA)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


@query("op5_packing")
def op5(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), default_path(BYTE_RANKS))
