"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

Index: each task cuts its documents into shards of bounded rows and tokens
and inverts each by itself, so nothing is shuffled. A list holds blocks of
``BLOCK`` postings (document number in the shard, occurrences), packed as
deltas in the narrowest width. A block's header holds its first and last
document and its impacts: the pairs (occurrences, document length) of the
block that no other pair beats in both. Scores fall with the length and rise
with the occurrences, so the impacts give a block's greatest score once the
corpus totals are known, without reading its postings.

Search, for each item and shard: the item's terms stand in the order of
their bounds in the shard. Lists are added whole, the greatest first, until
the bounds of the rest together are below the ``k``-th best score so far:
no document outside the lists read (the essential ones) can still enter. For
the documents found, the maxima of the blocks they would be in on the other
lists reject most before these blocks are unpacked; only the blocks left are.
Each shard hands on its ``k`` best of each item, and the last step merges
them by score.

Items are taken in blocks of about ``ITEM_TERMS`` terms, so what the driver
and the tasks hold of them is bounded, whatever the size of ``items``.

Words: digits, letters and all non-ASCII characters, A-Z lower-cased; terms
are 64-bit hashes of words. Null text has no terms; documents without terms
are in no list and not counted. Rows that repeat a ``doc_id`` are ranked
each by itself; a null ``doc_id`` stands after the others of its score.
Items without terms, or of terms in no document, give no rows; rows that
repeat an ``item_id`` are ranked each by itself. Empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import query, stored, table
from .words import LETTERS, chunks, hashes, spans

TOP = 20
BLOCK = 128
SHARD_ROWS, SHARD_TOKENS = 1 << 16, 1 << 22  # a shard's bounds; a longer text is a shard of its own
IMPACTS = 8  # pairs of a block's header, at most: the rest go into one that bounds them
ITEM_TERMS = 1 << 17  # distinct terms of items searched together
HELD_POSTINGS = 1 << 22  # unpacked postings a task keeps for the next items
# The scoring formula.
W_SCALE, TF_SCALE, TF_STEP, M_STEP, B = 1000, 1_000_000_000, 1000, 12, 25

TERM = LETTERS.copy()
TERM[ord("0"):ord("9") + 1] = True

INDEX = ("shard long, term long, n int, first binary, last binary, at binary, width binary, "
         "impact_at binary, impacts binary, postings binary")
PARTS = [c.split()[0] for c in INDEX.split(", ")][3:]


def terms_of(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, term hashes, index of each row's first term) of runs of texts."""
    for row, buf, offs in chunks(col):
        starts, ends, first = spans(buf, offs, TERM)
        yield row, hashes(buf, starts, ends).view(np.int64), first


# ---- index ----

def inverted(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, first posting of each and a closing entry, documents, occurrences), sorted by term and document."""
    terms, code = np.unique(term, return_inverse=True)
    key, tf = np.unique(code.astype(np.int64) << 32 | doc, return_counts=True)
    of, docs = key >> 32, key & 0xFFFFFFFF
    return terms, np.searchsorted(of, np.arange(len(terms) + 1)), docs, tf


def _narrow(x: np.ndarray, b0: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bytes (1, 2 or 4) that hold each block's values."""
    top = np.maximum.reduceat(x, b0)
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))


def packed(lists: np.ndarray, docs: np.ndarray, tf: np.ndarray, length: np.ndarray) -> dict[str, tuple]:
    """Column name -> (offsets per list, bytes): the lists cut to blocks."""
    n = np.diff(lists)
    blocks = -(-n // BLOCK)
    of_list = np.repeat(np.arange(len(n)), blocks)
    block_at = np.concatenate([[0], np.cumsum(blocks)])
    b0 = lists[of_list] + (np.arange(len(of_list)) - block_at[of_list]) * BLOCK
    counts = np.minimum(b0 + BLOCK, lists[of_list + 1]) - b0
    own = np.repeat(np.arange(len(b0)), counts)  # block of each posting
    rank = np.arange(len(docs)) - b0[own]
    delta = np.where(rank == 0, 0, np.diff(docs, prepend=0))
    wd, wt = _narrow(delta, b0, counts), _narrow(tf, b0, counts)
    size = counts * (wd + wt)
    start = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(start[-1], np.uint8)
    for values, width, base in ((delta, wd, start[:-1]), (tf, wt, start[:-1] + counts * wd)):
        w = width[own]
        at = base[own] + rank * w
        for k in range(4):
            here = w > k
            out[at[here] + k] = (values[here] >> (8 * k)) & 255
    # Impacts: by block and falling occurrences, the lengths that set a new minimum.
    order = np.lexsort((length[docs], -tf, own))
    ln, blk, occ = length[docs][order], own[order], tf[order]
    low = np.minimum.accumulate(ln - blk * (1 << 40)) + blk * (1 << 40)  # running minimum within a block
    before = np.concatenate([[np.iinfo(np.int64).max], low[:-1]])
    keep = (rank_in(blk) == 0) | (ln < before)
    blk, occ, ln = blk[keep], occ[keep], ln[keep]
    place = rank_in(blk)
    over = place >= IMPACTS  # folded into the last pair kept, which then bounds them: occurrences stay the greater
    last = np.flatnonzero(place == IMPACTS - 1)
    if over.any():
        least = np.minimum.reduceat(ln, np.flatnonzero(place == 0))
        ln[last] = least[blk[last]]
        blk, occ, ln = blk[~over], occ[~over], ln[~over]
    impact_n = np.bincount(blk, minlength=len(b0))
    impact_at = np.concatenate([[0], np.cumsum(impact_n)])
    at_of = lambda width: np.concatenate([[0], np.cumsum(blocks * width)])
    return {"first": (at_of(4), docs[b0].astype("<u4").tobytes()),
            "last": (at_of(4), docs[b0 + counts - 1].astype("<u4").tobytes()),
            "at": (at_of(4), (start[:-1] - start[block_at[of_list]]).astype("<u4").tobytes()),
            "width": (at_of(2), np.stack([wd, wt], axis=1).astype(np.uint8).tobytes()),
            "impact_at": (at_of(4), (impact_at[1:] - impact_at[block_at[of_list]]).astype("<u4").tobytes()),
            "impacts": (impact_at[block_at] * 8, np.stack([occ, ln], axis=1).astype("<u4").tobytes()),
            "postings": (start[block_at], out.tobytes())}


def rank_in(sorted_key: np.ndarray) -> np.ndarray:
    """Place of each entry in its run of equal keys."""
    if not len(sorted_key):
        return sorted_key
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    first = np.flatnonzero(new)
    return np.arange(len(sorted_key)) - first[np.cumsum(new) - 1]


def build_index(docs: DataFrame, shard_rows: int = SHARD_ROWS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """The lists of all terms, one row per shard and term, written to the scratch folder: shards are numbered by task,
    so a second reading of ``docs`` must not number them anew. Rows of null ``term`` hold a shard's documents: ids
    in ``first``, which ids are null in ``width``, lengths in ``last``."""
    names = [c.split()[0] for c in INDEX.split(", ")]

    def shard_rows_of(shard, ids, no_id, doc, term) -> Iterator[pa.RecordBatch]:
        doc, term, ids = np.concatenate(doc), np.concatenate(term), np.concatenate(ids)
        length = np.bincount(doc, minlength=len(ids))
        has = {"first": ids.astype("<i8").tobytes(), "width": np.concatenate(no_id).astype(np.uint8).tobytes(),
               "last": length.astype("<i8").tobytes()}
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int64()), pa.array([None], pa.int64()),
             pa.array([int(np.count_nonzero(length))], pa.int32()),
             *(pa.array([has.get(c, b"")], pa.binary()) for c in PARTS)], names)
        if not len(term):
            return
        terms, lists, of, tf = inverted(doc, term)
        columns = packed(lists, of, tf, length)
        arrays = [pa.array(np.full(len(terms), shard)), pa.array(terms), pa.array(np.diff(lists).astype(np.int32))]
        for c in PARTS:
            offs, data = columns[c]
            arrays.append(pa.Array.from_buffers(pa.binary(), len(terms), [
                None, pa.py_buffer(offs.astype(np.int32).tobytes()), pa.py_buffer(data)]))
        yield pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        ids, no_id, doc, term, rows, size = [], [], [], [], 0, 0
        for batch in batches:
            key = batch.column(0)
            for row, found, first in terms_of(batch.column(1)):
                n = np.diff(first)
                if rows and (rows + len(n) > shard_rows or size + len(found) > shard_tokens):
                    yield from shard_rows_of(shard, ids, no_id, doc, term)
                    shard += 1
                    ids, no_id, doc, term, rows, size = [], [], [], [], 0, 0
                own = key.slice(row, len(n))
                no_id.append(own.is_null().to_numpy(zero_copy_only=False))
                ids.append(own.fill_null(0).to_numpy(zero_copy_only=False))
                doc.append(np.repeat(np.arange(rows, rows + len(n)), n))
                term.append(found)
                rows, size = rows + len(n), size + len(found)
        if rows:
            yield from shard_rows_of(shard, ids, no_id, doc, term)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(rows.mapInArrow(run, INDEX), "search-index")


def totals(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"n": [int(np.frombuffer(x, "<i8").sum()) for x in pdf["last"]]}, dtype="int64")

    own = index.where("term IS NULL")
    docs = own.agg(F.sum("n")).first()[0] or 0
    return int(docs), int(own.select("last").mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0)


# ---- search ----

def share(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a posting's score beside the weight."""
    m = 100 - B + (B * length * n_docs) // n_terms
    return (TF_SCALE * tf) // (TF_STEP * tf + M_STEP * m)


class List:
    """A term's list in one shard: headers as arrays, postings packed."""

    def __init__(self, row, weight: int, n_docs: int, n_terms: int):
        self.weight, self.n = weight, row["n"]
        self.first, self.last, self.at, self.impact_at = (
            np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("first", "last", "at", "impact_at"))
        self.width = np.frombuffer(row["width"], np.uint8).reshape(-1, 2)
        self.data = np.frombuffer(row["postings"], np.uint8)
        pairs = np.frombuffer(row["impacts"], "<u4").reshape(-1, 2).astype(np.int64)
        best = weight * share(pairs[:, 0], pairs[:, 1], n_docs, n_terms)
        self.block_max = np.maximum.reduceat(best, np.concatenate([[0], self.impact_at[:-1]]))
        self.max = int(self.block_max.max())
        self.unpacked = 0  # blocks read, for tests

    def block_of(self, docs: np.ndarray) -> np.ndarray:
        """The block that may hold each document, -1 for none."""
        b = np.searchsorted(self.last, docs)
        b[b == len(self.last)] = -1
        return np.where((b >= 0) & (self.first[b] <= docs), b, -1)

    def unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, occurrences) of the postings of some blocks."""
        self.unpacked += len(blocks)
        counts = np.minimum(self.n - blocks * BLOCK, BLOCK)
        own = np.repeat(np.arange(len(blocks)), counts)
        rank = rank_in(own)
        out = []
        base = self.at[blocks]
        for k in (0, 1):
            width = self.width[blocks, k].astype(np.int64)
            at, w = base[own] + rank * width[own], width[own]
            values = self.data[at].astype(np.int64)
            for j in range(1, int(width.max(initial=1))):
                here = w > j
                values[here] |= self.data[at[here] + j].astype(np.int64) << (8 * j)
            out.append(values)
            base = base + counts * width
        delta, tf = out
        run = np.cumsum(delta)
        head = np.concatenate([[0], np.cumsum(counts)[:-1]])  # a block's first delta is 0
        return run - run[head][own] + self.first[blocks][own], tf


def best_of(lists: list[tuple[int, List]], length: np.ndarray, order: np.ndarray, k: int, n_docs: int, n_terms: int,
            whole=None) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the ``k`` best of a shard, ties by ``order``; ``lists`` holds (repeats, list)."""
    whole = whole or (lambda x: scored(x, np.arange(len(x.first)), length, n_docs, n_terms))
    lists = sorted(lists, key=lambda x: -x[0] * x[1].max)
    rest = np.concatenate([np.cumsum([q * x.max for q, x in lists][::-1])[::-1], [0]]) if lists else np.zeros(1)
    score = np.zeros(len(length), np.int64)
    floor, done = 0, 0
    for q, x in lists:  # essential lists
        if rest[done] < floor or rest[done] == 0:
            break
        docs, s = whole(x)
        score[docs] += q * s
        done += 1
        if score.max() > rest[done]:  # else the floor cannot end the loop yet
            floor = kth(score, k)
    found = np.flatnonzero(score)
    own = score[found]
    tail = lists[done:]
    if tail and len(found):
        left = own + rest[done] >= floor
        found, own = found[left], own[left]
        bounds = lambda q, x, docs: np.where((b := x.block_of(docs)) >= 0, q * x.block_max[b], 0)
        more = np.zeros(len(found), np.int64)  # what the maxima of a document's blocks on the lists ahead allow
        for q, x in tail:
            more += bounds(q, x, found)
        for q, x in tail:
            left = own + more >= floor
            found, own, more = found[left], own[left], more[left]
            block = x.block_of(found)
            more = more - np.where(block >= 0, q * x.block_max[block], 0)
            need = np.unique(block[block >= 0])
            if len(need):
                docs, s = scored(x, need, length, n_docs, n_terms)
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                own = own + np.where(docs[at] == found, q * s[at], 0)
            floor = max(floor, kth(own, k))
    best = np.lexsort((order[found], -own))[:k]
    best = best[own[best] > 0]
    return found[best], own[best]


def kth(score: np.ndarray, k: int) -> int:
    """The ``k``-th best score, 0 if there are fewer."""
    return int(np.partition(score, len(score) - k)[len(score) - k]) if len(score) >= k else 0


def scored(x: List, blocks: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int):
    docs, tf = x.unpack(blocks)
    return docs, x.weight * share(tf, length[docs], n_docs, n_terms)


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, terms, repeats): one row per row of ``items`` that has terms; ``item`` numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = TaskContext.get().partitionId() << 40
        for batch in batches:
            for row, found, first in terms_of(batch.column(1)):
                for i in range(len(first) - 1):
                    terms, n = np.unique(found[first[i]:first[i + 1]], return_counts=True)
                    item += 1
                    if len(terms):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([item]), batch.column(0).slice(row + i, 1), pa.array([terms.tolist()]),
                             pa.array([n.tolist()], pa.list_(pa.int64()))], ["item", "item_id", "terms", "repeats"])

    kind = items.schema["item_id"].dataType.simpleString()
    return items.select("item_id", "text").mapInArrow(
        run, f"item long, item_id {kind}, terms array<long>, repeats array<long>")


def search(index: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = ITEM_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each item with a score above 0."""
    spark = index.sparkSession
    items = stored(item_terms(items), "items")
    n_blocks = max(1, -(-(items.agg(F.sum(F.size("terms"))).first()[0] or 0) // block_terms))
    n_docs, n_terms = totals(index)
    found = []
    for b in range(n_blocks):  # a block: about ITEM_TERMS terms, or one longer item
        block = items.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == b)
        rows = block.select("item", "terms", "repeats").toPandas()
        if len(rows) and n_docs:
            found.append(_search_block(spark, index, rows, k, n_docs, n_terms))
    kind = items.schema["item_id"].dataType.simpleString()
    if not found:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    best = reduce(DataFrame.union, found)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search_block(spark, index: DataFrame, rows: pd.DataFrame, k: int, n_docs: int, n_terms: int) -> DataFrame:
    """(item, doc_id, score): the shards' best for the items of one block."""
    wanted = np.unique(np.concatenate([np.asarray(t, np.int64) for t in rows["terms"]]))
    terms = F.broadcast(spark.createDataFrame(pd.DataFrame({"term": wanted})))
    lists = index.join(terms, "term", "left_semi")
    df = lists.groupBy("term").agg(F.sum("n").alias("df")).collect()  # the block's terms
    weight = {r.term: math.floor(W_SCALE * math.log((2 * n_docs + 2) / (2 * r.df + 1))) for r in df}
    queries = [(int(i), list(zip(np.asarray(t).tolist(), np.asarray(n).tolist())))
               for i, t, n in zip(rows["item"], rows["terms"], rows["repeats"])]
    sent = spark.sparkContext.broadcast((weight, queries))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        weight, queries = sent.value
        docs = pdf[pdf["term"].isna()].iloc[0]
        length, ids = np.frombuffer(docs["last"], "<i8"), np.frombuffer(docs["first"], "<i8")
        no_id = np.frombuffer(docs["width"], np.uint8).astype(bool)
        order = np.empty(len(ids), np.int64)
        order[np.lexsort((ids, no_id))] = np.arange(len(ids))
        rows = {int(row["term"]): row for row in pdf[pdf["term"].notna()].to_dict("records")}
        own = {t: List(row, weight[t], n_docs, n_terms) for t, row in rows.items() if weight[t] > 0}
        held: OrderedDict[int, tuple] = OrderedDict()
        size = 0

        def whole(x: List):
            """A list's documents and scores; the last ones used are kept, HELD_POSTINGS at most."""
            nonlocal size
            if id(x) not in held:
                held[id(x)] = scored(x, np.arange(len(x.first)), length, n_docs, n_terms)
                size += x.n
                while size > HELD_POSTINGS and len(held) > 1:
                    size -= len(held.popitem(last=False)[1][0])
            held.move_to_end(id(x))
            return held[id(x)]

        item, at, score = [], [], []
        for number, q in queries:
            mine = [(n, own[t]) for t, n in q if t in own]
            d, s = best_of(mine, length, order, k, n_docs, n_terms, whole)
            item.append(np.full(len(d), number))
            at.append(d)
            score.append(s)
        at = np.concatenate(at)
        names = pd.Series(ids[at].astype(str), dtype=object).where(~no_id[at], None)  # as text: exact beside nulls
        return pd.DataFrame({"item": np.concatenate(item), "doc_id": names, "score": np.concatenate(score)})

    # The term goes through pandas as text for the same reason.
    needed = lists.unionByName(index.where("term IS NULL")).withColumn("term", F.col("term").cast("string"))
    return needed.groupBy("shard").applyInPandas(run, "item long, doc_id string, score long").withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def rank(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    return search(build_index(docs), items, k)


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
SQL = rf"""
WITH docs AS (SELECT doc_id, {_TERMS} AS w FROM documents),
stat AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM docs WHERE len(w) > 0),
asked AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
          GROUP BY item_id, term),
post AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM docs)
         GROUP BY doc_id, n, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0 * any_value(n_docs) + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
           FROM post, stat GROUP BY term),
part AS (SELECT doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS s
         FROM post p JOIN weight USING (term), stat),
scores AS (SELECT item_id, doc_id, CAST(sum(q * s) AS BIGINT) AS score FROM asked JOIN part USING (term)
           GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scores WHERE score > 0) WHERE rank <= 20
"""


@query("op13_search", SQL)
def op13(spark, sf_dir):
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
