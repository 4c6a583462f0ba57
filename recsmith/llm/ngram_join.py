"""N-gram Jaccard join by signature trees.

A document's set is its distinct word 5-grams. Sets link when
``100 * overlap >= 75 * union``. All links count, the components are exact:

1. One total order of all shingles puts the frequent ones last (a bounded
   list, counted over all documents), the others by their hash. A set lacks
   at most a quarter of a set it links with, so two sets that link share at
   least ``k`` of the first ``n // 4 + k`` of each, for any ``k``. Each such
   shingle is the root of a signature tree over the sets that have it so
   early. With ``k = 1 + n // 12``, a set that shares fewer than
   ``1 + n // 16`` of its roots with others has no link, since the other set
   has three quarters of its size or more; that drops what only quotes a
   passage.
2. Sets are first compared in their ``LEAD`` first roots, which almost all
   sets that link share: large roots in parts of bounded size, dealt anew for
   some turns while that still merges components. So a group of thousands of
   near copies collapses without all its pairs.
3. Roots that hold several components then (one of those with the same sets
   is enough, and only sets in enough of them) are searched whole, in units
   of bounded size: the dual traversal of signature trees (``sigtree``) tells
   which sets of a unit may link with one of another component. A large root
   is cut into parts that meet pair by pair, each pair in a task of its own;
   roots of one greatest component are searched as one where that is less work.
4. The sets left are compared in full inside their unit (``setunits``); no
   pairs are handed on, only the components that links join.

Identical sets are one node (64-bit hash of the set); shingles are 64-bit
hashes. No documents, links or components pass the driver.

Null or empty text: an empty set, linked with nothing, its own component.
Fewer than five words: one shingle, the whole sequence. Rows that repeat a
``doc_id`` belong to one document's component each by its own text; a null
``doc_id`` takes part and never names a component. Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import setunits, sigtree
from .common import query, stored, table
from .words import SPACED, chunks, hashes, list_array, mix, spans

NGRAM = 5
FREQUENT_SHARE = 2000  # a shingle in more than one in so many documents is frequent ...
FREQUENT_LEAST = 64  # ... and in more than so many
COUNT_RUN = 1 << 22  # shingles a task counts at once
PERCENT = 75  # of the union, that sets which link share
LEAD = 4  # first roots of a set, for the first comparison
TURNS = 4  # deals of large roots there, at most
SALTS = 64  # parts of a frequent root where lonely sets are dropped
FILTER_BITS = 1 << 24  # of the filter in front of the second reading
_ORDER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F], np.uint64)


def shingle_sets(col: pa.Array, ngram: int = NGRAM) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of an Arrow column."""
    for row, buf, offs in chunks(col):
        starts, ends, first = spans(buf, offs, SPACED)
        w = hashes(buf, starts, ends)
        grams = np.zeros(max(0, len(w) - ngram + 1), np.uint64)
        for k in range(ngram):
            grams += w[k:k + len(grams)] * _ORDER[k]
        grams = mix(grams)
        for i in range(len(offs) - 1):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= ngram:
                s = np.sort(grams[lo:hi - ngram + 1])
                yield row + i, s[np.concatenate([[True], s[1:] != s[:-1]])]
            elif hi > lo:
                own = w[lo:hi] * _ORDER[:hi - lo]
                yield row + i, mix(own.sum(keepdims=True, dtype=np.uint64) + np.uint64(hi - lo))
            else:
                yield row + i, np.empty(0, np.uint64)


def set_id(members: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Sorted hashes of the frequent shingles: at most FREQUENT_SHARE times the mean set size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n_docs = [], 0, 0

        def counted():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(values[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["shingle", "n"])

        for batch in batches:
            for _, s in shingle_sets(batch.column(0)):
                held.append(s)
                size, n_docs = size + len(s), n_docs + 1
                if size >= COUNT_RUN:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    total = docs.count()
    least = max(FREQUENT_LEAST, total // FREQUENT_SHARE)
    often = (docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle")
             .agg(F.sum("n").alias("n")).where(F.col("n") > least).select("shingle"))
    return np.sort(often.toPandas()["shingle"].to_numpy(np.int64).view(np.uint64))


def read_sets(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(doc_id, key, fp, n, sig, early, early_frequent): the set's id, size and bitmap, and its roots.

    The bitmap and roots of a set that its task has seen before are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, seen = sent.value, set()
        for batch in batches:
            fp, n, sig, early, late = [], [], [], [], []
            none = np.empty(0, np.int64)
            for _, s in shingle_sets(batch.column(2)):
                fp.append(set_id(s))
                n.append(len(s))
                if fp[-1] in seen or not len(s):
                    sig.append(None)
                    early.append(none)
                    late.append(none)
                    continue
                seen.add(fp[-1])
                sig.append(sigtree.bitmap(s).tobytes())
                if len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    is_often = often[at] == s
                else:
                    is_often = np.zeros(len(s), bool)
                roots = len(s) // 4 + 1 + len(s) // 12
                early.append(s[~is_often][:roots].view(np.int64))
                late.append(s[is_often][:max(0, roots - len(early[-1]))].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(sig, pa.binary()), list_array(early, pa.int64()), list_array(late, pa.int64())],
                ["doc_id", "key", "fp", "n", "sig", "early", "early_frequent"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text").mapInArrow(
        run, "doc_id long, key long, fp long, n long, sig binary, early array<long>, early_frequent array<long>")


def row_key() -> Column:
    """What a text is found by again: its id, or its hash where that is null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def rooted(sets: DataFrame) -> DataFrame:
    """(node, fp, n, place): sets that share a root with another; ``place`` is the root's in the set's order.

    Frequent roots are salted; their rows are all kept.
    """
    light = sets.select(F.posexplode("early").alias("place", "node"), "fp", "n", F.lit(-1).alias("salt"))
    heavy = sets.select(F.posexplode("early_frequent").alias("place", "node"), "fp", "n",
                        F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int").alias("salt"), F.size("early").alias("before"))
    heavy = heavy.withColumn("place", F.col("place") + F.col("before"))
    rows = light.union(heavy.select(light.columns)).repartition("node", "salt").dropDuplicates(["node", "salt", "fp"])
    order = Window.partitionBy("node", "salt").orderBy("fp")
    near = rows.withColumn("lonely", F.lag("fp").over(order).isNull() & F.lead("fp").over(order).isNull())
    return near.where("NOT lonely OR salt >= 0").select("node", "fp", "n", "place")


def sharing_enough(rows: DataFrame) -> DataFrame:
    """The rows of sets that share enough roots to have a link at all."""
    enough = rows.groupBy("fp").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n")).where("c >= 1 + n div 16")
    return rows.join(enough.select("fp"), "fp", "left_semi")


def full_sets(docs: DataFrame, reps: DataFrame, ngram: int = NGRAM) -> DataFrame:
    """(fp, members) of the sets whose representative row is in ``reps(key, fp)``.

    A filter of bounded size keeps most other texts out of the shuffle.
    """
    spark = docs.sparkSession
    bit = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS)) + 1
    words = (reps.select(bit.alias("b"))
             .groupBy(F.bitmap_bucket_number("b").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).collect())  # 2 MB at most
    bits = np.zeros((FILTER_BITS // 32768, 4096), np.uint8)
    for r in words:
        bits[r.k - 1] = np.frombuffer(bytes(r.bits), np.uint8)
    sent = spark.sparkContext.broadcast(bits.reshape(-1))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.column(1).to_numpy(zero_copy_only=False)
            hit = (sent.value[b >> 3] >> (b & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(hit.astype(bool))).select(["key", "text"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, members = [], []
            want = batch.column(0).to_pylist()
            for row, s in shingle_sets(batch.column(1), ngram):
                if set_id(s) == want[row]:
                    fp.append(want[row])
                    members.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(fp, pa.int64()), pa.array(members, pa.binary())],
                                             ["fp", "members"])

    rows = docs.select(row_key().alias("key"), "text")
    rows = rows.select("key", (bit - 1).alias("b"), "text").mapInArrow(keep, "key long, text string")
    return rows.join(reps.hint("shuffle_hash"), "key").select("fp", "text").mapInArrow(
        parse, "fp long, members binary")


def distinct_roots(rows: DataFrame) -> DataFrame:
    """The rows of one root of those that hold the same sets."""
    own = [F.bit_xor(F.xxhash64("fp", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("c"), *own)
    return rows.join(nodes.groupBy("c", "x1", "x2").agg(F.min("node").alias("node")), "node", "left_semi")


def may_link(sig: np.ndarray, n: np.ndarray, comp: np.ndarray, side: np.ndarray, percent: int) -> np.ndarray:
    """The groups of a unit's rows that the pairs left by the dual traversal of its signature trees connect."""
    i = j = np.empty(0, np.int64)
    if (comp != comp[0]).any():
        i, j = sigtree.candidates(list(sig), n, comp, side if side.min() != side.max() else None)
        apart = comp[i] != comp[j]
        i, j = i[apart], j[apart]
    return setunits.grouped(len(n), i, j)


def united(rows: DataFrame) -> DataFrame:
    """``rows(node, fp, n, comp)`` of large mixed roots; those of one greatest component become one node, named by
    it, where comparing its sets with the others takes fewer pairs than in all the roots."""
    size = rows.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("c"))
    size = size.groupBy("node").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("k"))
    size = size.select("node", F.col("top.comp").alias("main"), "k", (F.col("k") * (F.col("k") - F.col("top.c"))).alias("w"))
    apart = size.groupBy("main").agg(F.sum("w").alias("apart"))
    one = rows.join(size.select("node", "main"), "node").groupBy("main", "fp").agg(
        F.first("n").alias("n"), F.first("comp").alias("comp"))
    whole = one.groupBy("main").agg(F.count(F.lit(1)).alias("k"), F.count_if(F.col("comp") != F.col("main")).alias("r"))
    unite = whole.join(apart, "main").where("k * r < apart").select("main")
    left = rows.join(size.join(unite, "main", "left_anti").select("node"), "node", "left_semi")
    return left.select("node", "fp", "n", "comp").union(
        one.join(unite, "main", "left_semi").select(F.col("main").alias("node"), "fp", "n", "comp"))


def join_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    sets = stored(read_sets(docs, frequent_shingles(docs)), "sets")
    nodes = sets.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"))
    rows = stored(sharing_enough(stored(rooted(sets), "roots")), "roots")
    sig = stored(setunits.among(sets.where("sig IS NOT NULL").select("fp", "n", "sig"), rows).dropDuplicates(["fp"]),
                 "bitmaps")
    reps = nodes.select("key", "fp")

    def found_in(units: DataFrame, own: DataFrame) -> DataFrame:
        return stored(setunits.candidates(units, own, PERCENT, may_link), "candidates")

    def linked(comp: DataFrame | None, found: DataFrame) -> DataFrame:
        return setunits.merged(comp, stored(setunits.edges(found, full, PERCENT), "edges"))

    first = stored(setunits.mixed(distinct_roots(rows.where(F.col("place") < LEAD)), None), "mixed")
    found = found_in(setunits.own_parts(first, 0), sig)
    wanted = found.select("fp").union(first.where("parts > 1").select("fp")).distinct()
    full = stored(full_sets(docs, reps.join(wanted, "fp", "left_semi")), "members")
    comp, left = linked(None, found), None
    for turn in range(1, TURNS):
        first = stored(setunits.mixed(first.where("parts > 1"), comp), "mixed")
        before, left = left, first.count()
        if not left or (before and 2 * left > before):
            break
        comp = linked(comp, found_in(setunits.own_parts(first, turn), setunits.among(sig, first)))

    # A set has enough roots in common with one of another component, and these are all mixed.
    rest = stored(sharing_enough(stored(setunits.mixed(rows, comp), "mixed")), "mixed")
    rest = stored(setunits.mixed(distinct_roots(rest), comp), "mixed")
    found = found_in(setunits.own_parts(rest.where("parts = 1"), 0).union(
        setunits.all_parts(united(rest.where("parts > 1")))), sig)
    missing = found.select("fp").distinct().join(full.select("fp"), "fp", "left_anti")
    full = full.union(stored(full_sets(docs, reps.join(missing, "fp", "left_semi")), "members"))
    comp = linked(comp, found)

    named = nodes.join(comp, "fp", "left").select("fp", "doc_id", F.coalesce("comp", "fp").alias("comp"))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "comp").select("fp", "component_id")
    out = sets.select("doc_id", "fp", "n").join(named, "fp")
    empty = F.col("n") == 0
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id names their component, with all their columns.

    Rows that share a ``doc_id`` stay or go together; those without one stay
    if one of them is in a component without any id.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    kept = join_components(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        key.alias("key")).distinct()
    return docs.select(key.alias("key"), F.struct("*").alias("row")).join(kept, "key", "left_semi").select("row.*")


@query("op1_ngram_join")
def op1(spark, sf_dir):
    return join_components(table(spark, sf_dir, "documents"))
