"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is its distinct word 3-grams. Sets link when
``100 * overlap >= 85 * union``; every link is confirmed on full sets.

A set has a minwise token for each of some hash functions: its member of
least hash. Each of ``TREES`` trees starts with all sets in one node and
branches recursively: a node sends a set to one child for each of ``BRANCH``
functions chosen for the node, named by the set's minwise token there. A node
of bounded size is compared exhaustively (``setunits``). A larger one is dealt
to parts of that size, each compared exhaustively, in ``TURNS`` turns at most
while that still merges components; if it then holds several components, it
branches. A child that kept more than half of a large parent, or is still
large at ``DEPTH``, would not get small by branching: all its pairs of
different components are compared, part by part.

Recall: two sets of similarity s share a child with probability s for each
function, so a tree of two branches a node keeps a pair of similarity 0.85
with probability 0.969 at least at any depth, and four trees miss it with
probability 1e-6. The functions are fixed, so a table gives the same result
at each run.

Null or empty text: an empty set, linked with nothing, its own component.
Fewer than three words: one shingle, the whole sequence. Rows that repeat a
``doc_id`` belong to a component each by its own text, and stay or go each by
that; a null ``doc_id`` takes part and never names a component, and is kept
only where its component has no id. Other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import setunits
from .common import query, stored, table
from .ngram_join import full_sets, row_key, set_id, shingle_sets
from .words import list_array, mix

NGRAM, PERCENT = 3, 85
TREES, BRANCH, DEPTH = 4, 2, 6
CHOICE = 4  # functions at each depth below the first, of which a node chooses BRANCH
TURNS = 3
FUNCTIONS = TREES * BRANCH + (DEPTH - 1) * CHOICE
_SEEDS = mix(np.arange(1, 2 * FUNCTIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, -1)
RUN = 1 << 14  # members hashed at once


def minwise(members: np.ndarray) -> np.ndarray:
    """The least hash of a set by each function; a function's hash is one-to-one, so it names the token."""
    best = np.full(FUNCTIONS, np.iinfo(np.uint64).max, np.uint64)
    for s in range(0, len(members), RUN):
        h = (members[None, s:s + RUN] ^ _SEEDS[0][:, None]) * (_SEEDS[1][:, None] | np.uint64(1))
        np.minimum(best, (h ^ (h >> np.uint64(32))).min(axis=1), out=best)
    return best.view(np.int64)


def read_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp, n, sig, tokens): the set's id, size, bitmap and minwise tokens.

    The bitmap and tokens of a set that its task has seen before are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fp, n, sig, tokens = [], [], [], []
            for _, s in shingle_sets(batch.column(2), NGRAM):
                fp.append(set_id(s))
                n.append(len(s))
                new = len(s) and fp[-1] not in seen
                seen.add(fp[-1])
                sig.append(setunits.bitmap(s) if new else None)
                tokens.append(minwise(s) if new else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(sig, pa.binary()), list_array(tokens, pa.int64())],
                ["doc_id", "key", "fp", "n", "sig", "tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text").mapInArrow(
        run, "doc_id long, key long, fp long, n long, sig binary, tokens array<long>")


def first_nodes(sets: DataFrame) -> DataFrame:
    """(node, fp, n): the children of each tree's root that hold several sets, one of those that hold the same."""
    at = F.posexplode(F.slice("tokens", 1, TREES * BRANCH)).alias("f", "token")
    rows = sets.select("fp", "n", at).select(F.xxhash64("f", "token").alias("node"), "fp", "n")
    rows = stored(rows.groupBy("node", "fp").agg(F.first("n").alias("n")), "nodes")
    own = [F.bit_xor(F.xxhash64("fp", F.lit(k))).alias(f"x{k}") for k in (1, 2)]
    nodes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("k"), *own).where("k > 1")
    return rows.join(nodes.groupBy("k", "x1", "x2").agg(F.min("node").alias("node")), "node", "left_semi")


def known(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """(fp, n, sig, tokens) of the sets in ``rows(fp)``; only theirs are shuffled."""
    return setunits.among(sets.where("sig IS NOT NULL"), rows).select("fp", "n", "sig", "tokens").dropDuplicates(["fp"])


def children(rows: DataFrame, tokens: DataFrame, depth: int) -> DataFrame:
    """(node, fp, n, above): the nodes at ``depth``, by the functions their parents choose; ``above`` is the parent's size."""
    base = TREES * BRANCH + (depth - 1) * CHOICE + 1
    first = F.pmod(F.xxhash64("node"), F.lit(CHOICE))
    rows = rows.join(tokens, "fp").select(
        "fp", "n", F.col("k").alias("above"), "node", "tokens",
        F.explode(F.array(*[F.pmod(first + b, F.lit(CHOICE)).cast("int") for b in range(BRANCH)])).alias("f"))
    node = F.xxhash64("node", "f", F.element_at("tokens", F.col("f") + F.lit(base)))
    return rows.select(node.alias("node"), "fp", "n", "above")


def join_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    sets = stored(read_sets(docs), "sets")
    names = sets.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"))
    now = stored(setunits.mixed(stored(first_nodes(sets), "nodes"), None, apart=True), "mixed")
    found = stored(setunits.candidates(setunits.own_parts(now, 0), known(sets, now).drop("tokens"), PERCENT), "candidates")
    wanted = found.select("fp").union(now.where("parts > 1").select("fp")).distinct()
    full = stored(full_sets(docs, names.select("key", "fp").join(wanted, "fp", "left_semi"), NGRAM), "members")
    comp = setunits.merged(None, stored(setunits.edges(found, full, PERCENT), "edges"))

    def compared(comp: DataFrame, units: DataFrame) -> DataFrame:
        found = stored(setunits.candidates(units, some.select("fp", "n", "sig"), PERCENT), "candidates")
        return setunits.merged(comp, stored(setunits.edges(found, full, PERCENT), "edges"))

    large = now.where("parts > 1")
    for depth in range(1, DEPTH + 1):
        large, left = stored(setunits.mixed(large, comp, apart=True), "mixed"), None
        if large.isEmpty():
            break
        some = stored(known(sets, large), "known")  # the rest of the search is among these
        for turn in range(1, TURNS):
            before, left = left, large.count()
            if not left or (before and 2 * left > before):
                break
            comp = compared(comp, setunits.own_parts(large, depth * TURNS + turn))
            large = stored(setunits.mixed(large, comp, apart=True), "mixed")
        if large.isEmpty():
            break
        if depth == DEPTH:
            comp = compared(comp, setunits.all_parts(large))
            break
        below = stored(children(large, some.select("fp", "tokens"), depth), "nodes")
        whole = (F.col("parts") > 1) & (2 * F.col("k") > F.col("above"))
        now = stored(setunits.mixed(below, comp, "above", apart=True).withColumn("whole", whole), "mixed")
        comp = compared(comp, setunits.own_parts(now.where("NOT whole"), depth * TURNS).union(
            setunits.all_parts(now.where("whole"))))
        large = now.where("parts > 1 AND NOT whole")

    named = names.join(comp, "fp", "left").select("fp", "doc_id", F.coalesce("comp", "fp").alias("comp"))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    out = sets.select("doc_id", "fp", "n").join(named.join(least, "comp").select("fp", "component_id"), "fp")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.col("doc_id").eqNullSafe(own).alias("kept"))


_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')")
SQL = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
          FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS i FROM docs WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM grams x JOIN grams y USING (g)
                            GROUP BY x.doc_id, y.doc_id) p JOIN size s ON s.doc_id = a JOIN size t ON t.doc_id = b
          WHERE 100 * o >= 85 * (s.n + t.n - o)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM size UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)
"""


@query("op12_chosen_path", SQL)
def op12(spark, sf_dir):
    return join_components(table(spark, sf_dir, "documents"))
