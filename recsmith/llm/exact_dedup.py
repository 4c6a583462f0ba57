"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so: at the first sentence end or
line end after ``MIN_CHUNK`` characters, at ``MAX_CHUNK`` at the latest. The
chunks of all documents form a dictionary in which a chunk's identifier is
its 64-bit hash, verified by SHA-256: chunks that share a hash but not the
digest get different ranks. A document's recipe is the ordered list of its
chunks' identifiers; texts are equal when the lists are. Only hashes and
recipes are shuffled, never a text.

Null text counts as empty; empty texts are equal to each other. Of rows that
repeat both ``doc_id`` and text, one is kept. Rows with a null ``doc_id``
take part; such a row is kept only if its group has no id at all. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_lower, query, table

MIN_CHUNK, MAX_CHUNK = 512, 4096
SALTS = 16


def chunk_pattern(low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> str:
    """Every character falls into one match, so the matches in order are the text."""
    return rf"(?s).{{{low},{high - 1}}}?(?:[.!?\n]|\z)|.{{1,{high}}}"


def chunk_refs(docs: DataFrame, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> DataFrame:
    """(doc_id, text_sha256, ord, h, sha, copies): the chunks of each distinct row; an empty text has one null chunk."""
    norm = docs.select("doc_id", ascii_lower(F.coalesce("text", F.lit(""))).alias("norm"))
    chunks = norm.select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"),
        F.regexp_extract_all("norm", F.lit(chunk_pattern(low, high)), F.lit(0)).alias("chunks"))
    refs = chunks.select("doc_id", "text_sha256", F.posexplode_outer("chunks").alias("ord", "chunk"))
    return refs.select(
        "doc_id", "text_sha256", "ord", F.xxhash64("chunk").alias("h"),
        F.unhex(F.sha2("chunk", 256)).alias("sha")).groupBy("doc_id", "text_sha256", "ord", "h", "sha").agg(
        F.count(F.lit(1)).alias("copies"))


def conflicting_chunks(refs: DataFrame) -> DataFrame:
    """(h, sha, rank) of chunks whose hash another chunk has already: n^2 / 2^65 rows for n distinct chunks."""
    known = refs.where(F.col("sha").isNotNull()).select("h", "sha").distinct()
    doubtful = known.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    ranked = known.join(doubtful, "h", "left_semi").withColumn(
        "rank", F.row_number().over(Window.partitionBy("h").orderBy("sha")) - 1)
    return ranked.where("rank > 0")


def recipes(docs: DataFrame, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> DataFrame:
    """(doc_id, text_sha256, recipe, copies), one row per distinct (doc_id, text)."""
    refs = chunk_refs(docs, low, high)
    # Broadcast: the birthday bound keeps it to some ten thousand rows even for 10^12 chunks.
    ids = refs.join(F.broadcast(conflicting_chunks(refs)), ["h", "sha"], "left")
    entry: Column = F.when(F.col("sha").isNotNull(), F.struct("ord", "h", F.coalesce("rank", F.lit(0)).alias("rank")))
    return ids.groupBy("doc_id", "text_sha256").agg(
        F.sort_array(F.collect_list(entry)).alias("recipe"), F.max("copies").alias("copies"))


def exact_groups(docs: DataFrame, low: int = MIN_CHUNK, high: int = MAX_CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = recipes(docs, low, high).withColumn("recipe", F.transform("recipe", lambda x: F.struct(x.h, x["rank"])))
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    # A group may hold a third of all rows: its one row goes to SALTS tasks, its members to one of them each.
    shared = groups.where("group_size > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    out = rows.join(shared, ["recipe", "salt"], "left").select(
        "doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), "text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def _row_key(doc_id: Column, text_sha256: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), text_sha256), 256)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one for each text, with all their columns."""
    kept = exact_groups(docs).where("kept").select(
        _row_key(F.col("doc_id"), F.col("text_sha256")).alias("key")).distinct()
    sha = F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256)
    rows = docs.select(_row_key(F.col("doc_id"), sha).alias("key"), F.struct("*").alias("row"))
    first = F.row_number().over(Window.partitionBy("key").orderBy("key"))  # rows that repeat id and text
    return rows.join(kept, "key", "left_semi").withColumn("no", first).where("no = 1").select("row.*")


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""


@query("op6_exact_dedup", SQL)
def op6(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))
